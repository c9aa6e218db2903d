import random

import pytest

from gridcast.llm.exact_search import search, vectors_of

SCHEMA = "vec_id long, embedding array<float>, v string, score int"


def brute(rows, k):
    fine = [(i, tuple(v)) for i, v in rows if i is not None and v is not None and all(x is not None and abs(x) < float("inf") for x in v)]
    whole = [(i, [int(1024 * x // 1) for x in v]) for i, v in fine]
    out = []
    for i, q in {(i, tuple(v)) for i, v in whole}:
        if i % 4:
            continue
        dots = sorted((-min(max(sum(a * b for a, b in zip(q, x)), -(2**63)), 2**63 - 1), j) for j, x in whole if j != i)
        out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(dots[:k])]
    return sorted(out)


def run(spark, rows, k=5, **sizes):
    vectors = vectors_of(spark.createDataFrame([(i, v, "x", 1) for i, v in rows], SCHEMA))
    return sorted(tuple(r) for r in search(vectors, vectors.where("vec_id % 4 = 0"), k, **sizes).collect())


@pytest.mark.parametrize("sizes", [{}, {"query_block": 7, "candidate_block": 11, "pivots": 3}])
def test_equals_brute_force(spark, sizes):
    r = random.Random(3)
    rows = [(i, [r.choice([0.0, 0.5, -0.25, r.random()]) for _ in range(6)]) for i in range(120)]
    rows += [(200 + i, rows[0][1]) for i in range(40)]  # one very common vector
    rows += [(300, None), (301, [1.0, None]), (302, [float("nan")] * 6), (304, [float("inf")] * 6), (None, rows[0][1]), rows[4], (4, rows[5][1])]
    rows += [(401, [2.0] * 6)] * 9  # rows alike take a place each
    assert run(spark, rows, **sizes) == brute(rows, 5)


def test_few_rows_short_and_large_vectors(spark):
    rows = [(0, [1.0, 2.0]), (4, [3.0]), (5, []), (8, [1e30, -1e30]), (9, [1e30, 3e9])]
    assert run(spark, rows) == brute(rows, 5)
    assert run(spark, []) == [] and run(spark, rows[:1]) == []
