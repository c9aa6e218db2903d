import random

import pytest

from gridcast.llm.components import components
from gridcast.llm.ngram_join import bands_for, similar
from tests.llm.brute import WORD

SCHEMA = "doc_id long, text string, node string, label int"


def brute(docs, n=5, t=0.8):
    sets = []
    for _, text in docs:
        w = WORD.findall(text or "")
        sets.append({tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set())
    m = len(docs)
    root = list(range(m))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    links = [0] * m
    for i in range(m):
        for j in range(i):
            if sets[i] and 1000 * len(sets[i] & sets[j]) >= round(t * 1000) * len(sets[i] | sets[j]):
                links[i] += 1
                links[j] += 1
                root[find(i)] = find(j)
    least = lambda same: min((docs[j][0] for j in range(m) if same(j) and docs[j][0] is not None), default=None)
    out = []
    for i in range(m):
        if not sets[i]:
            out.append((docs[i][0],) * 3 + (0,))
        else:
            r = find(i)
            out.append((docs[i][0], least(lambda j: find(j) == r and sets[j]), least(lambda j: sets[j] == sets[i]), links[i]))  # noqa: B023
    return sorted(out, key=str)


def noisy(seed=4, families=12):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefghé") for _ in range(r.randint(2, 7)))
    docs = []
    for f in range(families):
        base = [word() for _ in range(r.randint(6, 120))]
        for _ in range(40 if f == 0 else r.randint(1, 9)):
            w = list(base)
            for _ in range(r.randint(0, max(1, len(w) // 40))):
                w[r.randrange(len(w))] = word()
            docs.append(" ".join(w))
    docs += docs[:5] + ["one", "one", "one two three", "one two three four five", None, "", " \n", "x " * 3000, "x " * 3001]
    r.shuffle(docs)
    rows = list(enumerate(docs))
    return rows + [(None, docs[3]), (None, "only nulls have this text here"), (None, "only nulls have this text here"), (7, docs[9]), (7, docs[7])]


@pytest.mark.parametrize("chunk", [128, 5])
def test_equals_brute_force(spark, chunk):
    docs = noisy()
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], SCHEMA)
    got = sorted([tuple(r) for r in similar(df, chunk=chunk).collect()], key=str)
    assert got == brute(docs) and max(r[3] for r in got) > 20


def test_empty_tables(spark):
    assert similar(spark.createDataFrame([], SCHEMA)).count() == 0
    assert [tuple(r) for r in similar(spark.createDataFrame([(1, None, "", 1)], SCHEMA)).collect()] == [(1, 1, 1, 0)]


def test_bands():
    bands, rows = bands_for(0.8, 0.9999, 140)
    assert bands * rows <= 140 and 1 - (1 - 0.8**rows) ** bands >= 0.9999


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(50)]
    got = dict(components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {i: 0 for i in range(41)} | {100 + i: 100 for i in range(50)}
