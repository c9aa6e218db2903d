import random

import pytest

from gridcast.llm.passage_dedup import COVER, PERIOD, is_cover, remove_passages
from tests.llm.brute import repeats_in_words

SCHEMA = "doc_id long, text string, block string"


def noisy(seed=2, n=60):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefé") for _ in range(r.randint(1, 6)))
    shared = [[word() for _ in range(r.randint(30, 160))] for _ in range(8)]
    docs = []
    for i in range(n):
        ws = []
        for _ in range(r.randint(0, 5)):
            s = r.choice(shared)
            ws += s[r.randint(0, 20) :] if r.random() < 0.6 else [word() for _ in range(r.randint(0, 70))]
        docs.append((i * 7 % n, "".join(w + r.choice([" ", "\n", "\t ", "\x0b"]) for w in ws)))
    docs += [(1000 + i, docs[i % 7][1]) for i in range(9)]
    docs += [(2000, "a " * 300), (2001, "a b " * 200), (2002, "a " * 49), (2003, "a a " * 60), (2004, "b a " * 90)]
    docs += [(3000, None), (3001, ""), (3002, " \n "), (None, " ".join(shared[0])), (None, " ".join(shared[0])), (5, docs[5][1]), (5, " ".join(shared[1]))]
    return docs


def test_cover():
    assert is_cover(COVER, PERIOD) and not is_cover(COVER[:5], PERIOD)


@pytest.mark.parametrize("block_bytes", [1 << 30, 4000])
def test_equals_brute_force(spark, block_bytes):
    docs = noisy()
    df = spark.createDataFrame([(i, t, "x") for i, t in docs], SCHEMA)
    got = sorted([tuple(r) for r in remove_passages(df, block_bytes=block_bytes).collect()], key=str)
    want = repeats_in_words(docs)
    assert got == want and sum(r[2] for r in got) > 1000


def test_empty_table(spark):
    assert remove_passages(spark.createDataFrame([], SCHEMA)).count() == 0
