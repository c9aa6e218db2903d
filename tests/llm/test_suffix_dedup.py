import random
import re
import tracemalloc
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

import pytest

from gridcast.llm import blocks as B
from gridcast.llm import suffix_dedup
from gridcast.llm.suffix_dedup import remove_repeats
from tests.llm.brute import repeats_in_bytes

SCHEMA = "doc_id long, text string, lang string, block int"


def noisy(seed=1, n=60):
    """Documents that share passages of 30 to 400 characters, with copies, periodic texts, ties and nulls."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abé") for _ in range(r.randint(1, 5)))
    shared = [" ".join(word() for _ in range(r.randint(8, 90))) for _ in range(8)]
    docs = []
    for i in range(n):
        parts = [r.choice(shared) if r.random() < 0.5 else " ".join(word() for _ in range(r.randint(0, 60))) for _ in range(r.randint(0, 5))]
        docs.append((i * 3 % n, r.choice(["\n", " ", ""]).join(parts)))
    docs += [(1000 + i, docs[i % 7][1]) for i in range(9)]  # copies
    docs += [(2000, "ab" * 300), (2001, "ab" * 200), (2002, "a" * 49), (2003, "a" * 50), (2004, "a" * 51), (2005, "x" + "a" * 60)]
    docs += [(3000, None), (3001, ""), (None, shared[0] * 2), (None, shared[0]), (5, docs[5][1]), (5, shared[1])]
    return docs


@pytest.mark.parametrize(("block_bytes", "hot"), [(1 << 30, 4096), (3000, 4096), (3000, 3)])
def test_equals_brute_force(spark, block_bytes, hot):
    docs = noisy()
    df = spark.createDataFrame([(i, t, "x", 7) for i, t in docs], SCHEMA)
    got = sorted([tuple(r) for r in remove_repeats(df, block_bytes=block_bytes, hot=hot).collect()], key=str)
    assert got == repeats_in_bytes(docs)


def test_empty_table(spark):
    assert remove_repeats(spark.createDataFrame([], SCHEMA)).count() == 0


def test_carries_columns_and_text(spark):
    text = "é" * 40 + " end"
    df = spark.createDataFrame([(1, text, "en", 3), (2, "x" + text, None, None), (3, None, None, None)], SCHEMA)
    rows = {r.doc_id: r for r in remove_repeats(df, keep_text=True, carry=("lang", "block")).collect()}
    assert rows[1].kept_text == text and rows[1]._c_lang == "en" and rows[1]._c_block == 3
    assert rows[2].kept_text == "x" and rows[2].n_spans == 1
    assert rows[3].kept_text == "" and rows[3].n_bytes == 0


def test_buckets_are_even():
    r = np.random.default_rng(5)
    data = r.integers(97, 123, 1 << 20).astype(np.uint8)
    gram = suffix_dedup._all_anchors(data, np.arange(0, len(data) + 1, 4096))[-1]
    for buckets in (10, 128):
        n = np.bincount(B.bucket_of(gram, buckets), minlength=buckets)
        assert n.max() < 2 * len(gram) / buckets and n.min() > 0


@pytest.mark.parametrize("hot", [4096, 3])
def test_a_block_sends_a_frequent_string_once(hot):
    """However many documents have a passage, the run of a block has one entry for each of its suffixes."""
    r = random.Random(3)
    passage = "".join(r.choice("abcdef ") for _ in range(200))

    def sent(copies):
        texts = [passage.encode()] * copies
        table = pa.table({"block": pa.array([0] * copies, pa.int32()), "doc_id": list(range(copies)), "text": pa.array(texts, pa.binary()), "order": [0] * copies})
        *_, doc, gram = suffix_dedup._all_anchors(*B.flat(table))
        marks = B.marks_of(0, gram, doc, 1)
        states = B.states_of(marks, hot)
        runs = suffix_dedup._send_runs(table, states, 1, [])
        return sum(len(B.unpack(x)[0]) for x in runs.column("run").to_pylist()), runs

    few, _ = sent(50)
    many, runs = sent(3000)
    assert many <= few + 27 * 3000 * 151 // suffix_dedup.MOST  # a cut between runs may part the strings of an anchor
    answers = suffix_dedup._merge_range(runs.filter(pc.equal(runs.column("kind"), runs.column("kind")[0])).append_column("x", runs.column("range")))
    assert sum(len(B.unpack(x)) for x in answers.column("answers").to_pylist()) < 32 * 20 * 200


def test_blocks_are_shuffled_once(spark):
    df = spark.createDataFrame([(i, "some text " * i, "x", 7) for i in range(50)], SCHEMA)
    plan = remove_repeats(df, block_bytes=2000)
    plan.collect()
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("ReusedExchange") == 2


def test_a_cut_takes_few_bytes_for_each_of_the_text(spark):
    n = 1 << 20
    text = np.random.default_rng(2).integers(97, 123, n, np.uint8).tobytes()
    table = pa.table({"doc_id": [1, 2], "order": [1, 2], "text": pa.array([text[:9], text[9:]], pa.binary())})
    answers = pa.table({"kind": pa.array([], pa.int32()), "answers": pa.array([], pa.binary())})
    suffix_dedup._cut(table, answers, True)
    tracemalloc.start()
    out = suffix_dedup._cut(table, answers, True)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert out.column("n_bytes").to_pylist() == [9, n - 9] and out.column("n_removed").to_pylist() == out.column("n_spans").to_pylist() == [0, 0]
    assert most < 15 * n


def test_workers_give_back_what_they_have_freed(monkeypatch):
    def resident():
        return int(re.search(r"VmRSS:\s+(\d+)", Path("/proc/self/status").read_text())[1]) >> 10

    np.ones(30 << 17)  # from here on glibc keeps arrays of up to 30 MB in its heap
    arrays = [np.ones(1 << 17) for _ in range(200)]
    kept = arrays[::40]
    del arrays
    before = resident()
    B.give_back()
    assert len(kept) == 5 and before - resident() > 100
    told = []
    monkeypatch.setattr(B, "give_back", lambda: told.append(1))
    assert list(B.by_batch(lambda batches: (2 * b for b in batches))([1, 2])) == [2, 4] and told == [1]
    assert B.by_group(lambda t: -t)(1) == -1 and B.by_cogroup(lambda t, s: t + s)(1, 2) == 3 and told == [1, 1, 1]
