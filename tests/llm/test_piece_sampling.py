import collections
import math
import tracemalloc

import numpy as np
import pytest

from gridcast.llm import piece_sampling as p

SCHEMA = "doc_id long, text string, pieces int"
ODD = ["", " ", "   ", "a", " a  b ", "▁", "▁ ▁a", "tab\tand\nline\r\n", "日本語 と 🙂🙂", "\x00\x01", "é" * 300, "x" * 5000, "the cat sat on the mat " * 2000, "ﬁ ½ ①", "ñandú été ß"]


@pytest.fixture(scope="module")
def lattice():
    return p.Lattice(p.load_pieces())


def test_lossless_reproducible_and_seeded_by_key(spark):
    rows = list(enumerate(ODD)) + [(None, "no id"), (50, None), (3, "a a a"), (3, "a a a")]
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], SCHEMA)
    once = p.round_trip(docs).collect()
    again = p.round_trip(docs.repartition(7)).collect()
    assert all(r.lossless for r in once) and len(once) == len(rows)
    key = lambda r: (str(r.doc_id), str(r.pieces))
    assert sorted(map(key, once)) == sorted(map(key, again))
    assert [r.pieces for r in once if r.doc_id == 50] == [None] and [r.pieces for r in once if r.doc_id == 0] == [[]]
    text = ODD[12]
    pair = {r.doc_id: r.pieces for r in p.encode(spark.createDataFrame([(1, text, 0), (2, text, 0)], SCHEMA)).collect()}
    assert pair[1] != pair[2]
    assert p.round_trip(docs.limit(0)).count() == 0


def test_the_batch_does_not_matter(lattice):
    keys = np.arange(len(ODD), dtype=np.uint64)
    ids, sizes = lattice.sample(ODD, keys)
    alone = [lattice.sample([t], keys[i : i + 1])[0].tolist() for i, t in enumerate(ODD)]
    ends = np.r_[0, np.cumsum(sizes)]
    assert alone == [ids[i:j].tolist() for i, j in zip(ends, ends[1:])]


LONG = {
    "words": "The quick brown fox, jumps over it. " * 40,
    "no spaces": "日本語のテキスト🙂ñé" * 120,
    "one character": "x" * 3000,
    "spaces": " " * 2500 + "end",
    "mixed": "a" * 900 + " 日本 " * 200 + "\x00▁" * 100 + "z" * 700,
}


@pytest.mark.parametrize("name", LONG)
@pytest.mark.parametrize("size", [64, 257, 1000])
def test_parts_of_a_long_text_have_its_pieces(lattice, monkeypatch, name, size):
    key, text = np.array([77], np.uint64), LONG[name]
    whole = lattice.sample([text], key)[0].tolist()
    monkeypatch.setattr(p, "BATCH_CHARS", size)
    monkeypatch.setattr(p, "CUT_CHARS", 50)
    assert lattice.sample_long(text, key).tolist() == whole
    assert lattice.decode(np.array(whole)) == text
    ends = [0]
    while ends[-1] < len(text) and len(text) - ends[-1] > size:
        ends.append(lattice.cut(text, ends[-1]))
    if name in ("words", "no spaces"):
        assert len(ends) > 1 and max(np.diff(ends)) <= size


def test_a_long_text_needs_memory_for_a_part(lattice):
    text = "The quick brown fox jumps over the lazy dog, and 日本. " * 75_000  # 4 million characters, a gigabyte at once
    tracemalloc.start()
    try:
        ids = lattice.sample_long(text, np.array([5], np.uint64))
        sampled = tracemalloc.get_traced_memory()[1]
        assert lattice.decode(ids) == text
    finally:
        tracemalloc.stop()
    assert sampled < 200 << 20


def test_a_long_row_among_short_ones(spark):
    text = "many words of a very long text, line by line\n" * 9_000
    docs = spark.createDataFrame([(1, "short", 0), (2, text, 0), (None, text, 0), (4, None, 0)], SCHEMA).coalesce(1)
    got = p.round_trip(docs).collect()
    assert len(text) > p.BATCH_CHARS and all(r.lossless for r in got) and len(got) == 4
    long = {r.doc_id: r.pieces for r in got}
    assert long[2] != long[None] and len(long[2]) > 9_000 and long[4] is None


@pytest.mark.parametrize("text", ["hello", "atan", "  ab"])
def test_frequencies_follow_the_weights(lattice, text):
    words = {x.replace(p.SPACE, " "): i for i, (x, _, k) in enumerate(p.load_pieces()) if k == "piece"}

    def paths(s):
        if not s:
            return [((), 0.0)]
        return [((*left, words[s[i:]]), w + lattice.weight[words[s[i:]]]) for i in range(len(s)) if s[i:] in words for left, w in paths(s[:i])]

    weight = {ids: math.exp(w) for ids, w in paths(" " + text)}
    total, n = sum(weight.values()), 40_000
    ids, sizes = lattice.sample([text] * n, p.mix(np.arange(n, dtype=np.uint64)))
    ends = np.r_[0, np.cumsum(sizes)]
    seen = collections.Counter(tuple(ids[i:j].tolist()) for i, j in zip(ends, ends[1:]))
    assert len(weight) > 3 and seen.keys() <= weight.keys()
    for path, w in weight.items():
        share = w / total
        assert abs(seen[path] / n - share) < 5 * math.sqrt(share / n) + 1e-3


def test_one_worker_a_task_encodes_and_decodes(spark):
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(ODD)] + [(50, None, 1)], SCHEMA)
    once = p.round_trip(docs)
    assert once._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    apart = p.decode(p.encode(docs)).collect()
    assert {r.doc_id: (r.pieces, r.lossless) for r in once.collect()} == {r.doc_id: (r.pieces, r.decoded == r.text) for r in apart}
