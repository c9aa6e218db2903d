"""Every stage of the pipeline against a plain version on one small corpus, and the whole on odd rows."""

import zlib

import pytest

import corpus_pipeline as c
from gridcast.llm import quality_classifier
from tests.llm.brute import WORD, repeats_in_bytes
from tests.llm.test_ngram_join import brute as near_copies

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def stages(spark, sf_dir, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("pipeline"))
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = [docs.collect()]
    for k, (_, f) in enumerate(c.STAGES):
        f(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
        out.append(docs.collect())
    return out


def test_columns(stages):
    assert all(set(rows[0].__fields__) == set(c.COLUMNS) for rows in stages[:-1])


def test_classifier_keeps_what_it_scores_high(spark, sf_dir, stages):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    good = {r.doc_id for r in quality_classifier.classify(docs, labels).collect() if r.predicted}
    assert {r.doc_id for r in stages[1]} == good
    unseen = [r for r in labels.collect() if zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    assert sum((r.doc_id in good) == bool(r.quality) for r in unseen) >= 0.95 * len(unseen)


def test_one_document_of_a_class_stays(stages):
    rows = near_copies([(r.doc_id, r.text) for r in stages[1]])
    assert {r.doc_id for r in stages[2]} == {i for i, leader, *_ in rows if i == leader}
    assert 0 < len(stages[2]) < len(stages[1])


def test_repeated_bytes_go(stages):
    want = {i: (n, gone) for i, n, gone, *_ in repeats_in_bytes([(r.doc_id, r.text) for r in stages[2]])}
    got = {r.doc_id: r for r in stages[3]}
    assert set(got) == {i for i, (n, gone) in want.items() if gone < n or n == 0}
    for r in stages[2]:
        n, gone = want[r.doc_id]
        if r.doc_id in got:
            text = got[r.doc_id].text
            assert (text == r.text) == (gone == 0) and got[r.doc_id].n_chars == (len(text) if gone else r.n_chars)
            assert n - gone - 6 * 3 <= len(text.encode()) <= n - gone
    assert any(gone for _, gone in want.values())


def test_sources_come_near_their_targets(stages):
    size, taken, largest = {}, {}, {}
    for r in stages[3]:
        n = len(WORD.findall(r.text))
        size[r.source] = size.get(r.source, 0) + n
        largest[r.source] = max(largest.get(r.source, 0), n)
    for r in stages[4]:
        taken[r.source] = taken.get(r.source, 0) + len(WORD.findall(r.text))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sorted(size))}
    target, free, left = {}, set(size), sum(size.values())
    while True:
        over = {s for s in free if 3 * size[s] < left * weight[s] / sum(weight[x] for x in free)}
        if not over:
            break
        for s in over:
            target[s] = 3 * size[s]
            left -= target[s]
        free -= over
    target |= {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
    for s in size:
        assert abs(taken.get(s, 0) - target[s]) <= largest[s]


def test_pieces_are_lossless(stages):
    assert len(stages[5]) == len(stages[4]) and all(r.lossless for r in stages[5])


def test_odd_rows(spark, tmp_path):
    good = "A plain sentence about the weather in spring follows another one of its kind here, number {}."
    rows = [(i, good.format(i * 7919) * 3, "en", f"s{i % 3}", 1) for i in range(30)]
    rows += [(100, None, None, None, None), (101, "", "en", "s1", 0), (None, good.format("none") * 3, "en", None, 5), (3, rows[3][1], "en", "s0", 1)]
    rows += [(200 + i, "!! ## || " * 40, "en", "s2", 2) for i in range(20)] + [(300, "é" * 200_000, "fr", "s1", 3)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(r[0], int(i < 30)) for i, r in enumerate(rows) if r[0] is not None and r[0] < 300]
    spark.createDataFrame(labels, "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    out = c.run(spark, str(tmp_path)).collect()
    assert out and all(r.lossless for r in out) and not any(200 <= (r.doc_id or 0) < 220 for r in out)
    empty = tmp_path / "empty"
    spark.createDataFrame([], SCHEMA).write.parquet(f"{empty}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int").write.parquet(f"{empty}/labels.parquet")
    assert c.run(spark, str(empty)).count() == 0


def test_classes_are_of_texts_not_of_ids(spark):
    line = lambda k: " ".join(f"word{k}x{i}" for i in range(60))
    rows = [(7, line(1)), (7, line(2)), (7, line(2)), (8, line(2) + " end"), (9, line(9))]  # one id, unlike texts
    rows += [(None, line(3)), (None, line(3)), (None, line(3) + " end"), (None, line(4)), (None, line(9)), (None, line(9) + " end")]
    rows += [(None, None), (None, " "), (5, ""), (5, "")]
    out = c.deduplicate(spark, spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], SCHEMA), "").collect()
    class_of = lambda t: " ".join((t or "").split()[:60])
    got = sorted([(r.doc_id, class_of(r.text)) for r in out], key=str)
    assert got == sorted([(7, line(1)), (7, line(2)), (9, line(9)), (None, line(3)), (None, line(4)), (None, ""), (None, ""), (5, ""), (5, "")], key=str)
