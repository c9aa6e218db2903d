import numpy as np
import pyarrow as pa
import zlib

from gridcast.llm import quality_classifier as q

SCHEMA = "doc_id long, text string, _label string"


def texts(n=300):
    good = "The quick brown fox jumps over a lazy dog. Then it sleeps under some old tree {} times."
    return [(i, good.format(i) * (1 + i % 3) if i % 2 else f"BUY!! NOW!! {i} | # $$$ " * 5, "x") for i in range(n)]


def test_held_out_rows_are_told_apart(spark):
    rows = texts()
    docs = spark.createDataFrame(rows, SCHEMA)
    labels = spark.createDataFrame([(i, i % 2, 0) for i, *_ in rows], "doc_id long, quality int, text int")
    got = q.classify(docs, labels).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert r.predicted == r.doc_id % 2 == (r.score >= 0.5) and 0 <= r.score <= 1


def test_held_out_labels_are_not_learnt_from(spark):
    rows = texts()
    docs = spark.createDataFrame(rows, SCHEMA)
    true = [(i, i % 2) for i, *_ in rows]
    turned = [(i, 1 - y if zlib.crc32(str(i).encode()) % 3 == 1 else y) for i, y in true]
    a, b = (q.train(docs, spark.createDataFrame(x, "doc_id long, quality int")) for x in (true, turned))
    assert np.array_equal(a.weights, b.weights) and a.threshold == b.threshold


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, "a"), (2, "", "b"), (None, "x " * 50_000, None), (4, "one", "c"), (4, "one", "c")], SCHEMA)
    none = spark.createDataFrame([(1, None), (None, 1), (9, 1)], "doc_id long, quality int")
    got = q.classify(docs, none).collect()
    assert len(got) == 5 and {r.score for r in got} == {0.5} and not any(r.held_out for r in got if r.doc_id is None)
    assert q.classify(docs.limit(0), none).count() == 0


def test_features_do_not_depend_on_the_batch():
    column = pa.array([t.encode() for _, t, _ in texts(40)] + [b"", b"\n"], pa.binary())
    alone = np.concatenate([q._features_of(column.slice(i, 1)) for i in range(len(column))])
    assert np.allclose(q._features_of(column), alone) and not alone[-2].any()


def brute(x, label):
    """The ranking from every pair, made one by one."""
    center, scale = x.mean(0), np.maximum(x.std(0), 1e-6)
    z = (x - center) / scale
    d = (z[label == 1][:, None] - z[label == 0][None]).reshape(-1, x.shape[1])
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(np.clip(d @ w, -500, 500)))
        curve = (d * (p * (1 - p))[:, None]).T @ d / len(d) + q.RIDGE * np.eye(len(w))
        w = w - np.linalg.solve(curve, q.RIDGE * w - (d * p[:, None]).mean(0))
    raw, bad = np.sort(z @ w), np.count_nonzero(label == 0)
    k = max(range(max(1, bad - len(raw) // 200), min(len(raw) - 1, bad + len(raw) // 200) + 1), key=lambda k: raw[k] - raw[k - 1])
    return w, (raw[k - 1] + raw[k]) / 2


def test_every_labelled_row_and_every_pair_counts(spark):
    draw = np.random.default_rng(1)
    words = ["stone", "Tree", "BUY", "42", "a", "#!", "|", "river.", "née"]
    rows, labels = [], []
    for i in range(1200):
        good = int(draw.random() < 0.4)
        share = np.r_[np.full(4, 1.0 + 0.5 * good), np.full(5, 1.5 - 0.5 * good)]
        rows.append((i, " ".join(draw.choice(words, draw.integers(5, 60), p=share / share.sum())), "x"))
        labels += [(i, good)] * (1 + (i % 10 == 0))
    docs, known = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, "doc_id long, quality int")
    learnt = [(i, y) for i, y in labels if zlib.crc32(str(i).encode()) % 3 != 1]
    x = q._features_of(pa.array([rows[i][1].encode() for i, _ in learnt], pa.binary()))
    label = np.array([y for _, y in learnt])
    assert label.sum() * (1 - label).sum() > 60_000
    weights, threshold = brute(x, label)
    got = q.train(docs, known)
    assert np.allclose(got.weights, weights, atol=1e-7) and np.isclose(got.threshold, threshold, atol=1e-7)


def test_threshold_among_equal_scores(spark):
    x = np.zeros((600, len(q.FEATURES)))
    x[:, 0] = np.repeat([1.0, 2.0, 4.0], [100, 400, 100])
    rows = [(0, 1, r.tolist()) for r in x]
    examples = spark.createDataFrame(rows, "_label int, _n long, x array<double>")
    ranking = q.Ranking(np.zeros(len(q.FEATURES)), np.ones(len(q.FEATURES)), np.eye(len(q.FEATURES))[0], 0.0)
    assert [q.widest_gap(examples, ranking, bad, 600) for bad in (99, 300, 502, 505)] == [1.5, 2.0, 3.0, 4.0]


def test_the_threshold_starts_no_other_python_workers(spark, monkeypatch):
    """createDataFrame would: its rows go through workers of RDDs, beside those of DataFrames."""
    x = np.zeros((8, len(q.FEATURES)))
    x[:, 0] = [0.1, 0.3, 0.7, 1.9, 2.0, 2.1, 2.2, 1e-7]
    examples = spark.createDataFrame([(0, 2**33, r.tolist()) for r in x], "_label int, _n long, x array<double>").repartition(3)
    ranking = q.Ranking(np.zeros(len(q.FEATURES)), np.ones(len(q.FEATURES)), np.eye(len(q.FEATURES))[0], 0.0)

    def none(*_, **__):
        raise AssertionError("rows from the driver")

    monkeypatch.setattr(type(spark), "createDataFrame", none)
    assert q.widest_gap(examples, ranking, 4 * 2**33, 8 * 2**33) == (0.7 + 1.9) / 2
