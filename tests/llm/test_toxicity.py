import zlib

import numpy as np
import pyarrow as pa

from gridcast.llm import toxicity as x

SCHEMA = "doc_id long, text string, _score string"


def held(i):
    return zlib.crc32(str(i).encode()) % 3 == 1


def texts(n=600):
    r = np.random.default_rng(3)
    words = ["".join(r.choice(list("abcdefgh"), 5)) for _ in range(80)]
    out = []
    for i in range(n):
        own = list(r.choice(words, 60))
        if i % 6 == 0:
            own[::12] = [f"Vile{w}" for w in own[::12]]  # a stem with many endings
        out.append((i, " ".join(own), "s"))
    return out


def tables(spark):
    rows = texts()
    docs = spark.createDataFrame(rows, SCHEMA)
    labels = spark.createDataFrame([(i, int(i % 6 == 0), 1) for i, *_ in rows if i % 3 == 0], "doc_id long, toxic int, text int")
    return docs, labels


def test_finds_a_stem_and_leaves_the_rest(spark):
    got = x.classify(*tables(spark)).collect()
    assert len(got) == 600
    wrong = [r for r in got if r.predicted != (r.doc_id % 6 == 0)]
    assert len(wrong) <= 6 and all(r.held_out == held(r.doc_id) and (r.score >= 0.7) == (r.predicted == 1) for r in got)


def test_held_out_labels_and_order_of_rows_change_nothing(spark):
    docs, labels = tables(spark)
    turned = labels.selectExpr("doc_id", "if(crc32(cast(doc_id as string)) % 3 = 1, 1 - toxic, toxic) as toxic", "text")
    a, b = x.train(docs, labels), x.train(docs.repartition(5), turned.repartition(3))
    assert np.array_equal(a.features, b.features) and np.array_equal(a.weights, b.weights) and a.bias == b.bias


def test_fit_reaches_the_least_risk():
    """Where the risk on clean rows stays above zero, the fit is that of the plain convex risk."""
    r = np.random.default_rng(1)
    p, u = r.normal(1, 1, (80, 3)), np.r_[r.normal(1, 1, (40, 3)), r.normal(-0.5, 1, (160, 3))]
    w, b = x.fit(p, u, 0.2, ridge=0.05, steps=3000, rate=0.02)

    def risk(v):
        zp, zu = p @ v[:3] + v[3], u @ v[:3] + v[3]
        clean = np.logaddexp(0, zu).mean() - 0.2 * np.logaddexp(0, zp).mean()
        assert clean > 0
        return 0.2 * np.logaddexp(0, -zp).mean() + clean + 0.025 * v[:3] @ v[:3]

    best = np.r_[w, b]
    for step in r.normal(0, 0.05, (200, 4)):
        assert risk(best) <= risk(best + step) + 1e-7


def test_values_equal_a_plain_count(spark):
    docs = [("Aber aberglaube " * 40_000).encode(), b"", "Ärger: abers, ÄRGER!".encode(), b"x" * 3_000_000, b"a-b 12 aber"]
    column = pa.array(docs, pa.binary())
    data, offsets = x.B.flat(pa.table({"text": column}))
    found = [(d, f) for ds, fs, _ in x.grams(data, offsets) for d, f in zip(ds.tolist(), fs.tolist())]
    # "aber" is a word with one stem, "aberglaube" one with four; the last text shares them
    lone = {f for d, f in found if d == 4}
    assert sum(d == 0 for d, _ in found) == 40_000 * (2 + 5)
    assert not any(d == 1 for d, _ in found) and sum(d == 3 for d, _ in found) == 5
    assert lone & {f for d, f in found if d == 0}
    alone = [x.values_of(column.slice(i, 1), np.arange(1 << x.BITS).astype(np.int32), 1 << x.BITS) for i in range(5)]
    doc, number, value = x.values_of(column, np.arange(1 << x.BITS).astype(np.int32), 1 << x.BITS)
    for i, (_, f, v) in enumerate(alone):
        assert np.array_equal(number[doc == i], f) and np.allclose(value[doc == i], v)


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, "a"), (2, "", "b"), (None, "x " * 50_000, None), (4, "one", "c"), (4, "one", "c")], SCHEMA)
    none = spark.createDataFrame([(1, None), (None, 1), (9, 1)], "doc_id long, toxic int")
    got = x.classify(docs, none).collect()
    assert len(got) == 5 and {round(r.score, 9) for r in got} == {x.PRIOR} and not any(r.held_out for r in got if r.doc_id is None)
    assert x.classify(docs.limit(0), none.limit(0)).count() == 0
    assert x.score_documents(docs, x.Scorer(np.zeros(0, np.int64), np.zeros(0), 0.0)).columns == ["doc_id", "text", "_score"]
