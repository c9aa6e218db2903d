"""Quality scores by Bradley-Terry pairwise ranking.

A document of label 1 is preferred to one of label 0. The probability of a preference is the logistic function of the
difference of two document scores, and a score is linear in features of the text, so the weights are those of a
logistic regression on feature differences without an intercept. The ranking has no zero of its own: the threshold is
the quantile of the training scores that leaves the labelled share of zeros below, moved to the widest gap within half
a percent of the rows. The reported score is the logistic function of the distance to it, so 0.5 is the threshold.

The fit takes every labelled row and every pair of a row of label 1 with one of label 0, without making the pairs. A
pair's loss is a smooth function of its two scores, so that each row is replaced by weights on the six nodes next to
its score (interpolation of degree five) and the sums over pairs become sums over pairs of nodes. One pass over the rows
gives counts and moments per node, from which a Newton step follows; nodes lie an eighth apart, wider far from zero,
which leaves an error of some 1e-8 of a pair's loss and bounds their number whatever the number of rows. The threshold comes
from all training scores, ranked in range partitions.

Features are counts over bytes and words of the whole text, made for a batch of documents at a time and kept as a table
of fourteen numbers a document for the passes of the fit. Scoring is one pass without a shuffle.

Null and empty texts have all features 0. Labels that are null are left out; a document with several labels counts once
for each. Where one of the two labels is missing, every score is 0.5.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridcast.llm import blocks as B
from gridcast.session import literal_table, work_path

RIDGE = 1e-3
STEPS = 30
# Nodes of the scores: node k lies at WIDE * sinh(k * STEP / WIDE), the last ones beyond any score that the ridge allows.
STEP, WIDE, LAST_NODE = 1 / 8, 64.0, 8192
_NEAR = range(-2, 4)  # a score's nodes, from the one at or below it

FEATURES = (
    "log_words", "short", "symbols", "bangs", "bars", "capitals", "digits", "non_ascii", "repeats", "distinct",
    "word_length", "stops", "lines", "spaced_bars",
)
_CLASSES = {
    "symbols": b"#*$%&<>@^~_=+",
    "bangs": b"!?",
    "bars": b"|",
    "capitals": bytes(range(65, 91)),
    "digits": b"0123456789",
    "non_ascii": bytes(range(128, 256)),
    "lines": b"\n",
    "stops": b".",
}


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of features per document."""
    n = len(offsets) - 1
    size = np.maximum(np.diff(offsets), 1)

    def share(mark: np.ndarray) -> np.ndarray:
        total = np.r_[0, np.cumsum(mark)]
        return (total[offsets[1:]] - total[offsets[:-1]]) / size

    out = {}
    for name, chars in _CLASSES.items():
        table = np.zeros(256, bool)
        table[list(chars)] = True
        out[name] = share(table[data])
    starts, ends, before = B.words(data, offsets)
    hashes = B.word_hashes(data, starts, ends)
    count = np.diff(before)
    some = np.maximum(count, 1)
    doc = np.repeat(np.arange(n), count)
    same = np.r_[False, (hashes[1:] == hashes[:-1]) & (doc[1:] == doc[:-1])] if len(hashes) else np.zeros(0, bool)
    order = np.lexsort((hashes, doc))
    new = np.r_[True, (hashes[order][1:] != hashes[order][:-1]) | (doc[order][1:] != doc[order][:-1])] if len(hashes) else same
    out["repeats"] = np.bincount(doc, same, n) / some
    out["distinct"] = np.where(count > 0, np.bincount(doc[order], new, n) / some, 0) * np.minimum(1, np.log1p(count) / 6)
    out["word_length"] = np.bincount(doc, ends - starts, n) / some / 10
    out["log_words"] = np.log1p(count) / 10
    out["short"] = np.exp(-count / 10.0) * (count > 0)
    out["spaced_bars"] = np.tanh(40 * out["bars"])
    for name in ("symbols", "bangs", "capitals", "repeats"):  # a few are as telling as many
        out[name] = np.tanh(8 * out[name])
    return np.stack([out[f] for f in FEATURES], axis=1).astype(np.float64)


def _features_of(column: pa.Array) -> np.ndarray:
    data, offsets = B.flat(pa.table({"text": column}))
    parts = [features(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]) for i, j in B.pieces(offsets, 1 << 20)]
    return np.concatenate(parts) if parts else np.zeros((0, len(FEATURES)))


@dataclass(frozen=True)
class Ranking:
    """score(x) = logistic((x - center) / scale . weights - threshold)"""

    center: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    threshold: float

    def raw(self, x: np.ndarray) -> np.ndarray:
        """Scores without the threshold, column by column: a row's score doesn't depend on the batch it comes in."""
        total = np.zeros(len(x))
        for k, w in enumerate(self.weights):
            total += (x[:, k] - self.center[k]) / self.scale[k] * w
        return total

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(x) - self.threshold, -500, 500)))


NO_RANKING = Ranking(np.zeros(len(FEATURES)), np.ones(len(FEATURES)), np.zeros(len(FEATURES)), 0.0)
_UPPER = np.triu_indices(len(FEATURES))
_MOMENTS = 1 + len(FEATURES) + len(_UPPER[0])


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES))


def _lists(x: np.ndarray) -> pa.Array:
    return pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), len(FEATURES)).cast(pa.list_(pa.float64()))


def _on_nodes(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each score the first of its nodes (from 0) and its weights on them."""
    at = np.clip(np.arcsinh(raw / WIDE) * (WIDE / STEP), -LAST_NODE, LAST_NODE)
    low = np.floor(at)
    weights = [np.prod([(at - low - m) / (k - m) for m in _NEAR if m != k], axis=0) for k in _NEAR]
    return low.astype(np.int64) + LAST_NODE, np.stack(weights)


def _node_scores(nodes: np.ndarray) -> np.ndarray:
    return WIDE * np.sinh((nodes - LAST_NODE + _NEAR[0]) * (STEP / WIDE))


def node_sums(examples: DataFrame, ranking: Ranking, total: int) -> DataFrame:
    """Per label and node: the weight, the sum and the products of the standardised features of the rows on it.

    A task's sums are rounded to a power of two below which sums over all rows have no digits, so that adding them up is
    exact and doesn't depend on the order in which tasks end.
    """
    unit = 2.0 ** (np.ceil(np.log2(8.0 * total)) - 52)

    def summed(batches):
        table = np.zeros((2, 2 * LAST_NODE + len(_NEAR), _MOMENTS))
        for batch in batches:
            x, label, n = _matrix(batch.column("x")), batch.column("_label").to_numpy(), batch.column("_n").to_numpy()
            if not len(x):
                continue
            z = (x - ranking.center) / ranking.scale
            moments = np.concatenate([np.ones((len(z), 1)), z, z[:, _UPPER[0]] * z[:, _UPPER[1]]], axis=1) * n[:, None]
            first, weights = _on_nodes(ranking.raw(x))
            cell = label * table.shape[1] + first
            order = np.argsort(cell, kind="stable")
            starts = np.flatnonzero(np.r_[True, np.diff(cell[order]) != 0])
            moments, into = moments[order], cell[order][starts]
            for k in range(len(_NEAR)):
                table.reshape(-1, _MOMENTS)[into + k] += np.add.reduceat(moments * weights[k][order, None], starts)
        label, node = np.nonzero(table.any(axis=2))
        sums = np.round(table[label, node] / unit) * unit
        arrays = [pa.array(label.astype(np.int32)), pa.array(node.astype(np.int32)), *map(pa.array, np.ascontiguousarray(sums.T))]
        yield pa.RecordBatch.from_arrays(arrays, names=["_label", "node", *names])

    names = [f"m{k}" for k in range(_MOMENTS)]
    parts = examples.select("_label", "_n", "x").mapInArrow(B.by_batch(summed), "_label int, node int, " + ", ".join(f"{m} double" for m in names))
    return parts.groupBy("_label", "node").agg(*[F.sum(m).alias(m) for m in names])


def pair_loss(sums: np.ndarray, label: np.ndarray, node: np.ndarray, w: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Mean logistic loss over all pairs with the ridge, its slope and its curvature, from the sums per node."""
    width = len(w)
    order = np.lexsort((node, label))
    sums, at = sums[order], _node_scores(node[order])
    bad = np.count_nonzero(label == 0)
    n, v = sums[:, 0], sums[:, 1 : 1 + width]
    square = np.zeros((len(sums), width, width))
    square[:, _UPPER[0], _UPPER[1]] = sums[:, 1 + width :]
    square[:, _UPPER[1], _UPPER[0]] = sums[:, 1 + width :]
    pairs = n[:bad].sum() * n[bad:].sum()
    loss, slope, curve = 0.0, np.zeros(width), np.zeros((width, width))
    for i in range(bad, len(sums), 256):  # nodes of label 1 against all of label 0
        good = slice(i, i + 256)
        d = at[good, None] - at[None, :bad]
        wrong = 1 / (1 + np.exp(np.clip(d, -500, 500)))  # how likely the pair still stands the wrong way round
        steep = wrong * (1 - wrong)
        loss += n[good] @ np.logaddexp(0, -d) @ n[:bad]
        slope += (n[good] @ wrong) @ v[:bad] - (wrong @ n[:bad]) @ v[good]
        cross = v[good].T @ steep @ v[:bad]
        curve += np.tensordot(steep @ n[:bad], square[good], 1) + np.tensordot(n[good] @ steep, square[:bad], 1) - cross - cross.T
    return loss / pairs + RIDGE * (w @ w) / 2, slope / pairs + RIDGE * w, curve / pairs + RIDGE * np.eye(width)


def fit(examples: DataFrame) -> Ranking:
    """Newton's method on the logistic loss of all pairs of a row of label 1 and one of label 0.

    `examples` has x, _label and _n, how often a row counts, and is read once a step.
    """
    n, width = F.col("_n"), len(FEATURES)
    each = [F.get("x", F.lit(k)) for k in range(width)]
    found = examples.agg(
        *[F.coalesce(F.sum(F.when(F.col("_label") == k, n)), F.lit(0)).alias(f"rows_{k}") for k in (0, 1)],
        *[F.sum(x * n).alias(f"sum_{k}") for k, x in enumerate(each)],
    ).first()
    bad, total = found.rows_0, found.rows_0 + found.rows_1
    if not bad or bad == total:
        return NO_RANKING
    # Ten digits, as the last ones of a sum depend on the order of its tasks.
    center = np.array([float(f"{found[f'sum_{k}'] / total:.10g}") for k in range(width)])
    apart = examples.agg(*[F.sum((x - float(c)) * (x - float(c)) * n) for x, c in zip(each, center)]).first()
    scale = np.array([float(f"{max((v / total) ** 0.5, 1e-6):.10g}") for v in apart])

    def at(w: np.ndarray):
        # As many rows as nodes with scores on them, two labels each.
        rows = node_sums(examples, Ranking(center, scale, w, 0.0), total).toArrow()
        sums = np.stack([rows.column(f"m{k}").to_numpy() for k in range(_MOMENTS)], axis=1)
        return pair_loss(sums, rows.column("_label").to_numpy(), rows.column("node").to_numpy(), w)

    w = np.zeros(width)
    was, slope, curve = at(w)
    for _ in range(STEPS):
        step, length = np.linalg.solve(curve, slope), 1.0
        new = at(w - step)
        while new[0] > was + 1e-7 and length > 1e-6:  # less is within the error of the nodes
            length /= 2
            new = at(w - length * step)
        w = w - length * step
        was, slope, curve = new
        if np.abs(length * step).max() < 1e-6:
            break
    ranking = Ranking(center, scale, w, 0.0)
    return Ranking(center, scale, w, widest_gap(examples, ranking, bad, total))


def widest_gap(examples: DataFrame, ranking: Ranking, bad: int, total: int) -> float:
    """The middle of the widest gap between neighbouring scores that has `bad` rows below it, give or take half a percent.

    Equal scores are one row, so none gathers; ranks are running counts within range partitions, of which only the
    bounds and counts are collected.
    """
    spark = examples.sparkSession

    def scored(batches):
        for batch in batches:
            yield pa.record_batch({"raw": pa.array(ranking.raw(_matrix(batch.column("x")))), "_n": batch.column("_n")})

    values = examples.select("x", "_n").mapInArrow(B.by_batch(scored), "raw double, _n long").groupBy("raw").agg(F.sum("_n").alias("n"))
    path = work_path(spark, "ranking_scores")
    values.repartitionByRange("raw").withColumn("part", F.spark_partition_id()).write.parquet(path)
    values = spark.read.parquet(path)
    parts = sorted(values.groupBy("part").agg(F.min("raw").alias("least"), F.max("raw").alias("most"), F.sum("n").alias("n")).collect(), key=lambda r: r.least)
    ahead, last, known = 0, None, []
    for p in parts:
        known.append((p.part, ahead, last))
        ahead, last = ahead + p.n, p.most
    # As part of the plan: createDataFrame would start Python workers of another kind on every executor.
    ahead_of = literal_table(spark, ["part", "ahead", "last"], known).select("part", F.col("ahead").cast("long"), F.col("last").cast("double"))
    along = Window.partitionBy("part").orderBy("raw")
    before = F.col("ahead") + F.sum("n").over(along.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("n")
    ranked = values.join(F.broadcast(ahead_of), "part").select(
        "raw", before.alias("before"), F.coalesce(F.lag("raw").over(along), F.col("last")).alias("previous")
    )
    low, high = max(1, bad - total // 200), min(total - 1, bad + total // 200)
    gap = F.struct(F.col("raw") - F.col("previous"), -F.col("before"), ((F.col("raw") + F.col("previous")) / 2).alias("middle"))
    best = ranked.agg(
        F.max(F.when(F.col("before").between(low, high), gap)).alias("gap"),
        F.max(F.when(F.col("before") <= low, F.col("raw"))).alias("tie"),  # all those ranks have one score
    ).first()
    return float(best.tie if best.gap is None else best.gap.middle)


def held_out(key: Column) -> Column:
    """Rows that no model learns from: crc32 of the id as text leaves 1 modulo 3. A null id is not one of them."""
    return F.coalesce(F.crc32(key.cast("string")) % 3 == 1, F.lit(False))


def feature_rows(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of `docs`: its id as `_id` and its features as `x`."""
    rows = docs.select(F.col(key).alias("_id"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"))

    def made(batches):
        for batch in batches:
            yield pa.record_batch({"_id": batch.column("_id"), "x": _lists(_features_of(batch.column("text")))})

    return rows.mapInArrow(B.by_batch(made), f"_id {rows.schema['_id'].dataType.simpleString()}, x array<double>")


def learn(rows: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "quality") -> Ranking:
    """A ranking from all of `rows` (see `feature_rows`) that are labelled and aren't held out."""
    known = labels.select(F.col(key).alias("_id"), F.col(label).cast("int").alias("_label")).where(
        F.col("_id").isNotNull() & F.col("_label").isin(0, 1) & ~held_out(F.col("_id"))
    )
    counted = known.groupBy("_id", "_label").agg(F.count(F.lit(1)).alias("_n"))
    # In a fixed order within tasks, so that a second run gets the same sums.
    examples = rows.join(counted, "_id").sortWithinPartitions("_id", "_label", "x").select("_label", "_n", "x")
    path = work_path(rows.sparkSession, "ranking_examples")
    examples.write.parquet(path)
    return fit(rows.sparkSession.read.parquet(path))


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality") -> Ranking:
    """A ranking from all labelled documents that aren't held out."""
    return learn(feature_rows(docs.where(~held_out(F.col(key))), key, text), labels, key, label)


def score_documents(docs: DataFrame, ranking: Ranking, text: str = "text") -> DataFrame:
    """`docs` without change, and a column `_score` between 0 and 1."""
    names = [c for c in docs.columns if c != "_score"]

    def scored(batches):
        for batch in batches:
            column = pa.compute.fill_null(batch.column(text), "").cast(pa.binary())
            arrays = [batch.column(c) for c in names]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(ranking.score(_features_of(column)))], names=[*names, "_score"])

    schema = docs.select(*names).schema.add("_score", "double")
    return docs.select(*names).mapInArrow(B.by_batch(scored), schema)


def classify(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality") -> DataFrame:
    """One row per row of `docs`: doc_id, held_out, score, predicted (1 from score 0.5 on)."""
    path = work_path(docs.sparkSession, "ranking_features")
    feature_rows(docs, key, text).write.parquet(path)  # the texts are read once, for the fit and the scores
    rows = docs.sparkSession.read.parquet(path)
    ranking = learn(rows, labels, key, label)

    def scored(batches):
        for batch in batches:
            yield pa.record_batch({"doc_id": batch.column("_id"), "score": pa.array(ranking.score(_matrix(batch.column("x"))))})

    scores = rows.mapInArrow(B.by_batch(scored), f"doc_id {rows.schema['_id'].dataType.simpleString()}, score double")
    return scores.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
