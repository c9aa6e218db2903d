"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic documents are the positives, documents drawn without a look at their labels are the unlabelled rest, and
the share of toxic ones among these, the class prior, corrects the risk: a linear scorer with logistic loss minimises

    prior * E_pos[loss as toxic] + max(0, E_unl[loss as clean] - prior * E_pos[loss as clean])

The second term estimates the risk on clean documents, which can't be negative; where it falls below zero the step goes
back up that term instead, so that a flexible scorer doesn't learn the few positives by heart.

Features are hashed: lower-case runs of letters, and their first 4 to 7 bytes, since a stem takes many endings. A feature's
value grows with its count for the length of the text. The `FEATURES` kept are those that more positives have than the
prior-corrected rest. The fit takes at most `POSITIVES` and `UNLABELLED` documents, the first by a hash of the id; scoring
is one pass over whole texts without a shuffle, in windows of bounded bytes, however long a text is.

The prior is the share of ones among all labels to learn from; where these hold no zero or no one it is `PRIOR`. Labels
may have been handed out by choice, so the share is checked against the texts: if a share q of the unlabelled and a share
p of the positives have a feature, the prior is at most q / p. The `CHECKED` most telling features give that bound together.

Null and empty texts have no feature, their score is the scorer's bias. Null ids and null labels are not learnt from, but
scored. Of several documents with one id, the one with the least text is learnt from; an id is toxic if any of its labels
is. Where there is no positive or no feature, every score is the prior.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridcast.llm import blocks as B
from gridcast.llm.quality_classifier import held_out
from gridcast.llm.stored import checkpointed
from gridcast.llm.words import early

POSITIVES = 5_000
UNLABELLED = 10_000
FEATURES = 1024
SEEN = 3  # positives that must have a feature
PRIOR = 0.1
CHECKED = 16
RIDGE = 3e-4
STEPS = 400
RATE = 0.05
STEMS = (4, 5, 6, 7)
BITS = 20
WINDOW = 1 << 20

_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _windows(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of about WINDOW bytes that end with a document or before a byte that is no letter."""
    start, n = 0, len(data)
    while start < n:
        end = start + WINDOW
        while end < n:
            stop = ~_LETTER[data[end : end + WINDOW]]
            edge = offsets[np.searchsorted(offsets, end)]
            at = end + int(stop.argmax()) if stop.any() else n
            if min(at, edge) <= end + WINDOW or end + WINDOW >= n:
                end = min(at, int(edge))
                break
            end += WINDOW
        yield start, min(end, n)
        start = end


def grams(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """By windows: document and hashed feature of every word and stem, and the document of every word."""
    for lo, hi in _windows(data, offsets):
        part = data[lo:hi]
        inside = _LETTER[part]
        opens, closes = inside.copy(), inside.copy()
        opens[1:] &= ~inside[:-1]
        closes[:-1] &= ~inside[1:]
        cut = offsets[(offsets > lo) & (offsets < hi)] - lo
        opens[cut] |= inside[cut]
        closes[cut - 1] |= inside[cut - 1]
        starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
        if not len(starts):
            continue
        doc = np.searchsorted(offsets, starts + lo, "right") - 1
        values = B.BYTES[_LOWER[part]]
        up, down = B.powers(len(values) + 1)
        sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * up[: len(values)], out=sums[1:])
        docs, features = [], []
        for k in (0, *STEMS):
            long = slice(None) if k == 0 else ends - starts >= k
            a = starts[long]
            b = a + k if k else ends
            docs.append(doc[long])
            features.append(B.mix((sums[b] - sums[a]) * down[a] + np.uint64(k + 1)) >> np.uint64(64 - BITS))
        yield np.concatenate(docs), np.concatenate(features).astype(np.int64), doc


@dataclass(frozen=True)
class Scorer:
    """score(text) = logistic(bias + sum of weight * value over the features of the text)"""

    features: np.ndarray
    weights: np.ndarray
    bias: float

    def lookup(self) -> np.ndarray:
        table = np.full(1 << BITS, -1, np.int16)
        table[self.features] = np.arange(len(self.features))
        return table

    def score(self, column: pa.Array, table: np.ndarray) -> np.ndarray:
        doc, feature, value = values_of(column, table, len(self.features))
        z = self.bias + np.bincount(doc, self.weights[feature] * value, len(column))
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def values_of(column: pa.Array, table: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, number and value of each kept feature that the texts of a batch have."""
    data, offsets = B.flat(pa.table({"text": column}))
    n_words = np.zeros(len(column), np.int64)
    keys = []
    for doc, feature, words in grams(data, offsets):
        n_words += np.bincount(words, minlength=len(column))
        number = table[feature]
        hit = number >= 0
        keys.append(doc[hit] * width + number[hit])
    key, count = np.unique(np.concatenate(keys) if keys else np.zeros(0, np.int64), return_counts=True)
    doc = key // max(width, 1)
    return doc, key - doc * width, np.log1p(200 * count / (n_words[doc] + 40))


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float, ridge: float = RIDGE, steps: int = STEPS, rate: float = RATE) -> tuple[np.ndarray, float]:
    """Weights and bias that minimise the non-negative risk; full gradients, with their running moments as step sizes."""
    width = positive.shape[1]
    w = np.zeros(width + 1)
    w[-1] = np.log(prior / (1 - prior))
    first, second = np.zeros(width + 1), np.zeros(width + 1)

    def chance(z: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))

    for step in range(1, steps + 1):
        p, u = positive @ w[:-1] + w[-1], unlabelled @ w[:-1] + w[-1]
        clean = np.logaddexp(0, u).mean() - prior * np.logaddexp(0, p).mean()
        pull_p, pull_u = -prior * chance(p) / len(p), chance(u) / len(u)
        if clean >= 0:
            pull_p = pull_p - prior * (1 - chance(p)) / len(p)
        else:
            pull_p, pull_u = -pull_p, -pull_u
        slope = np.r_[pull_p @ positive + pull_u @ unlabelled + ridge * w[:-1], pull_p.sum() + pull_u.sum()]
        first, second = 0.9 * first + 0.1 * slope, 0.999 * second + 0.001 * slope**2
        w -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return w[:-1], float(w[-1])


def class_prior(labels: DataFrame, key: str, label: str) -> float:
    """Share of ones among the ids to learn from, over all labels; PRIOR where one of the two labels is missing."""
    by_id = labels.where(F.col(key).isNotNull() & F.col(label).isin(0, 1) & ~held_out(F.col(key))).groupBy(key).agg(F.max(label).alias("one"))
    ones, n = by_id.agg(F.coalesce(F.sum("one"), F.lit(0)), F.count(F.lit(1))).first()
    return ones / n if 0 < ones < n else PRIOR


def _sample(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, positives: int, unlabelled: int) -> DataFrame:
    """(_positive, text) of the documents to learn from; one document can be in both classes."""

    def drawn(ids: DataFrame, n: int, positive: int) -> DataFrame:
        known = ids.select(F.col(key).alias("_id")).where(F.col("_id").isNotNull() & ~held_out(F.col("_id")))
        known = known.where(early(F.xxhash64("_id"), n, known.count())).distinct()
        return known.orderBy(F.xxhash64("_id"), "_id").limit(n).withColumn("_positive", F.lit(positive))

    # At most `positives` + `unlabelled` rows of two numbers.
    chosen = drawn(labels.where(F.col(label) == 1), positives, 1).unionByName(drawn(docs, unlabelled, 0))
    texts = docs.select(F.col(key).alias("_key"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    found = texts.join(F.broadcast(chosen), F.col("_key") == F.col("_id"))
    return checkpointed(found.groupBy("_id", "_positive").agg(F.min("_text").cast("binary").alias("text")).select("_positive", "text"))


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many documents of each class have a feature, and (as feature -1) how many there are."""
    for batch in batches:
        data, offsets = B.flat(pa.table({"text": batch.column("text")}))
        positive = batch.column("_positive").to_numpy()
        pairs = [np.unique(doc << BITS | feature) for doc, feature, _ in grams(data, offsets)]
        pair = np.unique(np.concatenate(pairs)) if pairs else np.zeros(0, np.int64)
        doc, feature = pair >> BITS, pair & ((1 << BITS) - 1)
        found, number = np.unique(feature, return_inverse=True)
        of = [np.bincount(number, positive[doc] == c, len(found)).astype(np.int64) for c in (1, 0)]
        total = [int((positive == c).sum()) for c in (1, 0)]
        yield pa.record_batch({"feature": pa.array(np.r_[found, -1].astype(np.int32)), "pos": pa.array(np.r_[of[0], total[0]]), "unl": pa.array(np.r_[of[1], total[1]])})


def train(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    prior: float | None = None,
    positives: int = POSITIVES,
    unlabelled: int = UNLABELLED,
    features: int = FEATURES,
) -> Scorer:
    """A scorer from at most `positives` confirmed and `unlabelled` other documents that aren't held out."""
    prior = class_prior(labels, key, label) if prior is None else prior
    rows = _sample(docs, labels, key, text, label, positives, unlabelled)
    counts = rows.mapInArrow(_frequencies, "feature int, pos long, unl long").groupBy("feature").agg(F.sum("pos").alias("pos"), F.sum("unl").alias("unl"))
    total = counts.where("feature = -1").first()
    none = Scorer(np.zeros(0, np.int64), np.zeros(0), float(np.log(prior / (1 - prior))))
    if total is None or not total.pos or not total.unl:
        return none
    p = F.col("pos") / total.pos
    rest = F.greatest(F.col("unl") / total.unl - prior * p, F.lit(0.0)) / (1 - prior)
    telling = ((p - rest) / F.sqrt(rest + 4 / total.pos + 1e-3)).alias("telling")
    best = counts.where((F.col("feature") >= 0) & (F.col("pos") >= SEEN)).select("feature", "pos", "unl", telling).where("telling > 0")
    found = best.orderBy(F.desc("telling"), "feature").limit(features).collect()
    if not found:
        return none
    kept = np.array(sorted(r.feature for r in found), np.int64)
    bound = sum(r.unl for r in found[:CHECKED]) / total.unl / (sum(r.pos for r in found[:CHECKED]) / total.pos)
    prior = min(prior, max(bound, 1 / total.unl))
    table = Scorer(kept, np.zeros(len(kept)), 0.0).lookup()

    def sparse(batches):
        for batch in batches:
            doc, number, value = values_of(batch.column("text"), table, len(kept))
            at = np.searchsorted(doc, np.arange(batch.num_rows + 1)).tolist()
            cells = [[x[i:j].tobytes() for i, j in zip(at, at[1:])] for x in (number.astype(np.int16), value.astype(np.float32))]
            yield pa.record_batch({"_positive": batch.column("_positive"), "number": pa.array(cells[0], pa.binary()), "value": pa.array(cells[1], pa.binary())})

    # The order of the rows is that of their contents, so that a rerun adds up in the same order.
    found = sorted((r._positive, bytes(r.number), bytes(r.value)) for r in rows.mapInArrow(sparse, "_positive int, number binary, value binary").collect())
    x = {c: np.zeros((sum(r[0] == c for r in found), len(kept)), np.float32) for c in (1, 0)}
    at = {1: 0, 0: 0}
    for c, number, value in found:
        x[c][at[c], np.frombuffer(number, np.int16)] = np.frombuffer(value, np.float32)
        at[c] += 1
    weights, bias = fit(x[1], x[0], prior)
    return Scorer(kept, weights, bias)


def score_documents(docs: DataFrame, scorer: Scorer, text: str = "text") -> DataFrame:
    """`docs` without change, and a column `_score` between 0 and 1."""
    names = [c for c in docs.columns if c != "_score"]

    def scored(batches):
        table = scorer.lookup()
        for batch in batches:
            column = pa.compute.fill_null(batch.column(text), "").cast(pa.binary())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(scorer.score(column, table))], names=[*names, "_score"])

    return docs.select(*names).mapInArrow(scored, docs.select(*names).schema.add("_score", "double"))


def classify(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", threshold: float = 0.7, **options) -> DataFrame:
    """One row per row of `docs`: doc_id, held_out, score, predicted (1 from score `threshold` on)."""
    scorer = train(docs, labels, key, text, label, **options)
    scored = score_documents(docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")), scorer)
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("_score").alias("score"), (F.col("_score") >= threshold).cast("int").alias("predicted")
    )
