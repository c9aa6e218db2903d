"""Similarity join on sets of word n-grams by MinHash banding, with every candidate pair checked on the full sets.

The set of a document holds the hashes of its runs of `n` words; a text of fewer words has itself as the one member,
a text without words has none and links to nothing. Two documents are linked if the Jaccard similarity of their sets is
at least the threshold.

1. Documents with equal sets are one node from here on: the copies of a text cost one row.
2. `bands_for` picks bands and rows for the wished recall at the threshold. The rows of a band hash to a bucket; nodes
   that share a bucket are candidates.
3. Candidates are gathered by the components of the graph node - bucket, of which only stars around each bucket's least
   node are made. A component of up to `CHUNK` nodes is checked as a whole; a larger one is cut into chunks, and two
   chunks meet if a bucket has nodes of both. No row per pair is made: a task gets two chunks of texts, counts common
   n-grams by a matrix product over the n-grams that two of its documents have, and returns the number of links of each
   node and a spanning forest of the links.
4. The components of those forests are the classes.

A chunk is bounded by nodes and by n-grams, so a near-copy family of any size is many bounded tasks. Their number grows
with the square of a family's distinct texts, as its links do; links are counted, never listed.

Rows that are equal in every way count as documents of their own. Null ids are documents too; a class of null ids only
has a null id.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridcast.llm import blocks as B
from gridcast.llm.components import components
from gridcast.llm.stored import checkpointed

N = 5
THRESHOLD = 0.8
RECALL = 0.9999
HASHES = 140  # MinHash values a document may have
CHUNK = 128
CHUNK_GRAMS = 400_000
COLUMNS = 4096  # n-grams in a step of the matrix product


def bands_for(threshold: float, recall: float, most: int) -> tuple[int, int]:
    """(bands, rows): the most rows a band, hence the fewest false candidates, with which a pair at the threshold shares
    a band with probability `recall`, in at most `most` hash values."""
    for rows in range(most, 0, -1):
        miss = 1 - threshold**rows
        bands = int(np.ceil(np.log(1 - recall) / np.log(miss))) if miss > 0 else 1
        if bands * rows <= most:
            return max(bands, 1), rows
    raise ValueError("too few hash values for this recall")


def gram_sets(data: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-gram hashes of the documents, document by document in order, and the n + 1 bounds between them."""
    starts, ends, before = B.words(data, offsets)
    words = B.word_hashes(data, starts, ends)
    count = np.diff(before)
    docs = len(count)
    doc = np.repeat(np.arange(docs), count)
    place = np.arange(len(words)) - before[:-1][doc]
    grams = B.window_hashes(words, n)
    whole = np.flatnonzero(place + n <= count[doc])
    short = np.flatnonzero((count > 0) & (count < n))
    values = np.r_[grams[whole], B.run_hashes(words, before[short], before[short + 1])]
    owner = np.r_[doc[whole], short]
    order = np.lexsort((values, owner))
    values, owner = values[order], owner[order]
    new = np.r_[True, (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])] if len(values) else np.zeros(0, bool)
    values, owner = values[new], owner[new]
    return values, np.searchsorted(owner, np.arange(docs + 1))


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]


def _keys(values: np.ndarray, bounds: np.ndarray) -> list[bytes]:
    """16 bytes that tell one set from another."""
    one, two = _sums(B.mix(values), bounds), _sums(B.mix(values ^ np.uint64(0xA5A5A5A5A5A5A5A5)), bounds)
    pairs = np.stack([B.mix(one), B.mix(two + np.diff(bounds).astype(np.uint64))], axis=1)
    return [p.tobytes() for p in pairs]


def _bands(values: np.ndarray, bounds: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """Band hashes of each document; those of an empty set mean nothing."""
    full = np.flatnonzero(np.diff(bounds) > 0)
    out = np.zeros((len(bounds) - 1, bands), np.uint64)
    if not len(full):
        return out
    draw = np.random.default_rng(11)
    odd = draw.integers(0, 2**63, bands * rows, np.uint64) * np.uint64(2) + np.uint64(1)
    more = draw.integers(0, 2**63, bands * rows, np.uint64)
    for band in range(bands):
        h = np.zeros(len(full), np.uint64)
        for i in range(band * rows, band * rows + rows):
            h = B.mix(h ^ np.minimum.reduceat(values * odd[i] + more[i], bounds[full]))
        out[full, band] = h
    return out


def signatures(docs: DataFrame, n: int, bands: int, rows: int, key: str, text: str) -> DataFrame:
    """id, text_hash, node (16 bytes), grams, bands: one row per row of docs."""
    body = F.coalesce(F.col(text), F.lit("")).cast("binary")
    source = docs.select(F.col(key).cast("long").alias("id"), F.xxhash64(body).alias("text_hash"), body.alias("text"))

    def made(batches):
        for batch in batches:
            data, offsets = B.flat(pa.Table.from_batches([batch]))
            keys, sizes, hashes = [], [], []
            for i, j in B.pieces(offsets):
                values, bounds = gram_sets(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], n)
                keys += _keys(values, bounds)
                sizes.append(np.diff(bounds))
                hashes.append(_bands(values, bounds, bands, rows))
            flat = np.concatenate(hashes).view(np.int64).ravel() if hashes else np.zeros(0, np.int64)
            ends = np.arange(batch.num_rows + 1, dtype=np.int32) * bands
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    batch.column("text_hash"),
                    pa.array(keys, pa.binary()),
                    pa.array(np.concatenate(sizes) if sizes else [], pa.int64()),
                    pa.ListArray.from_arrays(ends, flat),
                ],
                names=["id", "text_hash", "node", "grams", "bands"],
            )

    return source.mapInArrow(B.by_batch(made), "id long, text_hash long, node binary, grams long, bands array<long>")


def _common_counts(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Number of common n-grams of each document of a with each of b; both are (values, bounds)."""
    values = np.r_[a[0], b[0]]
    distinct, column, times = np.unique(values, return_inverse=True, return_counts=True)
    shared = times > 1
    number = np.cumsum(shared) - 1
    out = np.zeros((len(a[1]) - 1, len(b[1]) - 1), np.float64)
    sides = []
    for (v, bounds), c in ((a, column[: len(a[0])]), (b, column[len(a[0]) :])):
        keep = np.flatnonzero(shared[c])
        c = number[c[keep]]
        row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))[keep]
        order = np.argsort(c, kind="stable")
        sides.append((c[order], row[order], len(bounds) - 1))
    for start in range(0, int(shared.sum()), COLUMNS):
        parts = []
        for c, row, rows in sides:
            i, j = np.searchsorted(c, [start, start + COLUMNS])
            m = np.zeros((rows, COLUMNS), np.float32)
            m[row[i:j], c[i:j] - start] = 1
            parts.append(m)
        out += parts[0] @ parts[1].T
    return out


def _check(table: pa.Table, n: int, per_mille: int) -> pa.Table:
    """For the nodes of two chunks (side 0 and 1) or of one: links of each, and a spanning forest of the links."""
    data, offsets = B.flat(table)
    values, bounds = gram_sets(data, offsets, n)
    keys = _keys(values, bounds)
    sides, seen = ([], []), set()
    for i, (node, side, key) in enumerate(zip(table.column("node").to_pylist(), table.column("side").to_pylist(), keys)):
        # an id with several texts, or repeated rows, bring more than the text of the node
        if node == key and (node, side) not in seen:
            seen.add((node, side))
            sides[side].append(i)
    members = table.column("members").to_numpy()
    one, two = (np.array(sorted(s, key=lambda i: keys[i]), np.int64) for s in sides)
    alone = not len(two)
    if alone:
        two = one

    def sets(rows):
        sizes = np.diff(bounds)[rows]
        at = np.repeat(bounds[rows] - np.r_[0, np.cumsum(sizes)[:-1]], sizes) + np.arange(sizes.sum()) if len(rows) else np.zeros(0, np.int64)
        return values[at], np.r_[0, np.cumsum(sizes)]

    a, b = sets(one), sets(two)
    common = _common_counts(a, b)
    union = np.diff(a[1])[:, None] + np.diff(b[1])[None, :] - common
    linked = (common * 1000 >= per_mille * union) & (common > 0)
    if alone:
        np.fill_diagonal(linked, False)
    node, other, links = [], [], []
    for rows, count in ((one, linked @ members[two]), (two, members[one] @ linked))[: 1 if alone else 2]:
        for i, c in zip(rows.tolist(), count.tolist()):
            if c:
                node.append(keys[i])
                other.append(None)
                links.append(int(c))
    root = {i: i for i in (*one.tolist(), *two.tolist())}

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i, j in np.argwhere(linked).tolist():
        x, y = find(one[i]), find(two[j])
        if x != y:
            root[max(x, y)] = min(x, y)
            node.append(keys[one[i]])
            other.append(keys[two[j]])
            links.append(0)
    return pa.table({"node": pa.array(node, pa.binary()), "other": pa.array(other, pa.binary()), "links": pa.array(links, pa.int64())})


def text_hash(text: str = "text"):
    """What tells the texts of one id apart; a text of null is an empty one."""
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")).cast("binary"))


def _linked(docs: DataFrame, key: str, text: str, n: int, threshold: float, recall: float, chunk: int, chunk_grams: int) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(row signatures; nodes; links and forests of the checked chunks; label of each node that has a link)."""
    bands, rows = bands_for(threshold, recall, HASHES)
    signed = checkpointed(signatures(docs, n, bands, rows, key, text))
    nodes = checkpointed(
        signed.where("grams > 0")
        .groupBy("node")
        .agg(
            F.min(F.struct(F.col("id").isNull().alias("none"), "id", "text_hash")).alias("first"),
            F.count(F.lit(1)).alias("members"),
            F.any_value("grams").alias("grams"),
            F.any_value("bands").alias("bands"),
        )
        .select("node", F.col("first.id").alias("id"), F.col("first.text_hash").alias("text_hash"), "members", "grams", "bands")
    )
    banded = nodes.select("node", F.posexplode("bands").alias("band", "hash"))
    buckets = banded.groupBy("band", "hash").agg(F.min("node").alias("hub"), F.count(F.lit(1)).alias("size")).where("size > 1").drop("size")
    in_bucket = checkpointed(banded.join(buckets, ["band", "hash"]))
    # one edge from each node to its least hub, and one from that to each of its others: many nodes share those
    hubs = in_bucket.groupBy("node").agg(F.collect_set("hub").alias("hubs")).withColumn("least", F.array_min("hubs"))  # at most `bands`
    between = hubs.select(F.explode("hubs").alias("a"), F.col("least").alias("b"))
    candidates = components(hubs.select(F.col("node").alias("a"), F.col("least").alias("b")).unionByName(between).where("a <> b").distinct())

    # components cut into chunks
    sized = candidates.join(nodes.select("node", "id", "text_hash", "members", "grams"), "node")
    extent = sized.groupBy("label").agg(
        F.greatest(F.ceil(F.count(F.lit(1)) / chunk), F.ceil(F.sum("grams") / chunk_grams)).cast("int").alias("chunks")
    )
    placed = checkpointed(sized.join(extent, "label").withColumn("chunk", F.pmod(F.xxhash64("node"), "chunks").cast("int")))
    cut = in_bucket.join(placed.where("chunks > 1").select("node", "label", "chunk"), "node").select("label", "band", "hash", "chunk").distinct()
    met = (
        cut.join(cut.withColumnRenamed("chunk", "second"), ["label", "band", "hash"])
        .where("chunk <= second")
        .select("label", F.col("chunk").alias("first"), "second")
        .distinct()
    )
    whole = placed.where("chunks = 1").select("label", F.lit(0).alias("first"), F.lit(0).alias("second")).distinct()
    meetings = checkpointed(met.unionByName(whole))
    what = ("label", "first", "second", "node", "id", "text_hash", "members")
    left = placed.join(meetings.withColumn("chunk", F.col("first")), ["label", "chunk"]).select(*what, F.lit(0).alias("side"))
    right = placed.join(meetings.where("first < second").withColumn("chunk", F.col("second")), ["label", "chunk"]).select(*what, F.lit(1).alias("side"))
    body = F.coalesce(F.col(text), F.lit("")).cast("binary")
    texts = docs.select(F.col(key).cast("long").alias("id"), F.xxhash64(body).alias("text_hash"), body.alias("text"))
    wanted = placed.select(F.coalesce("id", F.lit(B.NULL_ID)).alias("_id"), "text_hash").distinct()
    few = texts.withColumn("_id", F.coalesce("id", F.lit(B.NULL_ID))).join(wanted, ["_id", "text_hash"], "left_semi").drop("id")
    tasks = left.unionByName(right).withColumn("_id", F.coalesce("id", F.lit(B.NULL_ID))).drop("id").join(few, ["_id", "text_hash"])
    per_mille = round(threshold * 1000)
    checked = checkpointed(
        tasks.select("label", "first", "second", "node", "members", "side", "text")
        .groupBy("label", "first", "second")
        .applyInArrow(lambda t: _check(t, n, per_mille), "node binary, other binary, links long")
    )
    return signed, nodes, checked, components(checked.where("other is not null").select(F.col("node").alias("a"), F.col("other").alias("b")))


def leaders(
    docs: DataFrame, key: str = "doc_id", text: str = "text", n: int = N, threshold: float = THRESHOLD, recall: float = RECALL, chunk: int = CHUNK, chunk_grams: int = CHUNK_GRAMS
) -> DataFrame:
    """doc_id, text_hash: of each class of documents with words the least id, nulls last, and then the least hash. A
    class is what the links join, whatever ids its rows have."""
    _, nodes, _, classes = _linked(docs, key, text, n, threshold, recall, chunk, chunk_grams)
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "text_hash")).alias("first")
    named = nodes.join(classes, "node", "left").groupBy(F.coalesce("label", "node").alias("label")).agg(first)
    return named.select(F.col("first.id").alias("doc_id"), F.col("first.text_hash").alias("text_hash"))


def similar(
    docs: DataFrame, key: str = "doc_id", text: str = "text", n: int = N, threshold: float = THRESHOLD, recall: float = RECALL, chunk: int = CHUNK, chunk_grams: int = CHUNK_GRAMS
) -> DataFrame:
    """One row per row of `docs`: doc_id, class_id (least id of all documents it is linked to, directly or by way of
    others), copy_id (least id of the documents with its n-gram set), n_links (documents linked to it directly)."""
    signed, nodes, checked, classes = _linked(docs, key, text, n, threshold, recall, chunk, chunk_grams)
    links = checked.groupBy("node").agg(F.sum("links").alias("links"))
    linked = classes.join(nodes.select("node", "id"), "node")
    names = linked.groupBy("label").agg(F.min("id").alias("class_id"))
    table = (
        nodes.select("node", F.col("id").alias("copy_id"), "members")
        .join(links, "node", "left")
        .join(classes.join(names, "label").drop("label").withColumn("in_class", F.lit(True)), "node", "left")
        .select(
            "node",
            "copy_id",
            F.when(F.col("in_class"), F.col("class_id")).otherwise(F.col("copy_id")).alias("class_id"),
            (F.coalesce("links", F.lit(0)) + F.col("members") - 1).alias("n_links"),
        )
    )
    some = signed.where("grams > 0").select("id", "node").join(table, "node")
    none = signed.where("grams = 0").select(F.col("id").alias("doc_id"), F.col("id").alias("class_id"), F.col("id").alias("copy_id"), F.lit(0).cast("long").alias("n_links"))
    return some.select(F.col("id").alias("doc_id"), "class_id", "copy_id", "n_links").unionByName(none)
