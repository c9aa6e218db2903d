"""Which rows have a text that a smaller id has too, by radix tries over ranges of text prefixes.

A task puts the texts of its rows into a compressed trie; a terminal holds the least id of its text and the rows that
have it. All rows but those of the least id are copies for certain, so one row a distinct text goes on with its text,
however many copies there are. These go to ranges: between splitters that are prefixes as long as the drawn texts need to
be told apart, and where prefixes can't split a heavy range, over several parts by a hash of the whole text. Equal texts
always meet. Each range is put into one trie, row by row, and traversed for the flags.

A text of null is an empty one. A null id comes after all others; rows of one id are no copies of each other.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridcast.llm.blocks import NULL_ID
from gridcast.llm.words import early

RANGE_BYTES = 4 << 20  # of text, about, in a range
FLUSH_BYTES = 16 << 20  # of distinct text in a task's own trie
SAMPLE_DOCS = 2000  # for the splitters, which only balance the work
PREFIX = 1024  # bytes of a drawn text


class _Node:
    __slots__ = ("edges", "least", "rows")

    def __init__(self):
        self.edges: dict[int, tuple[bytes, _Node]] = {}
        self.least = NULL_ID
        self.rows: list | None = None


def _shared(label: bytes, text: bytes, at: int) -> int:
    """How many first bytes the label shares with text[at:]; halved, so that slices and not bytes are compared."""
    low, high = 1, min(len(label), len(text) - at)
    while low < high:
        middle = (low + high + 1) // 2
        if label[low:middle] == text[at + low : at + middle]:
            low = middle
        else:
            high = middle - 1
    return low


class Trie:
    """Compressed radix trie of byte strings: an edge has a label of one byte or more, and none shares its first byte."""

    def __init__(self):
        self.root, self.size = _Node(), 0

    def insert(self, text: bytes, least: int, row) -> None:
        """Notes a row of a text at its terminal."""
        node, at, n = self.root, 0, len(text)
        while at < n:
            edge = node.edges.get(text[at])
            if edge is None:
                leaf = _Node()
                node.edges[text[at]] = text[at:], leaf
                self.size += n - at
                node, at = leaf, n
                break
            label, below = edge
            if text.startswith(label, at):
                node, at = below, at + len(label)
                continue
            k = _shared(label, text, at)
            fork = _Node()
            fork.edges[label[k]] = label[k:], below
            node.edges[text[at]] = label[:k], fork
            node, at = fork, at + k
        if node.rows is None:
            node.rows = []
        if least < node.least:
            node.least = least
        node.rows.append(row)

    def terminals(self) -> Iterator[_Node]:
        """Depth first, without recursion: a trie of long texts may be deep."""
        stack = [self.root]
        while stack:
            node = stack.pop()
            if node.rows is not None:
                yield node
            stack.extend(below for _, below in node.edges.values())


class Routes:
    """From a text to its range: a number below `size`."""

    def __init__(self, drawn: Iterable[bytes], ranges: int):
        """`drawn` holds first bytes of a sample of texts; a range shall have one of `ranges` equal shares."""
        drawn = sorted(set(drawn))
        n = min(ranges, len(drawn))
        self.splitters: list[bytes] = []
        for i in range(1, n):
            k = len(drawn) * i // n
            text, before = drawn[k], drawn[k - 1]
            # The shortest prefix that tells a text from the one before it.
            shared = _shared(text, before, 0) if text[:1] == before[:1] and before else 0
            self.splitters.append(text[: shared + 1])
        # Drawn texts are different, so each of the n prefix ranges has an equal share of them.
        self.parts = max(1, -(-ranges // max(n, 1)))
        self.size = (len(self.splitters) + 1) * self.parts

    def of(self, text: bytes) -> int:
        prefix = bisect_right(self.splitters, text)
        return prefix * self.parts + (zlib.crc32(text) % self.parts if self.parts > 1 else 0)


COLUMNS = "doc_id long, part string, mask int, n long"


def _local(batches: Iterator[pa.RecordBatch], routes: Routes, judge: Callable[[bytes], int], copy: int) -> Iterator[pa.RecordBatch]:
    trie, spread = Trie(), 0

    def flushed():
        nonlocal spread
        out = []
        for node in trie.terminals():
            first: dict = {}
            for doc_id, part, mask, text in node.rows:
                if (NULL_ID if doc_id is None else doc_id) == node.least:
                    first.setdefault(part, [doc_id, mask, node.rows[0][3], 0])[3] += 1
                else:
                    out.append((spread % routes.size, None, doc_id, part, mask | copy, 1))
                    spread += 1
            for part, (doc_id, mask, text, n) in first.items():
                out.append((routes.of(text), text, doc_id, part, mask, n))
        for i in range(0, len(out), 4096):
            yield _batch(out[i : i + 4096], ROUTED)

    for batch in batches:
        for doc_id, part, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "part", "text"))):
            least = NULL_ID if doc_id is None else doc_id
            trie.insert(text, least, (doc_id, part, judge(text), text))
            if trie.size >= FLUSH_BYTES:
                yield from flushed()
                trie = Trie()
    yield from flushed()


ROUTED = pa.schema([("route", pa.int64()), ("text", pa.binary()), ("doc_id", pa.int64()), ("part", pa.string()), ("mask", pa.int32()), ("n", pa.int64())])
FLAGGED = pa.schema([("doc_id", pa.int64()), ("part", pa.string()), ("mask", pa.int32()), ("n", pa.int64())])


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, schema)], schema=schema)


def _ranges(batches: Iterator[pa.RecordBatch], copy: int) -> Iterator[pa.RecordBatch]:
    """Rows of whole ranges, one range after the other; a trie lives as long as its range."""
    trie, at = Trie(), None

    def flushed():
        out = []
        for node in trie.terminals():
            out += [(i, part, mask | (copy if (NULL_ID if i is None else i) > node.least else 0), n) for i, part, mask, n in node.rows]
        for i in range(0, len(out), 65536):
            yield _batch(out[i : i + 65536], FLAGGED)

    for batch in batches:
        decided = []
        for route, text, doc_id, part, mask, n in zip(*(c.to_pylist() for c in batch.columns)):
            if route != at:
                yield from flushed()
                trie, at = Trie(), route
            if text is None:
                decided.append((doc_id, part, mask, n))
            else:
                trie.insert(text, NULL_ID if doc_id is None else doc_id, (doc_id, part, mask, n))
        yield _batch(decided, FLAGGED)
    yield from flushed()


def flag_copies(docs: DataFrame, part: str, judge: Callable[[bytes], int], copy: int, key: str = "doc_id", text: str = "text", range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(doc_id, part, mask, n): how many rows of an id and a part have these flags, in one or several rows.

    `judge` gives the flags of a text by its bytes; `copy` is the flag of rows whose text a smaller id has.
    """
    data = F.coalesce(F.col(text), F.lit("")).cast("binary")
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), data.alias("text"))
    size, n = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)), F.count(F.lit(1))).first()
    hashed = rows.select(F.xxhash64("doc_id", "text").alias("h"), F.substring("text", 1, PREFIX).alias("text")).where(early(F.col("h"), SAMPLE_DOCS, int(n)))
    drawn = hashed.groupBy("h").agg(F.min("text").alias("text")).orderBy("h").limit(SAMPLE_DOCS)  # repeated rows count once
    routes = Routes([bytes(r.text) for r in drawn.collect()], max(1, -(-int(size) // range_bytes)))
    routed = rows.mapInArrow(lambda b: _local(b, routes, judge, copy), "route long, text binary, " + COLUMNS)
    return routed.repartition("route").sortWithinPartitions("route").mapInArrow(lambda b: _ranges(b, copy), COLUMNS)
