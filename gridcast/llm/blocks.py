"""Documents in blocks of bounded size, and hashes of byte strings and words on numpy arrays.

The operators that look for repeated passages work on blocks: a document's block is a hash of its id and text, and the
number of blocks follows from the counted bytes. Blocks talk to each other in packed arrays (one row per pair of block
and hash bucket), never in one row per position. All hashes are 64-bit polynomials of values mixed from the bytes.
"""

from __future__ import annotations

import ctypes
import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NULL_ID = np.iinfo(np.int64).max  # a null id sorts after all others
BASE = 0x9E3779B97F4A7C15 - 2  # odd, 3 modulo 8
SECOND = 0xD6E8FEB86659FD93
_INVERSE = {b: pow(b, -1, 2**64) for b in (BASE, SECOND)}
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def give_back() -> None:
    """Hands the memory that a worker has freed back to the system, where the C library can (glibc)."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def by_batch(made: Callable) -> Callable:
    """`made` for mapInArrow. A worker waits for the next stage with all it has freed, so it gives that back at the end."""

    def through(batches: Iterator) -> Iterator:
        yield from made(batches)
        give_back()

    return through


def by_group(made: Callable) -> Callable:
    """`made` for applyInArrow on large groups, see `by_batch`."""

    def through(table: pa.Table) -> pa.Table:
        out = made(table)
        give_back()
        return out

    return through


def by_cogroup(made: Callable) -> Callable:
    """`made` for applyInArrow on cogrouped tables, see `by_batch`."""

    def through(left: pa.Table, right: pa.Table) -> pa.Table:
        out = made(left, right)
        give_back()
        return out

    return through


def in_blocks(docs: DataFrame, block_bytes: int, key: str = "doc_id", text: str = "text", carry: tuple[str, ...] = ()) -> tuple[DataFrame, int, int]:
    """(rows of block, doc_id, text as bytes, a hash of it and the carried columns; number of blocks; number of rows).

    The input partition is part of a block's hash, so that rows repeated in every way don't all meet in one block."""
    size, n = docs.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0)), F.count(F.lit(1))).first()
    blocks = max(1, -(-int(size) // block_bytes))
    data = F.coalesce(F.col(text), F.lit("")).cast("binary")
    where = F.pmod(F.xxhash64(F.col(key), F.col(text), F.spark_partition_id()), F.lit(blocks)).cast("int")
    rows = docs.select(
        where.alias("block"), F.col(key).cast("long").alias("doc_id"), data.alias("text"), F.xxhash64(data).alias("order"), *(F.col(c).alias(f"_c_{c}") for c in carry)
    )
    return rows, blocks, int(n)


def in_order(table: pa.Table) -> pa.Table:
    """The rows of a block in the same order in every pass: a shuffle hands them out in any."""
    return table.take(pa.compute.sort_indices(table, [("doc_id", "ascending"), ("order", "ascending")]))


def ids(table: pa.Table) -> np.ndarray:
    column = table.column("doc_id")
    return column.fill_null(NULL_ID).to_numpy().astype(np.int64)


def flat(table: pa.Table, column: str = "text") -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a binary column as one array, and the n + 1 offsets of its rows."""
    chunks = [c for c in table.column(column).chunks if len(c)]
    data, ends = [], [np.zeros(1, np.int64)]
    total = 0
    for c in chunks:
        width = np.int64 if pa.types.is_large_binary(c.type) else np.int32
        at = np.frombuffer(c.buffers()[1], width, len(c) + 1, c.offset * np.dtype(width).itemsize).astype(np.int64)
        body = c.buffers()[2]
        data.append(np.frombuffer(body, np.uint8)[at[0] : at[-1]] if body is not None else np.zeros(0, np.uint8))
        ends.append(at[1:] - at[0] + total)
        total += int(at[-1] - at[0])
    return (np.concatenate(data) if len(data) > 1 else data[0] if data else np.zeros(0, np.uint8)), np.concatenate(ends)


def pieces(offsets: np.ndarray, size: int = 1 << 18):
    """Ranges of whole documents of about `size` bytes each, so that the arrays of one range stay in the cache."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + size, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


BYTES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def powers(n: int, base: int = BASE) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base, and of its inverse, modulo 2**64."""
    up, down = _powers.get(base, (None, None))
    if up is None or len(up) < n:
        n = max(n, 1 << 18)
        up, down = np.full(n, base, np.uint64), np.full(n, _INVERSE[base], np.uint64)
        up[0] = down[0] = 1
        if n <= 1 << 21:  # a long text is rare: its powers aren't kept
            _powers[base] = up, down = np.cumprod(up), np.cumprod(down)
        else:
            up, down = np.cumprod(up), np.cumprod(down)
    return up, down


def run_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int = BASE) -> np.ndarray:
    """Hash of each run values[start:end]; equal runs have equal hashes wherever they stand."""
    up, down = powers(len(values) + 1, base)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[: len(values)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def window_hashes(values: np.ndarray, width: int, base: int = BASE) -> np.ndarray:
    """Hash of every run of `width` values, as `run_hashes` gives it."""
    n = max(0, len(values) - width + 1)
    up, down = powers(len(values) + 1, base)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[: len(values)], out=sums[1:])
    return mix((sums[width : width + n] - sums[:n]) * down[:n] + np.uint64(width))


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word in the bytes, and how many words lie before each document's end (n + 1 numbers)."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = ~_SPACE[data]
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1]
    closes[:-1] &= ~inside[1:]
    cut = offsets[(offsets > 0) & (offsets < len(data))]  # words end with their document
    opens[cut] |= inside[cut]
    closes[cut - 1] |= inside[cut - 1]
    starts = np.flatnonzero(opens)
    return starts, np.flatnonzero(closes) + 1, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return run_hashes(BYTES[data], starts, ends)


def bucket_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket of a hash; it never falls as the hash rises."""
    return ((hashes >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def bucket_slices(sorted_hashes: np.ndarray, buckets: int):
    """(bucket, slice) for each bucket with hashes."""
    if len(sorted_hashes):
        at = bucket_of(sorted_hashes, buckets)
        cuts = np.flatnonzero(np.diff(at)) + 1
        for i, j in zip([0, *cuts.tolist()], [*cuts.tolist(), len(at)]):
            yield int(at[i]), slice(i, j)


def pack(value) -> bytes:
    """Arrays' bytes in one cell of a row, compressed: they are text or sorted numbers, and cross the network."""
    data = pickle.dumps(value, 5)
    return len(data).to_bytes(8, "little") + pa.compress(data, "zstd", asbytes=True)


def unpack(data: bytes):
    return pickle.loads(pa.decompress(data[8:], int.from_bytes(data[:8], "little"), "zstd"))


MARKS = "bucket int, block int, hashes binary, counts binary"
STATES = "block int, bucket int, states binary"
SHARED = 128  # flag in a count: two documents of the block have the hash


def marks_of(block: int, hashes: np.ndarray, docs: np.ndarray, buckets: int) -> pa.Table:
    """Distinct hashes of a block with the number of times it has them (127 at most); `docs` is in ascending order."""
    order = np.argsort(hashes, kind="stable")
    h, d = hashes[order], docs[order]
    first = np.flatnonzero(np.r_[True, h[1:] != h[:-1]]) if len(h) else np.zeros(0, np.int64)
    last = np.r_[first[1:], len(h)] - 1 if len(h) else first
    counts = np.minimum(last - first + 1, 127).astype(np.uint8) | np.where(d[first] != d[last], SHARED, 0).astype(np.uint8)
    h = h[first]
    rows = [(b, h[s].view(np.uint8).reshape(-1, 8)[:, :6].tobytes(), counts[s].tobytes()) for b, s in bucket_slices(h, buckets)]
    return pa.table(
        {
            "bucket": pa.array([r[0] for r in rows], pa.int32()),
            "block": pa.array([block] * len(rows), pa.int32()),
            "hashes": pa.array([r[1] for r in rows], pa.binary()),
            "counts": pa.array([r[2] for r in rows], pa.binary()),
        }
    )


def states_of(table: pa.Table, hot: int) -> pa.Table:
    """For the marks of one bucket: of each hash, 0 if one document has it, else 1, or 2 from `hot` occurrences on."""
    packed = [np.frombuffer(x, np.uint8).reshape(-1, 6) for x in table.column("hashes").to_pylist()]
    counts = np.concatenate([np.frombuffer(x, np.uint8) for x in table.column("counts").to_pylist()])
    wide = np.zeros((len(counts), 8), np.uint8)
    wide[:, :6] = np.concatenate(packed)
    values = wide.view(np.uint64).ravel()
    order = np.argsort(values, kind="stable")
    v = values[order]
    first = np.flatnonzero(np.r_[True, v[1:] != v[:-1]])
    n = np.diff(np.r_[first, len(v)])
    live = (n > 1) | (np.bitwise_or.reduceat(counts[order], first) >= SHARED)
    total = np.add.reduceat((counts[order] & 127).astype(np.int64), first)
    state = np.where(live, np.where(total >= hot, 2, 1), 0).astype(np.uint8)
    back = np.empty(len(v), np.uint8)
    back[order] = np.repeat(state, n)
    ends = np.cumsum([len(p) for p in packed])
    parts = [back[e - len(p) : e].tobytes() for p, e in zip(packed, ends.tolist())]
    return pa.table({"block": table.column("block"), "bucket": table.column("bucket"), "states": pa.array(parts, pa.binary())})


def states_by_hash(table: pa.Table, hashes: np.ndarray) -> np.ndarray:
    """State of each of a block's hashes, from the rows that `states_of` sent back to it."""
    if not len(hashes):
        return np.zeros(0, np.uint8)
    rows = sorted(zip(table.column("bucket").to_pylist(), table.column("states").to_pylist()))
    states = np.concatenate([np.frombuffer(s, np.uint8) for _, s in rows])
    distinct, inverse = np.unique(hashes, return_inverse=True)
    if len(distinct) != len(states):
        raise ValueError("a block changed between two passes over it")
    return states[inverse]
