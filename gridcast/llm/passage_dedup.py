"""Remove repeated passages of words by difference-cover anchors.

A word goes if a window of `LENGTH` words that covers it also starts in a document with a smaller id. A difference
cover modulo `PERIOD` is a set of residues such that for any two positions some shift below PERIOD moves both onto it.
So it is enough to hash the runs of LENGTH - PERIOD + 1 words that start at such positions, 6 in 31: two equal windows
share an aligned run wherever their documents put them.

1. Hashes of the aligned runs go to buckets; a run that only one document has is dead.
2. Around its live runs each block extends to the windows of LENGTH words that contain one, hashes these by 128 bits,
   merges equal ones and sends each with the least document id it has seen.
3. Buckets find the least id of each window and send it back to the blocks where some document has a larger one.

Everything but the blocks themselves moves as packed arrays, and each block sends a window once however often it has it,
so a passage in a third of all documents costs one entry a block.

Null text has no words. Null ids sort last and are equal to each other; rows with one id never remove from each other.
"""

from __future__ import annotations

import hashlib
import pickle
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from gridcast.llm import blocks as B

LENGTH = 50
PERIOD = 31
COVER = (1, 5, 11, 24, 25, 27)
BLOCK_BYTES = 4 << 20
WINDOWS = "bucket int, block int, windows binary"
LEAST = "block int, least binary"


def is_cover(cover: tuple[int, ...], period: int) -> bool:
    """Whether every difference modulo the period is one of two residues of the cover."""
    return {(a - b) % period for a in cover for b in cover} == set(range(period))


class _Words:
    """The words of a block of documents."""

    def __init__(self, table: pa.Table):
        self.data, self.offsets = B.flat(table)
        hashes, counts = [], [np.zeros(1, np.int64)]
        total = 0
        for i, j in B.pieces(self.offsets):
            base = self.offsets[i]
            data = self.data[base : self.offsets[j]]
            starts, ends, before = B.words(data, self.offsets[i : j + 1] - base)
            hashes.append(B.word_hashes(data, starts, ends))
            counts.append(before[1:] + total)
            total += len(starts)
        self.hashes = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        self.before = np.concatenate(counts)  # words before each document, and in all
        self.doc = np.repeat(np.arange(table.num_rows), np.diff(self.before))
        self.place = np.arange(total) - self.before[self.doc]

    def whole(self, width: int) -> np.ndarray:
        """Marks the words at which a run of `width` words of one document starts."""
        return self.place + width <= np.diff(self.before)[self.doc]

    def hash(self, width: int, base: int = B.BASE) -> np.ndarray:
        out = np.zeros(len(self.hashes), np.uint64)
        h = B.window_hashes(self.hashes, width, base)
        out[: len(h)] = h
        return out

    def aligned(self) -> tuple[np.ndarray, np.ndarray]:
        """Words at which aligned runs start, and the hashes of the runs."""
        width = LENGTH - PERIOD + 1
        on = np.zeros(PERIOD, bool)
        on[list(COVER)] = True
        at = np.flatnonzero(on[self.place % PERIOD] & self.whole(width))
        return at, self.hash(width)[at]


def _send_windows(table: pa.Table, states: pa.Table, buckets: int) -> pa.Table:
    w = _Words(table)
    at, runs = w.aligned()
    live = at[B.states_by_hash(states, runs) > 0]
    near = np.zeros(len(w.hashes) + 1, np.int32)
    np.add.at(near, np.maximum(live - PERIOD + 1, 0), 1)
    np.add.at(near, live + 1, -1)
    p = np.flatnonzero((np.cumsum(near)[:-1] > 0) & w.whole(LENGTH))
    one, two = w.hash(LENGTH)[p], w.hash(LENGTH, B.SECOND)[p]
    who = B.ids(table)[w.doc[p]]
    order = np.lexsort((who, two, one))
    one, two, who = one[order], two[order], who[order]
    first = np.flatnonzero(np.r_[True, (one[1:] != one[:-1]) | (two[1:] != two[:-1])]) if len(one) else np.zeros(0, np.int64)
    most = who[np.r_[first[1:], len(one)] - 1] if len(one) else who
    least, one, two = who[first], one[first], two[first]
    rows = []
    for b, s in B.bucket_slices(one, buckets):
        names, code = np.unique(least[s], return_inverse=True)
        rows.append((b, pickle.dumps((one[s].tobytes(), two[s].tobytes(), names.tobytes(), code.astype(np.int32).tobytes(), np.packbits(most[s] > least[s]).tobytes()), 5)))
    block = table.column("block")[0].as_py()
    return pa.table(
        {"bucket": pa.array([r[0] for r in rows], pa.int32()), "block": pa.array([block] * len(rows), pa.int32()), "windows": pa.array([r[1] for r in rows], pa.binary())}
    )


def _least_windows(table: pa.Table) -> pa.Table:
    one, two, least, several, sizes = [], [], [], [], []
    for packed in table.column("windows").to_pylist():
        a, b, names, code, flags = pickle.loads(packed)
        one.append(np.frombuffer(a, np.uint64))
        two.append(np.frombuffer(b, np.uint64))
        least.append(np.frombuffer(names, np.int64)[np.frombuffer(code, np.int32)])
        several.append(np.unpackbits(np.frombuffer(flags, np.uint8), count=len(one[-1])).astype(bool))
        sizes.append(len(one[-1]))
    a, b, low = np.concatenate(one), np.concatenate(two), np.concatenate(least)
    order = np.lexsort((low, b, a))
    first = np.r_[True, (a[order][1:] != a[order][:-1]) | (b[order][1:] != b[order][:-1])]
    best = np.empty(len(a), np.int64)
    best[order] = low[order][np.flatnonzero(first)][np.cumsum(first) - 1]
    tell = (best < low) | np.concatenate(several)
    ends = np.cumsum(sizes)
    out = []
    for e, n in zip(ends.tolist(), sizes):
        t = np.flatnonzero(tell[e - n : e]) + e - n
        names, code = np.unique(best[t], return_inverse=True)
        out.append(pickle.dumps((a[t].tobytes(), b[t].astype(np.uint32).tobytes(), names.tobytes(), code.astype(np.int32).tobytes()), 5) if len(t) else None)
    return pa.table({"block": table.column("block"), "least": pa.array(out, pa.binary())})


def _cut(table: pa.Table, least: pa.Table, keep_text: bool) -> pa.Table:
    w = _Words(table)
    told = [pickle.loads(x) for x in least.column("least").to_pylist() if x is not None]
    covered = np.zeros(len(w.hashes) + 1, np.int32)
    if told and len(w.hashes):
        one = np.concatenate([np.frombuffer(x[0], np.uint64) for x in told])
        two = np.concatenate([np.frombuffer(x[1], np.uint32) for x in told])
        low = np.concatenate([np.frombuffer(x[2], np.int64)[np.frombuffer(x[3], np.int32)] for x in told])
        order = np.lexsort((two, one))
        one, two, low = one[order], two[order], low[order]
        mine, also = w.hash(LENGTH), w.hash(LENGTH, B.SECOND).astype(np.uint32)
        k = np.minimum(np.searchsorted(one, mine), len(one) - 1)
        p = np.flatnonzero((one[k] == mine) & w.whole(LENGTH))
        k = k[p]
        while True:  # windows whose first hash two keys share
            step = (two[k] != also[p]) & (k + 1 < len(one))
            step &= one[np.minimum(k + 1, len(one) - 1)] == mine[p]
            if not step.any():
                break
            k = k + step
        gone = p[(two[k] == also[p]) & (low[k] < B.ids(table)[w.doc[p]])]
        np.add.at(covered, gone, 1)
        np.add.at(covered, gone + LENGTH, -1)
    stays = np.cumsum(covered)[:-1] == 0
    total = np.r_[0, np.cumsum(~stays)]
    n_words = np.diff(w.before)
    n_removed = total[w.before[1:]] - total[w.before[:-1]]
    body = w.data.tobytes()
    texts = []
    for i, j, a, b, k in zip(w.offsets[:-1].tolist(), w.offsets[1:].tolist(), w.before[:-1].tolist(), w.before[1:].tolist(), n_removed.tolist()):
        own = body[i:j].split()
        texts.append(b" ".join(compress(own, stays[a:b].tolist()) if k else own))
    out = {
        "doc_id": table.column("doc_id"),
        "n_words": pa.array(n_words.astype(np.int64)),
        "n_removed": pa.array(n_removed.astype(np.int64)),
        "kept_sha256": pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string()),
    }
    if keep_text:
        out["kept_text"] = pa.array([t.decode() for t in texts], pa.string())
    return pa.table(out)


def remove_passages(docs: DataFrame, key: str = "doc_id", text: str = "text", block_bytes: int = BLOCK_BYTES, keep_text: bool = False) -> DataFrame:
    """One row per row of `docs`: doc_id, n_words, n_removed, kept_sha256 (kept words joined by a space), and kept_text
    with keep_text. block_bytes bounds what a task holds at a time; at 100 TB take 256 MB."""
    rows, n_blocks, _ = B.in_blocks(docs, block_bytes, key, text)

    def marks(table: pa.Table) -> pa.Table:
        w = _Words(table)
        at, runs = w.aligned()
        return B.marks_of(table.column("block")[0].as_py(), runs, w.doc[at], n_blocks)

    states = rows.groupBy("block").applyInArrow(marks, B.MARKS).groupBy("bucket").applyInArrow(lambda t: B.states_of(t, 1 << 62), B.STATES)
    windows = rows.groupBy("block").cogroup(states.groupBy("block")).applyInArrow(lambda t, s: _send_windows(t, s, n_blocks), WINDOWS)
    least = windows.groupBy("bucket").applyInArrow(_least_windows, LEAST)
    out = "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", kept_text string" * keep_text
    return rows.groupBy("block").cogroup(least.groupBy("block")).applyInArrow(lambda t, x: _cut(t, x, keep_text), out)
