"""Remove repeated byte strings by a distributed, prefix-aware merge sort of suffixes.

A byte goes if a string of `LENGTH` bytes that covers it also starts in a document with a smaller id. Steps:

1. Every string of LENGTH bytes names one anchor: the leftmost place of the least hash among its GRAM-byte grams. Equal
   strings name the same place in themselves. Anchors stand at about every fourteenth byte; strings next to each other
   mostly share theirs. Hashes of the grams at anchors go to buckets; a gram that only one document has is dead.
2. Each block of documents sorts the suffixes that start at its live anchors, cut where the last string of the anchor
   ends, merges equal ones, and sends them front-coded (length of the prefix shared with the suffix before, and the
   rest) to the ranges between sampled splitters. The bytes before an anchor, back to the start of its first string,
   go with it.
3. Each range merges its sorted runs with a loser tree that keeps, for every run, how many bytes its head shares with
   the last winner. Unequal numbers decide a match without looking at a byte; equal ones compare from there on.
4. Suffixes with one gram leave the tree side by side. Among them the strings of each anchor find the least document id
   with the same string; a suffix that has it in a later document is answered to its block with that id.
5. Each block looks up all its occurrences of the suffixes it got an answer for, and removes those with greater ids.

A gram with `HOT` occurrences or more would make a group of unbounded size, so its strings go each as a suffix of its
own: then only equal strings form a group. Both ways are exact. A block sends a suffix once, with the place of one
occurrence, the least and the greatest id; its other occurrences never leave it, so that a range has one entry a block for
a string, however often documents have it.

Null text is empty; ids that are null sort last and are equal to each other, so they don't remove from one another.
Rows with one id never remove from each other. Strings never cross documents.
"""

from __future__ import annotations

import hashlib
from array import array
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridcast.llm import blocks as B

LENGTH = 50
GRAM = 24
BLOCK_BYTES = 4 << 20
HOT = 4096
MOST = 1 << 17  # suffixes in a run
SAMPLE_DOCS = 3000  # for the splitters of the ranges, which only balance the work
SAMPLE_EACH = 6
RUNS = "range int, kind int, block int, run binary"
ANSWERS = "block int, kind int, answers binary"


def anchors(data: np.ndarray, offsets: np.ndarray, first: int = 0) -> tuple[np.ndarray, ...]:
    """Of each anchor: place, first and last start of its strings, document number (plus `first`), hash of its gram."""
    empty = np.zeros(0, np.int64)
    n = len(data) - LENGTH + 1
    if n <= 0:
        return empty, empty, empty, empty, np.zeros(0, np.uint64)
    grams = B.window_hashes(B.BYTES[data], GRAM)
    least = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64)
    width, reach = LENGTH - GRAM + 1, 1
    while reach * 2 <= width:
        least = np.minimum(least[:-reach], least[reach:])
        reach *= 2
    if reach < width:
        least = np.minimum(least[: reach - width], least[width - reach :])
    place = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
    # drop strings that cross from one document into the next
    inside = np.ones(n, bool)
    cover = np.zeros(n + 1, np.int32)
    for at, step in ((np.maximum(offsets[1:] - LENGTH + 1, 0), 1), (offsets[1:], -1)):
        np.add.at(cover, np.minimum(at, n), step)
    inside &= np.cumsum(cover)[:-1] == 0
    starts = np.flatnonzero(inside)
    if not len(starts):
        return empty, empty, empty, empty, np.zeros(0, np.uint64)
    at = place[starts]
    cut = np.flatnonzero((np.diff(at) != 0) | (np.diff(starts) != 1)) + 1
    lo = starts[np.r_[0, cut]]
    hi = starts[np.r_[cut, len(starts)] - 1]
    at = at[np.r_[0, cut]]
    doc = np.searchsorted(offsets, at, "right") - 1 + first
    return at, lo, hi, doc, B.mix(grams[at])  # least hashes crowd at the low end; mixed again they spread over all buckets


def _all_anchors(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    parts = []
    for i, j in B.pieces(offsets):
        base = offsets[i]
        at, lo, hi, doc, gram = anchors(data[base : offsets[j]], offsets[i : j + 1] - base, i)
        parts.append((at + base, lo + base, hi + base, doc, gram))
    if not parts:
        return anchors(data[:0], np.zeros(1, np.int64))
    return tuple(np.concatenate(x) for x in zip(*parts))


def _rows_at(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, width: int) -> np.ndarray:
    """One row of `width` bytes per start: data[start:start + length], then zeros."""
    padded = np.r_[data, np.zeros(width, np.uint8)]
    rows = np.lib.stride_tricks.sliding_window_view(padded, width)[starts]
    rows[np.arange(width) >= lengths[:, None]] = 0
    return rows


class _Sorted:
    """Suffixes of one block in order, equal ones (with equal bytes before) merged.

    `order` holds the occurrences, and those of suffix i are order[bounds[i]:bounds[i + 1]].
    """

    def __init__(self, data: np.ndarray, at: np.ndarray, first: np.ndarray, end: np.ndarray):
        n, most = end - at, at - first
        key = np.zeros((len(at), 80), np.uint8)
        key[:, :LENGTH] = _rows_at(data, at, n, LENGTH)
        key[:, LENGTH] = n  # zeros at the end of a suffix are told from padding
        key[:, LENGTH + 1 : 78] = _rows_at(data, first, most, LENGTH - GRAM + 1)[:, : 78 - LENGTH - 1]
        key[:, 78] = most
        columns = key.view(">u8")
        order = np.lexsort(columns.T[::-1])
        key, columns = key[order], columns[order]
        new = np.r_[True, (columns[1:] != columns[:-1]).any(1)] if len(key) else np.zeros(0, bool)
        self.bounds = np.r_[np.flatnonzero(new), len(key)]
        self.order = order
        key = key[new]
        self.suffix, self.size = key[:, :LENGTH], key[:, LENGTH].astype(np.int64)
        self.before, self.most = key[:, LENGTH + 1 : 78], key[:, 78].astype(np.int64)

    def front_code(self, i: int, j: int, doc_ids: np.ndarray, first: np.ndarray) -> bytes:
        """Suffixes i to j as a run: the bytes shared with the one before, the rest, and what an answer needs.

        `doc_ids` are the ids of the occurrences, `first` the starts of their first strings in the block.
        """
        s, n, b, m = self.suffix[i:j], self.size[i:j], self.before[i:j], self.most[i:j]
        shared = np.zeros(j - i, np.int64)
        differs = s[1:] != s[:-1]
        shared[1:] = np.minimum(np.where(differs.any(1), differs.argmax(1), LENGTH), np.minimum(n[1:], n[:-1]))
        column = np.arange(LENGTH)
        tails = s[(column >= shared[:, None]) & (column < n[:, None])]
        befores = b[np.arange(b.shape[1]) < m[:, None]]
        lo = self.bounds[i]
        own, starts = self.order[lo : self.bounds[j]], self.bounds[i:j] - lo
        who = doc_ids[own]
        return B.pack(
            (
                shared.astype(np.uint8).tobytes(),
                (n - shared).astype(np.uint8).tobytes(),
                tails.tobytes(),
                np.r_[0, np.cumsum(m)].astype(np.int64).tobytes(),
                befores.tobytes(),
                np.minimum.reduceat(who, starts).tobytes(),
                np.maximum.reduceat(who, starts).tobytes(),
                first[own[starts]].astype(np.int64).tobytes(),
            )
        )


class _Run:
    """A front-coded run, read from its start; `suffix` is the head. The numbers stay packed until they are asked for."""

    def __init__(self, block: int, packed: bytes):
        self.block = block
        self.shared_all, self.lengths, self.tails, ends, self.befores, *numbers = B.unpack(packed)
        self.ends = memoryview(ends).cast("q")
        self.least, self.most, self.places = (memoryview(x).cast("q") for x in numbers)
        self.at, self.byte, self.suffix = -1, 0, b""

    def before(self, i: int) -> bytes:
        return self.befores[self.ends[i] : self.ends[i + 1]]

    def advance(self) -> int:
        """Moves to the next suffix; the bytes it shares with the last one, or -1 at the end."""
        self.at += 1
        if self.at == len(self.shared_all):
            self.suffix = b""
            return -1
        n, k = self.shared_all[self.at], self.lengths[self.at]
        self.suffix = self.suffix[:n] + self.tails[self.byte : self.byte + k]
        self.byte += k
        return n


def _common(a: bytes, b: bytes, known: int) -> int:
    """Length of the common prefix of a and b, which share `known` bytes at least."""
    most = min(len(a), len(b))
    if a[known:most] == b[known:most]:
        return most
    while a[known] == b[known]:
        known += 1
    return known


def merge_runs(runs: list[_Run]):
    """Merges the runs by a loser tree: yields (bytes shared with the suffix before, run number, index in the run).

    known[r] is the number of bytes that the head of run r shares with the last winner it has lost against, -1 at the
    run's end. A head that shares more with the winner just put out is the smaller one.
    """
    size = 1
    while size < len(runs):
        size *= 2
    known = [-1] * size
    for r, run in enumerate(runs):
        known[r] = 0 if run.advance() >= 0 else -1
    loser = [0] * size

    def loses(a: int, b: int) -> bool:
        """Whether run a loses to run b; the loser then knows what it shares with the winner."""
        ka, kb = known[a], known[b]
        if ka != kb:
            return ka < kb
        if ka < 0:
            return a > b
        x, y = runs[a].suffix, runs[b].suffix
        n = _common(x, y, ka)
        if n == len(x) or n < len(y) and x[n] < y[n]:
            known[b] = n
            return False
        known[a] = n
        return True

    def play(node: int) -> int:
        if node >= size:
            return node - size
        a, b = play(2 * node), play(2 * node + 1)
        if loses(a, b):
            a, b = b, a
        loser[node] = b
        return a

    best = play(1)
    while known[best] >= 0:
        run = runs[best]
        yield known[best], best, run.at
        known[best] = run.advance()
        node = (best + size) >> 1
        while node:
            rival = loser[node]
            ka, kb = known[best], known[rival]
            if ka < kb or ka == kb and ka >= 0 and loses(best, rival):
                loser[node], best = best, rival
            node >>= 1


FEW = 8


def _least_by_string(kinds: dict) -> dict:
    """(suffix, before) -> least id of its documents, for the suffixes of one gram.

    Gives (suffix, before) -> [(first step, last step, id)]: the least id that has the string which starts so many steps
    before the anchor. Two suffixes share the strings whose steps are within their common bytes before the anchor and
    leave no more than their common bytes after it: one stretch of steps. For many suffixes a table of strings is
    shorter work than all pairs.
    """
    if len(kinds) == 1:
        return {(s, b): [(LENGTH - len(s), len(b), low)] for (s, b), low in kinds.items()}
    steps: dict = {}
    if len(kinds) <= FEW:
        ordered = sorted(kinds.items(), key=lambda x: x[1])
        for (s, b), low in ordered:
            out, first, last = [], LENGTH - len(s), len(b)
            open_steps = [(first, last)]
            for (t, c), other in ordered:
                if other >= low or not open_steps:
                    break
                lo, hi = LENGTH - _common(s, t, GRAM), _common_end(b, c)
                rest = []
                for x, y in open_steps:
                    i, j = max(x, lo), min(y, hi)
                    if i <= j:
                        out.append((i, j, other))
                        if x < i:
                            rest.append((x, i - 1))
                        if j < y:
                            rest.append((j + 1, y))
                    else:
                        rest.append((x, y))
                open_steps = rest
            steps[s, b] = out + [(x, y, low) for x, y in open_steps]
        return steps
    least: dict = {}
    for (s, b), low in kinds.items():
        m = len(b)
        for j in range(LENGTH - len(s), m + 1):
            string = b[m - j :] + s[: LENGTH - j]
            if least.get(string, low) >= low:
                least[string] = low
    for s, b in kinds:
        m, out = len(b), []
        for j in range(LENGTH - len(s), m + 1):
            low = least[b[m - j :] + s[: LENGTH - j]]
            if out and out[-1][2] == low:
                out[-1] = (out[-1][0], j, low)
            else:
                out.append((j, j, low))
        steps[s, b] = out
    return steps


def _common_end(a: bytes, b: bytes) -> int:
    n, most = 0, min(len(a), len(b))
    if a[len(a) - most :] == b[len(b) - most :]:
        return most
    while a[-1 - n] == b[-1 - n]:
        n += 1
    return n


def _remove_in(group: list, runs: list[_Run], found: dict) -> None:
    """Answers a group: all suffixes with one gram (or all equal strings). Of each suffix that a later document of its
    block has: place of one occurrence, first and last step of the strings concerned, least id that has them."""
    kinds: dict = {}
    for what, low, *_ in group:
        if kinds.get(what, low) >= low:
            kinds[what] = low
    steps = _least_by_string(kinds)
    for what, _, high, r, at in group:
        for first, last, low in steps[what]:
            if low < high:
                found[runs[r].block].extend((runs[r].places[at], first, last, low))


def _merge_range(table: pa.Table) -> pa.Table:
    kind = table.column("kind")[0].as_py()
    runs = [_Run(b, x) for b, x in sorted(zip(table.column("block").to_pylist(), table.column("run").to_pylist()))]
    same = LENGTH if kind else GRAM
    found: dict = defaultdict(lambda: array("q"))
    group: list = []
    low = high = 0
    for shared, r, at in merge_runs(runs):
        run = runs[r]
        if shared < same and group:
            if low < high:  # else one document holds all
                _remove_in(group, runs, found)
            group = []
        least, most = run.least[at], run.most[at]
        low, high = (min(low, least), max(high, most)) if group else (least, most)
        group.append(((run.suffix, run.before(at)), least, most, r, at))
    if group and low < high:
        _remove_in(group, runs, found)
    return pa.table(
        {
            "block": pa.array(list(found), pa.int32()),
            "kind": pa.array([kind] * len(found), pa.int32()),
            "answers": pa.array([B.pack(x.tobytes()) for x in found.values()], pa.binary()),
        }
    )


def _suffixes(kind: int, at: np.ndarray, lo: np.ndarray, hi: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, ...]:
    """Place, first and last string and document of the suffixes of anchors; of kind 1, each string is one by itself."""
    if not kind:
        return at, lo, hi, doc
    n = hi - lo + 1
    strings = np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    return strings, strings, strings, np.repeat(doc, n)


def _send_runs(table: pa.Table, states: pa.Table, buckets: int, splitters: list[bytes]) -> pa.Table:
    table = B.in_order(table)
    block = table.column("block")[0].as_py()
    data, offsets = B.flat(table)
    at, lo, hi, doc, gram = _all_anchors(data, offsets)
    state = B.states_by_hash(states, gram)
    doc_ids = B.ids(table)
    rows = []
    for kind, prefix in ((0, GRAM), (1, LENGTH)):
        use = np.flatnonzero(state == kind + 1)
        use = use[np.argsort(gram[use], kind="stable")]  # equal strings stand together, so runs hardly share any
        a, f, t, d = _suffixes(kind, at[use], lo[use], hi[use], doc[use])
        for i in range(0, len(a), MOST):  # a run is bounded, however many strings a block has
            k = slice(i, i + MOST)
            run = _Sorted(data, a[k], f[k], t[k] + LENGTH)
            bounds = np.array(sorted({s[:prefix] for s in splitters}), f"S{prefix}")
            heads = np.ascontiguousarray(run.suffix[:, :prefix]).view(f"S{prefix}").ravel()
            cuts = [0, *np.searchsorted(heads, bounds, "left").tolist(), len(heads)]
            rows += [(r, kind, run.front_code(x, y, doc_ids[d[k]], f[k])) for r, (x, y) in enumerate(zip(cuts, cuts[1:])) if x < y]
    return pa.table(
        {
            "range": pa.array([r[0] for r in rows], pa.int32()),
            "kind": pa.array([r[1] for r in rows], pa.int32()),
            "block": pa.array([block] * len(rows), pa.int32()),
            "run": pa.array([r[2] for r in rows], pa.binary()),
        }
    )


def _cover(table: pa.Table, answers: pa.Table, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Changes, byte by byte, of the number of removed strings that cover it."""
    covered = np.zeros(len(data) + 1, np.int32)
    if not answers.num_rows:
        return covered
    at, lo, hi, doc, gram = _all_anchors(data, offsets)
    doc_ids = B.ids(table)
    kinds = answers.column("kind").to_numpy()
    packed = answers.column("answers").to_pylist()
    for kind in np.unique(kinds).tolist():
        told = np.concatenate([np.frombuffer(B.unpack(x), np.int64) for x, k in zip(packed, kinds.tolist()) if k == kind]).reshape(-1, 4)
        # All anchors with a gram that an answer is about; the bytes then tell which occurrences are equal.
        about = np.unique(gram[np.searchsorted(lo, told[:, 0], "right") - 1])
        slot = np.minimum(np.searchsorted(about, gram), len(about) - 1)
        use = np.flatnonzero(about[slot] == gram)
        use = use[np.argsort(slot[use], kind="stable")]
        begins = np.searchsorted(slot[use], np.arange(len(about) + 1))
        slot_of = np.searchsorted(about, gram[np.searchsorted(lo, told[:, 0], "right") - 1])
        told = told[np.argsort(slot_of, kind="stable")]
        told_begins = np.searchsorted(np.sort(slot_of), np.arange(len(about) + 1))
        i = 0
        while i < len(about):  # whole grams, about MOST anchors at a time
            j = max(i + 1, int(np.searchsorted(begins, begins[i] + MOST, "right")) - 1)
            mine = use[begins[i] : begins[j]]
            a, f, t, d = _suffixes(kind, at[mine], lo[mine], hi[mine], doc[mine])
            run = _Sorted(data, a, f, t + LENGTH)
            group = np.empty(len(a), np.int64)
            group[run.order] = np.repeat(np.arange(len(run.bounds) - 1), np.diff(run.bounds))
            by_first = np.argsort(f, kind="stable")
            asked = told[told_begins[i] : told_begins[j]]
            g = group[by_first[np.searchsorted(f[by_first], asked[:, 0])]]
            n = run.bounds[g + 1] - run.bounds[g]
            occurrence = run.order[np.repeat(run.bounds[g], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
            first, last, low = (np.repeat(asked[:, c], n) for c in (1, 2, 3))
            later = doc_ids[d[occurrence]] > low
            place = a[occurrence[later]]
            np.add.at(covered, place - last[later], 1)
            np.add.at(covered, place - first[later] + LENGTH, -1)
            i = j
    return covered


def _per_document(marked: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Number of marked bytes of each document; a block has less than 2 GB."""
    total = np.zeros(len(marked) + 1, np.int32)
    np.cumsum(marked, out=total[1:])
    return (total[offsets[1:]] - total[offsets[:-1]]).astype(np.int64)


def _cut(table: pa.Table, answers: pa.Table, keep_text: bool) -> pa.Table:
    table = B.in_order(table)
    data, offsets = B.flat(table)
    covered = _cover(table, answers, data, offsets)
    gone = np.cumsum(covered, dtype=np.int32)[:-1] > 0
    del covered
    n_removed = _per_document(gone, offsets)
    opens = gone.copy()
    opens[1:] &= ~gone[:-1]
    opens[offsets[:-1][offsets[:-1] < len(data)]] |= gone[offsets[:-1][offsets[:-1] < len(data)]]
    n_spans = _per_document(opens, offsets)
    texts = []
    for i, j, k in zip(offsets[:-1].tolist(), offsets[1:].tolist(), n_removed.tolist()):
        texts.append((data[i:j][~gone[i:j]] if k else data[i:j]).tobytes())
    out = {
        "doc_id": table.column("doc_id"),
        "n_bytes": pa.array(np.diff(offsets)),
        "n_removed": pa.array(n_removed),
        "n_spans": pa.array(n_spans),
        "kept_sha256": pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string()),
    }
    if keep_text:
        out["kept_text"] = pa.array([t.decode("utf-8", "ignore") for t in texts], pa.string())
    return pa.table(out | {c: table.column(c) for c in table.column_names if c.startswith("_c_")})


def _sample(tables):
    for batch in tables:
        table = pa.Table.from_batches([batch])
        data, offsets = B.flat(table)
        at, _, hi, _, gram = _all_anchors(data, offsets)
        pick = np.argsort(gram, kind="stable")[: SAMPLE_EACH * table.num_rows]
        yield pa.record_batch({"s": pa.array([data[x : y + LENGTH].tobytes() for x, y in zip(at[pick], hi[pick])], pa.binary())})


def _splitters(rows: DataFrame, n: int, ranges: int) -> list[bytes]:
    few = rows if n <= SAMPLE_DOCS else rows.sample(fraction=SAMPLE_DOCS / n, seed=7)
    drawn = sorted(r.s for r in few.select("doc_id", "text").mapInArrow(B.by_batch(_sample), "s binary").limit(4 * SAMPLE_DOCS * SAMPLE_EACH).collect())
    return sorted({bytes(drawn[len(drawn) * i // ranges]) for i in range(1, ranges)}) if drawn else []


def remove_repeats(
    docs: DataFrame, key: str = "doc_id", text: str = "text", block_bytes: int = BLOCK_BYTES, hot: int = HOT, keep_text: bool = False, carry: tuple[str, ...] = ()
) -> DataFrame:
    """One row per row of `docs`: doc_id, n_bytes, n_removed, n_spans (maximal removed stretches), kept_sha256.

    keep_text adds kept_text: the bytes that stay, without the rest of characters cut in two. `carry` names columns of
    `docs` that come along as _c_<name>. block_bytes bounds what a task holds at a time; at 100 TB take 256 MB.
    """
    rows, n_blocks, n = B.in_blocks(docs, block_bytes, key, text, carry)
    splitters = _splitters(rows, n, n_blocks)
    in_rows = rows.groupBy("block")

    def marks(table: pa.Table) -> pa.Table:
        data, offsets = B.flat(table)
        *_, doc, gram = _all_anchors(data, offsets)
        return B.marks_of(table.column("block")[0].as_py(), gram, doc, n_blocks)

    states = in_rows.applyInArrow(B.by_group(marks), B.MARKS).groupBy("bucket").applyInArrow(B.by_group(lambda t: B.states_of(t, hot)), B.STATES)

    def send(table: pa.Table, back: pa.Table) -> pa.Table:
        if not table.num_rows:
            raise ValueError("hashes of a block that isn't there")
        return _send_runs(table, back, n_blocks, splitters)

    runs = rows.groupBy("block").cogroup(states.groupBy("block")).applyInArrow(B.by_cogroup(send), RUNS)
    answers = runs.groupBy("range", "kind").applyInArrow(B.by_group(_merge_range), ANSWERS)
    out = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept_text string" * keep_text
    out += "".join(f", _c_{c} {kind}" for c, kind in docs.dtypes if c in carry)
    return rows.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(B.by_cogroup(lambda t, s: _cut(t, s, keep_text)), out)
