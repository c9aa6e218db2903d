"""Sampled SentencePiece segmentations by forward filtering and backward sampling, and lossless decoding.

The lattice of a text has an arc for each vocabulary piece at each place where it stands; a piece of rank r weighs
(r + 2) ** -alpha. The forward pass sums the weights of all paths to each place, the backward pass draws the last piece
of a path in proportion to what leads there, then the one before it, and so on: an exact sample of a segmentation with
probability in proportion to its weight. All draws come from a hash of a seed, the row key, the place in the text
and the step, so a row has the same sample wherever and whenever it is encoded.

Where no arc crosses from one character to the next (as between words, and between most characters of a script without
spaces), the lattice falls into independent stretches. All stretches of a batch go through both passes together, one
place at a time, so the work is in arrays.

A long text goes through in parts of some BATCH_CHARS characters, cut at places that no arc crosses. Draws depend on the
place in the whole text, so the parts' pieces are those of the whole. Only a stretch without such a place, as one
character repeated without end, stays in one part.

Lossless: a space in front is added and taken away again, characters without a piece become byte pieces, and so does a
literal U+2581, the vocabulary's sign for a space. Null gives null, an empty text no pieces. Equal rows get equal pieces.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridcast.llm.blocks import by_batch, mix

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
ALPHA = 1.0
SEED = 13
BATCH_CHARS = 1 << 17
CUT_CHARS = 1 << 12  # places looked at together for a cut
SPACE = "▁"
STOP = "\0"
ONE = 1 << 30
GOLD, _STEP = np.uint64(0x9E3779B97F4A7C15), 0xC2B2AE3D27D4EB4F

Pieces = tuple[tuple[str, float, str], ...]


def load_pieces(path: str = MODEL) -> Pieces:
    """(piece, score, kind) by id; kind is piece, byte or other. Read on the driver: it is some 30,000 short strings."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    kind = lambda i: "byte" if model.is_byte(i) else "other" if model.is_control(i) or model.is_unknown(i) or model.is_unused(i) else "piece"
    return tuple((model.id_to_piece(i), model.get_score(i), kind(i)) for i in range(model.get_piece_size()))


class _Trie:
    """The vocabulary as a table of (state, character) -> state, looked up for many places at a time."""

    def __init__(self, words: dict[str, int]):
        chars = sorted({c for w in words for c in w})
        self.letter = np.zeros(0x110002, np.int64)  # number of each code point, 0 for those in no piece
        self.letter[[ord(c) for c in chars]] = np.arange(1, len(chars) + 1)
        number = {c: i + 1 for i, c in enumerate(chars)}
        self.width = len(chars) + 1
        step: dict[int, int] = {}
        ends = [-1]
        for w, i in words.items():
            at = 0
            for c in w:
                key = at * self.width + number[c]
                if key not in step:
                    step[key] = len(ends)
                    ends.append(-1)
                at = step[key]
            ends[at] = i
        self.piece = np.array(ends, np.int32)
        bits = max(4, (8 * len(step)).bit_length())
        self.shift, self.keys, self.states = np.uint64(64 - bits), np.full(1 << bits, -1, np.int64), np.zeros(1 << bits, np.int32)
        for key, state in step.items():
            at = (key * int(GOLD) % 2**64) >> int(self.shift)
            while self.keys[at] >= 0:
                at = (at + 1) % len(self.keys)
            self.keys[at], self.states[at] = key, state

    def step(self, states: np.ndarray, letters: np.ndarray) -> np.ndarray:
        """Next states, -1 where there is none."""
        keys = states * self.width + letters
        at = (keys.astype(np.uint64) * GOLD >> self.shift).astype(np.int64)
        there = self.keys[at]
        out = np.where(there == keys, self.states[at], -1).astype(np.int64)
        open_ = np.flatnonzero((there != keys) & (there >= 0))
        while len(open_):
            at[open_] = (at[open_] + 1) % len(self.keys)
            there = self.keys[at[open_]]
            hit = there == keys[open_]
            out[open_[hit]] = self.states[at[open_[hit]]]
            open_ = open_[~hit & (there >= 0)]
        return out


class Lattice:
    """Samples segmentations by one vocabulary."""

    def __init__(self, pieces: Pieces, alpha: float = ALPHA):
        bytes_of = [int(p[1:-1], 16) if k == "byte" else -1 for p, _, k in pieces]
        self.byte_id = {b: i for i, b in enumerate(bytes_of) if b >= 0}
        if len(self.byte_id) != 256:
            raise ValueError("the vocabulary lacks byte pieces")
        words = {p.replace(SPACE, " "): i for i, (p, _, k) in enumerate(pieces) if k == "piece"}
        self.trie = _Trie(words)
        self.longest = max(map(len, words))
        self.weight = np.array([-alpha * math.log(2 - s) if k == "piece" else 0.0 for _, s, k in pieces])
        self.worst = -alpha * math.log(2 + len(pieces))
        self.texts = [bytes([bytes_of[i]]) if k == "byte" else p.replace(SPACE, " ").encode() if k == "piece" else b"" for i, (p, _, k) in enumerate(pieces)]

    def arcs(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each length and character: log weight (-inf without an arc) and piece of the arc that ends with the
        character; whether an arc crosses from it to the next one. A piece of -1 - c is code point c as bytes."""
        n = len(points)
        weight = np.full((self.longest, n), -np.inf, np.float32)
        piece = np.zeros((self.longest, n), np.int32)
        letters = self.trie.letter[points]
        crossed = np.zeros(n + 1, np.int32)
        start, states, size = np.arange(n), np.zeros(n, np.int64), 0
        while len(start) and size < self.longest:
            fits = start + size < n
            start, states = start[fits], states[fits]
            states = self.trie.step(states, letters[start + size])
            on = states >= 0
            start, states = start[on], states[on]
            size += 1
            ids = self.trie.piece[states]
            whole = np.flatnonzero(ids >= 0)
            end = start[whole] + size - 1
            weight[size - 1, end] = self.weight[ids[whole]]
            piece[size - 1, end] = ids[whole]
            if size > 1:
                crossed[start[whole]] += 1  # starts of one length differ, and so do ends
                crossed[end] -= 1
        for i in np.flatnonzero(weight[0] == -np.inf).tolist():
            c = int(points[i])
            if c < 0x110000:
                data = chr(c).encode()
                weight[0, i] = len(data) * self.worst
                piece[0, i] = self.byte_id[data[0]] if len(data) == 1 else -1 - c
        return weight, piece, np.cumsum(crossed)[:-1] > 0

    def open_places(self, text: str, low: int, high: int) -> np.ndarray:
        """The places above `low`, up to `high`, that no arc of the text crosses; place c lies in front of character c.
        `low` must be `longest` or more, so that no arc from the space in front of a text matters."""
        start = low - self.longest
        points = np.frombuffer(text[start : high + self.longest].encode("utf-32-le"), np.uint32).astype(np.int64)
        crossed = self.arcs(points)[2]
        places = np.arange(low + 1, min(high, len(text)) + 1)
        return places[~crossed[places - 1 - start]]

    def cut(self, text: str, low: int) -> int:
        """Where a part of a text that begins at `low` ends: the last place within BATCH_CHARS that no arc crosses, or else
        the first behind."""
        aim, floor = low + BATCH_CHARS, low + self.longest
        for high in range(aim, floor, -CUT_CHARS):
            places = self.open_places(text, max(floor, high - CUT_CHARS), high)
            if len(places):
                return int(places[-1])
        for at in range(aim, len(text), CUT_CHARS):
            places = self.open_places(text, at, at + CUT_CHARS)
            if len(places):
                return int(places[0])
        return len(text)

    def sample_long(self, text: str, key: np.ndarray) -> np.ndarray:
        """The pieces of one text of any length, in memory for some BATCH_CHARS characters; `key` holds its key."""
        out, start = [], 0
        while start < len(text):
            end = len(text) if len(text) - start <= BATCH_CHARS else self.cut(text, start)
            out.append(self.sample([text[start:end]], key, np.array([start + 1 if start else 0]))[0].astype(np.int32))
            start = end
        return np.concatenate(out)

    def sample(self, texts: list[str], keys: np.ndarray, offsets: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """All pieces of the texts one after another, and the number of pieces of each.

        Where `offsets` is above 0, a text is the part of a longer one that lies so far behind its space in front."""
        offsets = np.zeros(len(texts), np.int64) if offsets is None else offsets
        heads = [STOP if not t or o else STOP + " " for t, o in zip(texts, offsets.tolist())]
        points = np.frombuffer("".join([h + t for h, t in zip(heads, texts)]).encode("utf-32-le"), np.uint32).astype(np.int64)
        starts = np.cumsum([0] + [len(h) + len(t) for h, t in zip(heads, texts)])
        points[starts[:-1]] = 0x110000  # in front of each text; no arc crosses it
        weight, piece, crossed = self.arcs(points)
        stop = np.zeros(len(points), bool)
        stop[starts[:-1]] = True

        # between places that no arc crosses, the lattice falls into independent stretches
        opens = np.flatnonzero(np.r_[True, ~crossed[:-1]]) if len(points) else np.zeros(0, np.int64)
        length = np.diff(np.r_[opens, len(points)])
        place = np.arange(len(points)) - np.repeat(opens, length)
        chance = self.forward(weight, place)

        real = ~stop[opens]
        opens, length = opens[real], length[real]
        doc = np.searchsorted(starts, opens, "right") - 1
        seeds = mix(keys[doc] + (opens - starts[doc] + offsets[doc]).astype(np.uint64) * GOLD)
        sizes, steps = np.zeros(len(opens), np.int64), []
        live, left, step = np.arange(len(opens)), length.copy(), 0
        while len(live):
            at = opens[live] + left - 1
            drawn = _uniform(seeds[live], step)
            taken, longer, size = np.zeros(len(at), np.int64), np.arange(len(at)), 0
            while len(longer):  # the last of the cumulated chances is above any draw
                longer = longer[chance[size, at[longer]] <= drawn[longer]]
                size += 1
                taken[longer] = size
            steps.append((live, piece[taken, at]))
            sizes[live] += 1
            left = left - taken - 1
            more = left > 0
            live, left = live[more], left[more]
            step += 1
        ends = np.cumsum(sizes)
        out = np.empty(int(sizes.sum()), np.int64)
        for step, (live, ids) in enumerate(steps):
            out[ends[live] - 1 - step] = ids
        per_doc = np.bincount(doc, sizes, len(texts)).astype(np.int64)
        if (out < 0).any():
            owner = np.repeat(np.arange(len(texts)), per_doc)
            several = {x: [self.byte_id[b] for b in chr(-1 - x).encode()] for x in np.unique(out[out < 0]).tolist()}
            wide = np.ones(len(out), np.int64)
            for x, ids in several.items():
                wide[out == x] = len(ids)
            first = np.cumsum(wide) - wide
            more = np.repeat(out, wide)
            for x, ids in several.items():
                for k, i in enumerate(ids):
                    more[first[out == x] + k] = i
            out, per_doc = more, np.bincount(owner, wide, len(texts)).astype(np.int64)
        return out, per_doc

    def forward(self, weight: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Of each length and character, the cumulated chance (in parts of ONE) that the arc which ends a path to the
        character is no longer.

        `place` counts the characters since the stretch began; all stretches advance together, one place at a time.
        """
        longest = len(weight)
        chance = np.full(weight.shape, ONE, np.int32)
        reach = np.zeros(len(place))
        order = np.argsort(place.astype(np.uint16) if place.max(initial=0) < 65536 else place, kind="stable")
        bounds = np.searchsorted(place[order], np.arange(place.max(initial=-1) + 2))
        for e, (i, j) in enumerate(zip(bounds.tolist(), bounds[1:].tolist())):
            at = order[i:j]
            if e == 0:
                reach[at] = weight[0, at]
                continue
            k = min(e + 1, longest)
            x = np.take(weight[:k], at, axis=1).astype(np.float64)
            for size in range(min(e, k)):
                x[size] += reach[at - 1 - size]
            top = x.max(0)
            x = np.exp((x - top).astype(np.float32))
            total = np.cumsum(x, axis=0, dtype=np.float64)
            reach[at] = top + np.log(total[-1])
            chance[: k - 1, at] = np.rint(total[:-1] / total[-1] * ONE)
        return chance

    def decode(self, ids: np.ndarray) -> str:
        texts = self.texts
        parts = (b"".join([texts[i] for i in ids[k : k + BATCH_CHARS].tolist()]) for k in range(0, len(ids), BATCH_CHARS))
        return b"".join(parts)[1:].decode("utf-8", "replace")


def _uniform(seeds: np.ndarray, step: int) -> np.ndarray:
    """Whole numbers from 0 to ONE - 1."""
    return (mix(seeds + np.uint64((step + 1) * _STEP % 2**64)) >> np.uint64(34)).astype(np.int32)


@lru_cache(2)
def _lattice(pieces: Pieces, alpha: float) -> Lattice:
    return Lattice(pieces, alpha)


def _encoding(shared: Broadcast, alpha: float) -> Callable:
    """Batches of doc_id, text and _seed to batches of doc_id, text and pieces."""

    def made(batches):
        lattice = _lattice(shared.value, alpha)
        for batch in batches:
            ends = np.cumsum(pa.compute.fill_null(pa.compute.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False))
            start = 0
            while start < batch.num_rows:
                done = ends[start - 1] if start else 0
                stop = max(start + 1, int(np.searchsorted(ends, done + BATCH_CHARS, "right")))
                part = batch.slice(start, stop - start)
                start = stop
                texts = part.column("text").to_pylist()
                keys = part.column("_seed").to_numpy().view(np.uint64)
                if len(texts) == 1 and len(texts[0] or "") > BATCH_CHARS:
                    ids = lattice.sample_long(texts[0], keys)
                    sizes = [len(ids)]
                else:
                    ids, sizes = lattice.sample([t or "" for t in texts], keys)
                offsets = np.r_[0, np.cumsum(sizes)].astype(np.int32)
                pieces = pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids.astype(np.int32)), mask=pa.array([t is None for t in texts]))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("text"), pieces], names=["doc_id", "text", "pieces"])

    return made


def _decoding(shared: Broadcast, alpha: float, names: list[str], pieces: str) -> Callable:
    """Batches of the columns `names` to batches of these and decoded."""

    def made(batches):
        lattice = _lattice(shared.value, alpha)
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                column = part.column(pieces)
                ends, flat = column.offsets.to_pylist(), column.values
                texts = [
                    None if gone else lattice.decode(flat[i:j].to_numpy()) for gone, i, j in zip(column.is_null().to_pylist(), ends, ends[1:])
                ]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], names=[*names, "decoded"])

    return made


def _seeded(docs: DataFrame, key: str, text: str, seed: int) -> tuple[DataFrame, str]:
    """(doc_id, text, _seed; schema of the encoded rows)"""
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"), F.xxhash64(F.lit(seed), F.col(key)).alias("_seed"))
    return rows, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, text string, pieces array<int>"


def encode(docs: DataFrame, key: str = "doc_id", text: str = "text", model: str = MODEL, alpha: float = ALPHA, seed: int = SEED) -> DataFrame:
    """`doc_id`, `text` and `pieces` (array of ids) for each row of `docs`."""
    shared = docs.sparkSession.sparkContext.broadcast(load_pieces(model))
    rows, schema = _seeded(docs, key, text, seed)
    return rows.mapInArrow(by_batch(_encoding(shared, alpha)), schema)


def decode(encoded: DataFrame, pieces: str = "pieces", model: str = MODEL) -> DataFrame:
    """`encoded` and `decoded`: the text of the pieces, null for null."""
    shared = encoded.sparkSession.sparkContext.broadcast(load_pieces(model))
    names = [c for c in encoded.columns if c != "decoded"]
    schema = encoded.select(*names).schema.add("decoded", "string")
    return encoded.select(*names).mapInArrow(by_batch(_decoding(shared, ALPHA, names, pieces)), schema)


def round_trip(docs: DataFrame, key: str = "doc_id", text: str = "text", model: str = MODEL, alpha: float = ALPHA, seed: int = SEED) -> DataFrame:
    """One row per row of `docs`: doc_id, pieces, n_pieces, lossless (whether decoding gives the text back).

    `encode` and `decode` in one worker a task, with one vocabulary: one after the other each would have its own."""
    shared = docs.sparkSession.sparkContext.broadcast(load_pieces(model))
    rows, schema = _seeded(docs, key, text, seed)
    encoded, decoded = _encoding(shared, alpha), _decoding(shared, alpha, ["doc_id", "text", "pieces"], "pieces")
    both = rows.mapInArrow(by_batch(lambda batches: decoded(encoded(batches))), f"{schema}, decoded string")
    return both.select("doc_id", "pieces", F.coalesce(F.size("pieces"), F.lit(0)).cast("long").alias("n_pieces"), F.col("decoded").eqNullSafe(F.col("text")).alias("lossless"))
