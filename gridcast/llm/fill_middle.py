"""Fill-in-the-middle by displacement scatter.

A text is cut into lines, two cuts are drawn from a hash of the id, and prefix, middle and suffix change places around
three sentinels. All texts of a batch lie in one array of bytes, and every byte moves by its piece's displacement: the
changes of the displacement stand in a difference array at the first byte of each piece, their running sum is each byte's
shift, and one scatter puts all bytes of the batch in place. The way back reads the sentinels of an output, makes the same
difference array from the lengths of its pieces, and gathers.

A text is left plain if it is empty, holds a sentinel, or by the rate. Cuts: of n lines, h1 % (n + 1) and h2 % (n + 1)
whole lines stand before the two cuts, where h1 to h4 are the four first 32-bit numbers of sha256("<seed>:<id>"); h3
decides against the rate, h4 between the two forms (percent).

Null text is empty. A null id is hashed as an empty one. Rows with one id have the same hashes. Texts are whole: a long one
moves in windows of WINDOW bytes, so beside its bytes, before and after, no array grows with it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridcast.llm import blocks as B

SENTINELS = ("<P>", "<S>", "<M>")  # of prefix, suffix and middle
PLAIN, PSM, SPM = range(3)
FORMS = ("plain", "psm", "spm")
PIECE = 1 << 20
WINDOW = 1 << 20


def occurrences(data: np.ndarray, mark: bytes) -> np.ndarray:
    """Places at which the bytes of `mark` start."""
    at = np.flatnonzero(data[: max(0, len(data) - len(mark) + 1)] == mark[0])
    for k in range(1, len(mark)):
        at = at[data[at + k] == mark[k]]
    return at


def _within(at: np.ndarray, length: int, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the places, those that don't reach over the end of their document, and these documents."""
    doc = np.searchsorted(offsets, at, "right") - 1
    own = at + length <= offsets[doc + 1]
    return at[own], doc[own]


def displacements(starts: np.ndarray, outs: np.ndarray, sizes: Sequence[np.ndarray], form: np.ndarray, marks: Sequence[int]) -> tuple[np.ndarray, np.ndarray]:
    """Where the displacement changes, and by how much: three changes a document, at its pieces.

    `starts` and `outs` are the first bytes of the texts and of the outputs, `sizes` those of prefix, middle and suffix,
    `marks` the lengths of the sentinels of prefix, suffix and middle.
    """
    p, m, s = sizes
    first, psm = form == PLAIN, form == PSM
    mp, ms, mm = marks
    to = [
        np.where(first, 0, np.where(psm, mp, ms + s + mp)),
        np.where(first, p, mp + ms + mm + p + s),
        np.where(first, p + m, np.where(psm, mp + p + ms, ms)),
    ]
    shift = np.stack([outs + to[0] - starts, outs + to[1] - starts - p, outs + to[2] - starts - p - m], axis=1).ravel()
    return np.stack([starts, starts + p, starts + p + m], axis=1).ravel(), np.diff(shift, prepend=0)


def shifts(at: np.ndarray, change: np.ndarray, n: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """(first byte, end, place of each byte after its displacement) for windows over n bytes."""
    carried = 0
    for lo in range(0, n, WINDOW):
        hi = min(lo + WINDOW, n)
        i, j = np.searchsorted(at, (lo, hi))
        step = np.zeros(hi - lo, np.int64)
        np.add.at(step, at[i:j] - lo, change[i:j])  # an empty piece starts where the next one does
        step[0] += carried
        shift = np.cumsum(step)
        carried = int(shift[-1])
        yield lo, hi, shift + np.arange(lo, hi)


def transform(data: np.ndarray, offsets: np.ndarray, hashes: np.ndarray, rate: int, spm_rate: int, sentinels: Sequence[bytes]):
    """Outputs of documents: (bytes, offsets, form, number of lines, prefix bytes, middle bytes)."""
    starts, ends = offsets[:-1], offsets[1:]
    feeds = np.flatnonzero(data == 10)
    before = np.searchsorted(feeds, offsets)
    full = np.diff(before)
    last = np.zeros(len(starts), bool)
    some = ends > starts
    last[some] = data[ends[some] - 1] != 10
    n = full + last
    feed_ends = np.r_[feeds + 1, 0]

    def cut(k: np.ndarray) -> np.ndarray:
        whole = feed_ends[np.minimum(before[:-1] + np.maximum(k, 1) - 1, len(feeds))]
        return np.where(k == 0, starts, np.where(k <= full, whole, ends))

    k1, k2 = hashes[:, 0] % (n + 1), hashes[:, 1] % (n + 1)
    a, b = cut(np.minimum(k1, k2)), cut(np.maximum(k1, k2))
    plain = ~some | (hashes[:, 2] % 100 >= rate)
    for mark in sentinels:
        plain[_within(occurrences(data, mark), len(mark), offsets)[1]] = True
    form = np.where(plain, PLAIN, np.where(hashes[:, 3] % 100 < spm_rate, SPM, PSM))
    extra = sum(len(x) for x in sentinels)
    out_offsets = offsets + extra * np.r_[0, np.cumsum(~plain)]
    sizes = (a - starts, b - a, ends - b)
    out = np.empty(out_offsets[-1], np.uint8)
    marks = [len(x) for x in sentinels]
    for lo, hi, to in shifts(*displacements(starts, out_offsets[:-1], sizes, form, marks), len(data)):
        out[to] = data[lo:hi]
    o, (p, m, s), (mp, ms, mm) = out_offsets[:-1], sizes, marks
    psm = form == PSM
    places = (np.where(psm, o, o + ms + s), np.where(psm, o + mp + p, o), o + mp + ms + p + s)
    for mark, at in zip(sentinels, places):
        for k, byte in enumerate(mark):
            out[at[~plain] + k] = byte
    return out, out_offsets, form, n, sizes[0], sizes[1]


def restore(out: np.ndarray, out_offsets: np.ndarray, form: np.ndarray, sentinels: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Texts and their offsets, from outputs and forms alone."""
    marks = [len(x) for x in sentinels]
    moved = np.flatnonzero(form != PLAIN)
    where = []
    for mark in sentinels:
        at, doc = _within(occurrences(out, mark), len(mark), out_offsets)
        own = form[doc] != PLAIN
        if not np.array_equal(doc[own], moved):
            raise ValueError("an output does not hold each sentinel once")
        where.append(at[own])
    size = np.diff(out_offsets)
    p, m, s = np.zeros_like(size), np.zeros_like(size), np.zeros_like(size)
    at_p, at_s, at_m = where
    end, psm, (mp, ms, mm) = out_offsets[1:][moved], form[moved] == PSM, marks
    m[moved] = end - at_m - mm
    p[moved] = np.where(psm, at_s, at_m) - at_p - mp
    s[moved] = np.where(psm, at_m, at_p) - at_s - ms
    p[form == PLAIN] = size[form == PLAIN]
    offsets = np.r_[0, np.cumsum(p + m + s)]
    data = np.empty(offsets[-1], np.uint8)
    for lo, hi, at in shifts(*displacements(offsets[:-1], out_offsets[:-1], (p, m, s), form, marks), len(data)):
        data[lo:hi] = out[at]
    return data, offsets


def _cells(data: np.ndarray, offsets: np.ndarray) -> Iterator[bytes]:
    for i, j in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        yield data[i:j].tobytes()


def _digests(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    view = memoryview(data)
    return pa.array([hashlib.sha256(view[i:j]).hexdigest() for i, j in zip(offsets[:-1].tolist(), offsets[1:].tolist())], pa.string())


def _chars(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Code points in runs of bytes."""
    total = np.zeros(len(data) + 1, np.int32)
    np.cumsum((data & 0xC0) != 0x80, out=total[1:])
    return (total[starts + sizes] - total[starts]).astype(np.int64)


def fill_in_middle(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    seed: int = 7,
    rate: int = 100,
    spm_rate: int = 50,
    sentinels: Sequence[str] = SENTINELS,
    keep_text: bool = False,
) -> DataFrame:
    """One row per row of `docs`: doc_id, n (lines), form, prefix_chars, middle_chars, output_sha256, restored_sha256.

    keep_text adds the output itself. The restored text is rebuilt from the output and the form. No shuffle.
    """
    marks = tuple(x.encode() for x in sentinels)
    if len(set(marks)) != 3 or not all(marks) or any(x.count("<") != 1 or x.count(">") != 1 or x[0] != "<" or x[-1] != ">" for x in sentinels):
        # Then no sentinel can arise where a piece of text and a sentinel meet.
        raise ValueError("sentinels are three different strings of the form <...>")
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))), 256)
    numbers = [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long").alias(f"h{i}") for i in range(4)]
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"), *numbers)

    def made(batches):
        for batch in batches:
            table = pa.Table.from_batches([batch])
            data, offsets = B.flat(table)
            hashes = np.stack([batch.column(f"h{i}").to_numpy() for i in range(4)], axis=1)
            for i, j in B.pieces(offsets, PIECE):
                part, at = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
                out, ends, form, n, p, m = transform(part, at, hashes[i:j], rate, spm_rate, marks)
                plain = form == PLAIN
                columns = {
                    "doc_id": batch.column("doc_id").slice(i, j - i),
                    "n": pa.array(n.astype(np.int64)),
                    "form": pa.array([FORMS[f] for f in form.tolist()], pa.string()),
                    "prefix_chars": pa.array(_chars(part, at[:-1], p), mask=plain),
                    "middle_chars": pa.array(_chars(part, at[:-1] + p, m), mask=plain),
                    "output_sha256": _digests(out, ends),
                    "restored_sha256": _digests(*restore(out, ends, form, marks)),
                }
                if keep_text:
                    columns["output"] = pa.array([x.decode() for x in _cells(out, ends)], pa.string())
                yield pa.record_batch(columns)

    schema = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string"
    return rows.mapInArrow(made, schema + ", output string" * keep_text)


def restore_texts(outputs: DataFrame, output: str = "output", form: str = "form", sentinels: Sequence[str] = SENTINELS) -> DataFrame:
    """`outputs` with a column `restored`: the text before the transformation."""
    marks = tuple(x.encode() for x in sentinels)
    names = [c for c in outputs.columns if c != "restored"]

    def made(batches):
        for batch in batches:
            data, offsets = B.flat(pa.table({"text": batch.column(output).cast(pa.binary())}))
            forms = np.array([FORMS.index(f) for f in batch.column(form).to_pylist()], np.int64)
            texts = [x.decode() for x in _cells(*restore(data, offsets, forms, marks))]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(texts, pa.string())], names=[*names, "restored"])

    return outputs.select(*names).mapInArrow(made, outputs.select(*names).schema.add("restored", "string"))
