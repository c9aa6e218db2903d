"""How filters interact: what each removes, in every order in which they can stand.

Every row gets a mask of the filters it fails. Copies come from radix tries over the texts (`text_tries`), the other flags
from one look at the text in the same pass. The masks are counted by part, and all orders are read from these counts: a
filter removes, at its place, the rows that fail it and none before it. Shapley values follow from the masks alone: of all
orders, a filter comes first among the k that a row fails in one of k.

Null texts are empty and fail what an empty text fails. A null part is the empty string. Rows with one id are counted one
by one and are no copies of each other; a null id comes after all others and has no label. An id has a label if any of its
label rows has it. An empty table has no parts, so no rows.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass
from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridcast.llm.text_tries import flag_copies

FILTERS = "ABCDE"
COPY = 1 << FILTERS.index("E")
PIECE = 1 << 20
_CAPITALS = bytes(range(65, 91))
_FOLLOWING = bytes(range(0x80, 0xC0))  # bytes that begin no code point
_SPACE = re.compile(rb"[\x20\x09-\x0D]")


@dataclass(frozen=True)
class Rules:
    """A: fewer than min_words words. B: less than distinct % of the words distinct. C: more than capitals % of the
    characters capitals. D: any of the symbols. E: the text of a smaller id."""

    min_words: int = 100
    distinct: int = 80
    capitals: int = 10
    symbols: str = "#$%&*|"


def _pieces(text: bytes):
    """The text in pieces cut at white space, so that the words of a long text don't all exist at once."""
    at = 0
    while len(text) - at > PIECE:
        space = _SPACE.search(text, at + PIECE)
        if not space:
            break
        yield text[at : space.start()]
        at = space.start()
    yield text[at:] if at else text


def mask_of(text: bytes, rules: Rules) -> int:
    """Flags of the filters A to D that a text fails."""
    n, distinct = 0, set()
    for piece in _pieces(text):
        words = piece.split()  # bytes split at the six white space characters of ASCII
        n += len(words)
        distinct.update(words)
    capitals = len(text) - len(text.translate(None, _CAPITALS))
    chars = len(text.translate(None, _FOLLOWING))
    symbols = len(text.translate(None, rules.symbols.encode())) < len(text)
    return (n < rules.min_words) | (100 * len(distinct) < rules.distinct * n) << 1 | (100 * capitals > rules.capitals * chars) << 2 | symbols << 3


def _orders() -> Column:
    """(filter_order, step, bit, before) of every filter in every order; `before` has the bits of those ahead of it."""
    rows = []
    for order in map("".join, permutations(FILTERS)):
        bits = [1 << FILTERS.index(f) for f in order]
        rows += [(order, k + 1, bits[k], sum(bits[:k])) for k in range(len(bits))]
    return F.array(*[F.struct(F.lit(o).alias("filter_order"), F.lit(s).alias("step"), F.lit(b).alias("bit"), F.lit(a).alias("before")) for o, s, b, a in rows])


def _total(count: str, keep) -> Column:
    """Sum of a count over the masks of a part for which `keep` holds."""
    return F.aggregate("cells", F.lit(0).cast("long"), lambda acc, c: acc + F.when(keep(c["mask"]), c[count]).otherwise(F.lit(0).cast("long")))


def audit(docs: DataFrame, labels: DataFrame, part: str = "lang", key: str = "doc_id", text: str = "text", rules: Rules = Rules(), **options) -> DataFrame:
    """part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley.

    One shuffle of the distinct texts, then of ids and flags; from there on a part has at most 32 rows.
    """
    flagged = flag_copies(docs, part, lambda t: mask_of(t, rules), COPY, key, text, **options)
    # Rows of one id are counted before they meet its label, so an id that many rows have is no hot key.
    by_id = flagged.groupBy("doc_id", "part", "mask").agg(F.sum("n").alias("n"))
    known = labels.where(F.col(key).isNotNull()).groupBy(F.col(key).cast("long").alias("doc_id"))
    known = known.agg(F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("bad"))
    counted = by_id.join(known, "doc_id", "left").groupBy("part", "mask").agg(
        F.sum("n").alias("n"),
        F.sum(F.when(F.col("good"), F.col("n")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("bad"), F.col("n")).otherwise(0)).alias("bad"),
    )
    parts = counted.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "bad")).alias("cells"))
    steps = parts.select("part", "cells", F.inline(_orders()))
    bit, before = F.col("bit"), F.col("before")
    failing = lambda mask: (mask.bitwiseAND(bit)) != 0
    reached = lambda mask: (mask.bitwiseAND(before)) == 0
    n_orders = math.factorial(len(FILTERS))
    share = F.aggregate(
        "cells",
        F.lit(0).cast("long"),
        lambda acc, c: acc + F.when(failing(c["mask"]), c["n"] * (F.lit(n_orders) / F.bit_count(c["mask"])).cast("long")).otherwise(F.lit(0).cast("long")),
    )
    return steps.select(
        "part",
        "filter_order",
        "step",
        _total("n", lambda m: m.bitwiseAND(before.bitwiseOR(bit)) == 0).alias("kept"),
        _total("n", lambda m: failing(m) & reached(m)).alias("removed"),
        _total("n", lambda m: failing(m) & ~reached(m)).alias("redundant"),
        _total("n", lambda m: m == bit).alias("unique_fails"),
        _total("good", lambda m: failing(m) & reached(m)).alias("good_lost"),
        _total("bad", lambda m: failing(m) & reached(m)).alias("toxic_lost"),
        share.alias("shapley"),
    )
