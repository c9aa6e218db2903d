"""Column expressions on words and lines, shared by the native operators.

A word is a maximal run of characters other than space, tab, line feed, vertical tab, form feed and carriage return.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPLIT_AT = "[\\x20\\x09-\\x0D]+"


def words_of(text: Column) -> Column:
    """The words of a text in order; an empty array for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPLIT_AT), "")


def count_words(text: Column) -> Column:
    """Number of words as a long, 0 for null."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit("[^\\x20\\x09-\\x0D]+")).cast("long")


def count_chars(text: Column, chars: str) -> Column:
    """How many characters of the text are among `chars`. One replacement a character: a scan of bytes each."""
    rest = text
    for c in chars:
        rest = F.replace(rest, F.lit(c), F.lit(""))
    return F.length(text) - F.length(rest)


def early(number: Column, rows: int, total: int) -> Column:
    """Whether a hash lies so low that about four times `rows` of `total` rows do.

    Ahead of a sort by the hash with a limit: else every task hands on as many rows as the limit allows, and what the last
    task (or the driver) gets would grow with the number of tasks.
    """
    return F.shiftrightunsigned(number, 33) < F.lit(int(min(1.0, 4 * rows / max(total, 1)) * 2**31))
