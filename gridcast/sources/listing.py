"""Forecast file indexes (byte ranges) and directory listings (readiness).

Both work on one text per row and need no shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ANALYSIS_MARK = "anl"
PRECIPITATION = ":APCP:"
ACCUMULATED_MARK = "acc fcst"


def read_texts(spark: SparkSession, path: str) -> DataFrame:
    """Whole text files as (file, text)."""
    return spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("file"), F.col("value").alias("text")
    )


def index_ranges(indexes: DataFrame, keys: Iterable[str]) -> DataFrame:
    """Byte range of each wanted message of a forecast file.

    ``indexes`` has file, step and text; a line reads ``n:offset:date:variable:level:forecast:``
    and a key ``:variable:level:``. Per key the first line of that variable and level that
    holds the step's forecast mark wins. Its range ends one byte before the next line's
    offset and is open (NULL) on the last line.

    One regular expression with all keys runs over the text of a file and yields only its
    wanted lines, each with the head of the line that follows; the first match of each key is
    then picked by its place among them. One row per match leaves, so nothing is shuffled.
    """
    keys = list(dict.fromkeys(keys))
    odd = [k for k in keys if not re.fullmatch(":[^:]+:[^:]+:", k)]
    if odd:
        raise ValueError(f"index keys read ':variable:level:', not {odd}")
    mark = F.when(F.col("step") > 0, F.concat(F.col("step").cast("string"), F.lit(" hour fcst"))).otherwise(
        F.lit(ANALYSIS_MARK)
    )

    def field(line: Column, n: int) -> Column:
        return F.split_part(line, F.lit(":"), F.lit(n))

    lines = F.regexp_extract_all("text", wanted_lines(keys, mark), F.lit(1))
    # Variable and level of every wanted line; the rest is read from the first line of each key only.
    found = F.transform("lines", lambda pair: F.substring_index(F.substring_index(pair, ":", 5), ":", -2))
    place = F.transform(F.array(*[F.lit(k.strip(":")) for k in keys]), lambda k: F.array_position("found", k).cast("int"))
    picked = F.inline(F.arrays_zip(F.array(*map(F.lit, keys)).alias("key"), F.col("place")))
    pair = F.get("lines", F.col("place") - 1)
    following = F.split_part(pair, F.lit("\n"), F.lit(2))
    return (
        indexes.select("file", "step", lines.alias("lines"))
        .select("file", "step", "lines", found.alias("found"))
        .select("file", "step", "lines", place.alias("place"))
        .select("file", "step", "lines", picked)
        .where("place > 0")
        .select("file", "step", "key", pair.alias("pair"), following.alias("following"))
        .select(
            "file",
            "step",
            "key",
            field(F.col("pair"), 2).try_cast("bigint").alias("range_start"),
            (field(F.col("following"), 2).try_cast("bigint") - 1).alias("range_end"),
        )
    )


def wanted_lines(keys: Iterable[str], mark: Column) -> Column:
    """Pattern whose first group is a line of one of the keys with the step's mark after it, and the head of the next line.

    The group lies in a look-ahead, so that the next line can match too.
    """

    def of(some: Iterable[str]) -> str:
        return "(?:" + "|".join(re.escape(k.strip(":")) for k in some) + "):"

    accumulated = [k for k in keys if k.startswith(PRECIPITATION)]
    other = f"|{of(accumulated)}(?=[^\n]*{ACCUMULATED_MARK})" if accumulated else ""
    # (?md): lines end at a line feed only. The three fields before the key are taken whole, never given back.
    head = "(?md)^(?=(" + "[^:\n]*+:" * 3 + f"(?:{of(keys)}(?=[^\n]*"
    return F.concat(F.lit(head), mark, F.lit(f"){other})[^\n]*+(?:\n[^:\n]*+:[^:\n]*+)?))"))


def link_texts(html: Column | str) -> Column:
    """Trimmed text of every anchor of a page, inner tags removed, empty ones left out."""
    anchors = F.regexp_extract_all(html, F.lit(r"(?is)<a\b[^>]*>(.*?)</a>"), F.lit(1))
    texts = F.transform(anchors, lambda a: F.trim(F.regexp_replace(a, r"<[^>]*>", "")))
    return F.filter(texts, lambda t: F.length(t) > 0)


def target_file(step: int, ensemble: bool) -> str:
    """What the name of the last file of a complete run contains."""
    product, suffix = ("enfo", "-ep.grib2") if ensemble else ("oper", "-fc.grib2")
    return f"-{step}h-{product}{suffix}"


def sentinel_file(cycle: int, step: int) -> str:
    """Name of the last file of a complete run on servers without typed products."""
    return f"gfs.t{cycle:02d}z.pgrb2.0p25.f{step}"


def listing_ready(pages: DataFrame, link_pattern: str, sentinel: str) -> DataFrame:
    """Per listing page: is the last file of the run there?

    A page is ready when a link's text contains ``link_pattern``, or its text contains the
    ``sentinel`` name anywhere.
    """
    linked = F.exists(link_texts("html"), lambda t: F.contains(t, F.lit(link_pattern)))
    return pages.select(
        "url",
        F.size(link_texts("html")).alias("links"),
        (linked | F.contains(F.col("html"), F.lit(sentinel))).alias("ready"),
    )
