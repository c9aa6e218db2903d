"""Quality rules, line first: judge every line, drop the failing lines, reject documents that lose too much text.

Everything is a projection of one row, so no row is shuffled and a long document costs only its own task time.
A line fails if one of three families of rules says so:

* punctuation: symbols or exclamation marks are frequent for its number of words, or all its letters are capitals;
* navigation: cells separated by bars, or a menu entry such as "sign in" or "next page" as the whole line;
* boilerplate: a stock phrase of web pages, or one word filling half of a line of eight words or more.

Nulls and empty texts have no words and fail the base rules. The row keeps its key columns whatever they hold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridcast.llm.words import count_chars, words_of

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MAX_LOST_PERCENT = 30
MENU = (
    "home", "menu", "search", "login", "log in", "sign in", "sign up", "register", "next", "previous", "next page",
    "previous page", "back to top", "read more", "share", "contact us", "about us", "site map", "sitemap",
)
STOCK = (
    "cookie policy", "cookies on this", "enable javascript", "all rights reserved", "terms of use", "privacy policy",
    "click here", "subscribe to our", "lorem ipsum",
)
FAMILIES = ("punctuation", "navigation", "boilerplate")


def line_fails(line: Column, words: Column, seen: Column, rules: tuple[str, ...] = FAMILIES) -> Column:
    """True for a line with words that breaks a rule of one of the named families. A line without words passes.

    `seen` is a struct of booleans on the whole text (see `_seen`); what the text lacks is not looked for in its lines.
    """
    n = F.size(words)
    made = {
        "punctuation": seen["symbol"] & (count_chars(line, SYMBOLS) * 5 > n)
        | seen["bang"] & (n >= 3) & (count_chars(line, "!") * 3 > n)
        | (n >= 5) & ~F.rlike(line, F.lit("[a-z]")) & (line == F.upper(line)) & (line != F.lower(line)),
        "navigation": seen["symbol"] & F.contains(line, F.lit("|")) & (count_chars(line, "|") * 4 >= n) & (count_chars(line, "|") >= 2)
        | (n <= 3) & F.lower(F.array_join(words, " ")).isin(*MENU),
        "boilerplate": (n >= 8) & (F.size(F.array_distinct(words)) * 2 <= n) | seen["stock"] & _has_stock(F.lower(line)),
    }
    fails = F.lit(False)
    for rule in rules:
        fails = fails | made[rule]
    return (n > 0) & fails


def _has_stock(lower: Column) -> Column:
    found = F.lit(False)
    for phrase in STOCK:
        found = found | F.contains(lower, F.lit(phrase))
    return found


def _seen(text: Column, lower: Column) -> Column:
    return F.struct(
        F.rlike(text, F.lit("[#*$%&|<>]")).alias("symbol"), F.contains(text, F.lit("!")).alias("bang"), _has_stock(lower).alias("stock")
    )


def with_repeated_words(rows: DataFrame, words: str, out: str) -> DataFrame:
    """Adds column `out`: words inside 3-word windows that the text holds at least twice, the first ones included.

    Windows are compared by a 64-bit hash of their words. Sorting them puts equal windows side by side; the starts of
    the repeated ones are sorted again, and each covers the words up to the next start, three at most. Every step is a
    projection of its own, so that no array is made twice.
    """
    n = F.size(words)
    last = F.greatest(n - 3, F.lit(0))
    windows = F.transform(
        F.slice(words, 1, F.greatest(n - 2, F.lit(0))),
        lambda w, i: F.struct(F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)).alias("h"), i.alias("p")),
    )
    sort = F.sort_array(windows)
    kept = [c for c in rows.columns]
    rows = rows.select(*kept, sort.alias("_w"))
    # each window beside the next one, then beside the one before: shifting costs one pass and no look-up by index
    rows = rows.select(*kept, "_w", F.zip_with("_w", F.slice("_w", 2, F.greatest(last, F.lit(1))), lambda a, b: F.coalesce(a["h"] == b["h"], F.lit(False))).alias("_next"))
    rows = rows.select(
        *kept,
        F.sort_array(
            F.filter(
                F.zip_with(
                    F.zip_with("_w", "_next", lambda w, x: F.struct(w["p"].alias("p"), x.alias("x"))),
                    F.concat(F.array(F.lit(False)), F.slice("_next", 1, last)),
                    lambda w, before: F.when(w["x"] | before, w["p"]),
                ),
                lambda p: p.isNotNull(),
            )
        ).alias("_starts"),
    )
    covered = F.aggregate(
        "_starts",
        F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last")),
        lambda acc, p: F.struct((acc["n"] + F.least(F.lit(3), p - acc["last"])).alias("n"), p.alias("last")),
        lambda acc: acc["n"],
    )
    return rows.select(*kept, covered.cast("long").alias(out))


def clean_documents(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of `docs`: key, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    n_lines_removed, lost_chars, clean_text, kept.

    clean_text holds the lines that pass, joined by line feeds. `kept` needs the base rules to pass and at most
    `MAX_LOST_PERCENT` of the characters in words to be on removed lines.
    """
    chars = lambda words: F.length(F.array_join(words, ""))
    body = docs.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("_t"))
    # a line feed is no part of a word, so the words of the lines are the words of the text
    split = body.select(
        "doc_id", "_t", F.transform(F.split("_t", "\n"), lambda x: F.struct(x.alias("l"), words_of(x).alias("w"))).alias("_lines")
    )
    split = split.select("doc_id", "_t", "_lines", F.flatten("_lines.w").alias("_words"), F.lower("_t").alias("_low"))
    split = split.select("doc_id", "_t", "_lines", "_words", _seen(F.col("_t"), F.col("_low")).alias("_seen"))
    judged = with_repeated_words(split, "_words", "n_repeat_words").select(
        "doc_id",
        F.size("_words").cast("long").alias("n_words"),
        chars(F.col("_words")).cast("long").alias("word_chars"),
        F.when(F.col("_seen.symbol"), count_chars(F.col("_t"), SYMBOLS)).otherwise(0).cast("long").alias("n_symbols"),
        F.filter("_lines", lambda x: F.size(x["w"]) > 0).getField("l").alias("_full"),
        "n_repeat_words",
        F.filter("_lines", lambda x: ~line_fails(x["l"], x["w"], F.col("_seen"))).alias("_good"),
        F.size("_lines").alias("_n_lines"),
    )
    counted = judged.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        (F.size("_full") - F.size(F.array_distinct("_full"))).cast("long").alias("n_dup_lines"),
        "n_repeat_words",
        (F.col("_n_lines") - F.size("_good")).cast("long").alias("n_lines_removed"),
        (F.col("word_chars") - chars(F.flatten("_good.w"))).cast("long").alias("lost_chars"),
        F.array_join("_good.l", "\n").alias("clean_text"),
    )
    failed = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT)
    return counted.withColumn("base_failed", failed).withColumn(
        "kept", ~F.col("base_failed") & (F.col("lost_chars") * 100 <= F.col("word_chars") * MAX_LOST_PERCENT)
    )
