"""Mix sources to target weights with hash thresholds, without sorting a row.

Each document has a hash of its id and text, cut into `LEVELS` digits. Words are summed by source and first digit, which
gives one histogram per source; the bucket in which the running sum passes the budget is the boundary. Only its rows
are summed again by the next digit, and so on. The last digit is the rest of the hash, so that the last boundary bucket
holds the rows of one id and text alone. In the end a document is taken if its hash is below the threshold of its
source; of the rows in the last bucket, which are alike, as many are taken as bring the source closest to its target.
Budgets are nested: a smaller target takes a subset.

Rows alike may be a third of all rows. They are numbered without gathering them: by task within the source, after
the number of those that earlier tasks hold.

A third of all rows in one source is harmless: sums are partial before the shuffle (one row per task, source and
bucket), and rows get their source's numbers by a broadcast join. The table of sources is broadcast only when its
counted size is small; otherwise the join shuffles, and adaptive execution splits the hot source.

A null text has size 0 and hashes as an empty one, a null source is a source of its own (last in order), a null id
hashes as the text "null".
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridcast.llm.stored import checkpointed
from gridcast.llm.words import count_words

WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
DIGITS = 3  # hexadecimal digits a level: 4,096 buckets
LEVELS = 4  # the last takes the rest of the hash
MAX_BROADCAST_SOURCES = 10_000


def hash_digits(key: Column, text: Column) -> dict[str, Column]:
    """The digits _d0, _d1, .. of the hash of an id and a text; all but the last between 0 and 16**DIGITS - 1."""
    name = F.concat(F.coalesce(key.cast("string"), F.lit("null")), F.lit(":"), F.coalesce(text, F.lit("")))
    parts = {f"_d{i}": F.conv(F.substring("_h", i * DIGITS + 1, DIGITS), 16, 10).cast("int") for i in range(LEVELS - 1)}
    return {"_h": F.md5(name), **parts, f"_d{LEVELS - 1}": F.substring("_h", (LEVELS - 1) * DIGITS + 1, 32)}


def _with_digits(df: DataFrame, key: str, text: str) -> DataFrame:
    hashed, *digits = hash_digits(F.col(key), F.col(text)).items()
    return df.withColumn(*hashed).withColumns(dict(digits)).drop("_h")


def targets(sources: DataFrame) -> DataFrame:
    """From source, source_size: the weight and the target of each source, and its full copies and rest.

    Targets share the sum of all sizes by weight. Sources whose share is above MAX_REPEATS times their size stop there
    and the rest is shared again. In order of cap by weight that is one running sum: a source is full if its cap is at
    most its share of what the sources before it leave.
    """
    named = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (named - 1) % len(WEIGHTS) + 1).cast("long")
    filling = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before, onward = filling.rowsBetween(Window.unboundedPreceding, -1), filling.rowsBetween(0, Window.unboundedFollowing)
    everywhere = filling.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    upto = filling.rowsBetween(Window.unboundedPreceding, 0)
    left = F.sum("source_size").over(everywhere) - F.coalesce(F.sum("cap").over(before), F.lit(0))
    full = F.col("cap") * F.col("_w") <= F.col("weight") * F.col("_r")
    shared = (
        sources.withColumn("weight", weight)
        .withColumn("cap", F.col("source_size") * MAX_REPEATS)
        .withColumns({"_r": left, "_w": F.sum("weight").over(onward)})
        .withColumn("_full", full)
        .withColumn("_full", F.min("_full").over(upto))
        # what the first source that isn't full sees holds for all after it
        .withColumn("_share", F.first(F.when(~F.col("_full"), F.struct("_r", "_w")), ignorenulls=True).over(everywhere))
        .withColumn(
            "target",
            F.when(F.col("_full"), F.col("cap").cast("double")).otherwise(
                (F.col("weight") * F.col("_share._r")).cast("double") / F.col("_share._w").cast("double")
            ),
        )
    )
    copies = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    return shared.withColumn("copies", copies).select(
        "source", "source_size", "weight", "target", "copies", (F.col("target") - F.col("copies") * F.col("source_size")).alias("rest")
    )


def _with_sources(rows: DataFrame, sources: DataFrame, small: bool) -> DataFrame:
    """Columns of each row's source beside the row; null sources match."""
    right = sources.withColumnRenamed("source", "_source")
    return rows.join(F.broadcast(right) if small else right, rows["source"].eqNullSafe(F.col("_source"))).drop("_source")


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """One row per row of `docs`: doc_id, source, size, source_size, target, copies, taken (= size * copies)."""
    sized, table, small = _plan(docs, key, text, source)
    rows = _with_copies(sized, table, small)
    return rows.select(
        "doc_id", "source", "size", "source_size", "target", F.col("_times").alias("copies"), (F.col("size") * F.col("_times")).alias("taken")
    )


def mix_rows(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The rows of `docs` as often as the mix takes them, with their own columns."""
    _, table, small = _plan(docs, key, text, source)
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    own = docs.select(whole.alias("_row"), F.col(key).alias("_key"), F.col(text).alias("_text"), F.col(source).alias("source"))
    own = _with_digits(own, "_key", "_text").drop("_key", "_text")
    rows = _with_copies(own, table, small).where("_times > 0")
    return rows.select("_row", F.explode(F.array_repeat(F.lit(0), F.col("_times").cast("int")))).select("_row.*")


def _with_copies(rows: DataFrame, table: DataFrame, small: bool) -> DataFrame:
    """`_times` beside each row: the full copies of its source, and one more if its hash is below the threshold."""
    below, same = F.lit(False), F.lit(True)
    for k in range(LEVELS):
        below = below | (same & (F.col(f"_d{k}") < F.col(f"_t{k}")))
        same = same & (F.col(f"_d{k}") == F.col(f"_t{k}"))
    joined = _with_sources(rows, table, small).withColumns(
        {"_below": F.coalesce(below, F.lit(False)), "_same": F.coalesce(same, F.lit(False))}
    )
    copies, take, alike = F.col("copies"), F.col("_take"), F.col("_alike")
    partly = (take > 0) & (take < alike)
    whole = (F.col("_below") | (F.col("_same") & (take >= alike))).cast("long")
    clear = joined.withColumn("_times", copies + F.coalesce(whole, F.lit(0)))
    if table.where(partly).isEmpty():  # no source ends within rows alike
        return clear
    tied = F.col("_same") & F.coalesce(partly, F.lit(False))
    # Rows alike of which some are taken: numbered by task, after those of the tasks before.
    some = checkpointed(joined.where(tied)).withColumn("_part", F.spark_partition_id())
    held = some.groupBy("source", "_part").count()
    tasks = Window.partitionBy("source").orderBy("_part")
    held = held.select(
        F.col("source").alias("_source"), F.col("_part").alias("_task"), (F.sum("count").over(tasks) - F.col("count")).alias("_earlier")
    )
    numbered = some.withColumn("_n", F.row_number().over(Window.partitionBy("source", "_part").orderBy(F.lit(0))))
    numbered = numbered.join(held, F.col("source").eqNullSafe(F.col("_source")) & (F.col("_part") == F.col("_task")))
    one = (F.col("_n") + F.col("_earlier") <= take).cast("long")
    numbered = numbered.withColumn("_times", copies + one).drop("_n", "_earlier", "_source", "_task", "_part")
    return clear.where(~tied).unionByName(numbered)


def _plan(docs: DataFrame, key: str, text: str, source: str) -> tuple[DataFrame, DataFrame, bool]:
    """(id, source, size and hash digits of each row; target, copies and threshold of each source; whether the latter
    is small)."""
    sized = docs.select(
        F.col(key).alias("doc_id"), F.col(source).alias("source"), count_words(F.col(text)).alias("size"), F.col(text).alias("_text")
    )
    sized = checkpointed(_with_digits(sized, "doc_id", "_text").drop("_text"))
    sources = checkpointed(targets(sized.groupBy("source").agg(F.sum("size").alias("source_size"))))
    small = sources.count() <= MAX_BROADCAST_SOURCES

    bounds = sources.select("source", F.lit(0).cast("long").alias("_before"), "rest")
    inside = sized
    for i in range(LEVELS):
        running = Window.partitionBy("source").orderBy(f"_d{i}")
        sums = inside.groupBy("source", f"_d{i}").agg(F.sum("size").alias("_words"), F.count(F.lit(1)).alias("_alike"))
        passed = (
            _with_sources(sums, bounds.drop("_words", "_alike"), small)
            .withColumn("_cum", F.sum("_words").over(running) + F.col("_before"))
            .where(F.col("_cum") > F.col("rest"))
            .groupBy("source")
            .agg(F.min(F.struct(f"_d{i}", (F.col("_cum") - F.col("_words")).alias("_b"), "_words", "_alike", "rest", *(f"_t{k}" for k in range(i)))).alias("_m"))
        )
        bounds = checkpointed(
            passed.select(
                "source",
                *(F.col(f"_m._t{k}").alias(f"_t{k}") for k in range(i)),
                F.col(f"_m._d{i}").alias(f"_t{i}"),
                F.col("_m._b").alias("_before"),
                F.col("_m._words").alias("_words"),
                F.col("_m._alike").alias("_alike"),
                F.col("_m.rest").alias("rest"),
            )
        )
        edge = F.lit(True)
        for k in range(i + 1):
            edge = edge & (F.col(f"_d{k}") == F.col(f"_t{k}"))
        if i < LEVELS - 1:
            inside = _with_sources(sized, bounds.drop("_before", "rest", "_words", "_alike"), small).where(edge).select(sized.columns)

    # Rows alike have one size; the threshold's bucket has words, since the running sum passes the budget in it.
    each = F.col("_words") / F.col("_alike")
    take = F.least("_alike", F.greatest(F.lit(0), F.ceil((F.col("rest") - F.col("_before")) / each - 0.5)))
    limits = bounds.select("source", *(f"_t{k}" for k in range(LEVELS)), take.alias("_take"), "_alike")
    return sized, _with_sources_outer(sources, limits), small


def _with_sources_outer(sources: DataFrame, limits: DataFrame) -> DataFrame:
    right = limits.withColumnRenamed("source", "_source")
    return sources.join(right, sources["source"].eqNullSafe(F.col("_source")), "left").drop("_source")
