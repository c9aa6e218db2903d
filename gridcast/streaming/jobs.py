"""Streams: coalesced refresh events, and raw tables loaded into facts as they grow."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from datetime import datetime, timedelta

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from gridcast import spec
from gridcast.operators.events import WINDOW_COLUMNS, OpenWindow, coalesce_events, routed_models
from gridcast.operators.facts import to_fact
from gridcast.operators.staging import stage
from gridcast.operators.writers import merge_by_arrival, merge_on_key


def refresh_windows(events: DataFrame, lateness: str = "10 minutes", window: str = "5 minutes") -> DataFrame:
    """Coalesced refresh windows of an event stream; a window closes when the watermark passes it."""
    timed = events.withColumn("ts", F.col("ts").cast("timestamp"))  # watermarks need an instant
    return coalesce_events(timed.withWatermark("ts", lateness), window)


def windows_from_first(events: DataFrame, lateness: str = "10 minutes", minutes: int = 5) -> DataFrame:
    """Refresh windows of an event stream, each opened by the first event after the last one closed.

    The state of the one consumer is its open window and the events that the watermark hasn't passed, so that they are
    folded in order of time whatever micro-batches they come in. A timer closes a window when the watermark reaches its
    end, also if no event follows. Events come in as one row per micro-batch and instant.
    """
    length = timedelta(minutes=minutes)
    names = WINDOW_COLUMNS.replace(",", "").split()[::2]

    def fold(_, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        start, models, n, waiting = state.get if state.exists else (None, "", 0, [])
        window = OpenWindow(length, None if start is None else _instant(start), models, n)
        waiting = [tuple(w) for w in waiting]
        for batch in batches:
            per_instant = batch.groupby(["ts", "model"], as_index=False).agg(events=("n", "sum"))
            waiting += [(int(t.value // 1000), m, int(k)) for t, m, k in per_instant.itertuples(index=False)]
        mark = state.getCurrentWatermarkMs() * 1000
        ripe = sorted(w for w in waiting if w[0] < mark)
        waiting = sorted(w for w in waiting if w[0] >= mark)
        done = []
        for micros, model, k in ripe:
            done += window.take(_instant(micros), model, k)
        done += window.closed_by(_instant(mark))
        opened = None if window.start is None else _micros(window.start)
        state.update((opened, ",".join(sorted(window.models)), window.events, waiting))
        due = [opened + int(length.total_seconds() * 1e6)] if opened is not None else []
        due += [waiting[0][0]] if waiting else []
        if due:
            state.setTimeoutTimestamp(max(min(due), mark) // 1000 + 1)
        if done:
            yield pd.DataFrame(done, columns=names)

    timed = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", lateness)
    routed = timed.select(F.lit(0).alias("consumer"), "ts", F.explode(routed_models("uri")).alias("model"), F.lit(1).alias("n"))
    state = "start long, models string, n long, waiting array<struct<ts: long, model: string, n: long>>"
    return routed.groupBy("consumer").applyInPandasWithState(fold, WINDOW_COLUMNS, state, "append", GroupStateTimeout.EventTimeTimeout)


def _instant(micros: int) -> datetime:
    return datetime(1970, 1, 1) + timedelta(microseconds=micros)


def _micros(ts: datetime) -> int:
    return (ts - datetime(1970, 1, 1)) // timedelta(microseconds=1)


def stream_raw(
    spark: SparkSession, path: str, shape: str, files_per_trigger: int | None = None, extra: str | None = None
) -> DataFrame:
    """New files of a raw table as a stream; ``extra`` adds columns (DDL) to the raw schema."""
    schema = spec.raw_schema(shape)
    if extra:
        for field in spark.createDataFrame([], extra).schema:
            schema = schema.add(field)
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def load_fact_stream(
    raw: DataFrame,
    model: str,
    shape: str,
    fact_path: str,
    checkpoint: str,
    stamp: Callable[[int], str],
    order: list | None = None,
    keep: tuple[str, ...] = (),
) -> StreamingQuery:
    """Stage and merge every micro-batch into the fact table, then stop at the end of the data.

    The checkpoint remembers what was loaded; a batch repeated after a failure merges to
    the same rows. ``stamp`` gives the load stamp of a batch by its number.
    """

    def load(batch: DataFrame, number: int) -> None:
        fact = to_fact(stage(batch, shape, keep=keep), model, shape, stamp(number), keep=keep)
        ordered = order if order is not None else [F.col(c).asc_nulls_last() for c in spec.FACT_METRICS[shape]]
        merge_on_key(fact, fact_path, spec.fact_key(shape), order=ordered, columns=spec.fact_columns(shape))

    return (
        raw.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def load_arrivals_stream(
    raw: DataFrame,
    model: str,
    shape: str,
    fact_path: str,
    checkpoint: str,
    arrival: Sequence[Column],
    stored: Sequence[str],
    stamp: Column,
) -> StreamingQuery:
    """As `load_fact_stream`, but the table is the same however the stream was cut into micro-batches.

    ``stored`` names the columns of the raw rows that tell when a row arrived; they are kept with the facts, and
    ``arrival`` sorts by them, the winning row first. ``stamp`` is the load stamp as an expression on them, so that it
    belongs to the delivery and not to the batch.
    """

    def load(batch: DataFrame, number: int) -> None:
        staged = stage(batch, shape, keep=tuple(stored))
        fact = to_fact(staged, model, shape, "1970-01-01 00:00:00", keep=tuple(stored)).withColumn("dbt_updated_at", stamp)
        merge_by_arrival(fact, fact_path, spec.fact_key(shape), arrival)

    return raw.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
