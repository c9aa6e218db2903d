"""From table-update events to the models that must be refreshed."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime, timedelta

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridcast import spec
from gridcast.functions import expand

ROUTES = tuple((f"{p.model}_{p.shape}", p.path_key) for p in spec.PRODUCTS)


def routed_models(uri: Column | str) -> Column:
    """Array of the models an address updates: those whose path key it contains.

    Eight ``contains`` in one expression stand in for a substring join.
    """
    uri = F.col(uri) if isinstance(uri, str) else uri
    return F.array_compact(F.array(*[F.when(F.contains(uri, F.lit(key)), F.lit(model)) for model, key in ROUTES]))


def last_success(runs: DataFrame) -> Column:
    """Start of the latest successful run, as a scalar subquery; NULL if none."""
    return runs.where(F.col("state") == "success").agg(F.max("start_date").alias("start_date")).scalar()


def models_to_refresh(
    events: DataFrame, runs: DataFrame, run_start: str, fallback_minutes: int = 15, manual: bool = False
) -> DataFrame:
    """Distinct models updated since the last successful run.

    Without a successful run, those updated in the ``fallback_minutes`` before this one. A
    ``manual`` run refreshes all models.
    """
    if manual:
        return events.sparkSession.range(1).select(expand([model for model, _ in ROUTES]).alias("model"))
    start = F.lit(run_start).cast("timestamp_ntz") - F.make_dt_interval(mins=F.lit(fallback_minutes))
    since = F.coalesce(last_success(runs), start)
    return (
        events.where(F.col("ts") > since)
        .select("uri")
        .distinct()
        .select(F.explode(routed_models("uri")).alias("model"))
        .distinct()
    )


def coalesce_events(events: DataFrame, window: str = "5 minutes") -> DataFrame:
    """Models updated per window, so that a burst of events makes one refresh.

    Works on a batch and, given a watermark, on a stream. A window's set holds at most
    the eight models, whatever number of events falls into it.
    """
    return (
        events.select("ts", F.explode(routed_models("uri")).alias("model"))
        .groupBy(F.window("ts", window))
        .agg(F.collect_set("model").alias("models"), F.count(F.lit(1)).alias("events"))
        .select(
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            F.array_join(F.array_sort("models"), ",").alias("models"),
            "events",
        )
    )


WINDOW_COLUMNS = "window_start timestamp, window_end timestamp, models string, events long"


class OpenWindow:
    """Fold of events in order of time: a window opens with the first event that lies in none, and takes all events for
    its length. Its state is the opening, the models so far (eight at most) and the number of events."""

    def __init__(self, length: timedelta, start: datetime | None = None, models: str = "", events: int = 0):
        self.length, self.start, self.models, self.events = length, start, set(models.split(",")) - {""}, events

    def closed_by(self, ts: datetime) -> list[tuple]:
        """The window as a row if it ends at or before a time."""
        if self.start is None or ts < self.start + self.length:
            return []
        row = (self.start, self.start + self.length, ",".join(sorted(self.models)), self.events)
        self.start, self.models, self.events = None, set(), 0
        return [row]

    def take(self, ts: datetime, models: str, events: int) -> list[tuple]:
        done = self.closed_by(ts)
        if self.start is None:
            self.start = ts
        self.models |= set(models.split(","))
        self.events += events
        return done


def instants(events: DataFrame) -> DataFrame:
    """One row per instant with an event of a model: ts, models (joined by commas), events. A burst becomes one row."""
    routed = events.select(F.col("ts").cast("timestamp").alias("ts"), F.explode(routed_models("uri")).alias("model"))
    grouped = routed.groupBy("ts").agg(F.array_join(F.array_sort(F.collect_set("model")), ",").alias("models"), F.count(F.lit(1)).alias("events"))
    return grouped.where(F.col("ts").isNotNull())


def coalesce_from_first(events: DataFrame, minutes: int = 5) -> DataFrame:
    """Models updated per window, where a window opens with the first event after the last one closed.

    Windows depend on each other only as long as events follow each other closely: after a pause of a window's length
    whatever comes next opens one. Events are dealt by such stretches, whose ends are found on the slots of that length
    that have an event (one row a slot, so their sort is bounded by the time span). A stretch is folded as a stream, in
    order, with one open window in memory. Events without a time are left out.
    """
    length = timedelta(minutes=minutes)
    slot = F.floor(F.unix_micros("ts") / F.lit(minutes * 60_000_000)).alias("slot")
    rows = instants(events).select("*", slot)
    # A slot without a neighbour before it starts a stretch: an empty slot lies between, so a pause of its length.
    slots = rows.select("slot").distinct()
    starts = F.when(F.col("slot") - F.lag("slot").over(Window.orderBy("slot")) == 1, None).otherwise(F.col("slot"))
    stretches = slots.select("slot", starts.alias("begin")).select(
        "slot", F.last("begin", ignorenulls=True).over(Window.orderBy("slot").rowsBetween(Window.unboundedPreceding, 0)).alias("stretch")
    )

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = WINDOW_COLUMNS.replace(",", "").split()[::2]
        window, at = OpenWindow(length), None
        for batch in batches:
            done = []
            for stretch, ts, models, n in batch.itertuples(index=False):
                if stretch != at:
                    done += window.closed_by(datetime.max)
                    at = stretch
                done += window.take(ts.to_pydatetime(), models, n)
            yield pd.DataFrame(done, columns=names)
        yield pd.DataFrame(window.closed_by(datetime.max), columns=names)

    dealt = rows.join(stretches, "slot").select("stretch", "ts", "models", "events")
    return dealt.repartition("stretch").sortWithinPartitions("stretch", "ts").mapInPandas(fold, WINDOW_COLUMNS)
