"""Structured Streaming over item arrivals."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState

from lodestream.functions.dates import episode_of
from lodestream.operators.pool import upsert
from lodestream.plans.storage import remove


def episode_counts(events: DataFrame, ts: str, kind: str, late: str = "2 days") -> DataFrame:
    """Counts by daily window, [D-1 22:30, D 22:30) UTC, and kind; rows up to ``late`` behind are still counted."""
    window = F.window(ts, "1 day", "1 day", "22 hours 30 minutes")
    counts = events.withWatermark(ts, late).groupBy(window.alias("w"), kind).agg(F.count("*").alias("n"))
    # the window ends on the morning of its episode in the sources' zone, which is the day after its end in UTC
    return counts.select(F.date_add(F.to_date(F.col("w.end")), 1).alias("episode"), kind, "n")


def first_seen(events: DataFrame, key: str, ts: str, within: str = "21 days") -> DataFrame:
    """The first row of a key within the watermark."""
    return events.withWatermark(ts, within).dropDuplicatesWithinWatermark([key])


def tagged(events: DataFrame, ts: str) -> DataFrame:
    return events.withColumn("episode", episode_of(F.col(ts)))


def final(stream: DataFrame, path: str, mode: str) -> StreamingQuery:
    """Runs a stream over what there is and writes its rows under path: of mode complete the last result, else all."""

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/out" if mode == "complete" else f"{path}/out/batch={number}")

    return stream.writeStream.outputMode(mode).foreachBatch(write).option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start()


def expired_clusters(hits: DataFrame, key: str, ts: str, ttl_days: int) -> DataFrame:
    """key, last_seen of clusters that nothing has hit for ttl_days of event time: a timer for each, which a hit moves
    ahead and never back. hits needs a watermark on ts."""

    def run(group: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            (last,) = state.get
            state.remove()
            yield pd.DataFrame({key: [group[0]], "last_seen": [pd.Timestamp(last, unit="ms")]})
            return
        last = state.get[0] if state.exists else 0
        for part in parts:
            last = max(last, int(part[ts].max().timestamp() * 1000))
        state.update((last,))
        state.setTimeoutTimestamp(max(last + ttl_days * 86_400_000, state.getCurrentWatermarkMs() + 1))

    kind = dict(hits.dtypes)[key]
    return hits.groupBy(key).applyInPandasWithState(run, f"{key} {kind}, last_seen timestamp", "last long", "append", "EventTimeTimeout")


def keep_pool(spark: SparkSession, items: DataFrame, path: str, checkpoint: str, order: str, trigger: dict | None = None) -> StreamingQuery:
    """Upserts every micro-batch into snapshots path/v=N; a batch that is replayed writes its own version again.

    The version before the last is removed once a new one stands: a replay needs the last but one at most.
    """

    def write(batch: DataFrame, number: int) -> None:
        before = f"{path}/v={number - 1}"
        columns = [c for c in batch.columns if c != order]
        old = batch.sparkSession.read.schema(batch.select(*columns).schema).parquet(before) if number else batch.select(*columns).limit(0)
        upsert(old, batch, F.col(order)).write.mode("overwrite").parquet(f"{path}/v={number}")
        if number > 1:
            remove(batch.sparkSession, f"{path}/v={number - 2}")

    writer: Callable = write
    return items.writeStream.foreachBatch(writer).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
