"""Streams of items: titles seen before, upserts, and counts over event time."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from corpusflow.functions import text as T
from corpusflow.sources import sinks


def unseen(items: DataFrame, ts: str = "pub_ts", delay: str = "7 days") -> DataFrame:
    """Items whose title key was not seen within ``delay``; empty keys go by url."""
    key = F.when(T.title_key(F.col("title")) == "", F.col("url")).otherwise(T.title_key(F.col("title")))
    return items.withColumn("title_key", key).withWatermark(ts, delay).dropDuplicatesWithinWatermark(["title_key"])


def counts(events: DataFrame, ts: str = "ts", width: str = "1 day", delay: str = "1 hour") -> DataFrame:
    """Rows and sums by type over windows of event time."""
    return events.withWatermark(ts, delay).groupBy(F.window(ts, width).alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("day"), "event_type", "n", "total")


def recent(items: DataFrame, channels: DataFrame, ts: str = "pub_ts", now: Column | None = None) -> DataFrame:
    """Items of ``channels(channel, lookback)`` within their channel's days; items without time stay."""
    own = items.join(F.broadcast(channels.select("channel", "lookback")), "channel")  # a catalogue
    limit = (F.current_timestamp() if now is None else now) - F.make_dt_interval("lookback")
    return own.filter(F.col(ts).isNull() | (F.col(ts) >= limit)).drop("lookback")


def upsert(new: DataFrame, path: str, checkpoint: str, key: str = "url", ts: str = "pub_ts", carry: Callable[[DataFrame, DataFrame], DataFrame] | None = None) -> StreamingQuery:
    """Keep the latest row for each key at ``path``; a repeated batch changes nothing.

    The table is rewritten with each batch: ``latest.follow`` does without, at the price of
    a table of changes.

    ``carry(batch, table)`` may bring what is known of earlier versions forward
    before the batch is merged (columns as in the batch).
    """

    def merge(batch: DataFrame, _: int) -> None:
        spark: SparkSession = batch.sparkSession
        known = sinks.read(spark, path, batch.schema)
        own = carry(batch, known).select(*batch.columns) if carry else batch
        both = own.withColumn("new_", F.lit(1)).unionByName(known.withColumn("new_", F.lit(0)))
        # a null time loses to any other; of equal times the row that came later wins
        best = F.max_by(F.struct(*batch.columns), F.struct(F.col(ts), "new_"))
        sinks.swap(both.groupBy(key).agg(best.alias("row")).select("row.*"), path)

    return new.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
