"""The latest row of each key, kept in a state store: the cost of a batch is that of its rows."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from corpusflow.shipping import ship

#: Rows lie in the state as JSON, with times to the microsecond.
_JSON = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "ignoreNullFields": "false"}
_CHANGE, _TOLD = "row_ string, change_ long, gone_ boolean", ["row_", "change_", "gone_"]
#: Keys are dealt to so many groups; a state that was written with another number is none of theirs.
GROUPS = 2048
#: A key read with many others costs a small part of one that is looked up.
_READ = 4
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"


def place(schema: T.StructType, order: list[str]) -> Column:
    """Values of ``order`` (times, dates, integers) as text that sorts as they do; null is least."""

    def part(name: str) -> Column:
        kind, c = schema[name].dataType, F.col(f"`{name}`")
        if isinstance(kind, T.DateType):
            c = F.unix_date(c)
        elif isinstance(kind, T.TimestampType | T.TimestampNTZType):
            c = F.unix_micros(c.cast("timestamp"))
        c = c.cast("long")
        flipped = F.lpad(F.hex(c.bitwiseXOR(F.lit(-(2**63)).cast("long"))), 16, "0")
        return F.when(c.isNull(), "-").otherwise(F.concat(F.lit("1"), flipped))  # '-' sorts before '1'

    return F.concat(*[part(n) for n in order])


class KeepLatest(StatefulProcessor):
    """Keeps a key's greatest row by place, the later arrival of equals, and tells each change.

    Rows come by groups of keys. What a group kept is read many keys at a time, up to ``_READ``
    times as many as came; beyond that each key that came is looked up. An entry is written
    for each key that changed. With ``keep_ms``, where a group is one key, a key that no row came for
    in that time is told as gone and forgotten.
    """

    def __init__(self, keep_ms: int | None = None):
        self.keep_ms = keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.kept = handle.getMapState("kept", "key string", "place string, row string, change long, until long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        best: dict[str, tuple[str, str]] = {}
        for frame in rows:
            for k, p, r in zip(frame["key_"], frame["place_"], frame["row_"], strict=True):
                if k not in best or p >= best[k][0]:
                    best[k] = (p, r)
        until = 0
        if self.keep_ms:
            until = timerValues.getCurrentProcessingTimeInMs() + self.keep_ms
            self.handle.registerTimer(until)
        most, n, held = _READ * len(best), 0, {}
        for n, (k, v) in enumerate(islice(self.kept.iterator(), most), 1):
            if k[0] in best:
                held[k[0]] = v
        told = []
        for k, (p, r) in best.items():
            kept = held.get(k) or (self.kept.getValue((k,)) if n == most else None)
            place, row, change, _ = kept or ("", None, 0, 0)  # '' sorts before all places
            changed = p >= place and r != row
            if changed:
                place, row, change = p, r, change + 1
                told.append((row, change, False))
            if changed or self.keep_ms:
                self.kept.updateValue((k,), (place, row, change, until))
        if told:
            yield pd.DataFrame(told, columns=_TOLD)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        kept = self.kept.getValue((key[0],))
        if kept:
            _, row, change, until = kept
            if until <= expiredTimerInfo.getExpiryTimeInMs():  # no later row has put it off
                self.kept.removeKey((key[0],))
                yield pd.DataFrame([(row, change + 1, True)], columns=_TOLD)

    def close(self) -> None:
        pass


def _combined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row a key from each batch of a task, so that a hot key is a few rows from each."""
    for batch in batches:
        best: dict[str, tuple[str, int]] = {}
        for k, (key, p) in enumerate(zip(batch.column("key_").to_pylist(), batch.column("place_").to_pylist(), strict=True)):
            if key not in best or p >= best[key][0]:
                best[key] = (p, k)
        yield batch.take(pa.array([k for _, k in best.values()], pa.int64()))


def changes(items: DataFrame, key: str, order: list[str], keep_ms: int | None = None) -> DataFrame:
    """A stream of changes ``change_, gone_`` and the columns of ``items``: a row each time a
    key's latest one becomes another.

    Latest by ``order``, null before all else; of equals the one that came later; rows
    without a key are no item. The state is RocksDB's, unless the session says otherwise.
    """
    spark = items.sparkSession
    ship(spark)
    if spark.conf.get(_PROVIDER).endswith("HDFSBackedStateStoreProvider"):
        spark.conf.set(_PROVIDER, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    schema, names = items.schema, items.columns
    own = items.filter(F.col(f"`{key}`").isNotNull()).select(F.col(f"`{key}`").cast("string").alias("key_"), place(schema, order).alias("place_"), F.to_json(F.struct(*[F.col(f"`{c}`") for c in names]), _JSON).alias("row_"))
    own = own.mapInArrow(_combined, "key_ string, place_ string, row_ string")
    group = F.col("key_") if keep_ms else F.pmod(F.xxhash64("key_"), F.lit(GROUPS)).cast("string")
    kept = own.withColumn("group_", group).groupBy("group_").transformWithStateInPandas(KeepLatest(keep_ms), _CHANGE, "Append", "ProcessingTime" if keep_ms else "None")
    return kept.withColumn("row_", F.from_json("row_", schema, _JSON)).select("change_", "gone_", *[F.col("row_")[c].alias(c) for c in names])


def follow(items: DataFrame, path: str, checkpoint: str, key: str, order: list[str], keep_ms: int | None = None, **trigger) -> StreamingQuery:
    """Append the changes of ``items`` to the table at ``path``; each batch writes only its own.

    Triggered by what is available now; with ``keep_ms``, whose timers wait for their
    time, give ``processingTime``.
    """
    out = changes(items, key, order, keep_ms).writeStream.format("parquet").option("checkpointLocation", checkpoint).outputMode("append")
    return out.trigger(**(trigger or {"availableNow": True})).start(path)


def current(spark: SparkSession, path: str, key: str) -> DataFrame:
    """The latest row of each key, from the table of changes: that of its last change."""
    told = spark.read.parquet(path)
    names = [c for c in told.columns if c not in ("change_", "gone_")]
    last = told.groupBy(key).agg(F.max_by(F.struct("gone_", *[F.col(f"`{c}`") for c in names if c != key]), "change_").alias("row_"))
    return last.filter(~F.col("row_.gone_")).select(key, "row_.*").select(*names)
