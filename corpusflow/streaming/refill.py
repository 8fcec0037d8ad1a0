"""Slots that wait for their translation, as a stream over the versions of a table.

The table's versions each hold slots ``doc_id, pos, text, out`` that are new or have
changed; a slot's state is that of its last version. A run reads the versions since the
last run, asks for the blank slots among them, as many as its budget allows, and appends
one version with what it got and what still waits, which the next run reads.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from corpusflow.operators.select import budget
from corpusflow.shipping import ship
from corpusflow.sources import sinks, versions
from corpusflow.storage import checkpointed

_SLOT = ["doc_id", "pos", "text", "out"]


def _last(slots: DataFrame) -> DataFrame:
    """Each slot as its last version has it."""
    best = F.max_by(F.struct("text", "out"), F.struct("version_", F.coalesce("out", F.lit("")) != ""))
    return slots.groupBy("doc_id", "pos").agg(best.alias("s")).select("doc_id", "pos", "s.text", "s.out")


def _stream(spark: SparkSession):
    ship(spark)
    spark.dataSource.register(versions.Versions)
    return spark.readStream.format("versions").option("stream", "true")


def refill(spark: SparkSession, path: str, checkpoint: str, ask: Callable[[DataFrame], DataFrame], max_slots: int | None = None) -> StreamingQuery:
    """One run: ``ask(doc_id, pos, text)`` gives ``doc_id, pos, out``, '' for what it could not get.

    A run that ended after its version was written does not ask again: the version says
    which batch it is of.
    """

    def step(batch: DataFrame, number: int) -> None:
        blank = F.trim(F.coalesce("out", F.lit(""))) == ""
        todo = checkpointed(_last(batch).filter(blank).withColumn("n_", F.lit(1).cast("long")))
        if todo.isEmpty():
            return
        if max_slots is not None:
            todo = budget(todo, ["doc_id", "pos"], "n_", max_slots)
        granted = todo.filter("granted > 0") if max_slots is not None else todo
        got = ask(granted.select("doc_id", "pos", "text")).select("doc_id", "pos", F.col("out").alias("got"))
        rows = todo.select("doc_id", "pos", "text").join(got, ["doc_id", "pos"], "left").select("doc_id", "pos", "text", F.coalesce("got", F.lit("")).alias("out"))
        sinks.append(rows, path, of=f"{checkpoint}#{number}")

    return _stream(spark).load(path).writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def slots(spark: SparkSession, path: str) -> DataFrame:
    """All slots as they are now, over all versions."""
    at = versions.folder(spark, path)
    numbers = [n for n in range(1, versions.latest(at)[0] + 1) if f"commit-{n}" in at.names() and versions.said(at.text(f"commit-{n}"))]
    own = [sinks.read_version(spark, path, n).select(*_SLOT).withColumn("version_", F.lit(n)) for n in numbers]
    out = own[0]
    for more in own[1:]:
        out = out.unionByName(more)
    return _last(out)
