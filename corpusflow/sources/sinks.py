"""Sinks: nested snapshot, staged swap, versioned commit, conditional commit, run statistics and log."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusflow.sources import versions


def _fs(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def write_items(items: DataFrame, path: str, by: str | None = None) -> None:
    """The items as a table, optionally partitioned."""
    out = items.write.mode("overwrite")
    (out.partitionBy(by) if by else out).parquet(path)


def export_snapshot(items: DataFrame, updated_at: str, path: str) -> bool:
    """One JSON document with all items; False (nothing written) without items.

    A document is one value by its format: for exports of a bounded selection.
    """
    if items.isEmpty():
        return False
    doc = items.agg(F.collect_list(F.struct(*items.columns)).alias("items")).select(F.lit(updated_at).alias("updatedAt"), "items")
    doc.write.mode("overwrite").json(path)
    return True


def swap(df: DataFrame, path: str) -> None:
    """Write beside ``path`` and rename, so that ``df`` may read ``path``.

    If the writer ends between the two renames, the table lies in a folder
    ``<path>.<id>.old``, from which ``exists`` and ``read`` bring it back.
    """
    spark = df.sparkSession
    exists(spark, path)
    staged = f"{path.rstrip('/')}.{uuid.uuid4().hex}"
    df.write.parquet(staged)
    fs, target = _fs(spark, path)
    old = _fs(spark, f"{staged}.old")[1]
    if fs.exists(target):
        fs.rename(target, old)
    if not fs.rename(_fs(spark, staged)[1], target):
        exists(spark, path)
        raise OSError(f"could not put the new table at {path}")
    fs.delete(old, True)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a table at ``path``, after a swap that was cut short is undone."""
    fs, target = _fs(spark, path)
    if fs.exists(target):
        return True
    left = fs.globStatus(_fs(spark, f"{path.rstrip('/')}.*.old")[1]) or []
    newest = sorted(left, key=lambda s: s.getModificationTime())[-1:]
    return bool(newest) and bool(fs.rename(newest[0].getPath(), target))


def read(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """The table at ``path``; without one, no rows of ``schema``."""
    if not exists(spark, path):
        if schema is None:
            raise FileNotFoundError(path)
        return spark.createDataFrame([], schema)
    return (spark.read.schema(schema) if schema is not None else spark.read).parquet(path)


def current_version(spark: SparkSession, path: str) -> int:
    """The newest version that can be read; 0: none."""
    return versions.latest(versions.folder(spark, path))[0]


def commit(df: DataFrame, path: str, expected: int) -> int:
    """Write a version if ``expected`` is still the latest; raises ``versions.Conflict`` if not.

    Spark's own writer writes the rows, then one marker makes them the version (see
    ``versions``): a writer that ends before leaves the version before as it was.
    """
    spark = df.sparkSession
    at = versions.folder(spark, path)
    if versions.latest(at)[0] != expected:
        raise versions.Conflict(f"version {expected} is no longer the latest")
    data = f"data-{uuid.uuid4().hex}"
    df.write.parquet(f"{path.rstrip('/')}/{data}")
    try:
        return versions.publish(at, expected, {"data": data, "schema": df.schema.json()})
    except versions.Conflict:
        fs, own = _fs(spark, f"{path.rstrip('/')}/{data}")
        fs.delete(own, True)
        raise


def append(df: DataFrame, path: str, of: str) -> int:
    """Write a version of what is new, after whatever the latest is; 0 if one of the same ``of`` is there.

    The rows are written once; only the marker is tried again if another writer was first.
    """
    at = versions.folder(df.sparkSession, path)
    if any((versions.said(at.text(n)) or {}).get("of") == of for n in at.names() if n.startswith("commit-")):
        return 0
    data = f"data-{uuid.uuid4().hex}"
    df.write.parquet(f"{path.rstrip('/')}/{data}")
    while True:
        try:
            return versions.publish(at, versions.latest(at)[0], {"data": data, "schema": df.schema.json(), "of": of})
        except versions.Conflict:
            continue


def read_version(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The rows of a committed version, by default the latest."""
    path = path.rstrip("/")
    said = versions.marker(versions.folder(spark, path), version)
    own = lambda name: name if "/" in name and ("data" in said) else f"{path}/{name}"  # noqa: E731  once whole paths
    paths = [own(n) for n in said.get("files", [said.get("data")])]
    schema = T.StructType.fromJson(json.loads(said["schema"])) if "schema" in said else None
    if not paths:
        return spark.createDataFrame([], schema)
    return (spark.read.schema(schema) if schema else spark.read).parquet(*paths)


@contextmanager
def exclusive(spark: SparkSession, path: str, stale: float = 6 * 3600, now=time.time) -> Iterator[None]:
    """The only writer at ``path`` while it lasts; raises if there is another.

    A lock that is older than ``stale`` seconds is of a writer that ended without it.
    """
    fs, lock = _fs(spark, f"{path.rstrip('/')}.lock")
    if fs.exists(lock) and now() - fs.getFileStatus(lock).getModificationTime() / 1000 > stale:
        fs.delete(lock, False)
    try:
        fs.create(lock, False).close()
    except Exception as e:
        raise RuntimeError(f"{path} has another writer") from e
    try:
        yield
    finally:
        fs.delete(lock, False)


def log_run(stats: DataFrame, path: str, **about: str) -> None:
    """Append the one row of a run's statistics, with what is said ``about`` it."""
    stats.select(*[F.lit(str(v)).alias(k) for k, v in about.items()], "*").coalesce(1).write.mode("append").json(path)


def export_terms(terms: DataFrame, classes: int, path: str, at: str) -> None:
    """One JSON document with all terms and their number: for a bounded harvest."""
    own = terms.agg(F.count(F.lit(1)).alias("term_count"), F.sort_array(F.collect_list(F.struct("item", *[c for c in terms.columns if c != "item"]))).alias("terms"))
    own.select(F.lit(at).alias("generated_at"), F.lit(classes).alias("classes_visited"), "term_count", "terms").write.mode("overwrite").json(path)


def commit_if_changed(delta: DataFrame, path: str, expected: int) -> int:
    """``commit`` if there are rows, else the version as it is."""
    return expected if delta.isEmpty() else commit(delta, path, expected)


def run_stats(rows: DataFrame, state: str = "state") -> DataFrame:
    """Counts of a run in one row."""
    return rows.agg(F.count_if(F.col(state) == "ok").alias("ok_count"), F.count_if(F.col(state) == "failed").alias("fail_count"), F.count_if(F.col(state).isNull()).alias("deferred"), F.count(F.lit(1)).alias("total"))
