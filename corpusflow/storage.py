"""Where intermediate tables lie (the folder that the cluster shares), and how small ones are dealt out."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

#: Used only where a single machine (tests) names no folder.
OWN_FOLDER = "/tmp/checkpoints"


def checkpoint_dir(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``; on a single machine an own folder where it is unset."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not path:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        path = OWN_FOLDER
    return path


def scratch(spark: SparkSession, tag: str) -> str:
    """A fresh path in the shared folder, deleted when the driver's JVM ends."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/corpusflow-{tag}-{uuid.uuid4().hex}"
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(target)
    return path


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` computed once, without its lineage."""
    spark = df.sparkSession
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(checkpoint_dir(spark))
    return df.checkpoint()


def stored(df: DataFrame, tag: str) -> DataFrame:
    """As ``checkpointed``, for large tables: in columns, a fraction of the disk."""
    path = scratch(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, piece: int | None = None) -> DataFrame:
    """A scan in fewer pieces than there are cores, dealt out by rows; else as it is.

    For work that is heavy for each row. Large tables have more pieces than that and are
    not shuffled; nor is anything that has been shuffled already. With ``piece``, for
    work that is heavier than a shuffle, pieces have no more bytes than that, so that
    a larger table has more of them and not longer ones.
    """
    plan = df._jdf.queryExecution()
    if plan.executedPlan().nodeName() == "AdaptiveSparkPlan":
        return df
    pieces, wanted = plan.toRdd().getNumPartitions(), df.sparkSession.sparkContext.defaultParallelism
    size = int(str(plan.optimizedPlan().stats().sizeInBytes())) if piece else 0
    if 0 < size < 1 << 50:  # what is of unknown size counts as more
        wanted = max(wanted, -(-size // piece))
    return df.repartition(wanted) if 0 < pieces < wanted else df
