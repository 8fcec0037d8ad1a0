"""Sharding by a k-d tree over document metadata (operator 3).

A node of the tree is a run of shards. It is split along the dimension in which
its documents spread widest (relative to the spread of all), at the weighted
median by bytes, until every leaf holds one shard's share of the bytes; the number
of shards is given, or follows from the bytes that a leaf may hold. All
nodes of a level are split by one range sort of a narrow table (no texts), whose
partitions carry running sums; only sums of partitions and of nodes reach the
driver, and their number is bounded by partitions and shards.

Documents with equal texts have equal coordinates and lie side by side in every
order. A cut moves to the edge of such a group if that costs at most
``GROUP_SLACK`` of a shard's bytes, so groups stay together unless one is too
large for the byte law, which comes first.

Dimensions: bytes of the text (log), least doc_id, language and source of the
documents with that text.

Cases: a null text has size 1 and CRC 0; null metadata take the lowest
coordinate; ties are cut in order of text hash, doc_id and row; repeated rows
each take a slot; fewer documents than shards leave shards empty; an empty table
gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow.llm import common as C
from corpusflow.shipping import ship

SHARDS = 8
GROUP_SLACK = 0.01
DIMENSIONS = ["d_size", "d_id", "d_lang", "d_source"]


def _code(c: Column) -> Column:
    """Strings on a line, in no meaning order; equal strings at one place."""
    return F.coalesce(F.crc32(c.cast("string").cast("binary")).cast("double"), F.lit(-1.0))


def digest(docs: DataFrame) -> DataFrame:
    """One narrow row a document, with its coordinates."""
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    own = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(raw) + 1).cast("long").alias("size"),
        F.crc32(raw).alias("text_crc32"),
        F.xxhash64(raw).alias("g"),
        _code(F.col("lang")).alias("lang_"),
        _code(F.col("source")).alias("source_"),
        F.monotonically_increasing_id().alias("rid"),
    )
    own = C.materialise(own, "digest")
    groups = own.groupBy("g").agg(F.min("doc_id").cast("double").alias("d_id"), F.min("lang_").alias("d_lang"), F.min("source_").alias("d_source"), F.count(F.lit(1)).alias("rows"))
    groups = C.materialise(groups.withColumn("d_id", F.coalesce("d_id", F.lit(-1.0))), "groups")
    joined = C.join_groups(own, groups, "g", "rows", own.count()).withColumn("d_size", F.log2(F.col("size").cast("double")))
    return joined.select("doc_id", "size", "text_crc32", "g", "rid", *DIMENSIONS, F.lit(0).alias("node"))


def _running(batches):
    """Running sums of bytes and rows before each row of a sorted partition."""
    part, size_at, rows_at = TaskContext.get().partitionId(), 0, 0
    for batch in batches:
        size = batch.column("size").to_numpy()
        n = len(size)
        before = size_at + np.concatenate([[0], np.cumsum(size)])
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(np.full(n, part, np.int32)), pa.array(before[:-1].astype(np.int64)), pa.array(np.arange(rows_at, rows_at + n, dtype=np.int64))],
            names=[*batch.schema.names, "part", "bytes_before", "rows_before"],
        )
        size_at, rows_at = int(before[-1]), rows_at + n


def _with(rows: DataFrame, values: dict[int, tuple], schema: str) -> DataFrame:
    """Rows with what is known of their node; nodes are no more than shards."""
    known = rows.sparkSession.createDataFrame([(k, *v) for k, v in values.items()], "node int, " + schema)
    return rows.join(F.broadcast(known), "node", "left")


def _sorted(rows: DataFrame, axis: dict[int, str]) -> DataFrame:
    """Rows of all nodes in order, with bytes and rows before each, over all nodes."""
    spark = rows.sparkSession
    ship(spark)
    order = ["node", "v", "g", "doc_id", "rid"]
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    named = _with(rows, {k: (DIMENSIONS.index(d),) for k, d in axis.items()}, "axis int")
    v = F.coalesce(F.get(F.array(*DIMENSIONS), F.col("axis")), F.lit(0.0))
    placed = named.withColumn("v", v).drop("axis").repartitionByRange(n, *order).sortWithinPartitions(*order)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in placed.schema) + ", part int, bytes_before long, rows_before long"
    table = C.materialise(placed.mapInArrow(C.in_worker(_running), schema), "kd")
    totals = table.groupBy("part").agg(F.sum("size").alias("b"), F.count(F.lit(1)).alias("r")).orderBy("part").collect()
    before, b, r = [], 0, 0
    for t in totals:  # one a partition
        before.append((t["part"], b, r))
        b, r = b + t["b"], r + t["r"]
    offsets = F.broadcast(spark.createDataFrame(before or [(0, 0, 0)], "part int, b long, r long"))
    moved = table.join(offsets, "part")
    return moved.withColumn("bytes_before", F.col("bytes_before") + F.col("b")).withColumn("rows_before", F.col("rows_before") + F.col("r")).drop("part", "b", "r")


def shard(docs: DataFrame, shards: int = SHARDS, target_bytes: int | None = None) -> DataFrame:
    """Per document: ``doc_id, size, text_crc32, shard, slot``.

    With ``target_bytes`` there are as many shards as keep a leaf's share within it.
    """
    rows = C.materialise(digest(docs), "coordinates")
    if target_bytes:
        shards = max(1, -(-(rows.agg(F.sum("size").alias("b")).first()["b"] or 0) // target_bytes))
    sizes = {0: shards}  # first shard of a node: number of its shards
    wide: dict[str, float] = {}
    while max(sizes.values()) > 1:
        ranges = [f(d).alias(f"{f.__name__}_{d}") for d in DIMENSIONS for f in (F.min, F.max)]
        nodes = {t["node"]: t for t in rows.groupBy("node").agg(F.sum("size").alias("b"), F.count(F.lit(1)).alias("r"), *ranges).collect()}
        if not nodes:
            return rows.select("doc_id", "size", "text_crc32", F.col("node").alias("shard"), F.lit(0).cast("long").alias("slot"))
        spread = {k: {d: t[f"max_{d}"] - t[f"min_{d}"] for d in DIMENSIONS} for k, t in nodes.items()}
        wide = wide or {d: s or 1.0 for d, s in spread[0].items()}
        axis = {k: max(DIMENSIONS, key=lambda d: (s[d] / wide[d], -DIMENSIONS.index(d))) for k, s in spread.items() if sizes[k] > 1}  # noqa: B023
        table = _sorted(rows.drop("rows_before"), axis)
        share, at, cuts = sum(t["b"] for t in nodes.values()) / shards, 0, {}
        for k in sorted(nodes):
            if sizes[k] > 1:
                cuts[k] = at + nodes[k]["b"] * (sizes[k] // 2) / sizes[k]
            at += nodes[k]["b"]
        at = _with(table, {k: (float(c),) for k, c in cuts.items()}, "cut double")
        over = at.filter((F.col("bytes_before") < F.col("cut")) & (F.col("bytes_before") + F.col("size") >= F.col("cut"))).select("node", "v", "g").collect()
        if over:  # one a node: the group that the cut would part
            parted = rows.sparkSession.createDataFrame([tuple(t) for t in over], "node int, v double, g long")
            ends = table.join(F.broadcast(parted), ["node", "v", "g"]).groupBy("node").agg(F.min("bytes_before").alias("a"), F.max(F.col("bytes_before") + F.col("size")).alias("b"))
            for edge in ends.collect():
                k = edge["node"]
                near = min((edge["a"], edge["b"]), key=lambda x: abs(x - cuts[k]))  # noqa: B023
                if abs(near - cuts[k]) <= GROUP_SLACK * share:
                    cuts[k] = float(near)
        # a row goes left if its middle lies before the cut
        half = {k: sizes[k] // 2 for k in cuts}
        at = _with(table, {k: (float(cuts[k]), half[k]) for k in cuts}, "cut double, half int")
        right = F.col("bytes_before") + F.col("size") / 2 > F.col("cut")
        placed = at.withColumn("node", F.when(right, F.col("node") + F.col("half")).otherwise(F.col("node")))
        rows = C.materialise(placed.select("doc_id", "size", "text_crc32", "g", "rid", *DIMENSIONS, "node", "rows_before"), "level")
        grown = {}
        for k, m in sizes.items():
            if k in half:
                grown |= {k: half[k], k + half[k]: m - half[k]}
            else:
                grown[k] = 1  # a leaf, or a run of shards without documents
        sizes = grown
    if "rows_before" not in rows.columns:
        rows = _sorted(rows, {})
    first = {t["node"]: t["f"] for t in rows.groupBy("node").agg(F.min("rows_before").alias("f")).collect()}
    slot = F.col("rows_before") - F.col("first")
    return _with(rows, {k: (f,) for k, f in first.items()}, "first long").select("doc_id", "size", "text_crc32", F.col("node").alias("shard"), slot.cast("long").alias("slot"))


def report(docs: DataFrame, shards: int = SHARDS, target_bytes: int | None = None) -> DataFrame:
    """``shard`` with the law that holds and without a grown shard."""
    return shard(docs, shards, target_bytes).select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
