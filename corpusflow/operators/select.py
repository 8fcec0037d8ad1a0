"""Selection: first wins, lookback, top-N, targets, budgets, chunks, context."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusflow.storage import checkpointed


def first_wins(df: DataFrame, keys: list[str], order: list, bypass: Column | None = None) -> DataFrame:
    """One row for each key, the first in ``order``; rows where ``bypass`` holds all stay.

    The order is a maximum of a struct, so hot keys are aggregated before they
    are shuffled.
    """
    row = F.struct(*df.columns)
    picked = lambda x: x.groupBy(*keys).agg(F.min_by(row, F.struct(*order)).alias("row")).select("row.*")
    if bypass is None:
        return picked(df)
    return picked(df.filter(~bypass)).unionByName(df.filter(bypass))


def kept_counts(items: DataFrame, kept: DataFrame, by: str) -> DataFrame:
    """``by, count, kept_count``: rows before and after duplicates went."""
    both = items.select(by, F.lit(0).alias("kept_")).unionByName(kept.select(by, F.lit(1).alias("kept_")))
    return both.groupBy(by).agg(F.count_if(F.col("kept_") == 0).alias("count"), F.sum("kept_").alias("kept_count"))


def longest_wins(df: DataFrame, key: str, text: str, order: str) -> DataFrame:
    """One row for each non-empty key: the longest text, the first in ``order`` of equals."""
    best = F.max_by(F.struct(*df.columns), F.struct(F.length(text), -F.col(order)))
    found = df.filter(F.col(key) != "").groupBy(key).agg(best.alias("row")).select("row.*")
    return found.unionByName(df.filter(F.col(key) == ""))


def lookback(df: DataFrame, ts: str, now: Column, days: Column) -> DataFrame:
    """Rows not older than ``days``; rows without time stay."""
    return df.filter(F.col(ts).isNull() | (F.col(ts) >= now - F.make_dt_interval(days)))


def top_n(df: DataFrame, keys: list[str], order: list, n: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("rank", rank).filter(F.col("rank") <= n)


def first_of_each(df: DataFrame, keys: list[str], order: str, n: int, salts: int = 32) -> DataFrame:
    """The first ``n`` rows of each key in ``order``, in two steps for hot keys.

    A key's rows are first ranked in ``salts`` parts apart, so no task sorts more
    than a part of a key, then among the at most ``salts * n`` that are left.
    """
    salt = F.pmod(F.xxhash64(order), F.lit(salts))
    rank = lambda *by: F.row_number().over(Window.partitionBy(*by).orderBy(order))
    part = df.withColumn("salt_", salt).withColumn("rank_", rank(*keys, "salt_")).filter(F.col("rank_") <= n)
    return part.withColumn("rank_", rank(*keys)).filter(F.col("rank_") <= n).drop("salt_", "rank_")


def budget(df: DataFrame, order: list, todo: str, cap: int) -> DataFrame:
    """How much of ``todo`` a running total grants each row, in order, up to ``cap``.

    Sums over ranges of the order are taken first, so that no task holds all rows:
    each range is ordered by itself and starts from the sum of those before it.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # computed once: ranges drawn anew could part the rows elsewhere
    parts = checkpointed(df.repartitionByRange(n, *order).withColumn("part_", F.spark_partition_id()))
    inside = Window.partitionBy("part_").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    totals = parts.groupBy("part_").agg(F.sum(todo).alias("sum_"))  # one row a range
    before = Window.orderBy("part_").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("part_", F.coalesce(F.sum("sum_").over(before), F.lit(0)).alias("start_"))
    used = F.col("start_") + F.coalesce(F.sum(todo).over(inside), F.lit(0))
    given = F.least(F.col(todo), F.greatest(F.lit(0), F.lit(cap) - F.col("used_")))
    return parts.join(F.broadcast(starts), "part_").withColumn("used_", used).withColumn("granted", given.cast("long")).drop("part_", "start_", "used_")


def chunks(df: DataFrame, keys: list[str], order: list, size: int) -> DataFrame:
    """Rows numbered into chunks of ``size`` within each key."""
    at = F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1
    return df.withColumn("chunk", F.floor(at / size).cast("long"))


def context(df: DataFrame, key: str, order: str, text: str, width: int = 200) -> DataFrame:
    """The previous row's text (cut to ``width``) and the key's first non-null text.

    Rows are dealt out by ranges of key and order, so that a key that holds all rows is
    split over the tasks. A range sees its own rows; of the ranges before and after it needs
    their first and last keys alone: the last text of the range before, and the first
    text of a key that goes on. That is two rows a range.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # computed once: ranges drawn anew could part the rows elsewhere
    own = checkpointed(df.repartitionByRange(n, key, order).withColumn("part_", F.spark_partition_id()))
    w = Window.partitionBy("part_", key).orderBy(order)
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    own = own.withColumns({"first_": F.row_number().over(w) == 1, "prev": F.substring(F.lag(text).over(w), 1, width), "head": F.first(text, ignorenulls=True).over(whole)})
    of = lambda pick: pick(F.struct(F.struct(key, order).alias("at"), F.substring(text, 1, width).alias("text")), F.struct(key, order))
    ends = checkpointed(own.groupBy("part_").agg(of(F.min_by).alias("low"), of(F.max_by).alias("high")))
    # the key that the range before ends with, and its last text there
    before = Window.orderBy("part_")
    handed = ends.select("part_", F.lag("high").over(before).alias("handed_"))
    own = own.join(F.broadcast(handed), "part_")  # a row a range
    goes_on = F.col("first_") & F.col("handed_").isNotNull() & F.col(f"handed_.at.{key}").eqNullSafe(F.col(key))
    own = own.withColumn("prev", F.when(goes_on, F.col("handed_.text")).otherwise(F.col("prev"))).drop("handed_", "first_")
    # heads of the keys that begin or end a range, over all ranges that have them
    edges = ends.select("part_", F.explode(F.array_distinct(F.array(f"low.at.{key}", f"high.at.{key}"))).alias("edge_"))
    edges = own.join(F.broadcast(edges), ["part_"]).filter(F.col(key).eqNullSafe(F.col("edge_"))).groupBy("part_", "edge_").agg(F.first("head").alias("own_"))
    heads = edges.groupBy(F.col("edge_").alias("known_")).agg(F.min_by("own_", F.when(F.col("own_").isNotNull(), F.col("part_"))).alias("of_all_"))
    known = edges.select(F.col("part_").alias("at_"), "edge_").join(heads, F.col("edge_").eqNullSafe(F.col("known_"))).select("at_", "edge_", "of_all_")
    same = (F.col("part_") == F.col("at_")) & F.col(key).eqNullSafe(F.col("edge_"))
    both = own.join(F.broadcast(known), same, "left")  # two rows a range, at most
    return both.withColumn("head", F.when(F.col("of_all_").isNotNull(), F.col("of_all_")).otherwise(F.col("head"))).select(*df.columns, "prev", "head")


def in_requests(df: DataFrame, order: list, todo: str, size: int, cap: int) -> DataFrame:
    """With ``requests`` (calls of ``size`` for what is to do) and ``deferred``: whether those
    before it, in order, have used up ``cap`` calls already."""
    own = df.withColumn("requests", F.ceil(F.col(todo) / size).cast("long"))
    own = budget(own, order, "requests", cap)
    return own.withColumn("deferred", (F.col("requests") > 0) & (F.col("granted") == 0)).drop("granted")


def title_targets(items: DataFrame) -> DataFrame:
    """Items whose title has no translation yet."""
    return items.filter((F.trim(F.coalesce("title", F.lit(""))) != "") & (F.trim(F.coalesce("title_out", F.lit(""))) == ""))


def full_targets(items: DataFrame, ts: str, now: Column, days: int = 3) -> DataFrame:
    """Items with a body that is not translated, of the last ``days`` or without time."""
    todo = items.filter(~F.col("state").eqNullSafe(F.lit("ok")) & (F.trim(F.coalesce("body", F.lit(""))) != ""))
    return lookback(todo, ts, now, F.lit(days))


def needs_work(body: Column, state: Column, title_done: Column, locked: Column, summary_done: Column) -> Column:
    """Whether a document still needs translating."""
    return (F.coalesce(F.trim(body), F.lit("")) != "") & (~state.eqNullSafe(F.lit("ok")) | (~title_done & ~locked) | ~summary_done)
