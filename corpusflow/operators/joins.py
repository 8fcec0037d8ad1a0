"""Joins that no key and no table size can break."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow.storage import checkpointed

#: Slots of a Bloom filter, 64 bits each: the most rows that one is broadcast as.
SLOTS = 1 << 19
#: A key is hot from one row in so many on; there are no more hot keys than that.
HOT_SHARE = 4096


def _bits(value: Column) -> tuple[Column, Column]:
    """Slot and two bits of a value."""
    h = F.xxhash64(value)
    one = lambda by: F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.shiftright(h, by), F.lit(64)).cast("int"))
    return F.pmod(F.shiftright(h, 12), F.lit(SLOTS)), one(0).bitwiseOR(one(6))


def bloom(values: DataFrame) -> DataFrame:
    """A Bloom filter ``slot_, mask_`` of the first column of ``values``: at most ``SLOTS`` rows, however many values.

    Other columns are bit sets; a slot has those of all its values.
    """
    first, *marks = values.columns
    slot, bits = _bits(F.col(first))
    own = values.select(slot.alias("slot_"), bits.alias("bits_"), *marks)
    return own.groupBy("slot_").agg(F.bit_or("bits_").alias("mask_"), *[F.bit_or(m).alias(m) for m in marks])


def perhaps(rows: DataFrame, value: Column, known: DataFrame) -> DataFrame:
    """Rows whose ``value`` a ``bloom`` filter may have: all that it has, few others; its bit sets beside them. No row is shuffled."""
    slot, bits = _bits(value)
    own = rows.withColumn("of_", slot).withColumn("bits_", bits)
    own = own.join(F.broadcast(known), F.col("of_") == F.col("slot_"))  # at most SLOTS rows of a few numbers
    return own.filter(F.col("mask_").bitwiseAND(F.col("bits_")) == F.col("bits_")).select(*rows.columns, *known.columns[2:])


def known_keys(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows whose ``key`` is in the distinct ``keys``, where one key may hold a third of all rows.

    ``rows`` are read twice: they should be a table. Hot keys, of which there are fewer than
    ``HOT_SHARE``, are broadcast, so that their rows stay where they are; the others meet
    in a shuffle, at every size, in which no key weighs much.
    """
    counts = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n_"))
    total = rows.count()
    hot = checkpointed(counts.filter(F.col("n_") * HOT_SHARE > total).select(key))
    wanted = keys.select(key).hint("merge")
    found = F.broadcast(hot.join(wanted, key, "left_semi"))  # fewer than HOT_SHARE keys
    rest = rows.join(F.broadcast(hot), key, "left_anti")
    return rows.join(found, key, "left_semi").unionByName(rest.join(wanted, key, "left_semi"))
