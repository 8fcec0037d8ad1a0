"""Hard-negative mining with a vector-approximation file (operator 11).

Anchors are some of the rows. An anchor's positives are its best other rows of its
own label; of each positive's window of scores, from ``LEAST`` percent of the
positive's score up to it, the best rows of other labels are its hard negatives.
Scores are integer inner products, ties go to the smaller id, and results are exact.

* ``build`` writes the index where the rows lie, without a shuffle: shards of at most
  ``SHARD`` rows, ordered by label. Each dimension of a shard is quantised into
  ``CELLS`` cells at the quantiles of the shard's own values; a row is its cells' numbers,
  two to a byte, beside its exact values. A cell keeps the least and greatest value in
  it, so bounds hold for every row.
* ``scan`` brings every block of anchors to every shard: shards are dealt to ``g``
  groups and blocks to ``s`` groups, and a join on ``(g, s)`` brings the groups together,
  so that no task holds more than a shard, a block, and what its blocks have found.
  For an anchor, tables of what each pair of cells adds at least and at most give by
  lookups the bounds of a score; only rows whose bounds may enter what is kept so far
  are scored exactly. Each task reports its best few for each anchor, and these meet in
  a shuffle.
* Twice: first among rows of the anchor's label, for the positives, then among the
  others, for the windows. What a task has found already narrows what comes after.

Cases: rows with a null id, label or vector, an empty vector, or a component that is null
or not finite take no part; vectors meet only those of their own length; a component
beyond ``sqrt(2^62 / length)`` counts as that, so that every score is a 64-bit integer;
repeated rows count each, but a row of the anchor's own id is no positive of it; an
anchor without positives, and a window without rows, give nothing, and a positive of
negative score has an empty window; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow.llm import common as C
from corpusflow.shipping import ship
from corpusflow.storage import spread

POSITIVES, NEGATIVES, LEAST, SCALE = 5, 5, 80, 256
#: Rows of a shard, cells of a dimension, anchors of a block, blocks of a group.
SHARD, CELLS, BLOCK, GROUP = 4096, 16, 1024, 64
_INDEX = "shard long, dims int, ids binary, labels binary, codes binary, cells binary, values binary"
_FOUND = "row long, anchor_id long, slot int, id long, score long"
_NONE = np.iinfo(np.int64).min


def quantised(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str | Column = "label", scale: int = SCALE) -> DataFrame:
    """``id, label, q`` of the rows that take part: components as ``floor(scale * x)``."""
    x = F.col(f"`{vector}`")
    label = F.col(f"`{label}`") if isinstance(label, str) else label
    own = rows.select(F.col(f"`{vec_id}`").cast("long").alias("id"), label.cast("long").alias("label"), x.cast("array<double>").alias("x"))
    sound = F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    own = own.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("x").isNotNull() & (F.size("x") > 0) & sound)
    most = F.floor(F.sqrt(F.lit(2.0**62) / F.size("x")))
    return own.select("id", "label", F.transform("x", lambda v: F.greatest(-most, F.least(most, F.floor(v * scale)))).alias("q"))


def approximate(q: np.ndarray, cells: int = CELLS) -> tuple[np.ndarray, np.ndarray]:
    """Cell numbers of pairs of dimensions ``[pairs, rows]``, and ``[dims, cells, 2]``: the
    least and greatest value of each cell. An odd dimension is paired with one of zeros."""
    n, dims = q.shape
    if dims % 2:
        q, dims = np.concatenate([q, np.zeros((n, 1), q.dtype)], axis=1), dims + 1
    codes, ends = np.zeros((dims, n), np.uint8), np.zeros((dims, cells, 2), np.int64)
    ranked = np.sort(q, axis=0)
    for d in range(dims):
        own = ranked[:, d]
        edges = own[np.arange(cells) * n // cells]  # a cell begins at its first value
        codes[d] = np.searchsorted(edges[1:], q[:, d], "right")
        cut = np.append(np.searchsorted(own, edges), n)
        cut[0] = 0
        full = np.flatnonzero(cut[1:] > cut[:-1])
        ends[d, full, 0], ends[d, full, 1] = own[cut[full]], own[cut[full + 1] - 1]
    return codes[0::2] * cells + codes[1::2], ends


def tables(anchor: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """``[pairs, cells * cells]``: what a pair of cells adds to a score with ``anchor``, at
    least (real part) and at most (imaginary part)."""
    a = np.zeros(len(ends), np.float64)
    a[: len(anchor)] = anchor
    x, y = (a[:, None] * ends[:, :, e] for e in (0, 1))
    adds = np.minimum(x, y) + 1j * np.maximum(x, y)
    return (adds[0::2, :, None] + adds[1::2, None, :]).reshape(len(ends) // 2, -1)


def bounds(table: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of the scores of rows with these codes."""
    total = np.zeros(codes.shape[1], np.complex128)
    for t, c in zip(table, codes, strict=True):
        total += t.take(c)
    # sums beyond 2^53 are rounded
    most = max(np.abs(table.real).max(axis=1).sum(), np.abs(table.imag).max(axis=1).sum())
    slack = most * 2.0**-44 if most > 2.0**52 else 0.0
    return total.real - slack, total.imag + slack


class Best:
    """The best ``k`` of each slot seen so far: by score, then by smaller id."""

    def __init__(self, slots: int, k: int):
        self.score, self.id = np.full((slots, k), _NONE), np.full((slots, k), np.iinfo(np.int64).max)

    def worst(self, slot: int) -> int:
        return self.score[slot, -1]

    def put(self, slot: int, scores: np.ndarray, ids: np.ndarray) -> None:
        if len(scores):
            s, i = np.concatenate([self.score[slot], scores]), np.concatenate([self.id[slot], ids])
            order = np.lexsort((i, ~s))[: self.score.shape[1]]  # ~s falls as s rises, without overflow
            self.score[slot], self.id[slot] = s[order], i[order]


def positives_of(anchor: dict, shard: dict, best: Best, slot: int, k: int) -> None:
    """Rows of the anchor's label that may be among its best ``k``."""
    a, b = np.searchsorted(shard["labels"], [anchor["label"], anchor["label"] + 1])
    if a == b:
        return
    lower, upper = bounds(tables(anchor["q"], shard["cells"]), shard["codes"][:, a:b])
    need = best.worst(slot)
    if b - a > k + 1:  # one of them may be the anchor itself
        need = max(need, np.partition(lower, b - a - k - 1)[b - a - k - 1])
    some = np.flatnonzero((upper >= need) & (shard["ids"][a:b] != anchor["id"]))
    best.put(slot, shard["values"][a:b][some] @ anchor["q"], shard["ids"][a:b][some])


def negatives_of(anchor: dict, shard: dict, best: Best, slot: int, least: int) -> None:
    """Rows of other labels that may be among the best of one of the anchor's windows."""
    windows = [(w, -(-least * p // 100), p) for w, p in enumerate(anchor["scores"])]
    windows = [(slot + w, max(lo, int(best.worst(slot + w))), lo, hi) for w, lo, hi in windows if lo <= hi]
    if not windows:
        return
    lower, upper = bounds(tables(anchor["q"], shard["cells"]), shard["codes"])
    some = np.zeros(len(lower), bool)
    for _, need, _, hi in windows:
        some |= (upper >= need) & (lower <= hi)
    a, b = np.searchsorted(shard["labels"], [anchor["label"], anchor["label"] + 1])
    some[a:b] = False
    at = np.flatnonzero(some)
    scores, ids = shard["values"][at] @ anchor["q"], shard["ids"][at]
    for w, _, lo, hi in windows:
        fit = (scores >= lo) & (scores <= hi)
        best.put(w, scores[fit], ids[fit])


def build(rows: DataFrame) -> DataFrame:
    """The index of ``rows(id, label, q)``: a row a shard."""

    def run(batches):
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            ids, labels = (batch.column(c).to_numpy() for c in ("id", "label"))
            lists = batch.column("q")
            off, flat = lists.offsets.to_numpy(), lists.values.to_numpy()
            dims = np.diff(off)
            for d in np.unique(dims):
                of = np.flatnonzero(dims == d)
                for part in np.array_split(of, -(-len(of) // SHARD)):
                    own = part[np.lexsort((ids[part], labels[part]))]
                    q = flat[off[own][:, None] + np.arange(d)]
                    codes, ends = approximate(q)
                    cells = [number, int(d), ids[own].tobytes(), labels[own].tobytes(), codes.tobytes(), ends.tobytes(), q.astype(np.int32).tobytes()]
                    yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(cells, (pa.int64(), pa.int32(), *[pa.binary()] * 5), strict=True)], names=[f.split()[0] for f in _INDEX.split(", ")])
                    number += 1

    return C.materialise(spread(rows).mapInArrow(C.in_worker(run), _INDEX), "va-file")


def _shard(row: dict) -> dict:
    ids = np.frombuffer(row["ids"], np.int64)
    n, dims = len(ids), row["dims"]
    even = dims + dims % 2
    return {
        "ids": ids, "labels": np.frombuffer(row["labels"], np.int64), "codes": np.frombuffer(row["codes"], np.uint8).reshape(even // 2, n),
        "cells": np.frombuffer(row["cells"], np.int64).reshape(even, CELLS, 2), "values": np.frombuffer(row["values"], np.int32).reshape(n, dims).astype(np.int64),
    }


def scan(index: DataFrame, anchors: DataFrame, slots: int, k: int, look: Callable[[dict, dict, Best, int], None]) -> DataFrame:
    """``row, anchor_id, slot, id, score``: each task's best ``k`` for each slot of each anchor.

    ``anchors(row, block, s, id, label, q, ...)``, ``row`` unique; ``look(anchor, shard,
    best, first slot)`` puts what it finds in a shard.
    """
    spark = index.sparkSession
    groups = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    found = anchors.agg(F.max("s")).first()[0]
    if found is None:
        return spark.createDataFrame([], _FOUND)
    members = [c for c in anchors.columns if c not in ("block", "s")]
    blocks = anchors.withColumn("dims", F.size("q")).groupBy("dims", "s", "block").agg(F.collect_list(F.struct(*members)).alias("anchors"))
    blocks = blocks.withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    shards = index.withColumn("g", F.pmod(F.hash("shard"), F.lit(groups))).withColumn("s", F.explode(F.sequence(F.lit(0), F.lit(found))))
    both = shards.join(blocks.hint("merge"), ["g", "s", "dims"])

    def run(batches):
        kept: dict[int, tuple[list[dict], Best]] = {}
        at, shard = None, None
        for batch in batches:
            names = [c for c in batch.schema.names if c not in ("anchors", "g", "s")]
            for r in range(batch.num_rows):
                number = batch.column("shard")[r].as_py()
                if number != at:
                    at, shard = number, _shard({c: _value(batch.column(c)[r]) for c in names})
                key = (batch.column("dims")[r].as_py(), batch.column("block")[r].as_py())
                if key not in kept:
                    own = batch.column("anchors")[r].as_py()
                    kept[key] = [{**a, "q": np.array(a["q"], np.int64)} for a in own], Best(len(own) * slots, k)
                own, best = kept[key]
                for p, anchor in enumerate(own):
                    look(anchor, shard, best, p * slots)
        for own, best in kept.values():
            slot, place = np.nonzero(best.score > _NONE)
            columns = [[own[x // slots]["row"] for x in slot], [own[x // slots]["id"] for x in slot], slot % slots, best.id[slot, place], best.score[slot, place]]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64()), strict=True)], names=[f.split()[0] for f in _FOUND.split(", ")])

    return both.mapInArrow(C.in_worker(run), _FOUND)


def _value(cell):
    return memoryview(cell.as_buffer()) if pa.types.is_binary(cell.type) or pa.types.is_large_binary(cell.type) else cell.as_py()


def _best(found: DataFrame, k: int, *keys: str) -> DataFrame:
    """The best ``k`` of what the tasks report: ``best``, an array of ``(score, id)`` by rank."""
    ranked = F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("down"), "id")))  # k a task at most
    return found.groupBy(*keys).agg(F.transform(F.slice(ranked, 1, k), lambda x: F.struct((-x["down"]).alias("score"), x["id"].alias("id"))).alias("best"))


def mine(rows: DataFrame, anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, least: int = LEAST) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` of
    ``rows(id, label, q)``; ``anchor`` tells from a row whether it is one."""
    ship(rows.sparkSession)
    index = build(rows)
    own = C.materialise(rows.filter(anchor).withColumn("row", F.monotonically_increasing_id()), "anchors")
    many = -(-own.count() // BLOCK)
    own = own.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(max(many, 1))).cast("int")).withColumn("s", F.pmod("block", F.lit(-(-max(many, 1) // GROUP))))
    found = scan(index, own, 1, positives, lambda a, shard, best, slot: positives_of(a, shard, best, slot, positives))
    windows = C.materialise(_best(found, positives, "row", "anchor_id"), "positives")
    told = own.join(windows.select("row", F.col("best.score").alias("scores")), "row")
    found = scan(index, told, positives, negatives, lambda a, shard, best, slot: negatives_of(a, shard, best, slot, least))
    hard = _best(found, negatives, "row", "slot").select("row", "slot", F.posexplode("best").alias("rank", "hard"))
    pairs = windows.select("row", "anchor_id", F.posexplode("best").alias("slot", "positive"))
    return pairs.join(hard, ["row", "slot"]).select(
        "anchor_id", F.col("positive.id").alias("positive_id"), (F.col("rank") + 1).alias("rank"), F.col("hard.id").alias("negative_id"), F.col("positive.score").alias("positive_score"), F.col("hard.score").alias("negative_score")
    )


#: Every anchor against every row.
ORACLE = f"""WITH r AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, [floor({SCALE} * CAST(x AS DOUBLE)) FOR x IN embedding] AS q FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0 AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
 s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score FROM r a JOIN r b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
 p AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) AS k FROM s WHERE same) WHERE k <= {POSITIVES}),
 n AS (SELECT p.anchor_id, p.id AS positive_id, s.id AS negative_id, p.score AS positive_score, s.score AS negative_score, row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY s.score DESC, s.id) AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND {LEAST} * p.score <= 100 * s.score AND s.score <= p.score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= {NEGATIVES}"""
