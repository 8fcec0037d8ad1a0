"""Distinct-item exchange: work once on each distinct item of a corpus.

Documents are cut into blocks of a bounded number of bytes. A block keeps, for
each document, the positions of its items as numbers into the block's list of
distinct items; that list is dealt out to buckets by the items' hashes. Each
bucket thus sees every block's copy of an item (one for each block, however
often the item occurs, so the hottest item weighs no more than any other),
answers each distinct item once, and the answers go back to their blocks, where
the documents are put together again by position.

The documents' positions never move: the table between the stages lies in the
shared folder, bucketed by block, and the answers are shuffled to its buckets.
No stage holds more than a block or a bucket, and nothing is broadcast.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusflow.llm import common as C
from corpusflow.shipping import ship
from corpusflow.storage import spread

#: Bytes of text in a block. More bytes: fewer copies of a word, more memory.
BLOCK_BYTES = 14 << 20
ROW = "block long, bucket int, head binary, body binary"
_ARROW = pa.schema([("block", pa.int64()), ("bucket", pa.int32()), ("head", pa.large_binary()), ("body", pa.large_binary())])
#: The bucket of a block's own documents.
DOCS = -1


def rows(found: list[tuple]) -> pa.RecordBatch:
    a = list(zip(*found, strict=True)) if found else [[], [], [], []]
    return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(a, _ARROW, strict=True)], schema=_ARROW)


def blocks(batches: Iterator[pa.RecordBatch], text: str, most: int) -> Iterator[tuple[int, pa.RecordBatch]]:
    """Batches cut to at most ``most`` bytes of text, numbered across the job."""
    number = TaskContext.get().partitionId() << 32
    for batch in batches:
        _, off = C.utf8(batch.column(text))
        even = -(-int(off[-1]) // max(1, -(-int(off[-1]) // most)))
        for a, b in C.spans(off, max(even, 1)):
            yield number, batch.slice(a, b - a)
            number += 1


def hashes(values: pa.Array) -> np.ndarray:
    """Stable 64-bit hashes of strings, the same in every process."""
    raw, off = C.utf8(values)
    out = np.zeros(len(off) - 1, np.uint64)
    full = np.flatnonzero(np.diff(off))
    if len(full):
        powers = np.cumprod(np.full(int(np.diff(off).max()), 0x9E3779B97F4A7C15, np.uint64))
        place = np.arange(len(raw)) - np.repeat(off[:-1], np.diff(off))
        out[full] = np.add.reduceat((raw.astype(np.uint64) + np.uint64(1)) * powers[place], off[:-1][full])
    out = (out ^ (out >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return out ^ (out >> np.uint64(32))


def each(table: pa.Table | pa.RecordBatch) -> Iterator[dict]:
    """Rows whose binary values lie where they are in ``table``, not copied."""
    for k in range(table.num_rows):
        block, bucket, head, body = (table.column(c)[k] for c in _ARROW.names)
        yield {"block": block.as_py(), "bucket": bucket.as_py(), **{n: memoryview(x.as_buffer()) if x.is_valid else None for n, x in (("head", head), ("body", body))}}


def exchange(
    docs: DataFrame,
    cut: Callable[[int, pa.RecordBatch, int], list[tuple]],
    answer: Callable[[Iterator[tuple]], Iterator[tuple]],
    join: Callable[[list[dict]], pa.Table],
    schema: str,
    text: str = "text",
    block_bytes: int = BLOCK_BYTES,
    after: Callable[[DataFrame], Callable] | None = None,
    sent: Callable[[dict, int], list[tuple]] | None = None,
) -> DataFrame:
    """Run the three stages.

    ``cut(block, batch, buckets)`` gives the rows of a block: one of bucket
    ``DOCS`` and one for each bucket that has items. With ``sent`` it gives the
    first alone, and ``sent(row, buckets)`` makes the others from it on their way
    into the shuffle, so that they do not lie in the table besides. ``answer(rows)`` takes all
    rows of some whole buckets, in any order, and yields one row for each.
    ``join(rows)`` takes a block's DOCS row and answers, and gives documents.
    ``after(replies)`` may make ``join`` from all answers, among them those to no
    block (a negative number), which then are written before they are joined.
    """
    spark = docs.sparkSession
    ship(spark)
    buckets = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))

    def first(batches):
        for number, batch in blocks(batches, text, block_bytes):
            yield rows(cut(number, batch, buckets))

    def between(batches):
        for batch in batches:
            for r in each(batch):
                yield rows(sent(r, buckets))

    def second(batches):
        found = ((r["block"], r["bucket"], r["head"], r["body"]) for batch in batches for r in each(batch))
        for r in answer(found):
            yield rows([r])

    def third(a: pa.Table, b: pa.Table) -> pa.Table:
        C.lean()
        out = join([*each(a), *each(b)])
        C.give_back()
        return out

    table = C.bucketed(spread(docs).mapInArrow(C.in_worker(first), ROW), "blocks", buckets, "block")
    items = table.mapInArrow(C.in_worker(between), ROW) if sent else table.filter(F.col("bucket") >= 0)
    replies = items.repartitionById(buckets, F.col("bucket")).mapInArrow(C.in_worker(second), ROW)
    if after:
        replies = C.materialise(replies, "replies")
        join = after(replies)
        replies = replies.filter(F.col("block") >= 0)
    own = table.filter(F.col("bucket") == DOCS).groupBy("block")
    return own.cogroup(replies.groupBy("block")).applyInArrow(third, schema)


def deal(values: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """Buckets that have items, and the positions of theirs, ascending."""
    to = (values % np.uint64(buckets)).astype(np.int32)
    order = np.argsort(to, kind="stable")
    cut = np.searchsorted(to[order], np.arange(buckets + 1))
    for b in range(buckets):
        if cut[b] < cut[b + 1]:
            yield b, order[cut[b] : cut[b + 1]]


def ids_of(batch: pa.RecordBatch, name: str) -> bytes:
    """A column as bytes that ``column`` reads back, of whatever type."""
    sink = pa.BufferOutputStream()
    one = pa.RecordBatch.from_arrays([batch.column(name)], names=["id"])
    with pa.ipc.new_stream(sink, one.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(one)
    return sink.getvalue().to_pybytes()


def column(blob) -> pa.Array:
    return pa.ipc.open_stream(pa.py_buffer(blob)).read_all().column("id").combine_chunks()
