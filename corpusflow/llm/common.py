"""Shared plumbing of the training-data operators.

* ``materialise`` cuts lineage with a Parquet table in the folder that
  ``spark.checkpoint.dir`` names, so a lost executor never costs more than the
  stage it was running.
* ``broadcast_if_small`` is the only way these operators broadcast a table: it
  counts rows and bytes first and leaves the join to shuffle beyond the bounds.
* ``join_groups`` joins rows with a row of their group where one group may hold
  a third of all rows.
* ``lean`` and ``give_back`` bound what a Python worker keeps between tasks.
* ``split_pieces`` is a vectorised byte-level BPE pre-tokeniser over whole
  Arrow string buffers.
"""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import gc
import unicodedata
import uuid
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusflow import storage

#: ASCII white space of the word pattern ``[^\x20\x09-\x0D]+``.
WS = " \t\n\x0b\x0c\r"
#: A broadcast side has at most so many rows and bytes; beyond it joins shuffle.
MAX_BROADCAST_ROWS = 2_000_000
MAX_BROADCAST_BYTES = 64 << 20
#: A group is heavy from one row in so many on; there are no more heavy groups than that.
HEAVY_SHARE = 4096


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder of the session; on a single machine an own one where it is unset."""
    return storage.checkpoint_dir(spark).rstrip("/")


def _file_system(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def full_address(spark: SparkSession, path: str) -> str:
    """``path`` with the scheme and host that Spark reads it under: ``fs.defaultFS`` where it names none."""
    files, target = _file_system(spark, path)
    return files.makeQualified(target).toUri().toString()


def scratch_path(spark: SparkSession, tag: str) -> str:
    """A fresh path in the shared folder, deleted when the driver's JVM ends."""
    path = f"{checkpoint_dir(spark)}/corpusflow-{tag}-{uuid.uuid4().hex}"
    files, target = _file_system(spark, path)
    files.deleteOnExit(target)
    if _STEPS:
        _STEPS[-1].append(path)
    return path


#: Paths of the steps that ``settled`` is in.
_STEPS: list[list[str]] = []


def settled(spark: SparkSession, tag: str, build) -> DataFrame:
    """What ``build()`` returns, materialised; what it materialised on the way is deleted,
    also where it fails.

    The result lies in the shared folder by then and depends on none of it.
    """
    paths: list[str] = []
    try:
        _STEPS.append(paths)
        try:
            df = build()
        finally:
            _STEPS.pop()
        return materialise(df, tag)
    finally:
        for path in paths:
            files, target = _file_system(spark, path)
            files.delete(target, True)


def materialise(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    The returned frame has the written table as its only lineage. An empty
    frame keeps its schema.
    """
    spark = df.sparkSession
    path = scratch_path(spark, tag)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, tag: str, buckets: int, *by: str) -> DataFrame:
    """Write ``df`` once as a table in buckets of ``by``, so that joins and groups
    on those columns read it where it lies. Its values are already compressed."""
    spark = df.sparkSession
    path = scratch_path(spark, tag)
    name = f"corpusflow_{tag}_{uuid.uuid4().hex}"
    atexit.register(_drop, spark, name)
    df.write.bucketBy(buckets, *by).option("compression", "uncompressed").option("path", path).saveAsTable(name)
    return spark.table(name)


def _drop(spark: SparkSession, name: str) -> None:
    with contextlib.suppress(Exception):  # the session may be gone by now
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def _bytes(c, kind: T.DataType):
    """About how many bytes a value takes."""
    if isinstance(kind, T.StringType | T.BinaryType):
        return F.coalesce(F.octet_length(c), F.lit(0)).cast("long") + 16
    if isinstance(kind, T.ArrayType):
        return F.coalesce(F.aggregate(c, F.lit(0).cast("long"), lambda s, x: s + _bytes(x, kind.elementType)), F.lit(0).cast("long")) + 16
    if isinstance(kind, T.StructType):
        return sum((_bytes(c[f.name], f.dataType) for f in kind), F.lit(8).cast("long"))
    return F.lit(8).cast("long")


def broadcast_if_small(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``max_rows`` rows and about
    ``max_bytes`` bytes, which a pass over it shows."""
    width = sum((_bytes(F.col(f"`{f.name}`"), f.dataType) for f in df.schema), F.lit(8).cast("long"))
    found = df.limit(max_rows + 1).agg(F.count(F.lit(1)).alias("n"), F.sum(width).alias("b")).first()
    return F.broadcast(df) if found["n"] <= max_rows and (found["b"] or 0) <= max_bytes else df.hint("merge")


def join_groups(rows: DataFrame, groups: DataFrame, key: str, count: str, total: int) -> DataFrame:
    """Rows joined with the one row of ``groups`` that has their ``key``; every row has one.

    ``groups[count]`` is the number of the key's rows and ``total`` that of all
    rows. Groups of more than ``total / HEAVY_SHARE`` rows, of which there are
    fewer than ``HEAVY_SHARE``, are broadcast, so that their rows stay where
    they are; the others meet in a shuffle, in which no key weighs much.
    """
    heavy = F.col(count) * HEAVY_SHARE > total
    large = F.broadcast(groups.filter(heavy).drop(count))  # fewer than HEAVY_SHARE rows
    own = rows.join(large, key)
    rest = rows.join(F.broadcast(groups.filter(heavy).select(key)), key, "left_anti")
    return own.unionByName(rest.join(groups.filter(~heavy).drop(count), key))


def fresh(df: DataFrame, wanted: str) -> str:
    """A column name like ``wanted`` that ``df`` does not have (case-blind)."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted = "_" + wanted
    return wanted


def words_col(text):
    """Words ``[^\\x20\\x09-\\x0D]+`` of a string column; null or blank: empty array."""
    bare = F.btrim(text, F.lit(WS))
    empty = F.array().cast("array<string>")
    return F.when(text.isNull() | (F.length(bare) == 0), empty).otherwise(F.split(bare, r"[ \t-\r]+"))


# --------------------------------------------------------------- Arrow helpers


@lru_cache(1)
def lean() -> None:
    """Make a worker give memory back: Arrow through malloc, and large blocks of
    malloc from the system one by one, so that what is freed leaves the process."""
    pa.set_memory_pool(pa.system_memory_pool())
    with contextlib.suppress(OSError, AttributeError):  # another C library
        libc = ctypes.CDLL("libc.so.6")
        libc.mallopt(-3, 1 << 18)  # M_MMAP_THRESHOLD
        libc.mallopt(-1, 1 << 20)  # M_TRIM_THRESHOLD


def give_back() -> None:
    """Return freed memory to the system, at the end of a task's work in a worker."""
    gc.collect()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def in_worker(run):
    """``run`` for ``mapInArrow``, in a worker that gives memory back when it ends."""

    def wrapped(batches):
        lean()
        try:
            yield from run(batches)
        finally:
            give_back()

    return wrapped


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and int64 offsets (one more than rows) of a string column; null: empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0] : off[-1]], off - off[0]


def spans(offsets: np.ndarray, most: int) -> list[tuple[int, int]]:
    """Row ranges of at most ``most`` bytes each; a longer row stands alone."""
    out, at, n = [], 0, len(offsets) - 1
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1)
        out.append((at, min(to, n)))
        at = out[-1][1]
    return out


def pack(array: np.ndarray) -> bytes:
    """zstd of an array, byte plane by byte plane (small numbers have empty high planes)."""
    width = array.dtype.itemsize
    planes = np.ascontiguousarray(array).view(np.uint8).reshape(-1, width).T
    parts = [pa.compress(np.ascontiguousarray(p).tobytes(), codec="zstd", asbytes=True) if len(array) else b"" for p in planes]
    return b"".join([len(array).to_bytes(8, "little"), *(len(p).to_bytes(8, "little") for p in parts), *parts])


def unpack(blob, dtype) -> np.ndarray:
    width, n = np.dtype(dtype).itemsize, int.from_bytes(blob[:8], "little")
    out = np.empty((n, width), np.uint8)
    at = 8 + 8 * width
    for k in range(width if n else 0):
        size = int.from_bytes(blob[8 + 8 * k : 16 + 8 * k], "little")
        out[:, k] = np.frombuffer(pa.decompress(blob[at : at + size], n, codec="zstd", asbytes=True), np.uint8)
        at += size
    return out.view(dtype).reshape(-1)


def pack_strings(values: pa.Array) -> bytes:
    raw, off = utf8(values)
    head = pack(np.diff(off).astype(np.int32))
    return len(head).to_bytes(8, "little") + head + pack(raw)


def unpack_strings(blob) -> pa.Array:
    cut = 8 + int.from_bytes(blob[:8], "little")
    return strings(unpack(blob[cut:], np.uint8), ends(unpack(blob[8:cut], np.int32)))


def strings(raw: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """A string array over ``raw`` without copying it."""
    if len(offsets) <= 1:
        return pa.array([], pa.large_string())
    return pa.LargeStringArray.from_buffers(len(offsets) - 1, pa.py_buffer(np.ascontiguousarray(offsets, np.int64)), pa.py_buffer(np.ascontiguousarray(raw)))


def ends(lengths: np.ndarray) -> np.ndarray:
    """Offsets of rows with these lengths, from 0."""
    out = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=out[1:])
    return out


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices ``starts[i] .. starts[i] + lengths[i] - 1`` one after another."""
    off = ends(lengths)
    return np.arange(off[-1]) + np.repeat(starts - off[:-1], lengths)


def sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of ``values[offsets[i]:offsets[i + 1]]`` for each row, 0 for empty rows."""
    total = np.zeros((len(values) + 1, *values.shape[1:]), np.float64)
    np.cumsum(values, axis=0, dtype=np.float64, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


# ------------------------------------------------------------ the pre-tokeniser

OTHER, LETTER, NUMBER, SPACE = 0, 1, 2, 3
#: Unicode White_Space, which the pattern's \s means. Fixed values.
WHITE_SPACE = [9, 10, 11, 12, 13, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
_classes: list[np.ndarray] = []


def classes() -> np.ndarray:
    """Class of each code point: letter, number, white space or other."""
    if not _classes:
        kind = {"L": LETTER, "N": NUMBER}
        table = np.fromiter((kind.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)), np.uint8, 0x110000)
        table[WHITE_SPACE] = SPACE
        _classes.append(table)
    return _classes[0]


def _piece_starts(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Byte positions at which a piece starts, over rows that lie end to end."""
    points = np.frombuffer(raw.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    n = len(points)
    if not n:
        return np.zeros(0, np.int64)
    at_byte = None
    heads = np.unique(offsets[:-1][np.diff(offsets) > 0])
    if n < len(raw):
        at_byte = np.flatnonzero((raw & 0xC0) != 0x80)
        heads = np.searchsorted(at_byte, heads)
    head = np.zeros(n + 1, bool)
    head[heads] = True
    head[n] = True
    cls = classes()[points]
    space = cls == SPACE
    start = head[:n].copy()
    start[1:] |= cls[1:] != cls[:-1]
    # a run of other than white space takes one plain space before it
    glued = np.zeros(n, bool)
    glued[1:] = (points[:-1] == 32) & ~space[1:] & ~head[1:n]
    start &= ~glued
    # the last white space of a run before something else stands apart from the run
    start[:-1] |= space[:-1] & ~space[1:] & ~head[1:n]
    # 's 't 'm 'd 're 've 'll where a piece starts with the apostrophe
    quote = np.flatnonzero((points == 39) & start)
    if len(quote):
        tail = np.concatenate([points, np.zeros(3, np.uint32)])
        shut = np.concatenate([head, np.ones(3, bool)])
        a, b = tail[quote + 1], tail[quote + 2]
        one = np.isin(a, [ord(c) for c in "stmd"]) & ~shut[quote + 1]
        two = (((a == ord("r")) | (a == ord("v"))) & (b == ord("e")) | (a == ord("l")) & (b == ord("l"))) & ~shut[quote + 1] & ~shut[quote + 2]
        for hit, size in ((quote[one], 2), (quote[two], 3)):
            start[hit + 1] = False
            after = hit + size
            start[after[after < n]] = True
    found = np.flatnonzero(start)
    return found if at_byte is None else at_byte[found]


def split_pieces(raw: np.ndarray, offsets: np.ndarray, step: int = 4 << 20) -> tuple[np.ndarray, np.ndarray]:
    """Pre-tokens of rows of UTF-8 text, each match of the byte-level BPE pattern.

    Returns the byte offsets of the pieces (one more than pieces; they cover
    every byte) and the piece number at which each row begins (one more than
    rows). ``step`` bounds the working memory, not what is read.
    """
    parts = [_piece_starts(raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]) + offsets[a] for a, b in spans(offsets, step)]
    starts = np.concatenate([*parts, [offsets[-1]]]).astype(np.int64)
    return starts, np.searchsorted(starts, offsets)


def distinct_pieces(raw: np.ndarray, bounds: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """Distinct pieces in order of first use, and the number of each piece."""
    if len(bounds) <= 1:
        return pa.array([], pa.large_string()), np.zeros(0, np.int32)
    found = strings(raw, bounds).dictionary_encode()
    return found.dictionary, found.indices.to_numpy(zero_copy_only=False)
