"""Token-id files in Simple-8b word-aligned coding (operator 9).

A 64-bit word holds a selector in its top 4 bits and, in the other 60, as many
ids as the selector says, lowest bits first. Ids are coded in blocks of
``BLOCK`` ids; a block starts on a word of its own and the file keeps each
block's word offset, so blocks are coded and decoded side by side with array
operations. A value of 60 one-bits or more is escaped: a word of 64 one-bits,
then the value as a word of its own.

File: ``MAGIC``, then the numbers of documents, ids, blocks and words (int64
each), then ids per document (int32), word offsets of blocks (int64), words.

Ids are the tokenizers library's: an added token that stands in a text (such as
``<|endoftext|>``) is one id, and the texts around it are encoded by themselves.

Cases: a null or empty text has the end id alone; bytes that are not UTF-8 count as
U+FFFD; rows with a null doc_id come
first, equal doc_ids follow one another in order of how their texts begin (32
characters) and, within a file, of their whole texts; an empty table writes no file;
further columns are ignored. A folder without a scheme is one of the session's default
file system, on the driver and in every worker.
"""

from __future__ import annotations

import json
import re
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusflow.llm import common as C
from corpusflow.shipping import ship

MAGIC = b"CFS8B\x00\x00\x01"
BLOCK = 1024
#: Ids and bits of each selector. Fixed values.
COUNTS = [240, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1]
BITS = [0, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60]
ESCAPE = np.uint64(0xFFFFFFFFFFFFFFFF)
_MOST = np.uint64((1 << 60) - 1)
_PAD = COUNTS[0]
END_ID = 0
#: Ids gathered before a file is written.
FILE_IDS = 4 << 20
#: Words kept encoded by a worker.
CACHE_WORDS = 800_000
DEFAULT_TOKENIZER = "byte_bpe_50k.json"


@lru_cache(1)
def _short_lengths() -> np.ndarray:
    return np.frexp(np.arange(1 << 16).astype(np.float64))[1].astype(np.uint8)


def _bit_lengths(values: np.ndarray) -> np.ndarray:
    """Bits of each value; 61 if it must be escaped."""
    if values.max() < 1 << 16:
        return _short_lengths()[values]
    small = values < np.uint64(1 << 53)
    out = np.frexp(np.where(small, values, np.uint64(0)).astype(np.float64))[1].astype(np.uint8)
    if not small.all():
        big = ~small
        out[big] = 53 + np.frexp((values[big] >> np.uint64(53)).astype(np.float64))[1]
        out[values >= _MOST] = 61
    return out


def pack_ids(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words, and the word offset of each block (one more than blocks)."""
    values = np.ascontiguousarray(values, np.uint64)
    n = -(-len(values) // BLOCK)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(1, np.int64)
    wide = BLOCK + _PAD
    grid = np.zeros((n, wide), np.uint64)
    full = np.zeros(n * BLOCK, np.uint64)
    full[: len(values)] = values
    grid[:, :BLOCK] = full.reshape(n, BLOCK)
    flat = grid.reshape(-1)
    bits = _bit_lengths(flat)
    most = {1: bits}  # largest bit length among the next k ids

    def widened(k: int, base: int) -> np.ndarray:
        out = most[base].copy()
        np.maximum(out[: len(out) - (k - base)], most[base][k - base :], out=out[: len(out) - (k - base)])
        return out

    for k in (2, 4, 8, 16, 32, 64, 128):
        most[k] = widened(k, k // 2)
    selector = np.full(len(flat), 15, np.uint8)
    for s in range(14, -1, -1):
        k = COUNTS[s]
        reach = most.get(k) if k in most else widened(k, 1 << (k.bit_length() - 1))
        selector[reach <= BITS[s]] = s
    # every block walks its words in step with the others
    starts = np.zeros(len(flat), bool)
    lengths = np.full(n, BLOCK)
    lengths[-1] = len(values) - (n - 1) * BLOCK
    lane, at, counts = np.arange(n) * wide, np.zeros(n, np.int64), np.array(COUNTS)
    while len(lane):
        here = lane + at
        starts[here] = True
        at = at + counts[selector[here]]
        go = at < lengths
        lane, at, lengths = lane[go], at[go], lengths[go]
    where = np.flatnonzero(starts)
    chosen = selector[where]
    words = np.zeros(len(where), np.uint64)
    for s in range(16):
        own = chosen == s
        if not own.any():
            continue
        word = np.full(int(own.sum()), np.uint64(s) << np.uint64(60))
        if BITS[s]:
            for j in range(COUNTS[s]):
                word |= flat[where[own] + j] << np.uint64(j * BITS[s])
        words[own] = word
    escaped = bits[where] == 61
    offsets = np.searchsorted(where, np.arange(n + 1) * wide)
    if escaped.any():
        words[escaped] = ESCAPE
        slots = C.ends(1 + escaped)
        wider = np.zeros(slots[-1], np.uint64)
        wider[slots[:-1]] = words
        wider[slots[:-1][escaped] + 1] = flat[where[escaped]]
        words, offsets = wider, slots[offsets]
    return words, offsets.astype(np.int64)


def unpack_ids(words: np.ndarray, offsets: np.ndarray, n_ids: int) -> np.ndarray:
    """The ids of all blocks, in order."""
    if not n_ids:
        return np.zeros(0, np.uint64)
    selector = (words >> np.uint64(60)).astype(np.int64)
    counts = np.array(COUNTS)[selector]
    ones = words == ESCAPE
    mark = np.zeros(len(words), bool)
    if ones.any():
        # in a run of one-bits words every second one is a value, not an escape
        edge = ones & ~np.concatenate([[False], ones[:-1]])
        first = np.maximum.accumulate(np.where(edge, np.arange(len(words)), 0))
        mark = ones & ((np.arange(len(words)) - first) % 2 == 0)
        value = np.concatenate([[False], mark[:-1]])
        counts[value] = 0
    lengths = np.full(len(offsets) - 1, BLOCK)
    lengths[-1] = n_ids - (len(lengths) - 1) * BLOCK
    before = C.ends(counts)
    block = np.repeat(np.arange(len(lengths)), np.diff(offsets))
    inside = before[:-1] - before[offsets[:-1]][block]
    counts = np.minimum(counts, lengths[block] - inside)
    to = inside + block * BLOCK
    out = np.zeros(n_ids, np.uint64)
    payload = words & _MOST
    for s in range(2, 16):
        own = np.flatnonzero((selector == s) & (counts > 0))
        mask = np.uint64((1 << BITS[s]) - 1)
        for j in range(COUNTS[s] if len(own) else 0):
            if j:
                own = own[counts[own] > j]
            out[to[own] + j] = (payload[own] >> np.uint64(j * BITS[s])) & mask
    marks = np.flatnonzero(mark)
    out[to[marks]] = words[marks + 1]
    return out


def to_bytes(lengths: np.ndarray, ids: np.ndarray) -> bytes:
    """A file of documents with these numbers of ids."""
    words, offsets = pack_ids(ids)
    head = np.array([len(lengths), len(ids), len(offsets) - 1, len(words)], "<i8")
    return b"".join([MAGIC, head.tobytes(), lengths.astype("<i4").tobytes(), offsets.astype("<i8").tobytes(), words.astype("<u8").tobytes()])


def from_bytes(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Ids per document, and all ids, of a file."""
    if blob[:8] != MAGIC:
        raise ValueError("not a token-id file")
    docs, n_ids, n_blocks, n_words = (int(x) for x in np.frombuffer(blob, "<i8", 4, 8))
    at = 40
    lengths = np.frombuffer(blob, "<i4", docs, at)
    at += 4 * docs
    offsets = np.frombuffer(blob, "<i8", n_blocks + 1, at)
    words = np.frombuffer(blob, "<u8", n_words, at + 8 * (n_blocks + 1))
    return lengths, unpack_ids(words, offsets, n_ids)


# ----------------------------------------------------------------- the tokenizer


def tokenizer_path(name: str = DEFAULT_TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(1)
def _byte_letters() -> dict[int, str]:
    """The letter that byte-level BPE writes for each byte: printable ones stand for themselves."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(others)}


class WordEncoder:
    """The tokenizers library's model over pre-tokens, with a bounded cache."""

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            said = json.load(f)
        if said["pre_tokenizer"].get("type") != "ByteLevel" or said.get("normalizer") or said["pre_tokenizer"]["add_prefix_space"]:
            raise ValueError("only plain byte-level tokenizers split as this operator does")
        added = {t["content"]: t["id"] for t in said.get("added_tokens", [])}
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in said.get("added_tokens", [])):
            raise ValueError("added tokens are taken as they stand only")
        self.added = {k.encode(): v for k, v in added.items()}
        self.pattern = "|".join(map(re.escape, sorted(added, key=len, reverse=True)))
        self.tokenizer = Tokenizer.from_file(path)
        self.model, self.letters, self.cache = self.tokenizer.model, _byte_letters(), {}

    def __call__(self, words: list[str]) -> list[bytes]:
        """Little-endian int32 ids of each word."""
        if len(self.cache) > CACHE_WORDS:
            self.cache.clear()
        cache, out = self.cache, []
        for w in words:
            got = cache.get(w)
            if got is None:
                tokens = self.model.tokenize(w.encode().decode("latin-1").translate(self.letters))
                got = cache[w] = b"".join([t.id.to_bytes(4, "little") for t in tokens])
            out.append(got)
        return out


@lru_cache(1)
def word_encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def _added(column: pa.Array, raw: np.ndarray, off: np.ndarray, encode: WordEncoder) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends, in bytes, of the added tokens in the rows of ``raw``."""
    found = []
    if encode.added:
        pattern = re.compile(encode.pattern.encode())
        for k in np.flatnonzero(pc.fill_null(pc.match_substring_regex(column, encode.pattern), False).to_numpy(zero_copy_only=False)):
            found += [(off[k] + m.start(), off[k] + m.end()) for m in pattern.finditer(raw[off[k] : off[k + 1]].tobytes())]
    found = np.array(found, np.int64).reshape(-1, 2)
    return found[:, 0], found[:, 1]


def encode_batch(column: pa.Array, encode: WordEncoder, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids per row with the end id, and all ids."""
    raw, off = C.utf8(column)
    a, b = _added(column, raw, off, encode)
    # added tokens and what lies between them are rows of their own
    cut = np.sort(np.concatenate([off, np.setdiff1d(np.concatenate([a, b]), off)]))
    bounds, rows = C.split_pieces(raw, cut)
    words, seq = C.distinct_pieces(raw, bounds)
    found = encode(words.to_pylist())
    sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
    special = np.array([encode.added[raw[x:y].tobytes()] for x, y in zip(a, b, strict=True)], np.int32)
    flat, starts = np.concatenate([np.frombuffer(b"".join(found), "<i4"), special]), C.ends(sizes)[:-1]
    n, at = sizes[seq], starts[seq]
    if len(a):
        first, last = np.searchsorted(bounds, a), np.searchsorted(bounds, b)
        n[C.ragged(first, last - first)] = 0
        n[first], at[first] = 1, len(flat) - len(special) + np.arange(len(special))
    lengths = C.sums(n, np.searchsorted(bounds, off)).astype(np.int64) + 1
    ids = np.full(int(lengths.sum()), end_id, np.uint32)
    inner = np.ones(len(ids), bool)
    inner[C.ends(lengths)[1:] - 1] = False
    ids[inner] = flat[C.ragged(at, n)]
    return lengths, ids


# --------------------------------------------------------------------- the files


def _place(uri: str):
    """The file system and the path in it that a full address names."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def write_files(docs: DataFrame, folder: str, path: str | None = None, end_id: int = END_ID, partitions: int | None = None) -> DataFrame:
    """Write all documents in ascending ``doc_id``; returns the manifest.

    Manifest: ``part, file`` (ascending, they give the order of the files),
    ``name, doc_ids array<bigint>, n_ids``. A file is written under the
    attempt's own name and then renamed, so a repeated task replaces it whole.
    """
    spark = docs.sparkSession
    ship(spark)
    path, folder = path or tokenizer_path(), C.full_address(spark, folder)
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.make_valid_utf8("text").alias("text"))
    # by id, then by how the texts begin and by row, so that one id of many rows is many ranges
    ordered = ordered.withColumn("head", F.substring("text", 1, 32)).withColumn("row", F.monotonically_increasing_id())
    ordered = ordered.repartitionByRange(n, "doc_id", "head", "row").sortWithinPartitions("doc_id", "text").select("doc_id", "text")

    def run(batches):
        part, attempt = TaskContext.get().partitionId(), TaskContext.get().taskAttemptId()
        encode, file = word_encoder(path), 0
        ids, lengths, texts = [], [], []

        def flush():
            nonlocal file, ids, lengths, texts
            name = f"part-{part:06d}-{file:06d}.s8b"
            store, base = _place(folder)
            store.create_dir(base, recursive=True)
            flat = np.concatenate(texts)
            with store.open_output_stream(f"{base}/.{name}.{attempt}") as out:
                out.write(to_bytes(np.concatenate(lengths), flat))
            store.move(f"{base}/.{name}.{attempt}", f"{base}/{name}")
            row = pa.RecordBatch.from_pydict({"part": [part], "file": [file], "name": [name], "doc_ids": [sum(ids, [])], "n_ids": [len(flat)]}, schema=_manifest)
            file, ids, lengths, texts = file + 1, [], [], []
            return row

        for batch in batches:
            _, off = C.utf8(batch.column("text"))
            for a, b in C.spans(off, 16 << 20):
                own = batch.slice(a, b - a)
                size, flat = encode_batch(own.column("text"), encode, end_id)
                ids.append(own.column("doc_id").to_pylist())
                lengths.append(size)
                texts.append(flat)
                if sum(map(len, texts)) >= FILE_IDS:
                    yield flush()
        if texts:
            yield flush()

    return C.materialise(ordered.mapInArrow(C.in_worker(run), "part int, file int, name string, doc_ids array<long>, n_ids long"), "s8b-manifest")


_manifest = pa.schema([("part", pa.int32()), ("file", pa.int32()), ("name", pa.string()), ("doc_ids", pa.list_(pa.int64())), ("n_ids", pa.int64())])


def read_files(manifest: DataFrame, folder: str) -> DataFrame:
    """Per document, from the files: ``doc_id, start, n_tokens, ids_crc32``.

    The number of ids before each part is a list as long as there are parts.
    """
    ship(manifest.sparkSession)
    folder = C.full_address(manifest.sparkSession, folder)
    totals = {r["part"]: r["n"] for r in manifest.groupBy("part").agg(F.sum("n_ids").alias("n")).collect()}
    before, at = {}, 0
    for part in sorted(totals):
        before[part] = at
        at += totals[part]
    inside = Window.partitionBy("part").orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    n = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    files = manifest.withColumn("inside", F.coalesce(F.sum("n_ids").over(inside), F.lit(0)))
    # the manifest is small but the files are not: a task for some files, not one for all
    files = files.repartitionById(n, F.pmod(F.col("part") + F.col("file"), F.lit(n)))

    def run(batches):
        store, base = _place(folder)
        for batch in batches:
            for r in batch.to_pylist():
                with store.open_input_file(f"{base}/{r['name']}") as f:
                    lengths, ids = from_bytes(f.read())
                ids, cut = ids.astype("<u4"), C.ends(lengths)
                raw = memoryview(ids.tobytes())
                crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(cut[:-1], cut[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(r["doc_ids"], pa.int64()), pa.array(cut[:-1] + before[r["part"]] + r["inside"]), pa.array(lengths, pa.int64()), pa.array(crc, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    return files.mapInArrow(C.in_worker(run), "doc_id long, start long, n_tokens long, ids_crc32 long")


def round_trip(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Write all documents' ids to files in the shared folder and read them back."""
    folder = C.scratch_path(docs.sparkSession, "s8b")
    return read_files(write_files(docs, folder, path), folder)
