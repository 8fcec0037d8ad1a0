"""I-Match fingerprints of documents (operator 12).

A term is a run of bytes that are ASCII letters, digits or not ASCII, A-Z lower-cased. The
lexicon holds the terms within a band of document frequency (inverse document frequency
likewise): in at least ``MIN_DOCS`` documents and at most one of ``TOP_SHARE``. Each of
``SEEDS`` hash functions deals the lexicon at random into ``LEVELS`` subsets, each half as
large as the one before; a document's distinct terms in a subset, sorted, give one hash. A
fingerprint is the number of its terms and these hashes, in hexadecimal. A text without
a term in the band is printed by all its terms, and the number says so.

``likeness``: a subset's hashes agree if no term of it tells the two texts apart, and the
larger the subset the fewer differing terms that takes. The most likely number ``d`` of
differing terms, by the numbers of agreeing subsets of each size, gives with the numbers
``a`` and ``b`` of terms ``(a + b - d) / (a + b + d)``, the share of common ones. Equal
fingerprints give 1.

The frequencies and the prints take one exchange (see ``blocks``): documents lie in blocks,
a block's distinct terms go to buckets by hash with the number of its documents that have
them, each bucket sums its terms over all blocks, and one bit a term goes back. Blocks are
as many as partitions of a shuffle, so the rows dealt are as many as that has segments.

``prints_and_edits`` also prints edited texts (the first part of a text and the beginning
of the next document's): blocks then are ranges of the documents' order, cut by bytes, and
each also has the first document of the next.

Cases: a null text is empty; a text without terms has number 0 and no hashes, and equals
only its like; bytes that are not UTF-8 count as U+FFFD; null ids come first, equal
ids in order of their texts' XXH64, repeated rows one after another; a lone document's next
is itself; terms are told apart by 48 bits; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.llm import blocks as B
from corpusflow.llm import common as C
from corpusflow.shipping import ship
from corpusflow.storage import spread

#: The lexicon's band: documents that have a term, at least, and one of so many at most.
MIN_DOCS, TOP_SHARE = 2, 10
SEEDS, LEVELS = 6, 14
#: Bytes of text in a block, at most but for one range, and in a working step.
BLOCK_BYTES, STEP = 24 << 20, 4 << 20
_BITS = np.uint64(48)
_MASK = np.uint64((1 << 48) - 1)
_ODD = np.uint64(0x9E3779B97F4A7C15)
_KIND = np.zeros(256, bool)
_KIND[[*b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz", *range(128, 256)]] = True
_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[65:91] += np.uint64(32)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> np.ndarray:
    return np.cumprod(np.full(max(n, 1), _ODD, np.uint64))


def terms(raw: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Distinct terms of rows, sorted: the row in the upper 16 bits, the term's hash below."""
    if off[-1] == off[0]:
        return np.zeros(0, np.uint64)
    inside = _KIND[raw]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    heads = off[:-1][np.diff(off) > 0] - off[0]
    begins[heads] = inside[heads]
    at = np.flatnonzero(begins)
    if not len(at):
        return np.zeros(0, np.uint64)
    value = (_LOWER[raw] + np.uint64(1)) * inside
    until = np.append(at[1:], len(raw))
    place = np.arange(at[0], len(raw)) - np.repeat(at, until - at)
    # what follows a word is worth nothing, however long
    h = np.add.reduceat(value[at[0] :] * _powers(int((until - at).max()))[place], at - at[0])
    rows = (np.searchsorted(off - off[0], at, "right") - 1).astype(np.uint64)
    return np.unique((rows << _BITS) | (_mixed(h) & _MASK))


def prints(keys: np.ndarray, rows: int, fallback: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of terms (negative where ``fallback``) and hashes ``[rows, SEEDS * LEVELS]`` of
    sorted terms as ``terms`` has them; 0: none."""
    row, h = (keys >> _BITS).astype(np.int64), keys & _MASK
    out = np.zeros((rows, SEEDS * LEVELS), np.uint16)
    for seed in range(SEEDS):
        u = _mixed(h + np.uint64((seed + 1) * int(_ODD) % 2**64))
        low = u & (~u + np.uint64(1))  # the lowest bit that is set
        level = np.minimum(np.log2(np.maximum(low, np.uint64(1)).astype(np.float64)), LEVELS - 1).astype(np.uint8)
        u = _mixed(u ^ _ODD)
        for k in range(LEVELS):
            at = np.flatnonzero(level == k)
            if len(at):
                first = np.flatnonzero(np.append(True, np.diff(row[at]) > 0))
                size = np.diff(np.append(first, len(at)))
                rank = np.arange(len(at)) - np.repeat(first, size)
                value = _mixed(np.add.reduceat(u[at] * _powers(int(size.max()))[rank], first)) >> np.uint64(48)
                out[row[at[first]], seed * LEVELS + k] = np.maximum(value, np.uint64(1))
    n = np.bincount(row, minlength=rows)
    return np.where(fallback, -n, n), out


def written(n: np.ndarray, hashes: np.ndarray) -> list[str]:
    """Fingerprints as text: the number's sign and 8 digits, 4 for each hash."""
    raw, size = hashes.astype(">u2").tobytes(), 2 * hashes.shape[1]
    return [f"{'-' if k < 0 else '+'}{abs(int(k)):08x}{raw[r * size : (r + 1) * size].hex()}" for r, k in enumerate(n)]


def read(text: list[str]) -> tuple[np.ndarray, np.ndarray]:
    n = np.array([int(t[:9], 16) for t in text], np.int64)
    return n, np.array([np.frombuffer(bytes.fromhex(t[9:]), ">u2") for t in text], np.uint16).reshape(len(text), SEEDS * LEVELS)


#: Numbers of differing terms that are tried, and the chance that a subset of a level agrees.
_TRIED = np.unique(np.round(1.04 ** np.arange(420)))
_RATE = 0.5 ** np.minimum(np.arange(1, LEVELS + 1), LEVELS - 1)
_AGREE = np.clip((1 - _RATE)[None, :] ** _TRIED[:, None], 1e-300, 1 - 1e-12)


def likeness(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Of fingerprints (numbers and hashes) row by row, 0 to 1."""
    equal = a[1] == b[1]
    k = equal.reshape(-1, SEEDS, LEVELS).sum(axis=1)
    d = _TRIED[np.argmax(k @ np.log(_AGREE).T + (SEEDS - k) @ np.log1p(-_AGREE).T, axis=1)]
    m, n = np.abs(a[0]), np.abs(b[0])
    d = np.clip(d, np.maximum(np.abs(m - n), 1), np.maximum(m + n, 1))
    return np.where(equal.all(axis=1) & (a[0] == b[0]), 1.0, (m + n - d) / np.maximum(m + n + d, 1))


# ------------------------------------------------------------------- the exchange

#: Bits of an entry: a term of the text, of the edited text.
OWN, EDITED = 1, 2


def _block_rows(block: int, head: bytes, steps: Iterator[np.ndarray], texts: int, counted: int, buckets: int) -> list[tuple]:
    """A block's rows for the exchange. ``steps`` gives, for up to 65536 texts at a time,
    ``(number of texts, terms, edited terms)``; the first ``counted`` texts count as documents."""
    row, h, flags, at = [], [], [], 0
    for n, own, edited in steps:
        both = np.union1d(own, edited) if len(edited) else own
        row.append((both >> _BITS).astype(np.int64) + at)
        h.append(both & _MASK)
        flags.append((np.isin(both, own, assume_unique=True) * OWN + np.isin(both, edited, assume_unique=True) * EDITED).astype(np.uint8) if len(edited) else np.full(len(both), OWN, np.uint8))
        at += n
    row, h, flags = (np.concatenate([np.zeros(0, t), *x]) for x, t in ((row, np.int64), (h, np.uint64), (flags, np.uint8)))
    distinct, number = np.unique(h, return_inverse=True)
    # small numbers for frequent terms
    order = np.argsort(-np.bincount(number, minlength=len(distinct)), kind="stable")
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    distinct, number = distinct[order], place[number]
    docs = np.bincount(number[(flags & OWN > 0) & (row < counted)], minlength=len(distinct)).astype(np.int32)
    entry = np.argsort((row << 32) | number)  # ascending in a row: what is kept is the step from one to the next
    row, number, flags = row[entry], number[entry], flags[entry]
    size = np.bincount(row, minlength=texts).astype(np.int32)
    step = np.diff(number, prepend=0)
    full = C.ends(size)[:-1][size > 0]
    step[full] = number[full]
    parts = [C.pack(distinct), C.pack(size), C.pack(step.astype(np.int32)), C.pack(np.packbits(np.stack([flags & OWN > 0, flags & EDITED > 0], axis=1)))]
    body = b"".join([*(len(p).to_bytes(8, "little") for p in parts), *parts])
    return [(block, B.DOCS, head, body), *((block, b, C.pack(distinct[w]), C.pack(docs[w])) for b, w in B.deal(distinct, buckets))]


def _entries(body) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct terms, sizes of rows, and each entry's number and flags (two bits)."""
    cut, parts = 32, []
    for k, dtype in enumerate((np.uint64, np.int32, np.int32, np.uint8)):
        n = int.from_bytes(body[8 * k : 8 * k + 8], "little")
        parts.append(C.unpack(body[cut : cut + n], dtype))
        cut += n
    distinct, size, step, bits = parts
    total = np.cumsum(step.astype(np.int64))
    at = C.ends(size)
    full = at[:-1][size > 0]
    before = total[full] - step[full]
    number = total - np.repeat(before, size[size > 0])
    return distinct, size, number, np.unpackbits(bits)[: 2 * len(step)].reshape(-1, 2).astype(bool)


def _answer(documents: int):
    def answer(rows):
        kept: dict[int, list] = {}
        for block, bucket, head, body in rows:
            kept.setdefault(bucket, []).append((block, C.unpack(head, np.uint64), C.unpack(body, np.int32)))
        for bucket in list(kept):
            own = kept.pop(bucket)
            distinct, number = np.unique(np.concatenate([h for _, h, _ in own]), return_inverse=True)
            found = np.bincount(number, np.concatenate([n for *_, n in own]).astype(np.float64), len(distinct))
            fit = ((found >= MIN_DOCS) & (found * TOP_SHARE <= documents))[number]
            at = 0
            for block, h, _ in own:
                yield block, bucket, None, np.packbits(fit[at : at + len(h)]).tobytes()
                at += len(h)

    return answer


def _prints_of(rows: list[dict], buckets: int) -> tuple[bytes, list[tuple[np.ndarray, np.ndarray]]]:
    """A block's own head, and the prints of its texts and edited texts."""
    own = next(r for r in rows if r["bucket"] == B.DOCS)
    distinct, size, number, flags = _entries(own["body"])
    fit = np.zeros(len(distinct), bool)
    where = dict(B.deal(distinct, buckets))
    for r in rows:
        if r["bucket"] != B.DOCS:
            at = where[r["bucket"]]
            fit[at] = np.unpackbits(np.frombuffer(r["body"], np.uint8))[: len(at)].astype(bool)
    row = np.repeat(np.arange(len(size)), size)
    out = []
    for which in (0, 1):
        has = flags[:, which]
        some = has & fit[number]
        fallback = (np.bincount(row[some], minlength=len(size)) == 0) & (np.bincount(row[has], minlength=len(size)) > 0)
        some |= has & fallback[row]
        n, hashes = np.zeros(len(size), np.int64), np.zeros((len(size), SEEDS * LEVELS), np.uint16)
        for a in range(0, len(size), 1 << 16):
            b = min(a + (1 << 16), len(size))
            x, y = C.ends(size)[[a, b]]
            at = np.flatnonzero(some[x:y]) + x
            keys = np.sort(((row[at] - a).astype(np.uint64) << _BITS) | distinct[number[at]])
            n[a:b], hashes[a:b] = prints(keys, b - a, fallback[a:b])
        out.append((n, hashes))
    return own["head"], out


def _finished(cut: DataFrame, buckets: int, documents: int, join, schema: str) -> DataFrame:
    """From the rows of blocks: the terms' answers, then ``join`` by block."""
    table = C.bucketed(cut, "imatch", buckets, "block")

    def second(batches):
        found = ((r["block"], r["bucket"], r["head"], r["body"]) for batch in batches for r in B.each(batch))
        for r in _answer(documents)(found):
            yield B.rows([r])

    def third(a: pa.Table, b: pa.Table) -> pa.Table:
        C.lean()
        out = join([*B.each(a), *B.each(b)])
        C.give_back()
        return out

    replies = table.filter(F.col("bucket") >= 0).repartitionById(buckets, F.col("bucket")).mapInArrow(C.in_worker(second), B.ROW)
    return table.filter(F.col("bucket") == B.DOCS).groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(third, schema)


def _steps(raw: np.ndarray, off: np.ndarray) -> Iterator[tuple[int, int]]:
    for a, b in C.spans(off, STEP):
        for x in range(a, b, 1 << 16):
            yield x, min(x + (1 << 16), b)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = B.BLOCK_BYTES) -> DataFrame:
    """``id_col, n_terms, fingerprint`` of each row of ``docs``, whose terms are those of the corpus."""
    spark = docs.sparkSession
    ship(spark)
    buckets = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    own = docs.select(F.col(f"`{id_col}`").alias("id"), F.make_valid_utf8(F.col(f"`{text_col}`")).alias("text"))

    def first(batches):
        for number, batch in B.blocks(batches, "text", block_bytes):
            raw, off = C.utf8(batch.column("text"))
            steps = ((b - a, terms(raw[off[a] : off[b]], off[a : b + 1]), np.zeros(0, np.uint64)) for a, b in _steps(raw, off))
            yield B.rows(_block_rows(number, B.ids_of(batch, "id"), steps, batch.num_rows, batch.num_rows, buckets))

    def join(rows: list[dict]) -> pa.Table:
        head, ((n, hashes), _) = _prints_of(rows, buckets)
        return pa.table({"id": B.column(head), "n_terms": pa.array(np.abs(n)), "fingerprint": written(n, hashes)})

    kind = docs.schema[id_col].dataType.simpleString()
    return _finished(spread(own).mapInArrow(C.in_worker(first), B.ROW), buckets, own.count(), join, f"id {kind}, n_terms long, fingerprint string").withColumnRenamed("id", id_col)


# ------------------------------------------------------------- documents in order


def _keys(doc: np.ndarray, h: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Keys whose order as bytes is that of (doc, h, row)."""
    flip = np.int64(np.iinfo(np.int64).min)
    return np.ascontiguousarray(np.stack([doc ^ flip, h ^ flip, row ^ flip], axis=1).astype(">i8")).view("S24").reshape(-1)


def _ranges(spark: SparkSession, own: DataFrame) -> tuple[list[tuple], int]:
    """First rows ``(doc, h, row)`` of the blocks in order, and the number of documents.

    By partial sums over ranges of narrow rows, a few for each block.
    """
    n = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    narrow = own.select("doc", "h", "row", F.octet_length("text").cast("long").alias("bytes"))
    total = narrow.agg(F.sum("bytes").alias("b")).first()["b"] or 0
    most = min(BLOCK_BYTES, max(total // n, 1 << 20))
    parts = narrow.repartitionByRange(4 * max(n, total // most + 1), "doc", "h", "row").groupBy(F.spark_partition_id().alias("p"))
    found = parts.agg(F.min(F.struct("doc", "h", "row")).alias("first"), F.sum("bytes").alias("bytes"), F.count(F.lit(1)).alias("n")).collect()  # a row a range
    cuts, size = [], most
    for r in sorted(found, key=lambda r: r["p"]):
        if size + r["bytes"] > most:
            cuts.append(tuple(r["first"]))
            size = 0
        size += r["bytes"]
    return cuts, sum(r["n"] for r in found)


_HEAD = pa.schema([("doc", pa.int64()), ("null", pa.bool_()), ("h", pa.int64()), ("row", pa.int64())])


def _ipc(table: pa.Table | pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write(table)
    return sink.getvalue().to_pybytes()


def prints_and_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``.

    The edited text: the last half (rounded down) of a text's code points replaced by the
    first as many, or all, of the next document's in ascending ``id_col``.
    """
    spark = docs.sparkSession
    ship(spark)
    least = F.lit(np.iinfo(np.int64).min).cast("long")
    own = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.make_valid_utf8(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))).alias("text"))
    own = own.select(F.coalesce("id", least).alias("doc"), F.col("id").isNull().alias("null"), F.xxhash64("text").alias("h"), F.monotonically_increasing_id().alias("row"), "text")
    cuts, documents = _ranges(spark, own)
    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    if not documents:
        return spark.createDataFrame([], schema)
    many = len(cuts)
    firsts = _keys(*(np.array(c, np.int64) for c in zip(*cuts, strict=True)))
    # blocks by the first document, told by id and hash, of the one after
    ahead: dict[bytes, list[int]] = {}
    for b, c in enumerate(cuts):
        ahead.setdefault(_head16(c), []).append((b - 1) % many)

    def packed(batches):
        for batch in batches:
            doc, h, row = (batch.column(c).to_numpy() for c in ("doc", "h", "row"))
            keys = _keys(doc, h, row)
            to = np.maximum(np.searchsorted(firsts, keys, "right") - 1, 0)
            for block in np.unique(to):
                yield B.rows([_piece(batch, np.flatnonzero(to == block), int(block), 0)])
            short = np.ascontiguousarray(keys).view(np.uint8).reshape(-1, 24)[:, :16]
            told = set()
            for k in np.flatnonzero(np.isin(doc, [c[0] for c in cuts]) & np.isin(h, [c[1] for c in cuts])):
                head = short[k].tobytes()
                if head in ahead and head not in told:  # one of equal texts will do
                    told.add(head)
                    for block in ahead[head]:
                        yield B.rows([_piece(batch, np.array([k]), block, 1)])

    buckets = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))

    def first(batches):
        own, tail, block = [], None, None
        for batch in batches:
            for r in B.each(batch):
                block = r["block"]
                if r["bucket"]:
                    tail = r["head"], r["body"]
                else:
                    own.append((bytes(r["head"]), bytes(r["body"])))
        if own:
            yield B.rows(_edited_block(block, own, tail, buckets))

    def join(rows: list[dict]) -> pa.Table:
        head, (plain, edited) = _prints_of(rows, buckets)
        told = pa.ipc.open_stream(pa.py_buffer(head)).read_all()
        n = told.num_rows
        now, after, other = (tuple(x[a:b] for x in p) for p, a, b in ((plain, 0, n), (plain, 1, n + 1), (edited, 0, n)))
        return pa.table({
            "doc_id": told["doc_id"], "n_chars": told["n_chars"], "edited_sha256": told["edited_sha256"], "fingerprint": written(*now), "edited_fingerprint": written(*other),
            "near_edited": likeness(now, other), "near_next": likeness(now, after),
        })

    pieces = own.mapInArrow(C.in_worker(packed), B.ROW).repartitionById(many, F.col("block").cast("int"))
    return _finished(pieces.mapInArrow(C.in_worker(first), B.ROW), buckets, documents, join, schema)


def _head16(key: tuple) -> bytes:
    return _keys(*(np.array([x], np.int64) for x in key)).view(np.uint8)[:16].tobytes()


def _piece(batch: pa.RecordBatch, at: np.ndarray, block: int, bucket: int) -> tuple:
    own = batch.take(pa.array(at))
    return block, bucket, _ipc(own.select(_HEAD.names)), C.pack_strings(own.column("text"))


def _edited_block(block: int, own: list[tuple], tail: tuple, buckets: int) -> list[tuple]:
    """A block's documents in order, their edited texts' digests, and all terms."""
    heads = pa.concat_tables([pa.ipc.open_stream(pa.py_buffer(h)).read_all() for h, _ in own])
    order = np.argsort(_keys(*(heads[c].to_numpy() for c in ("doc", "h", "row"))), kind="stable")
    texts = pa.chunked_array([C.unpack_strings(t).cast(pa.large_string()) for _, t in own])
    texts = pa.concat_arrays([*texts.take(pa.array(order)).chunks, C.unpack_strings(tail[1]).cast(pa.large_string())])
    raw, off = C.utf8(texts)
    n = len(order)
    points = C.ends((raw & 0xC0) != 0x80) if len(raw) else np.zeros(1, np.int64)  # code points before each byte
    chars = points[off[1:]] - points[off[:-1]]
    half = chars[:n] // 2
    # the last byte with so many before it, as a code point counts from its first byte on
    keep = np.searchsorted(points, points[off[:n]] + chars[:n] - half, "right") - 1
    take = np.searchsorted(points, points[off[1 : n + 1]] + np.minimum(half, chars[1:]), "right") - 1
    del points
    whole = memoryview(raw)
    shas: list[str] = []

    def steps():
        for a, b in _steps(raw[: off[n]], off[: n + 1]):
            parts = [bytes(whole[off[k] : keep[k]]) + bytes(whole[off[k + 1] : take[k]]) for k in range(a, b)]
            shas.extend(hashlib.sha256(p).hexdigest() for p in parts)
            cut = C.ends(np.array([len(p) for p in parts], np.int64))
            yield b - a, terms(raw[off[a] : off[b]], off[a : b + 1]), terms(np.frombuffer(b"".join(parts), np.uint8), cut)
        yield 1, terms(raw[off[n] :], off[n:]), np.zeros(0, np.uint64)

    out = _block_rows(block, b"", steps(), n + 1, n, buckets)
    ids = pa.array(heads["doc"].to_numpy()[order], mask=heads["null"].to_numpy(zero_copy_only=False)[order])
    told = _ipc(pa.table({"doc_id": ids, "n_chars": pa.array(chars[:n]), "edited_sha256": shas}))
    return [(block, B.DOCS, told, out[0][3]), *out[1:]]
