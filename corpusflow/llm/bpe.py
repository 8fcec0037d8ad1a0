"""Byte-level BPE encoding and decoding (operator 2).

Encoding: documents are split into pre-tokens with their positions; each
distinct pre-token of the corpus is encoded once, in the bucket that its hash
names; the ids join back to the positions and documents are reassembled (see
``blocks``). Decoding joins ids with the token-byte table, whose size the
vocabulary file bounds.

Cases: a null or empty text has no ids and decodes to zero bytes; bytes that are not
UTF-8 count as U+FFFD; texts of any
length are whole; repeated rows (of ids too) give a row each; a null id stays
null; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusflow.llm import blocks as B
from corpusflow.llm import common as C
from corpusflow.shipping import ship

DEFAULT_VOCABULARY = "byte_bpe_50k.tiktoken"
#: Ids put together at once.
_STEP = 1 << 18


def vocabulary_path(name: str = DEFAULT_VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(2)
def ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


@lru_cache(2)
def encoder(path: str):
    import public_tokenizers
    import tiktoken

    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks(path), special_tokens={})


def encode_words(words: list[str], path: str) -> list[bytes]:
    """Ids (int32) of pre-tokens, none of which is split again."""
    enc = encoder(path)
    return [np.array(enc._encode_single_piece(w), np.int32).tobytes() for w in words]


def _cut(text: str, id_col: str):
    def cut(block: int, batch: pa.RecordBatch, buckets: int) -> list[tuple]:
        raw, off = C.utf8(batch.column(text))
        bounds, rows = C.split_pieces(raw, off)
        words, seq = C.distinct_pieces(raw, bounds)
        # numbers by descending frequency: positions then take few bytes
        order = np.argsort(-np.bincount(seq, minlength=len(words)), kind="stable")
        rank = np.empty(len(order), np.int32)
        rank[order] = np.arange(len(order))
        words, seq = words.take(pa.array(order)), rank[seq]
        out = [(block, B.DOCS, B.ids_of(batch, id_col), C.pack(np.concatenate([[len(words)], np.diff(rows), seq]).astype(np.int32)))]
        for b, at in B.deal(B.hashes(words), buckets):
            out.append((block, b, C.pack(at.astype(np.int32)), C.pack_strings(words.take(pa.array(at)))))
        return out

    return cut


def _answer(path: str):
    def answer(rows):
        known: dict[str, bytes] = {}
        for block, bucket, head, body in rows:
            words = C.unpack_strings(body).to_pylist()
            new = [w for w in words if w not in known]
            known.update(zip(new, encode_words(new, path), strict=True))
            found = [known[w] for w in words]
            sizes = np.fromiter(map(len, found), np.int32, len(found)) // 4
            yield block, bucket, bytes(head), C.pack(np.concatenate([sizes, np.frombuffer(b"".join(found), np.int32)]))

    return answer


def _ids_of_block(rows: list[dict]) -> tuple[pa.Array, np.ndarray, Iterator[np.ndarray]]:
    """Of a block: its documents' ids (keys), their offsets in tokens, and the token ids
    of all documents one after another, some at a time."""
    docs = next(r for r in rows if r["bucket"] == B.DOCS)
    keys = B.column(docs["head"])
    body = C.unpack(docs["body"], np.int32)
    n_words, counts, seq = int(body[0]), body[1 : 1 + len(keys)], body[1 + len(keys) :]
    sizes, starts, flats, at = np.zeros(n_words, np.int32), np.zeros(n_words, np.int64), [], 0
    for r in rows:
        if r["bucket"] != B.DOCS:
            where, got = C.unpack(r["head"], np.int32), C.unpack(r["body"], np.int32)
            own, flat = got[: len(where)], got[len(where) :]
            sizes[where], starts[where] = own, C.ends(own)[:-1] + at
            flats.append(flat)
            at += len(flat)
    flat = np.concatenate(flats) if flats else np.zeros(0, np.int32)
    offsets = C.ends(sizes[seq])[C.ends(counts)]

    def tokens():
        for a in range(0, len(seq), _STEP):
            own = seq[a : a + _STEP]
            yield flat[C.ragged(starts[own], sizes[own])]

    return keys, offsets, tokens()


def _lists(rows: list[dict]) -> pa.Table:
    keys, offsets, tokens = _ids_of_block(rows)
    flat = np.concatenate([np.zeros(0, np.int32), *tokens])
    values = pa.LargeListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int32())).cast(pa.list_(pa.int32()))
    return pa.table({"id": keys, "ids": values})


@lru_cache(2)
def decimals(path: str) -> tuple[np.ndarray, np.ndarray]:
    """Each id as a space and its digits, end to end, and their offsets."""
    text = [b" %d" % k for k in range(max(ranks(path).values()) + 1)]
    return np.frombuffer(b"".join(text), np.uint8), C.ends(np.array([len(t) for t in text]))


def _digests(rows: list[dict], path: str) -> pa.Table:
    """Digests document by document, as the tokens come; no document is held whole."""
    keys, offsets, tokens = _ids_of_block(rows)
    tables = [decimals(path), token_bytes(path)]
    out: list[list[str]] = [[], []]
    open_, at, row = [hashlib.sha256(), hashlib.sha256()], 0, 0

    def close():
        nonlocal open_, row
        for o, h in zip(out, open_, strict=True):
            o.append(h.hexdigest())
        open_, row = [hashlib.sha256(), hashlib.sha256()], row + 1

    for own in tokens:
        raws = []
        for table, off in tables:
            n = (off[1:] - off[:-1])[own]
            raws.append((memoryview(table[C.ragged(off[own], n)].tobytes()), C.ends(n)))
        end = at + len(own)
        a = at
        while row < len(keys):
            b = min(end, int(offsets[row + 1]))
            for k, (raw, cut) in enumerate(raws):
                # the first id of a document has no space before it
                lead = 1 if k == 0 and a == offsets[row] and b > a else 0
                open_[k].update(raw[cut[a - at] + lead : cut[b - at]])
            a = b
            if offsets[row + 1] > end:
                break
            close()
        at = end
    while row < len(keys):
        close()
    return pa.table({"id": keys, "n_tokens": pa.array(np.diff(offsets), pa.int64()), "ids_sha256": out[0], "decoded_sha256": out[1]})


def _exchanged(docs: DataFrame, join, schema: str, id_col: str, text_col: str, path: str, block_bytes: int) -> DataFrame:
    kind = docs.schema[id_col].dataType.simpleString()
    own = docs.select(F.col(id_col).alias("id"), F.make_valid_utf8(F.col(text_col)).alias("text"))
    return B.exchange(own, _cut("text", "id"), _answer(path), join, f"id {kind}, {schema}", block_bytes=block_bytes).withColumnRenamed("id", id_col)


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, block_bytes: int = B.BLOCK_BYTES) -> DataFrame:
    """``(id_col, ids array<int>)`` for each row of ``docs``."""
    return _exchanged(docs, _lists, "ids array<int>", id_col, text_col, path or vocabulary_path(), block_bytes)


@lru_cache(2)
def token_bytes(path: str) -> tuple[np.ndarray, np.ndarray]:
    """The token-byte table: all tokens' bytes end to end, and their offsets."""
    table = ranks(path)
    by_id = [b""] * (max(table.values()) + 1)
    for token, i in table.items():
        by_id[i] = token
    return np.frombuffer(b"".join(by_id), np.uint8), C.ends(np.array([len(t) for t in by_id]))


def decoded(lists: pa.Array, path: str) -> list[bytes | None]:
    """The bytes of each row's ids, gathered from the token-byte table; null ids: null."""
    table, off = token_bytes(path)
    sizes = np.diff(off)
    lists = lists.cast(pa.large_list(pa.int32()))
    where = lists.offsets.to_numpy().astype(np.int64)
    flat = lists.values.to_numpy(zero_copy_only=False)
    null = lists.is_null().to_numpy(zero_copy_only=False)
    out: list[bytes | None] = []
    for a, b in C.spans(where, _STEP):
        own = flat[where[a] : where[b]]
        n = sizes[own]
        raw = table[C.ragged(off[own], n)].tobytes()
        cut = C.ends(n)[where[a : b + 1] - where[a]]
        out += [raw[x:y] for x, y in zip(cut[:-1], cut[1:], strict=True)]
    return [None if x else d for x, d in zip(null, out, strict=True)]


def decode(tokens: DataFrame, ids_col: str = "ids", into: str = "decoded", path: str | None = None) -> DataFrame:
    """``tokens`` with the bytes of its ids in ``into``; null ids: null bytes."""
    path = path or vocabulary_path()
    ship(tokens.sparkSession)
    keep = [c for c in tokens.columns if c != into]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in tokens.schema if f.name != into) + f", `{into}` binary"

    def run(batches):
        for batch in batches:
            values = decoded(batch.column(ids_col), path)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(values, pa.binary())], names=[*keep, into])

    return tokens.select(*[F.col(f"`{c}`") for c in keep]).mapInArrow(C.in_worker(run), schema)


def digests(docs: DataFrame, path: str | None = None, block_bytes: int = B.BLOCK_BYTES) -> DataFrame:
    """Per document: ``doc_id, n_tokens``, SHA-256 of the ids as text and of the decoded bytes.

    The ids are decoded where a block's documents are put together, and only
    digests leave the worker.
    """
    path = path or vocabulary_path()
    return _exchanged(docs, lambda rows: _digests(rows, path), "n_tokens long, ids_sha256 string, decoded_sha256 string", "doc_id", "text", path, block_bytes)
