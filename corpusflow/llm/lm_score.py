"""Language-model scoring by cross-entropy difference (operator 8).

Two token-bigram models over the same vocabulary, one of the target documents and one
of the background (all documents), of equal smoothing and, by scaling the background's
counts, equal mass. A token's loss under a model is the negative log probability of the
token after the one before it (at first: after the start of a document), interpolated
with the token's own frequency; a document's score is the mean over its tokens of the
target's loss minus the background's: low scores read like the target. A document's own
counts are taken off before it is scored, so a target document is not its own model.

All tokens and pairs of all texts are counted. Documents are cut into blocks; a block
sends each of its distinct tokens and pairs once, as 56-bit hashes with their counts, to
the bucket of the hash (of 10^12 different ones, one in 70,000 meets another); the bucket sums over blocks and answers with the sums (see
``blocks``). These rows are made from the block's documents on their way into the shuffle and
lie nowhere else. What is gathered thus grows with the corpus, and no task or driver holds
the model: a bucket holds its share of all blocks' rows, which ``spark.sql.shuffle.partitions``
bounds.

Cases: a null or empty text has no tokens and score 0; without target documents or
background all scores are 0; texts of any length are whole; bytes that are not UTF-8
count as U+FFFD; repeated rows count and score each; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusflow.llm import blocks as B
from corpusflow.llm import common as C

#: Pseudo-count of each token of the vocabulary; weight of its frequency against the pairs'.
SMOOTHING, BACK_OFF = 0.05, 1.0
#: Tokens scored at once.
_STEP = 1 << 18
#: Bits that a 64-bit hash loses: they would be a seventh of what blocks send.
_SHORT = np.uint64(8)
#: The hash of the start of a document.
_START = np.uint64(0x243F6A8885A308D3) >> _SHORT
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


class _Units:
    """The distinct tokens, the start and the distinct pairs of a block, dealt to buckets.

    ``keys`` are their hashes, tokens first, then the start (number ``n``), then pairs.
    """

    def __init__(self, hashes: np.ndarray, seq: np.ndarray, rows: np.ndarray, buckets: int):
        self.n = n = len(hashes)
        self.before = np.concatenate([[n], seq[:-1]])[: len(seq)].astype(np.int64)
        self.before[rows[:-1][np.diff(rows) > 0]] = n
        pairs, place = np.unique(self.before * (n + 1) + seq, return_inverse=True)
        self.place = place + n + 1  # each token's pair
        hashes = np.append(hashes, _START)
        both = hashes[pairs // (n + 1)] * _M1 + hashes[pairs % (n + 1)]
        both = (both ^ (both >> np.uint64(30))) * _M2
        self.keys = np.concatenate([hashes, (both ^ (both >> np.uint64(27))) >> _SHORT])
        to = self.keys % np.uint64(buckets)
        self.order = np.lexsort((self.keys, to))
        self.cut = np.searchsorted(to[self.order], np.arange(buckets + 1, dtype=np.uint64))

    def of(self, bucket: int) -> np.ndarray:
        """Numbers of the bucket's units, in order of their keys."""
        return self.order[self.cut[bucket] : self.cut[bucket + 1]]


def _cut(block: int, batch: pa.RecordBatch, buckets: int) -> list[tuple]:
    raw, off = C.utf8(batch.column("text"))
    bounds, rows = C.split_pieces(raw, off)
    words, seq = C.distinct_pieces(raw, bounds)
    target = batch.column("target").to_numpy(zero_copy_only=False)
    head = C.pack(B.hashes(words) >> _SHORT)
    body = C.pack(np.concatenate([target, np.diff(rows), seq]).astype(np.int32))
    return [(block, B.DOCS, B.ids_of(batch, "id"), len(head).to_bytes(8, "little") + len(target).to_bytes(8, "little") + head + body)]


def _held(blob) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of a block's documents: their distinct tokens' hashes, which are of the target, their lengths, their tokens."""
    size, n_docs = (int.from_bytes(blob[k : k + 8], "little") for k in (0, 8))
    hashes, body = C.unpack(blob[16 : 16 + size], np.uint64), C.unpack(blob[16 + size :], np.int32)
    return hashes, body[:n_docs] > 0, body[n_docs : 2 * n_docs], body[2 * n_docs :]


def _sent(docs: dict, buckets: int) -> list[tuple]:
    """A block's rows to the buckets, from its documents."""
    hashes, target, lengths, seq = _held(docs["body"])
    units = _Units(hashes, seq, C.ends(lengths), buckets)
    own = np.repeat(target, lengths)
    some = lengths > 0
    counts = []
    for mask in (own, np.ones(len(seq), bool)):
        tokens = np.bincount(seq[mask], minlength=units.n + 1)
        tokens[units.n] = (some & (target if mask is own else True)).sum()
        pairs = np.bincount(units.place[mask], minlength=len(units.keys))[units.n + 1 :]
        counts.append(np.concatenate([tokens, pairs]))
    out = []
    for b in range(buckets):
        at = units.of(b)
        if len(at):
            # keys of a bucket leave the same remainder, which need not be sent
            steps = np.diff(units.keys[at] // np.uint64(buckets), prepend=np.uint64(0))
            out.append((docs["block"], b, C.pack(steps), C.pack(np.concatenate([counts[0][at], counts[1][at], at < units.n]).astype(np.uint32))))
    return out


def _answer(rows) -> Iterator[tuple]:
    held: dict[int, list] = {}
    for block, bucket, head, body in rows:
        keys = np.cumsum(C.unpack(head, np.uint64), dtype=np.uint64)
        held.setdefault(bucket, []).append((block, keys, C.unpack(body, np.uint32).reshape(3, -1)))
    for bucket, own in held.items():
        _, number = np.unique(np.concatenate([k for _, k, _ in own]), return_inverse=True)
        t, b, token = np.concatenate([x for _, _, x in own], axis=1)
        sums = [np.bincount(number, x).astype(np.int64) for x in (t, b)]
        is_token = np.bincount(number, token) > 0
        yield -1, bucket, C.pack(np.array([is_token.sum(), sums[0][is_token].sum(), sums[1][is_token].sum()])), None
        at = 0
        for block, keys, _ in own:
            mine = number[at : at + len(keys)]
            yield block, bucket, None, C.pack(np.concatenate([s[mine] for s in sums]))
            at += len(keys)


def _repeats(row: np.ndarray, unit: np.ndarray, n: int) -> np.ndarray:
    """How often each place's unit stands in its own row."""
    _, number, counts = np.unique(row * n + unit, return_inverse=True, return_counts=True)
    return counts[number]


def _join(rows: list[dict], buckets: int, vocabulary: int, target_mass: int, mass: int) -> pa.Table:
    docs = next(r for r in rows if r["bucket"] == B.DOCS)
    ids = B.column(docs["head"])
    n_docs = len(ids)
    hashes, target, counts, seq = _held(docs["body"])
    at = C.ends(counts)
    units = _Units(hashes, seq, at, buckets)
    sums = np.zeros((2, len(units.keys)))
    for r in rows:
        if r["bucket"] != B.DOCS:
            sums[:, units.of(r["bucket"])] = C.unpack(r["body"], np.int64).reshape(2, -1)
    total = np.zeros(n_docs)
    for a, b in C.spans(at, _STEP) if target_mass and mass else []:
        x, y = at[a], at[b]
        own, row = counts[a:b], np.repeat(np.arange(b - a), counts[a:b])
        token, pair, before = seq[x:y], units.place[x:y], units.before[x:y]
        of_token = _repeats(row, token, units.n)
        of_pair = _repeats(row, pair, len(units.keys))
        of_before = np.where(before == units.n, 1, np.concatenate([[0], of_token[:-1]])[: y - x])
        logs = []
        # without the document's own counts: in the target's if it is one of them, and in the background's
        for k, (m, without) in enumerate(((target_mass, np.repeat(target[a:b], own)), (mass, np.ones(y - x, bool)))):
            scale = 1.0 if k == 0 else target_mass / mass
            left = np.repeat(m - own * (target[a:b] if k == 0 else 1), own)
            single = (scale * (sums[k][token] - without * of_token) + SMOOTHING) / (scale * left + SMOOTHING * vocabulary)
            both = scale * (sums[k][pair] - without * of_pair) + BACK_OFF * single
            logs.append(np.log(both / (scale * (sums[k][before] - without * of_before) + BACK_OFF)))
        total[a:b] = C.sums(logs[1] - logs[0], at[a : b + 1] - x)
    return pa.table({"id": ids, "n_tokens": pa.array(counts, pa.int64()), "score": total / np.maximum(counts, 1)})


def score(docs: DataFrame, target: DataFrame, block_bytes: int = B.BLOCK_BYTES) -> DataFrame:
    """Per document: ``doc_id, n_tokens, score``; ``target`` has the target's ``doc_id``."""
    spark = docs.sparkSession
    buckets = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    kind = docs.schema["doc_id"].dataType.simpleString()
    ids = C.broadcast_if_small(target.select(F.col("doc_id").alias("t_")).filter(F.col("t_").isNotNull()).distinct())
    own = docs.select(F.col("doc_id").alias("id"), F.make_valid_utf8("text").alias("text")).join(ids, F.col("id") == F.col("t_"), "left")
    own = own.select("id", "text", F.col("t_").isNotNull().alias("target"))

    def after(replies: DataFrame):
        # three numbers a bucket: its tokens, and their counts in the target and in all
        found = [C.unpack(r["head"], np.int64) for r in replies.filter(F.col("block") < 0).select("head").collect()]
        vocabulary, target_mass, mass = (int(x) for x in np.sum(found, axis=0)) if found else (0, 0, 0)
        return lambda rows: _join(rows, buckets, vocabulary, target_mass, mass)

    out = B.exchange(own, _cut, _answer, None, f"id {kind}, n_tokens long, score double", block_bytes=block_bytes, after=after, sent=_sent)
    return out.withColumnRenamed("id", "doc_id")
