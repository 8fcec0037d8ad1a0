"""Toxicity by subword-bag embeddings and a linear softmax (operator 10).

A word's vector is the mean of the embeddings of its character n-grams (hashed,
with word bounds), a segment's the mean of its words'; a linear softmax over the
segment gives its class. Embeddings and softmax are trained jointly in numpy,
so that a misspelling unseen in training still shares most of its n-grams'
vectors with the word it hides. A document is as toxic as its worst segment of
``SEGMENT`` words: one insult in a long text is not averaged away.

Training draws a bounded sample: about ``SAMPLE_ROWS`` labelled documents, up to half
of them toxic, or so many fewer that their texts have about ``SAMPLE_BYTES`` bytes
together. A hash of the id draws them, whatever their order and length. Scoring reads
whole texts of any length.

Cases: a null text, or one without words, is scored as an empty segment; without
labelled rows of both classes all scores are the share of toxic ones (0 without
any); repeated rows give a row each; an empty table gives an empty result;
further columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusflow.llm import common as C
from corpusflow.shipping import ship
from corpusflow.storage import spread

SAMPLE_ROWS = 6000
#: Of the whole sample.
SAMPLE_BYTES = 24 << 20
SEGMENT = 8
DIMENSIONS = 8
BUCKETS = 1 << 17
SIZES = (3, 4, 5)
EPOCHS = 80
#: Sharpness of the soft maximum at the end; steps of embeddings, softmax, bias.
SHARP = 12.0
RATES = (5.0, 0.02, 0.1)
DECAY = 0.002
_STEP = 4 << 20
_FIT_STEP = 1 << 19


def _plain() -> np.ndarray:
    out = np.arange(256, dtype=np.uint8)
    out[ord("A") : ord("Z") + 1] += 32
    return out


def word_bounds(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the runs of letters, digits and inner signs; words before each row.

    White space and ``.,;:!?|"()[]{}<>`` part words; other bytes belong to them.
    """
    gap = np.zeros(256, bool)
    gap[list(b' \t\n\x0b\x0c\r.,;:!?|"()[]{}<>')] = True
    inside = np.concatenate([[False], ~gap[raw], [False]])
    change = inside[1:] != inside[:-1]
    head = np.zeros(len(raw) + 1, bool)
    head[off] = True
    start = (change | head) & inside[1:]
    end = (change | head) & inside[:-1]
    start, end = np.flatnonzero(start), np.flatnonzero(end)
    return start, end, np.searchsorted(start, off)


def subwords(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams of words that lie end to end: bucket numbers and their offsets.

    Each word is ``<word>``; its n-grams are those of ``SIZES`` bytes and the
    whole word. n-grams are ordered by word.
    """
    n = len(off) - 1
    size = np.diff(off) + 2
    at = C.ends(size)
    wide = np.empty(at[-1], np.uint64)
    inner = np.ones(len(wide), bool)
    inner[at[:-1]] = inner[at[1:] - 1] = False
    wide[at[:-1]], wide[at[1:] - 1] = ord("<"), ord(">")
    wide[inner] = _plain()[raw]
    owner = np.repeat(np.arange(n), size)
    left = at[1:][owner] - np.arange(len(wide))  # bytes from here to the word's end
    key, keys, owners = np.zeros(len(wide), np.uint64), [], []
    padded = np.concatenate([wide, np.zeros(max(SIZES), np.uint64)])
    for k in range(1, max(SIZES) + 1):
        key = key * np.uint64(0x100000001B3) + padded[k - 1 : k - 1 + len(wide)] + np.uint64(1)
        if k in SIZES:
            here = left >= k
            keys.append(key[here] ^ np.uint64(k))
            owners.append(owner[here])
    power = np.uint64(0x9E3779B97F4A7C15) * (np.arange(len(wide)) - at[:-1][owner] + 1).astype(np.uint64)
    with np.errstate(over="ignore"):
        whole = np.add.reduceat((wide + np.uint64(7)) * power, at[:-1]) if n else np.zeros(0, np.uint64)
    keys.append(whole)
    owners.append(np.arange(n))
    key, owner = np.concatenate(keys), np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    key = key[order]
    key = (key ^ (key >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    bucket = (key >> np.uint64(40)) % np.uint64(BUCKETS)
    return bucket.astype(np.int64), C.ends(np.bincount(owner, minlength=n))


def bag(column) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct words of a batch, the words' numbers, and words before each row."""
    raw, off = C.utf8(column)
    raw = _plain()[raw]
    start, end, rows = word_bounds(raw, off)
    # words end to end, then by their distinct values
    joined = raw[C.ragged(start, end - start)] if len(start) else raw[:0]
    bounds = C.ends(end - start)
    if not len(start):
        return pa.array([], pa.large_binary()), np.zeros(0, np.int32), rows
    values = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(joined))])
    found = values.dictionary_encode()
    return found.dictionary, found.indices.to_numpy(zero_copy_only=False), rows


def binary(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    if not len(values):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = values.buffers()
    off = np.frombuffer(offsets, np.int64)[values.offset : values.offset + len(values) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0] : off[-1]], off - off[0]


def segments(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word offsets of segments, and segments before each row; an empty row has one."""
    n_words = np.diff(rows)
    pieces = np.maximum(1, -(-n_words // SEGMENT))
    first = C.ends(pieces)
    owner = np.repeat(np.arange(len(n_words)), pieces)
    inside = np.arange(first[-1]) - first[:-1][owner]
    start = rows[:-1][owner] + inside * n_words[owner] // pieces[owner]
    return np.concatenate([start, rows[-1:]]), first


@dataclass
class Model:
    scores: np.ndarray  # an n-gram's share in the log odds: embedding times softmax
    bias: float
    base: float  # score without a trained model
    trained: bool


def segment_logits(model_scores, bias, words: pa.Array, seq: np.ndarray, cut: np.ndarray) -> np.ndarray:
    raw, off = binary(words)
    per_word = np.zeros(len(words))
    for a, b in C.spans(off, _STEP):
        grams, at = subwords(raw[off[a] : off[b]], off[a : b + 1] - off[a])
        per_word[a:b] = C.sums(model_scores[grams], at) / np.diff(at)
    return C.sums(per_word[seq], cut) / np.maximum(np.diff(cut), 1) + bias


def _grams(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of the words' n-grams, and how many each word has. In steps, to bound memory."""
    raw, off = binary(words)
    parts, sizes = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
    for a, b in C.spans(off, _FIT_STEP):
        grams, at = subwords(raw[off[a] : off[b]], off[a : b + 1] - off[a])
        parts.append(grams.astype(np.int32))
        sizes.append(np.diff(at))
    return np.concatenate(parts), np.concatenate(sizes)


def fit(texts: list[str], labels: list[int]) -> Model:
    """Train embeddings and softmax together, full batch, by gradient steps with momentum.

    A document's log odds are a soft maximum over its segments, at first their
    mean. Steps are scaled by the gradient's largest entry as a whole, so n-grams
    keep the proportions of their evidence and rare ones do not catch up.
    """
    y = np.asarray(labels, float)
    base = float(y.mean()) if len(y) else 0.0
    if not 0 < base < 1:
        return Model(np.zeros(BUCKETS), 0.0, base, False)
    words, seq, rows = bag(pa.array(texts, pa.string()))
    cut, first = segments(rows)
    grams, n_grams = _grams(words)
    n_words = len(words)
    gram_word = np.repeat(np.arange(n_words, dtype=np.int32), n_grams)
    first_gram = C.ends(n_grams)[:-1]
    seg_of = np.repeat(np.arange(len(cut) - 1), np.diff(cut))
    seg_len = np.maximum(np.diff(cut), 1)
    seg_doc = np.repeat(np.arange(len(y)), np.diff(first))
    rng = np.random.default_rng(3)
    e = rng.normal(0, 0.001, (BUCKETS, DIMENSIONS))
    u = rng.normal(0, 1, DIMENSIONS)
    bias = np.zeros(1)
    weight = np.where(y == 1, 0.5 / base, 0.5 / (1 - base))
    params = [e, u, bias]
    speed = [np.zeros_like(p) for p in params]
    used = np.unique(grams)
    for epoch in range(EPOCHS):
        p = e @ u
        per_word = np.add.reduceat(p.astype(np.float32)[grams], first_gram) / n_grams if n_words else np.zeros(0)
        z = C.sums(per_word[seq], cut) / seg_len + bias[0]
        sharp = SHARP * max(0.0, epoch / EPOCHS - 0.2)
        top = np.maximum.reduceat(z, first[:-1])
        w = np.exp(sharp * (z - top[seg_doc]))
        total = np.add.reduceat(w, first[:-1])
        w /= total[seg_doc]
        doc = np.add.reduceat(w * z, first[:-1])
        err = (1 / (1 + np.exp(-doc)) - y) * weight / len(y)
        dz = err[seg_doc] * w
        dbias = np.array([dz.sum()])
        dword = np.bincount(seq, (dz / seg_len)[seg_of], minlength=n_words) / n_grams
        dp = np.bincount(grams, dword.astype(np.float32)[gram_word], minlength=BUCKETS)
        de, du = dp[:, None] * u, e.T @ dp
        for param, grad, v, rate in zip(params, (de, du, dbias), speed, RATES, strict=True):
            v *= 0.8
            v -= rate * grad / (np.abs(grad).max() + 1e-12)
            param += v
            param *= 1 - DECAY * (param is not bias)
    p = e @ u
    known = np.zeros(BUCKETS)
    known[used] = p[used]
    return Model(known, float(bias[0]), base, True)


def score_batch(model: Model, column) -> np.ndarray:
    """Scores of the rows of a string column."""
    n = len(column)
    if not model.trained:
        return np.full(n, model.base)
    out = np.zeros(n)
    _, off = C.utf8(column)
    for a, b in C.spans(off, 16 << 20):
        words, seq, rows = bag(column.slice(a, b - a))
        cut, first = segments(rows)
        z = segment_logits(model.scores, model.bias, words, seq, cut)
        out[a:b] = 1 / (1 + np.exp(-np.clip(np.maximum.reduceat(z, first[:-1]), -500, 500)))
    return out


def held_out(id_col: str = "doc_id"):
    """Whether a row is kept from training: CRC-32 of its id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """A model from ``docs(doc_id, text)`` and ``labels(doc_id, toxic)``."""
    own = labels.filter(F.col("toxic").isin(0, 1) & ~held_out()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    counts = {r["toxic"]: r["n"] for r in own.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    share = F.lit(0.0)
    for k, n in counts.items():
        share = F.when(F.col("toxic") == k, min(1.0, SAMPLE_ROWS / 2 / n)).otherwise(share)
    # where in its class's share an id lies, from 0 to 1: the sample is a prefix of it
    draw = F.pmod(F.xxhash64(F.col("doc_id"), F.lit(7)), F.lit(1 << 20)) / (F.lit(1 << 20) * share)
    picked = C.broadcast_if_small(own.select("doc_id", "toxic", draw.alias("draw")).filter("draw < 1"))
    texts = docs.select("doc_id", "text").filter(F.col("text").isNotNull()).join(picked, "doc_id")
    # of an id's rows the one whose text has the least hash
    one = F.min_by(F.struct("text", "toxic", "draw"), F.xxhash64("text")).alias("own")
    cores = docs.sparkSession.sparkContext.defaultParallelism
    rows = C.materialise(texts.groupBy("doc_id").agg(one).select("doc_id", "own.*").coalesce(cores), "sample")
    size = rows.agg(F.sum(F.octet_length("text")).alias("b")).first()["b"] or 0
    drawn = rows.filter(F.col("draw") < min(1.0, SAMPLE_BYTES / max(size, 1))).orderBy("doc_id").collect()
    return fit([r["text"] for r in drawn], [r["toxic"] for r in drawn])


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """Per document: ``doc_id, held_out, score, predicted``."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS numbers
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            score = score_batch(shared.value, batch.column("text"))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(score), pa.array((score >= 0.5).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    own = docs.select("doc_id", held_out().alias("held_out"), F.col("text"))
    return spread(own).mapInArrow(C.in_worker(run), f"doc_id {kind}, held_out boolean, score double, predicted int")


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Train on the labelled rows that are not held out and score every document."""
    return predict(docs, train(docs, labels))
