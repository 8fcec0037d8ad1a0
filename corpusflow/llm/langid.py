"""Language identification by error-correcting output codes (operator 5).

Every language has a codeword. One binary classifier for each bit, a linear
model over byte n-grams fitted in numpy, tells how far a text speaks for a 1.
Decoding sums each codeword's losses, weighted by the classifiers' training
accuracy, and takes the nearest codeword; a text whose two nearest codewords lie
within ``MARGIN`` of each other is flagged as ambiguous.

Fitting uses a sample of labelled rows that is bounded by their number alone: about
``SAMPLE_ROWS`` different texts, the same number for each language (at least
``LEAST_ROWS``, or all there are), chosen by a hash of the text. Their whole texts are
counted where they lie, whatever their length; the driver gets the sums of one
language after another and some numbers a row. Prediction reads whole texts too.

Cases: a null text or one without a letter is ``und`` with score 0; no labelled
rows give a model that says ``und``; one language only gives that language; ties
go to the language that sorts first; repeated rows give a row each; an empty
table gives an empty result; further columns are ignored by ``predict``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusflow.llm import common as C
from corpusflow.shipping import ship
from corpusflow.storage import spread

SAMPLE_ROWS = 4000
LEAST_ROWS = 40
#: Weighted loss between the two nearest codewords below which a text is ambiguous.
MARGIN = 0.02
UNKNOWN = "und"
BITS = 16
#: Buckets of pairs, then of triples.
WIDTH = 2 << BITS
#: Spaces after each row: n-grams that begin in a row end in it.
_PAD = 3


def codewords(n: int) -> np.ndarray:
    """An ``n`` x bits matrix of 0 and 1.

    Up to 6 languages the exhaustive code of ``2 ** (n - 1) - 1`` bits; beyond
    that, the best separated of some dense random codes drawn from a fixed seed.
    """
    if n <= 1:
        return np.ones((n, 1), np.int8)
    if n <= 6:
        return np.array([[(c >> (n - 1 - k)) & 1 if k else 1 for c in range(1 << (n - 1), (1 << n) - 1)] for k in range(n)], np.int8)
    width, rng, best, most = int(10 * np.log2(n)), np.random.default_rng(11), None, -1
    for _ in range(50):
        code = rng.integers(0, 2, (n, width)).astype(np.int8)
        sign = 2 * code.astype(np.float32) - 1
        apart = (width - sign @ sign.T) / 2 + width * np.eye(n, dtype=np.float32)
        if apart.min() > most and (code.min(0) != code.max(0)).all():
            best, most = code, apart.min()
    return best


def _byte_map() -> np.ndarray:
    out = np.arange(256, dtype=np.uint8)
    out[: ord("A")] = 32
    out[ord("A") : ord("Z") + 1] += 32
    out[ord("Z") + 1 : ord("a")] = 32
    out[ord("z") + 1 : 128] = 32
    return out


def ngrams(raw: np.ndarray) -> np.ndarray:
    """Hashed byte pairs and triples at each position, two columns."""
    b = _byte_map()[raw].astype(np.uint32)
    b = np.concatenate([b, np.full(2, 32, np.uint32)])
    two = b[:-2] << np.uint32(8) | b[1:-1]
    three = ((two << np.uint32(8) | b[2:]) * np.uint32(2654435761)) >> np.uint32(32 - BITS)
    return np.stack([two, three + np.uint32(1 << 16)], axis=1)


def padded(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows with ``_PAD`` spaces after each, and their offsets."""
    n = len(off) - 1
    wide = np.full(len(raw) + _PAD * n, 32, np.uint8)
    ends = off + _PAD * np.arange(n + 1)
    wide[C.ragged(ends[:-1], np.diff(off))] = raw
    return wide, ends


def _steps(raw: np.ndarray, off: np.ndarray, step: int):
    """n-grams, ``step`` positions at a time, and where each row's first and last are
    among them. A row's n-grams begin in its text or at the first space after it."""
    for a, b in C.spans(off, step):
        for x in range(off[a], off[b], step):  # a longer row in steps
            y = min(x + step, off[b])
            start, stop = np.clip(off[a:b], x, y) - x, np.clip(off[a + 1 : b + 1] - _PAD + 1, x, y) - x
            yield a, b, ngrams(raw[x : y + 2])[: y - x], start, stop


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray  # languages x bits
    weights: np.ndarray  # (2 << 16) x bits: mean log odds of an n-gram
    bias: np.ndarray
    scale: np.ndarray
    trust: np.ndarray  # weight of each bit's loss


def _means(weights: np.ndarray, raw: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Mean weights of each padded row's n-grams."""
    bits = weights.shape[1]
    out = np.zeros((len(off) - 1, bits))
    for a, b, grams, start, stop in _steps(raw, off, max(1 << 12, (1 << 21) // bits)):
        for column in range(2):
            total = np.zeros((len(grams) + 1, bits))
            np.cumsum(weights[grams[:, column]], axis=0, dtype=np.float64, out=total[1:])
            out[a:b] += total[stop] - total[start]
    return out / (2 * np.maximum(np.diff(off) - _PAD + 1, 1))[:, None]


def _counts(raw: np.ndarray, off: np.ndarray) -> np.ndarray:
    """How often each n-gram stands in padded rows, together."""
    out = np.zeros(WIDTH, np.int64)
    for _, _, grams, start, stop in _steps(raw, off, 1 << 18):
        out += np.bincount(grams[C.ragged(start, stop - start)].reshape(-1), minlength=WIDTH)
    return out


def _weights(code: np.ndarray, counts) -> np.ndarray:
    """An n-gram's log odds for each bit, from ``(number of a language, counts)``."""
    ones, all_ = np.zeros((WIDTH, code.shape[1])), np.zeros(WIDTH)
    for k, n in counts:
        rates = n + 0.1
        for half in (slice(None, 1 << BITS), slice(1 << BITS, None)):
            rates[half] /= rates[half].sum()
        all_ += rates
        ones[:, code[k] == 1] += rates[:, None]
    out, n_ones = np.zeros(ones.shape, np.float32), code.sum(0)
    for bit in range(code.shape[1]):
        if 0 < n_ones[bit] < len(code):
            out[:, bit] = np.log(ones[:, bit] / n_ones[bit]) - np.log((all_ - ones[:, bit]) / (len(code) - n_ones[bit]))
    return out


def _calibrated(languages: list[str], code: np.ndarray, weights: np.ndarray, x: np.ndarray, which: np.ndarray) -> Model:
    """The model whose classifiers part the rows ``x`` of languages ``which`` best."""
    bias, scale, trust = np.zeros(code.shape[1]), np.ones(code.shape[1]), np.ones(code.shape[1])
    for bit in range(code.shape[1]):
        y = code[which, bit]
        if not len(y) or y.min() == y.max():
            continue
        a, b = np.median(x[y == 0, bit]), np.median(x[y == 1, bit])
        bias[bit], scale[bit] = (a + b) / 2, 8 / max(b - a, 1e-6)
        trust[bit] = max(2 * ((x[:, bit] > bias[bit]) == y).mean() - 1, 0.05)
    return Model(languages, code, weights, bias, scale, trust / trust.sum())


def fit(texts: list[bytes], labels: list[str]) -> Model:
    """One linear n-gram classifier for each bit of the code, from rows at hand."""
    languages = sorted(set(labels))
    code = codewords(len(languages))
    raw, off = padded(*C.utf8(pa.array([t.decode() for t in texts], pa.string())))
    which = np.searchsorted(languages, labels) if languages else np.zeros(0, np.int64)

    def counts():
        for k in range(len(languages)):
            own = np.flatnonzero(which == k)
            yield k, _counts(raw[C.ragged(off[own], off[own + 1] - off[own])], C.ends(off[own + 1] - off[own]))

    weights = _weights(code, counts())
    return _calibrated(languages, code, weights, _means(weights, raw, off), which)


def decode(model: Model, raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Number of the nearest codeword, score, and whether it is ambiguous, by row."""
    z = (_means(model.weights, raw, off) - model.bias) * model.scale
    sign = 2.0 * model.code - 1
    loss = np.stack([(np.logaddexp(0, -sign[k] * z) * model.trust).sum(1) for k in range(len(model.languages))], axis=1)
    order = np.sort(loss, axis=1)
    margin = order[:, 1] - order[:, 0] if loss.shape[1] > 1 else np.full(len(loss), 1.0)
    share = np.exp(-4 * (loss - order[:, :1]))
    return loss.argmin(1), 1 / share.sum(1), margin < MARGIN


def sample(docs: DataFrame) -> DataFrame:
    """Different rows ``(text, lang)``, about ``SAMPLE_ROWS``, the same number by language.

    Which rows there are depends on the set of texts alone, not on their order,
    ids, lengths or numbers of copies.
    """
    known = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("text", "lang", F.xxhash64("text", F.lit(5)).alias("h"))
    counts = known.select("lang", "h").distinct().groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    counts = C.materialise(counts.coalesce(1), "languages")  # a row a language
    each = max(SAMPLE_ROWS / max(counts.count(), 1), LEAST_ROWS)
    shares = C.broadcast_if_small(counts.select("lang", (F.lit(each) / F.col("n")).alias("share")))
    drawn = known.join(shares, "lang").filter(F.pmod("h", F.lit(1 << 20)) < F.col("share") * (1 << 20))
    cores = docs.sparkSession.sparkContext.defaultParallelism
    # as many files as cores: the rows are bounded, and a file each for few rows is dear
    return C.materialise(drawn.select("lang", "h", "text").dropDuplicates(["lang", "h"]).drop("h").coalesce(cores), "sample")


def train(docs: DataFrame) -> Model:
    """A model from labelled rows ``(text, lang)``."""
    ship(docs.sparkSession)
    rows = sample(docs)
    languages = [r["lang"] for r in rows.select("lang").distinct().orderBy("lang").collect()]
    languages.sort()
    code = codewords(len(languages))

    def count(batches):
        for batch in batches:
            lang = batch.column("lang").dictionary_encode()
            for k, name in enumerate(lang.dictionary):
                own = batch.column("text").filter(pc.equal(lang.indices, k))
                n = _counts(*padded(*C.utf8(own)))
                at = np.flatnonzero(n)
                yield pa.RecordBatch.from_pydict({"lang": pa.array([name.as_py()] * len(at), pa.string()), "gram": pa.array(at, pa.int32()), "n": pa.array(n[at], pa.int64())})

    sums = rows.mapInArrow(C.in_worker(count), "lang string, gram int, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    # a language after another, each at most WIDTH numbers
    each = sums.groupBy("lang").agg(F.collect_list("gram").alias("grams"), F.collect_list("n").alias("ns"))

    def counts():
        for r in each.toLocalIterator():
            out = np.zeros(WIDTH, np.int64)
            out[r["grams"]] = r["ns"]
            yield languages.index(r["lang"]), out

    weights = _weights(code, counts())
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def measure(batches):
        for batch in batches:
            x = _means(shared.value, *padded(*C.utf8(batch.column("text"))))
            yield pa.RecordBatch.from_arrays([batch.column("lang"), pa.array(list(x), pa.list_(pa.float64()))], names=["lang", "x"])

    # as many rows as the sample has, of some numbers each
    found = sorted(tuple(r) for r in rows.mapInArrow(C.in_worker(measure), "lang string, x array<double>").collect())
    x = np.array([r[1] for r in found]).reshape(len(found), code.shape[1])
    return _calibrated(languages, code, weights, x, np.searchsorted(languages, [r[0] for r in found]) if found else np.zeros(0, np.int64))


def predict(docs: DataFrame, model: Model, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` columns with ``lang_pred, score, ambiguous`` for each whole text;
    these take the place of columns of their names."""
    keep = [c for c in keep if c.lower() not in ("lang_pred", "score", "ambiguous")]
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # of a size that BITS and the languages bound
    letter = F.coalesce(F.col(f"`{text}`").rlike(r"\p{L}"), F.lit(False))
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*[F.col(f"`{c}`") for c in keep]).schema]
    t, l = text if text in keep else C.fresh(docs, "text_"), C.fresh(docs, "letter_")

    def run(batches):
        m = shared.value
        for batch in batches:
            wide, ends = padded(*C.utf8(batch.column(t)))
            n = len(ends) - 1
            names, score, unsure = [UNKNOWN] * n, np.zeros(n), np.zeros(n, bool)
            if m.languages and n:
                best, score, unsure = decode(m, wide, ends)
                known = batch.column(l).to_numpy(zero_copy_only=False)
                names = [m.languages[k] if y else UNKNOWN for k, y in zip(best, known, strict=True)]
                score, unsure = np.where(known, score, 0.0), unsure | ~known
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in keep), pa.array(names, pa.string()), pa.array(score, pa.float64()), pa.array(unsure, pa.bool_())],
                names=[*keep, "lang_pred", "score", "ambiguous"],
            )

    whole = [] if text in keep else [F.col(f"`{text}`").alias(t)]
    own = docs.select(*[F.col(f"`{c}`") for c in keep], *whole, letter.alias(l))
    return spread(own).mapInArrow(C.in_worker(run), ", ".join([*fields, "lang_pred string, score double, ambiguous boolean"]))


def held_out(id_col: str = "doc_id"):
    """Whether a row is kept from fitting: CRC-32 of its id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame) -> DataFrame:
    """Per document: ``doc_id, held_out, lang_pred, score, ambiguous``."""
    model = train(docs.filter(~held_out()).select("doc_id", "text", "lang"))
    return predict(docs.select("doc_id", "text", held_out().alias("held_out")), model, ["doc_id", "held_out"])


def filter_documents(docs: DataFrame) -> DataFrame:
    """The documents whose text has a language, with all their columns.

    Rejected: texts without a letter and those between two codewords.
    """
    model = train(docs.filter(~held_out()).select("doc_id", "text", "lang"))
    plain = docs.toDF(*[f"c{k}" for k in range(len(docs.columns))])
    found = predict(plain, model, plain.columns, f"c{docs.columns.index('text')}")
    kept = found.filter((F.col("lang_pred") != UNKNOWN) & ~F.col("ambiguous"))
    return kept.select(*[F.col(a).alias(b) for a, b in zip(plain.columns, docs.columns, strict=True)])
