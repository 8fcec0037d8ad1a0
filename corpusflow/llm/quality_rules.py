"""Host-level quality rules (operator 1). DataFrame functions only.

Base rules count, for each document, words, their characters, symbols, repeated
lines and repeated three-word windows. A document fails with fewer than
``min_words`` words or more than ``max_repeat_percent`` of its words in repeated
windows. Failures are then summed by host; each host's rate is shrunk towards a
beta prior fitted to all hosts by the beta-binomial's moments (of the spread of the
rates, what small numbers of documents explain is taken off), and a host whose shrunk rate exceeds
``max_host_rate`` loses all its documents.

The counts of a document need no shuffle: they are array expressions over its
own words. Only one narrow row a document is written, summed by host (with
partial sums, so a host that holds a third of all rows is one row from each
task) and joined back.

Cases: a null or blank text has zero counts and fails; a document without host
(null) is judged by the base rules alone; hosts all alike give a prior without
spread, which keeps the shrunk rate at the mean; repeated rows count each; an
empty table gives an empty result; further columns are ignored by ``judge`` and
kept by ``filter_documents``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow.llm import common as C
from corpusflow.storage import spread

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MAX_HOST_RATE = 0.5
#: Weight of the prior, in documents: within these bounds.
PRIOR_WEIGHT = (1.0, 1e6)
SYMBOLS = "[#*$%&|<>]"


def features(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns with the base counts of each whole text."""
    keep = docs.columns if keep is None else keep
    t, w, n = (C.fresh(docs, x) for x in ("text_", "words_", "n_"))
    d = spread(docs.select(*[F.col(f"`{c}`") for c in keep], F.coalesce(F.col(f"`{text}`"), F.lit("")).alias(t)))
    d = d.withColumn(w, C.words_col(F.col(t)))
    d = d.withColumn(n, F.size(w))
    # Windows by hash, each with its position in the low bits, sorted: equal
    # windows lie side by side. Neighbours are then compared word by word.
    b, s, g = (C.fresh(docs, x) for x in ("bits_", "sorted_", "grams_"))
    word = lambda i: F.get(F.col(w), i)
    d = d.withColumn(b, F.length(F.bin(F.col(n).cast("long"))))
    many = F.col(n) >= 4
    none = F.array().cast("array<bigint>")
    d = d.withColumn(g, F.when(many, F.transform(F.sequence(F.lit(0), F.col(n) - 3), lambda i: F.xxhash64(word(i), word(i + 1), word(i + 2)))).otherwise(none))
    at = lambda x: x.bitwiseAND(F.expr(f"shiftleft(1L, `{b}`) - 1")).cast("int")
    shifted = F.transform(F.col(g), lambda h, i: F.call_function("shiftleft", h, F.col(b)).bitwiseOR(i.cast("long")))
    d = d.withColumn(s, F.sort_array(shifted))
    item = lambda k: F.get(F.col(s), k)
    high = lambda x: F.call_function("shiftrightunsigned", x, F.col(b))

    def same(k: Column) -> Column:
        p, q = at(item(k)), at(item(k + 1))
        return (high(item(k)) == high(item(k + 1))) & (word(p) == word(q)) & (word(p + 1) == word(q + 1)) & (word(p + 2) == word(q + 2))

    def covered(k: Column) -> Column:
        p, q = at(item(k)), at(item(k + 1))
        return F.array(p, p + 1, p + 2, q, q + 1, q + 2)

    pairs = F.filter(F.sequence(F.lit(0), F.col(n) - 4), same)
    repeated = F.when(many, F.size(F.array_distinct(F.flatten(F.transform(pairs, covered))))).otherwise(0)
    lines = F.filter(F.split(F.col(t), "\n"), lambda x: F.length(F.btrim(x, F.lit(C.WS))) > 0)
    l = C.fresh(docs, "lines_")
    d = d.withColumn(l, lines)
    return d.select(
        *[F.col(f"`{c}`") for c in keep],
        F.col(n).cast("long").alias("n_words"),
        F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
        (F.length(t) - F.length(F.regexp_replace(F.col(t), SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size(l) - F.size(F.array_distinct(l))).cast("long").alias("n_dup_lines"),
        repeated.cast("long").alias("n_repeat_words"),
    )


def host_verdicts(judged: DataFrame, host: str = "source", max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """``host, n_docs, n_failed, host_rate, host_rejected`` from ``base_failed`` rows."""
    own = judged.filter(F.col(host).isNotNull())
    hosts = own.groupBy(host).agg(F.count(F.lit(1)).alias("n_docs"), F.sum(F.col("base_failed").cast("long")).alias("n_failed"))
    rate = F.col("n_failed") / F.col("n_docs")
    # mean and spread of the rates, and the share of the spread that is due to few documents
    prior = hosts.agg(F.avg(rate).alias("m"), F.var_pop(rate).alias("v"), F.avg(1 / F.col("n_docs")).alias("h")).first()
    m, v, h = prior["m"] or 0.0, prior["v"] or 0.0, prior["h"] or 1.0
    between = (v / (m * (1 - m)) - h) / (1 - h) if 0 < m < 1 and h < 1 else 0.0  # intraclass correlation
    weight = min(max(1 / between - 1, PRIOR_WEIGHT[0]), PRIOR_WEIGHT[1]) if between > 0 else PRIOR_WEIGHT[1]
    shrunk = (F.col("n_failed") + F.lit(weight * m)) / (F.col("n_docs") + F.lit(weight))
    return hosts.select(host, "n_docs", "n_failed", shrunk.alias("host_rate"), (shrunk > max_rate).alias("host_rejected"))


def judge(docs: DataFrame, id_col: str = "doc_id", host: str = "source", text: str = "text") -> DataFrame:
    """Per document: its id, the base counts, ``base_failed`` and ``kept``."""
    own = docs.select(F.col(id_col).alias("doc_id"), F.col(host).alias("source"), F.col(text).alias("text"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    base = C.materialise(features(own, "text", ["doc_id", "source"]).withColumn("base_failed", failed), "quality")
    verdicts = C.materialise(host_verdicts(base).select("source", "n_docs", "host_rejected"), "hosts")
    with_host = base.filter(F.col("source").isNotNull())
    # a hot host's rows stay where they are
    both = C.join_groups(with_host, verdicts, "source", "n_docs", verdicts.agg(F.sum("n_docs").alias("n")).first()["n"] or 0)
    both = both.unionByName(base.filter(F.col("source").isNull()).withColumn("host_rejected", F.lit(False)))
    kept = ~F.col("base_failed") & ~F.coalesce("host_rejected", F.lit(False))
    return both.select(F.col("doc_id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", kept.alias("kept"))


def filter_documents(docs: DataFrame) -> DataFrame:
    """The documents that ``judge`` keeps, with all their columns.

    The verdict on hosts is a small table; the base rules are evaluated where
    the documents are, so that no text is shuffled.
    """
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row_"), F.col("source").alias("source"), F.col("text").alias("text"))
    base = C.materialise(features(packed, "text", ["row_", "source"]).withColumn("base_failed", failed).select("row_", "source", "base_failed"), "quality")
    verdicts = C.broadcast_if_small(host_verdicts(base).filter("host_rejected").select(F.col("source").alias("host_")))
    return base.filter(~F.col("base_failed")).join(verdicts, F.col("source") == F.col("host_"), "left_anti").select("row_.*")


ORACLE = r"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, source, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words,
  list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
p AS (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM w WHERE len(words) >= 4),
g AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, words[i], words[i + 1], words[i + 2]) AS n FROM p),
r AS (SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS j FROM g WHERE n > 1) GROUP BY doc_id),
f AS (SELECT w.doc_id, source, CAST(len(words) AS BIGINT) AS n_words, CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
  CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
  CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words
  FROM w LEFT JOIN r USING (doc_id)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM f),
h AS (SELECT source, count(*) AS n, count(*) FILTER (base_failed) AS k FROM b WHERE source IS NOT NULL GROUP BY source),
m AS (SELECT avg(k / n) AS m, var_pop(k / n) AS v, avg(1.0 / n) AS few FROM h),
c AS (SELECT m, CASE WHEN m > 0 AND m < 1 AND few < 1 THEN (v / (m * (1 - m)) - few) / (1 - few) ELSE 0 END AS between_hosts FROM m),
q AS (SELECT source, (k + wt * m) / (n + wt) > 0.5 AS bad FROM h,
  (SELECT m, CASE WHEN between_hosts > 0 THEN greatest(1.0, least(1e6, 1 / between_hosts - 1)) ELSE 1e6 END AS wt FROM c))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT coalesce(bad, false) AS kept
FROM b LEFT JOIN q USING (source)
"""
