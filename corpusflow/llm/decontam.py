"""Benchmark decontamination by templates (operator 7). DataFrame functions only.

Texts become template tokens: numbers, names (capitalised words inside a
sentence) and units turn into typed placeholders, all else is lower-cased words.
Windows of ``WINDOW`` template tokens of documents and benchmark items meet in a
hash join. Where they meet, the values behind the placeholders are compared:
within one alignment of a document with an item, a value of the item must stand
for one value of the document throughout, as in a question with new parameters;
a chance likeness of templates gives contradictory values, and windows that hold
such a value do not count unless their values are the item's own. A
document is contaminated by an item that it covers to at least ``MIN_COVER`` of
its windows, or of which it holds a passage of ``MIN_RUN`` tokens in a row,
however long the item is.

The first pass hashes each document's windows in place and sends only those that
the benchmark has; the benchmark's windows are broadcast behind a count and
joined by shuffle beyond it. Only documents with hits are read again.

An item without a window (fewer than ``MIN_TOKENS`` tokens, or numbers and names with
too few words) is matched as it stands, from ``MIN_EXACT`` tokens on: where a document holds
its whole run of tokens, values and all, in any case.

Cases: null or blank texts have no windows; items of fewer than ``WINDOW`` but at
least ``MIN_TOKENS`` tokens are one window of their own length; items of fewer than
``MIN_EXACT`` match nothing; repeated items and rows count each for themselves; an empty
benchmark or table gives no contamination; rows are told apart by doc_id and text, so a
null or repeated doc_id is judged as the row it is; further columns are ignored by ``judge`` and kept by ``filter_documents``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow.llm import common as C
from corpusflow.storage import spread

WINDOW = 8
MIN_TOKENS = 5
#: Tokens from which on an item without windows is looked for as it stands.
MIN_EXACT = 4
MIN_COVER = 0.25
#: Tokens of windows that touch, within one alignment.
MIN_RUN = 13
#: Ordinary words that a window must hold: placeholders alone prove nothing.
MIN_WORDS = 3
#: Words that count as units after a number. Fixed values.
UNITS = "mm cm m km in ft yd mi mg g kg t lb oz ml l gal s sec min h hr hours days weeks years kmh mph hz khz mhz ghz kb mb gb tb w kw mw v a k c f usd eur gbp dollars euros percent"


#: Private characters: what a token is, and the point inside a number.
NAME, NUMBER, UNIT, POINT = "\U000f0000", "\U000f0001", "\U000f0002", "\U000f0003"
_MARKS = r"\x{F0000}-\x{F0003}"


def _prepared(df: DataFrame, id_col: str, text: str) -> DataFrame:
    """``id, raw, tpl``: tokens with their values and template tokens, one to one.

    Patterns begin with what is rare in a text, so that a pass over it is cheap.
    """
    t = F.translate(F.coalesce(F.col(text), F.lit("")), NAME + NUMBER + UNIT + POINT, "")
    t = F.regexp_replace(t, r"(\d)[.,](?=\d)", "$1" + POINT)
    t = F.regexp_replace(t, r"(\p{Lu})(?<=[\p{L}\p{N},;] \p{Lu})(\p{Ll}+)(?![\p{L}\p{N}])", NAME + "$1$2")
    t = F.regexp_replace(t, r"(\d)(?<![\p{L}\p{N}]\d)([\d\x{F0003}]*)(?![\p{L}\p{N}])", NUMBER + "$1$2")
    t = F.regexp_replace(t, r"(\x{F0001}[\d\x{F0003}]+) ?((?i)" + "|".join(UNITS.split()) + r")(?![\p{L}\p{N}])", "$1 " + UNIT + "$2")
    own = df.select(F.col(id_col).alias("id"), F.btrim(F.regexp_replace(t, rf"[^\p{{L}}\p{{N}}{_MARKS}]+", " ")).alias("m"))
    kinds = F.lower(F.regexp_replace("m", r"([\x{F0000}-\x{F0002}])[^ ]+", "$1"))
    split = lambda c: F.when(F.length("m") == 0, F.array().cast("array<string>")).otherwise(F.split(c, " "))
    return own.select("id", split(F.col("m")).alias("raw"), split(kinds).alias("tpl"))


def _numbered(items: DataFrame, id_col: str = "item_id", text: str = "text") -> DataFrame:
    """Prepared items; equal ones are told apart by a row number of their own."""
    return _prepared(items, id_col, text).withColumn("n", F.size("tpl")).withColumn("item", F.monotonically_increasing_id())


def benchmark_windows(own: DataFrame) -> DataFrame:
    """``item, at, w, h, n_windows, raw, tpl`` of ``_numbered`` items: windows of ``w`` tokens at ``at``."""
    own = own.filter(F.col("n") >= MIN_TOKENS).withColumn("w", F.least(F.col("n"), F.lit(WINDOW)))
    own = own.withColumn("n_windows", F.col("n") - F.col("w") + 1)
    rows = own.select("item", "id", "w", "n_windows", "tpl", "raw", F.explode(F.sequence(F.lit(0), F.col("n_windows") - 1)).alias("at"))
    rows = rows.withColumn("tpl", F.slice("tpl", F.col("at") + 1, F.col("w"))).withColumn("raw", F.slice("raw", F.col("at") + 1, F.col("w")))
    plain = F.size(F.filter("tpl", lambda x: ~x.isin(NAME, NUMBER, UNIT)))
    return rows.filter(plain >= F.least(F.lit(MIN_WORDS), F.col("w"))).withColumn("h", F.xxhash64("tpl"))


def _sum(text: Column) -> Column:
    """What tells rows of one id apart."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def _bare() -> Column:
    """Tokens without marks, in lower case."""
    return F.transform("raw", lambda x: F.lower(F.regexp_replace(x, f"[{_MARKS}]", "")))


def _as_they_stand(docs: DataFrame, exact: DataFrame) -> DataFrame:
    """Documents that hold a whole item of ``exact(item, item_id, run)``, as ``matches`` has them."""
    head = lambda run: F.xxhash64(F.slice(run, 1, MIN_EXACT))
    known = C.broadcast_if_small(exact.select(head(F.col("run")).alias("h")).distinct())
    own = _prepared(docs, "id", "text").select("id", _bare().alias("run"))
    starts = F.sequence(F.lit(0), F.size("run") - MIN_EXACT)
    at = own.filter(F.size("run") >= MIN_EXACT).select("id", F.explode(F.transform(starts, lambda i: F.struct(i.alias("pos"), F.xxhash64(F.slice(F.col("run"), i + 1, MIN_EXACT)).alias("h")))).alias("g"))
    hits = C.materialise(at.select("id", "g.pos", "g.h").join(known, "h", "left_semi"), "heads")
    ids = C.broadcast_if_small(hits.select("id").distinct())
    again = _prepared(docs.join(ids, "id", "left_semi").dropDuplicates(["id"]), "id", "text").select("id", _bare().alias("whole"))
    items = C.broadcast_if_small(exact.withColumn("h", head(F.col("run"))))
    # a place is a place of few items: those that begin alike
    met = hits.join(items, "h").join(again, "id").filter(F.slice("whole", F.col("pos") + 1, F.size("run")) == F.col("run"))
    return met.select("id.id", "id.sum", "item_id", F.lit(1).cast("long").alias("n_matched"), F.lit(1.0).alias("cover"), F.size("run").alias("longest"), "item").distinct().drop("item")


def matches(docs: DataFrame, items: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Contaminated documents by item: ``id, sum, item_id, n_matched, cover, longest``."""
    # a struct is never null itself, so rows with a null id meet in joins
    docs = spread(docs.select(F.struct(F.col(id_col).alias("id"), _sum(F.col("text")).alias("sum")).alias("id"), "text"))
    numbered = C.materialise(_numbered(items), "items")
    windows = C.materialise(benchmark_windows(numbered), "benchmark")
    exact = numbered.filter(F.col("n") >= MIN_EXACT).join(windows.select("item").distinct(), "item", "left_anti").select("item", F.col("id").alias("item_id"), _bare().alias("run"))
    found = _by_windows(docs, windows)
    return found if exact.isEmpty() else found.unionByName(_as_they_stand(docs, C.materialise(exact, "exact")))


def _by_windows(docs: DataFrame, windows: DataFrame) -> DataFrame:
    # a window in which the item has fewer left to cover counts against what it has
    total = windows.groupBy("item").agg(F.count(F.lit(1)).alias("total"))
    lengths = sorted(r["w"] for r in windows.select("w").distinct().collect())  # at most WINDOW values
    if not lengths:
        return docs.limit(0).select("id.id", "id.sum", F.lit(None).cast(windows.schema["id"].dataType).alias("item_id"), F.lit(0).cast("long").alias("n_matched"), F.lit(0.0).alias("cover"), F.lit(0).alias("longest"))
    prepared = _prepared(docs, "id", "text").select("id", "tpl", F.size("tpl").alias("n"))

    def hashed(w: int) -> Column:
        spans = F.when(F.col("n") >= w, F.sequence(F.lit(0), F.col("n") - w)).otherwise(F.array().cast("array<int>"))
        return F.transform(spans, lambda i: F.struct(F.lit(w).alias("w"), i.alias("pos"), F.xxhash64(F.slice(F.col("tpl"), i + 1, w)).alias("h")))

    each = [hashed(w) for w in lengths]
    grams = prepared.select("id", F.explode(each[0] if len(each) == 1 else F.concat(*each)).alias("g")).select("id", "g.w", "g.pos", "g.h")
    known = C.broadcast_if_small(windows.select("h", "w").distinct())
    hits = C.materialise(grams.join(known, ["h", "w"]), "hits")
    # only documents with hits are read again, for the values behind placeholders
    ids = C.broadcast_if_small(hits.select("id").distinct())
    again = _prepared(docs.join(ids, "id", "left_semi").dropDuplicates(["id"]), "id", "text").select(F.col("id").alias("id2"), "raw", "tpl")
    found = hits.join(again, hits["id"] == again["id2"]).select("id", "h", "w", "pos", F.slice("raw", F.col("pos") + 1, F.col("w")).alias("d_raw"), F.slice("tpl", F.col("pos") + 1, F.col("w")).alias("d_tpl"))
    own = C.broadcast_if_small(windows.select("h", "w", "item", F.col("id").alias("item_id"), "at", "raw", "tpl"))
    met = found.join(own, ["h", "w"]).filter(F.col("d_tpl") == F.col("tpl"))
    # slots: what an item's value stands for, by alignment
    pairs = F.filter(F.arrays_zip("tpl", "raw", "d_raw"), lambda x: x["tpl"].isin(NAME, NUMBER, UNIT))
    slots = F.transform(pairs, lambda x: F.struct(F.concat_ws(" ", x["tpl"], x["raw"]).alias("of"), x["d_raw"].alias("to"), (x["raw"] == x["d_raw"]).alias("same")))
    met = C.materialise(met.select("id", "item", "item_id", "at", "w", (F.col("pos") - F.col("at")).alias("shift"), slots.alias("slots")), "met")
    each = met.select("id", "item", "shift", F.explode("slots").alias("s")).select("id", "item", "shift", "s.of", "s.to").distinct()
    clash = each.groupBy("id", "item", "shift", "of").agg(F.count(F.lit(1)).alias("k")).filter("k > 1").groupBy("id", "item", "shift").agg(F.collect_set("of").alias("clash"))
    kept = F.col("clash").isNull() | F.forall("slots", lambda x: x["same"]) | ~F.exists("slots", lambda x: F.array_contains(F.col("clash"), x["of"]))
    sound = met.join(clash, ["id", "item", "shift"], "left").filter(kept)
    # passages: windows of an alignment that overlap or touch
    spans = sound.groupBy("id", "item", "item_id", "shift", "w").agg(F.sort_array(F.collect_set("at")).alias("ats"))
    none = F.struct(F.lit(0).alias("start"), F.lit(-1).alias("end"), F.lit(0).alias("longest"))

    def step(acc: Column, at: Column) -> Column:
        start = F.when(at <= acc["end"], acc["start"]).otherwise(at)
        end = at + F.col("w")
        return F.struct(start.alias("start"), end.alias("end"), F.greatest(acc["longest"], end - start).alias("longest"))

    spans = spans.withColumn("longest", F.aggregate("ats", none, step)["longest"])
    cover = spans.groupBy("id", "item", "item_id").agg(F.size(F.array_distinct(F.flatten(F.collect_list("ats")))).cast("long").alias("n_matched"), F.max("longest").alias("longest"))
    joined = cover.join(C.broadcast_if_small(total), "item").withColumn("cover", F.col("n_matched") / F.col("total"))
    return joined.filter((F.col("cover") >= MIN_COVER) | (F.col("longest") >= MIN_RUN)).select("id.id", "id.sum", "item_id", "n_matched", "cover", "longest")


def _marked(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``docs`` with ``contaminated`` and the item that it covers most."""
    found = matches(docs.select("doc_id", "text"), items, "doc_id")
    worst = found.groupBy("id", "sum").agg(F.max_by("item_id", F.struct("cover", -F.col("item_id"))).alias("item_id"), F.max("cover").alias("cover"), F.count(F.lit(1)).alias("n_items"))
    worst = C.broadcast_if_small(C.materialise(worst, "contaminated"))
    return docs.join(worst, docs["doc_id"].eqNullSafe(worst["id"]) & (_sum(docs["text"]) == worst["sum"]), "left").withColumn("contaminated", F.col("n_items").isNotNull())


def judge(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Per document: ``doc_id, contaminated, item_id, cover, n_items``."""
    return _marked(docs.select("doc_id", "text"), items).select("doc_id", "contaminated", "item_id", F.coalesce("cover", F.lit(0.0)).alias("cover"), F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"))


def filter_documents(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents that no benchmark item contaminates, with all their columns."""
    found = C.materialise(matches(docs.select("doc_id", "text"), items, "doc_id").select("id", "sum").distinct(), "contaminated")
    bad = C.broadcast_if_small(found)
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad["id"]) & (_sum(docs["text"]) == bad["sum"]), "left_anti")
