"""Glossary hits: an n-gram dictionary join, for a glossary and documents of any size."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow.operators.joins import bloom, known_keys, perhaps
from corpusflow.operators.select import top_n
from corpusflow.storage import checkpointed, spread, stored

MAX_WORDS, MAX_HITS = 4, 8
#: For each hit that is asked for: words in which texts are searched first, windows and distinct windows that are kept of those; each time, so many times as many.
LEAD, KEPT, DISTINCT, WIDER = 2.5, 2.25, 1.25, 8
_WORD = r"A-Za-z0-9\-"


def _bare(c: Column) -> Column:
    return F.btrim(c, F.lit(".-"))


def _words(text: Column) -> Column:
    """What stands between other characters than letters, digits and hyphens; '' before the first or after the last.

    Taking words out is some four times as fast as a split at what they are not.
    """
    c = F.coalesce(text, F.lit(""))
    edge = lambda at: F.when(F.substring(c, at, 1).rlike(f"^[^{_WORD}]"), F.array(F.lit(""))).otherwise(F.array().cast("array<string>"))
    return F.concat(edge(1), F.regexp_extract_all(c, F.lit(f"[{_WORD}]+"), F.lit(0)), edge(-1))


def _bit(n: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), n)


def _blooms(terms: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Filters of the terms' first words, with the numbers of words of their terms, and of the terms."""
    n_words = F.size(F.split("term", " "))
    heads = terms.filter(n_words <= MAX_WORDS).select(_bare(F.substring_index("term", " ", 1)).alias("head"), _bit(n_words).alias("sizes"))
    return bloom(heads.distinct()), bloom(terms.select("term"))


def _lead(text: Column, words: int) -> Column:
    """The first ``words`` words of a text and what stands between and after them."""
    return F.regexp_extract(text, f"^(?:[^{_WORD}]*+[{_WORD}]++){{0,{words}}}+[^{_WORD}]*+", 0)


def windows(docs: DataFrame, blooms: tuple[DataFrame, DataFrame], id_col: str, text: str, lead: tuple[int, int, int] | None = None, only: DataFrame | None = None) -> DataFrame:
    """``id, term, place, cut``: windows of 1 to 4 words that may be terms, once a document, at their first place.

    A word takes the three after it along and nothing else. Two Bloom filters go to
    where the documents lie; only what passes both is shuffled. With ``lead``, numbers of
    words, windows and distinct windows, only windows are searched that begin in so many
    first words, and of those no more are kept; where there may be more, the last one
    is marked ``cut``. ``only``: a Bloom filter of ids.
    """
    heads, known = blooms
    own = spread(docs.select(id_col, text))
    own = own if only is None else perhaps(own, F.col(id_col), only)
    own = own.select(id_col, _words(_lead(F.col(text), lead[0] + MAX_WORDS) if lead else F.col(text)).alias("w"))
    names = [f"w{n}" for n in range(MAX_WORDS)]
    starts = F.least(F.size("w"), F.lit(lead[0])) if lead else F.size("w")
    own = own.select(id_col, *[F.slice("w", F.lit(n + 1), starts).alias(name) for n, name in enumerate(names)])
    at = own.select(id_col, F.posexplode(F.arrays_zip(*names)).alias("i", "g")).select(id_col, "i", "g.*")
    at = perhaps(at, _bare(F.lower(names[0])), heads)
    wanted = lambda n: F.col(names[n - 1]).isNotNull() & (F.col("sizes").bitwiseAND(_bit(F.lit(n))) != 0)
    gram = lambda n: _bare(F.lower(F.concat_ws(" ", *names[:n])))
    found = F.array(*[F.when(wanted(n), F.struct((F.col("i").cast("long") * 10 + n).alias("place"), gram(n).alias("term"))) for n in range(1, MAX_WORDS + 1)])
    grams = at.select(id_col, F.explode(found).alias("x")).select(id_col, "x.place", "x.term").filter("term <> ''")
    grams = perhaps(grams, F.col("term"), known)
    if not lead:
        return grams.groupBy(id_col, "term").agg(F.min("place").alias("place")).withColumn("cut", F.lit(False))
    # at first a document's windows are cut where it lies, and are dealt out once; later, repeats are many
    few = top_n(grams, [id_col], ["place"], lead[1]) if only is None else grams.withColumn("rank", F.lit(0))
    first = few.groupBy(id_col, "term").agg(F.min("place").alias("place"), F.max("rank").alias("last_"))
    first = top_n(first, [id_col], ["place"], lead[2])
    return first.select(id_col, "term", "place", ((F.col("last_") == lead[1]) | (F.col("rank") == lead[2])).alias("cut"))


def hits(docs: DataFrame, terms: DataFrame, id_col: str = "doc_id", text: str = "text", max_hits: int = MAX_HITS) -> DataFrame:
    """``id, rank, term`` (and the glossary's columns): distinct terms of windows of
    1 to 4 words, in order of first place and length, at most ``max_hits``.

    ``terms`` has a unique lower-case ``term``; its other columns join the hits that are left.

    Texts are searched from the beginning, as far as it takes: those that have ``max_hits``
    in their first words are done, and only the others are searched further, or as a
    whole where hardly any is done (a glossary of rare terms). What is later than the
    last hit is no row of any table.
    """
    terms = checkpointed(terms)
    names = terms.select("term")
    blooms = tuple(checkpointed(b) for b in _blooms(names))
    lead: tuple[int, int, int] | None = tuple(int(n * max_hits) + 1 for n in (LEAD, KEPT, DISTINCT))
    parts, todo, only = [], None, None
    same = F.col(id_col).eqNullSafe(F.col("left_"))
    while True:
        found = stored(windows(docs, blooms, id_col, text, lead, only), "windows")
        first = stored(top_n(known_keys(found.drop("cut"), names, "term"), [id_col], ["place"], max_hits), "hits").drop("place")
        own = first if todo is None else first.join(todo, same, "left_semi")  # the filter lets others through
        if lead is None:
            parts.append(own)
            break
        # more words than were searched have as many signs and more; or some windows were cut
        more = (docs if only is None else perhaps(docs.select(id_col, text), F.col(id_col), only)).filter(F.length(text) >= 2 * lead[0] - 1)
        more = more.select(F.col(id_col).alias("left_")).unionByName(found.filter("cut").select(F.col(id_col).alias("left_"))).distinct()
        done = first.filter(F.col("rank") == max_hits).select(id_col)
        more = more.join(done, same, "left_anti")
        todo = stored(more if todo is None else more.join(todo.withColumnRenamed("left_", "of_"), F.col("left_").eqNullSafe(F.col("of_")), "left_semi"), "left")
        n_left = todo.count()
        parts.append(own.join(todo, same, "left_anti") if n_left else own)
        if not n_left:
            break
        only = checkpointed(bloom(todo))
        lead = tuple(WIDER * n for n in lead) if 8 * done.count() > n_left else None
    first = reduce(DataFrame.unionByName, parts)
    return first.join(terms, "term").select(id_col, "term", *[c for c in terms.columns if c != "term"], "rank") if len(terms.columns) > 1 else first.select(id_col, "term", "rank")
