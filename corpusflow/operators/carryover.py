"""Carry earlier enrichment forward when a document changes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow.functions import text as T


def common_prefix(a: Column, b: Column) -> Column:
    """Length of the longest common prefix of two arrays."""
    same = F.zip_with(a, b, lambda x, y: F.coalesce(x == y, F.lit(False)))
    return F.coalesce(F.nullif(F.array_position(same, F.lit(False)), F.lit(0)) - 1, F.least(F.size(a), F.size(b)).cast("long"))


def slots_state(paras: Column) -> tuple[Column, Column]:
    """Number of non-blank slots, and ``ok`` if there are slots and all are, else ``failed``."""
    done = F.size(F.filter(paras, lambda x: F.coalesce(T.strip(x) != "", F.lit(False))))
    return done, F.when((F.size(paras) > 0) & (done == F.size(paras)), "ok").otherwise("failed")


def fill_slots(old: Column, new: Column) -> Column:
    """Old non-blank slots stay, blank ones take the new value."""
    return F.zip_with(old, new, lambda a, b: F.coalesce(F.when(T.strip(a) != "", a), b, F.lit("")))


def prefix_hashes(paras: Column) -> Column:
    """For each paragraph a hash of it and all before it: two texts agree up to a paragraph where these do."""
    start = F.struct(F.lit(0).cast("long").alias("h"), F.array().cast("array<bigint>").alias("all"))

    def step(acc: Column, p: Column) -> Column:
        h = F.xxhash64(acc["h"], p)
        return F.struct(h.alias("h"), F.concat(acc["all"], F.array(h)).alias("all"))

    return F.aggregate(paras, start, step, lambda acc: acc["all"])


def carry(items: DataFrame, previous: DataFrame, separator: str = r"\n{2,}") -> DataFrame:
    """``items(url, body)`` with ``previous(url, ord, body, title_out, summary_out, paras_out, state)``.

    Titles and summaries carry on any match of the url, and so do ``locked`` and
    ``title_trans`` where ``previous`` has them; translated paragraphs for
    the common prefix of both bodies' paragraphs; a state of ``ok`` without
    paragraphs only if the body is unchanged. The last of repeated urls wins by
    ``ord``. ``carried``: whether the url was known; ``n_carried``: its paragraphs.

    Bodies stay where they are: what meets on the url are a hash for each paragraph's
    prefix and counts. Then what is carried goes to the items, by url and digest of the body.
    """
    flags = [c for c in ("locked", "title_trans") if c in previous.columns]
    norm = F.transform(T.paragraphs(F.col("body"), separator), T.collapse)
    # never null, and told so: else joins would first compute it in a filter, with the whole body inside
    digest = F.coalesce(F.sha2(F.coalesce("body", F.lit("")), 256), F.lit(""))
    done_old = F.size(F.coalesce("paras_out", F.array().cast("array<string>")))
    narrow = previous.select("url", F.struct(prefix_hashes(norm).alias("hashes"), digest.alias("digest"), done_old.alias("n_out"), "state").alias("old"), "ord")
    narrow = narrow.groupBy("url").agg(F.max_by("old", "ord").alias("old"))
    own = items.withColumn("digest_", digest).withColumn("hashes_", prefix_hashes(norm))
    new = own.select("url", "digest_", "hashes_").distinct()
    plan = new.join(narrow, "url").withColumn("n_new", F.size("hashes_")).withColumn("prefix", F.when(F.col("old.n_out") > 0, common_prefix(F.col("old.hashes"), F.col("hashes_"))))
    whole = (F.col("prefix") == F.size("old.hashes")) & (F.size("old.hashes") == F.col("n_new")) & (F.col("prefix") > 0)
    k = F.when(whole, F.col("old.n_out").cast("long")).otherwise(F.least("prefix", F.col("old.n_out").cast("long")))
    same = (F.col("old.state") == "ok") & (F.col("old.digest") == F.col("digest_")) & (F.col("old.n_out") == 0)
    plan = plan.select("url", "digest_", "n_new", F.coalesce(k, F.lit(0)).cast("int").alias("k"), F.coalesce(same, F.lit(False)).alias("same"))
    told = previous.groupBy("url").agg(F.max_by(F.struct("title_out", "summary_out", "paras_out", *flags), "ord").alias("told"))
    told = plan.join(told, "url").select("url", "digest_", "n_new", "k", "same", "told.title_out", "told.summary_out", F.slice("told.paras_out", F.lit(1), F.col("k")).alias("kept"), *[f"told.{c}" for c in flags])
    clash = [c for c in told.columns if c in items.columns and c not in ("url", "digest_")]
    both = own.drop("hashes_", *clash).join(told, ["url", "digest_"], "left")
    pad = F.array_repeat(F.lit(""), F.greatest(F.col("n_new") - F.col("k"), F.lit(0)))
    both = both.withColumn("paras_out", F.when(F.col("k") > 0, F.concat("kept", pad)))
    done, _ = slots_state(F.col("paras_out"))
    state = F.when(F.col("paras_out").isNotNull(), F.when((F.col("n_new") > 0) & (done == F.col("n_new")), "ok").otherwise("failed")).when(F.col("same"), "ok")
    return both.select(
        *[c for c in items.columns if c not in clash],
        "title_out",
        "summary_out",
        *flags,
        "paras_out",
        F.array_join("paras_out", "\n\n").alias("full_out"),
        F.when(F.col("paras_out").isNotNull(), done).alias("n_done"),
        F.when(F.col("paras_out").isNotNull(), F.col("n_new")).alias("n_paras"),
        state.alias("state"),
        F.col("k").isNotNull().alias("carried"),
        F.coalesce("k", F.lit(0)).alias("n_carried"),
    )
