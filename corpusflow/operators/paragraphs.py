"""Paragraph cleaning as window operations: no row loops, order kept by position."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusflow.functions import text as T


def explode(docs: DataFrame, id_col: str = "doc_id", body: str = "text", separator: str = r"\n{2,}") -> DataFrame:
    """``id, pos, para`` (collapsed, non-blank)."""
    paras = F.transform(T.paragraphs(F.col(body), separator), T.collapse)
    return docs.select(id_col, F.posexplode(paras).alias("pos", "para"))


def drop_junk(paras: DataFrame) -> DataFrame:
    return paras.filter((F.col("para") != "") & ~T.junk_paragraph(F.col("para")))


def drop_repeats(paras: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Without paragraphs equal to the previous kept one."""
    before = F.lag("para").over(Window.partitionBy(id_col).orderBy("pos"))
    return paras.withColumn("before", before).filter(~F.col("para").eqNullSafe(F.col("before"))).drop("before")


def merge_short(paras: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Sentences of at most two words join the next paragraph, left to right, in pairs.

    Inside a run of short sentences the odd ones open a pair and the even ones
    close it; a longer paragraph after an odd run closes the run's last pair.
    A running count of openings then names the merged paragraphs.
    """
    order = Window.partitionBy(id_col).orderBy("pos")
    own = paras.withColumn("short", T.short_sentence(F.col("para"))).withColumn("rn", F.row_number().over(order))
    own = own.withColumn("last_long", F.max(F.when(~F.col("short"), F.col("rn"))).over(order.rowsBetween(Window.unboundedPreceding, -1)))
    own = own.withColumn("run", F.col("rn") - F.coalesce("last_long", F.lit(0)))  # place in the run, or one past it
    opens = F.col("run") % 2 == 1
    own = own.withColumn("grp", F.sum(opens.cast("int")).over(order))
    merged = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "para"))), lambda x: x["para"]), " ")
    return own.groupBy(id_col, "grp").agg(F.min("pos").alias("pos"), merged.alias("para")).drop("grp")


def clean(docs: DataFrame, id_col: str = "doc_id", body: str = "text", separator: str = r"\n{2,}") -> DataFrame:
    """The whole cleaner: ``id, pos, para`` of what remains."""
    return merge_short(drop_repeats(drop_junk(explode(docs, id_col, body, separator)), id_col), id_col)


def reassemble(paras: DataFrame, id_col: str = "doc_id", joint: str = "\n\n", cap: int = T.BODY_CAP) -> DataFrame:
    """Paragraphs back to one body a document, cut at ``cap`` characters."""
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "para"))), lambda x: x["para"]), joint)
    return paras.groupBy(id_col).agg(F.count(F.lit(1)).alias("n_paras"), F.substring(body, 1, cap).alias("body"))
