"""A corpus through five training-data operators, each stage written and reread.

This script belongs to the training-data operators: it imports them, and goes where
their folder goes. Every stage but the last returns the columns of ``documents``,
whatever others there are beside the ones it reads. Cases that all stages share: an
empty table gives an empty one; a row is what it is by its own text, whether its id is
null or another row's too; texts are whole, however long.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from corpusflow.llm import bpe, common, decontam, langid, quality_rules, simhash


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text has a language.

    A null text, one without a letter, and one between two languages are rejected.
    Without labelled rows no language is known and all are.
    """
    return langid.filter_documents(docs)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and their host's record keep.

    A null or blank text fails; a document without host is judged by the base rules
    alone; repeated rows count each.
    """
    return quality_rules.filter_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar ones.

    Five-word shingles, a Jaccard similarity of 0.8 and chains of such pairs. The least
    id stays (null comes first); of repeated rows one stays; texts without words are
    one group.
    """
    return simhash.deduplicate(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark items.

    Null, blank and very short items match nothing; an empty benchmark keeps all.
    """
    return decontam.filter_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per document: ``doc_id, n_tokens, ids_sha256, decoded_sha256``.

    A null text has no ids and decodes to no bytes; repeated rows give a row each.
    """
    return bpe.digests(docs)


STAGES = [("language_id", language_id), ("quality_rules", quality), ("simhash", near_duplicates), ("decontamination", decontamination), ("byte_bpe", byte_bpe)]
#: Learned language codes and fingerprints are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each over what its predecessor kept."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        # written and reread; what the stage wrote on its way is deleted
        docs = common.settled(spark, name, lambda stage=stage, own=docs: stage(spark, own, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
