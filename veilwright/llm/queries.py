"""Queries p3, p8, p9 and p10 over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import read_table
from . import leaks, pii, subjects, tokens


def _texts(spark: SparkSession, sf: str) -> DataFrame:
    docs = read_table(spark, sf, "documents").select(F.lit("documents").alias("source_table"), F.col("doc_id").alias("row_id"), "text")
    notes = read_table(spark, sf, "encounter_notes").select(F.lit("encounter_notes").alias("source_table"), F.col("nd_auto_increment_id").alias("row_id"), F.col("content").alias("text"))
    return docs.unionByName(notes)


def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    """Every piece of personal data in documents and notes."""
    return pii.find_personal_data(_texts(spark, sf), pii.lexicon_words(read_table(spark, sf, "pii_data_table")))


def p3_masked(spark: SparkSession, sf: str) -> DataFrame:
    """Documents and notes with typed placeholders; the key is a parameter of the operator."""
    return pii.mask_personal_data(_texts(spark, sf), pii.lexicon_words(read_table(spark, sf, "pii_data_table")), b"example key")


def p3_masked_dates(spark: SparkSession, sf: str) -> DataFrame:
    """The same with dates masked too."""
    return pii.mask_personal_data(_texts(spark, sf), pii.lexicon_words(read_table(spark, sf, "pii_data_table")), b"example key", dates=True)


def p8_ids(spark: SparkSession, sf: str) -> DataFrame:
    """Token ids of every document."""
    return tokens.encode_corpus(read_table(spark, sf, "documents"))


def p8_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Documents whose decoded ids give their text back, by language."""
    docs = read_table(spark, sf, "documents")
    back = tokens.decode_corpus(tokens.encode_corpus(docs)).withColumnRenamed("text", "decoded")
    same = F.coalesce("text", F.lit("")) == F.col("decoded")
    return docs.join(back, "doc_id").groupBy(F.coalesce(F.substring(F.lower(F.trim("lang")), 1, 2), F.lit("")).alias("lang")).agg(F.count("*").alias("n_docs"), F.count_if(same).alias("n_same"))


def p9_found(spark: SparkSession, sf: str) -> DataFrame:
    """Documents that hold a passage of an evaluation item."""
    return leaks.find_leaks(read_table(spark, sf, "documents"), read_table(spark, sf, "eval_items"))


def p10_found(spark: SparkSession, sf: str) -> DataFrame:
    """Subject areas of every document."""
    return subjects.assign_subjects(*(read_table(spark, sf, t) for t in ("documents", "subject_labels", "subject_areas")))


QUERIES = {f.__name__: f for f in (p3_found, p3_masked, p3_masked_dates, p8_ids, p8_roundtrip, p9_found, p10_found)}

ORACLES = {
    "p8_roundtrip": """
select coalesce(substr(lower(trim(lang)), 1, 2), '') as lang, count(*) as n_docs, count(*) as n_same from documents group by 1""",
}
