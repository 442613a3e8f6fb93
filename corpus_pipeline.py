"""Training-data pipeline: each stage calls one operator of ``bundleflow.llm``.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; its result is written as
Parquet and reread as the next stage's documents.  All stages but the last keep all columns
of the documents, extra ones included; the last returns the ids of tokens.

Defined results: null texts and texts without letters leave in the first stage; rows with null
ids stay as others do (one of each group of near copies, by the hash of its text); repeated rows
of equal id and text become one in the second stage; very long texts are read whole; an empty
table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bundleflow.llm import bpe, decontaminate, langid, neardup, pii
from bundleflow.llm.common import Scratch, prepare, table

# Probability from which the found language replaces a differing ``lang``.
SURE = 0.9
NEAR = neardup.Setting(percent=80, bands=32, rows=5, extra=160)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language of the training rows, with that language as their ``lang``.

    Null texts, texts without letters and texts whose n-grams are rarer than ``Model.foreign`` allows
    go; texts in two languages stay.  A missing ``lang`` becomes the found language, and so does one
    that the text contradicts with a probability of ``SURE``; the last stage returns it."""
    prepare(spark)
    model = langid.fit(docs, train=langid.train_rows())
    found = langid.identify(docs, model, lang_out="found language", score_out="found score", rarity_out="found rarity")
    wrong = F.col("lang").isNull() | (F.col("found score") >= SURE)
    return (found.filter((F.col("found language") != langid.UNKNOWN) & (F.col("found rarity") <= model.foreign))
            .withColumn("lang", F.when(wrong, F.col("found language")).otherwise(F.col("lang")))
            .drop("found language", "found score", "found rarity"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (the one of the least id)."""
    prepare(spark)
    return neardup.drop_near_duplicates(docs, setting=NEAR)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of a benchmark item."""
    return decontaminate.drop_leaks(docs, table(prepare(spark), sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data in their texts replaced by its kind."""
    prepare(spark)
    return pii.redact(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as token ids; ``exact`` says that they decode to its text."""
    prepare(spark)
    rows = bpe.decode(bpe.encode(docs.select("doc_id", "lang", "source", "text")))
    return rows.select("doc_id", "lang", "source",
                       F.expr("octet_length(token_ids) div 4").alias("n_tokens"),
                       (F.col("decoded") == F.encode(F.coalesce("text", F.lit("")), "UTF-8")).alias("exact"),
                       "token_ids")


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("tokens", tokens),
]
# Stages 5, 8 and 4 learn or hash in ways SQL cannot express; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to ``documents``."""
    prepare(spark)
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = scratch.write(stage(spark, docs, sf_dir), name)
    return docs
