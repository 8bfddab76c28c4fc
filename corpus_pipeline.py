"""A training corpus from documents: five stages, each over all that the one before kept.

Every stage takes (spark, docs, sf_dir) and returns documents with all their columns; the last returns token
ids. ``run`` writes each result as Parquet into the shared work folder and reads it again.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from clickloom.llm import bpe, decontaminate, langid, neardup, pii
from clickloom.llm.sift import without
from clickloom.llm.texts import free_name
from clickloom.session import materialise, work_path


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learns from the documents with a language, rejects those without a letter or in no learned language, and
    names the language where it is null. A document with a letter and a language is in a learned one and stays;
    one without a language stays unless its n-grams are enough to tell that it is in no learned language."""
    filters = langid.train(docs.select("text", "lang"))
    lang, score, foreign = (free_name(docs, x) for x in ("told_lang", "told_score", "told_foreign"))
    told = langid.identify(docs, filters, lang_pred=lang, score=score, foreign=foreign)
    kept = told.where((F.col(lang) != langid.UNKNOWN) & (F.col("lang").isNotNull() | ~F.col(foreign)))
    return kept.withColumn("lang", F.coalesce("lang", lang)).drop(lang, score, foreign)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates stays."""
    return neardup.keep_one(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go. Rows are judged by their id and text, so that one with the id of
    another, or without an id, goes for its own text alone."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    row = free_name(docs, "row_key")
    named = F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))
    keyed = docs.withColumn(row, F.md5(F.concat(named, F.lit(":"), F.coalesce("text", F.lit("")))))
    held = decontaminate.find_items(keyed.select(F.col(row).alias("doc_id"), "text"), items)
    return without(keyed, row, materialise(held.select("doc_id").distinct())).drop(row)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data gives way to the name of its kind; ``n_chars`` follows."""
    spans = free_name(docs, "spans")
    redacted = pii.find_and_redact(docs, pii.train(docs.select("text")), spans=spans)
    return redacted.drop(spans).withColumn("n_chars", F.length("text").cast("long"))


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and whether decoding them gives its bytes back."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    coded = bpe.encode_and_decode(docs, path, public_tokenizers.PATTERN, ids="ids", decoded="decoded", keep=False)
    whole = F.col("decoded") == F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    return coded.select("doc_id", "lang", "source", "n_chars", F.size("ids").cast("long").alias("n_tokens"), "ids", whole.alias("round_trip"))


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("language_id", identify_language),
    ("near_dedup", drop_near_duplicates),
    ("decontaminate", drop_benchmark),
    ("personal_data", redact_personal_data),
    ("bpe", tokenise),
]

# Minimum hashes, trained fields and merges have no SQL form.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = work_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
