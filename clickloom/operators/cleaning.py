"""Standard schemas for raw articles, logs and behaviour records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from clickloom.functions.ids import catalogue_article_id, live_article_id
from clickloom.functions.text import blank_to_null, joined_text, strip, text_or
from clickloom.schemas import CATALOGUE_SOURCE, CATALOGUE_TAG, CATALOGUE_URL_PREFIX, LIVE_TAG


def flatten_source(df: DataFrame) -> DataFrame:
    """Replace the nested ``source`` by ``source_name``."""
    if "source" in df.columns:
        return df.withColumn("source_name", F.col("source.name")).drop("source")
    return df.withColumn("source_name", F.lit("unknown"))


def source_as_json(df: DataFrame) -> DataFrame:
    """Replace the nested ``source`` by its JSON text."""
    if "source" not in df.columns:
        return df
    return df.withColumn("source_json", F.to_json("source")).drop("source")


def _category(c: Column) -> Column:
    return F.lower(text_or(c, "general"))


def standardise_live(df: DataFrame, blank_is_missing: bool = True) -> DataFrame:
    """Flattened landed articles in the common article schema."""
    return df.select(
        live_article_id(
            F.col("url"), F.col("title"), F.col("publishedAt"), F.col("source_name"), blank_is_missing
        ).alias("article_id"),
        text_or(F.trim("url")).alias("url"),
        text_or(F.col("title")).alias("title"),
        text_or(F.col("description")).alias("abstract"),
        text_or(F.col("content")).alias("content"),
        _category(F.col("category")).alias("category"),
        text_or(F.col("source_name"), "unknown").alias("source"),
        text_or(F.col("publishedAt")).alias("pub_date"),
        text_or(F.col("fetched_at")).alias("fetched_at"),
        F.lit(LIVE_TAG).alias("data_source"),
    )


def standardise_catalogue(df: DataFrame) -> DataFrame:
    """Catalogue rows in the common article schema."""
    return df.select(
        catalogue_article_id(F.col("url"), F.col("news_id")).alias("article_id"),
        F.coalesce(blank_to_null(F.col("url")), F.concat(F.lit(CATALOGUE_URL_PREFIX), "news_id")).alias("url"),
        text_or(F.col("title")).alias("title"),
        text_or(F.col("abstract")).alias("abstract"),
        F.lit("").alias("content"),
        _category(F.col("category")).alias("category"),
        F.lit(CATALOGUE_SOURCE).alias("source"),
        F.lit("").alias("pub_date"),
        F.lit("").alias("fetched_at"),
        F.lit(CATALOGUE_TAG).alias("data_source"),
    )


def clean_logs(df: DataFrame) -> DataFrame:
    return df.select(
        text_or(F.col("user_id")).alias("user_id"),
        text_or(F.col("article_id")).alias("article_id"),
        _category(F.col("category")).alias("category"),
        F.lower(text_or(F.col("action"), "view")).alias("action"),
        text_or(F.col("session_id")).alias("session_id"),
        text_or(F.col("timestamp")).alias("timestamp"),
    )


def clicks_only(df: DataFrame, action: str = "action", any_case: bool = True) -> DataFrame:
    c = F.lower(F.col(action)) if any_case else F.col(action)
    return df.where(c == "click")


def drop_blank(df: DataFrame, column: str) -> DataFrame:
    return df.where(strip(F.col(column)) != "")


def column_or_blank(df: DataFrame, *names: str) -> Column:
    """First non-null of the named columns that exist, else an empty string."""
    return F.coalesce(*[F.col(n).cast("string") for n in names if n in df.columns], F.lit(""))


def embedding_text(df: DataFrame) -> DataFrame:
    """``embedding_text``: title and the first of abstract, description, content that is not blank."""
    bodies = [column_or_blank(df, n) for n in ("abstract", "description", "content")]
    return df.withColumn("embedding_text", joined_text(column_or_blank(df, "title"), *bodies))


def model_text(df: DataFrame) -> DataFrame:
    """``text``: title and abstract, for the term model."""
    return df.withColumn(
        "text", strip(F.concat_ws(" ", column_or_blank(df, "title"), column_or_blank(df, "abstract")))
    )


def label_sources(source: Column, labels: dict[str, str]) -> Column:
    table = F.create_map(*[F.lit(x) for kv in labels.items() for x in kv])
    return F.coalesce(F.try_element_at(table, source), source)
