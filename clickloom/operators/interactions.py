"""Training interactions, histories and summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from clickloom.functions.casts import utc_timestamp, whole_or_zero
from clickloom.functions.ids import catalogue_article_id
from clickloom.functions.text import strip
from clickloom.operators.cleaning import clicks_only
from clickloom.schemas import IMPRESSION_CLICK, LOG_CLICK, require_columns


def id_mapping(catalogue: DataFrame) -> DataFrame:
    """Catalogue id to content id, one row per catalogue id."""
    return (
        catalogue.select("news_id", catalogue_article_id(F.col("url"), F.col("news_id"), strip).alias("article_id"))
        .groupBy("news_id")
        .agg(F.min("article_id").alias("article_id"))
        .where(F.col("article_id").isNotNull())
    )


def translate_ids(clicks: DataFrame, mapping: DataFrame) -> DataFrame:
    """Replace catalogue ids by content ids; clicks without a mapping are dropped."""
    return clicks.withColumnRenamed("article_id", "news_id").join(mapping, "news_id", "inner").drop("news_id")


def only_known(df: DataFrame, articles: DataFrame) -> DataFrame:
    return df.join(articles.select("article_id").distinct(), "article_id", "left_semi")


def _tagged(clicks: DataFrame, time: str, tag: str) -> DataFrame:
    return clicks.select(
        F.col("user_id").cast("string").alias("user_id"),
        F.col("article_id").cast("string").alias("article_id"),
        utc_timestamp(F.col(time)).alias("timestamp"),
        F.lit(1.0).alias("rating"),
        F.lit(tag).alias("source"),
    )


def build_interactions(articles: DataFrame, behaviours: DataFrame, logs: DataFrame, mapping: DataFrame) -> DataFrame:
    """Every valid click of both origins, once per user, article, time and origin."""
    require_columns(behaviours, ["user_id", "article_id", "clicked", "event_time"], "behaviours")
    listed = behaviours.where(whole_or_zero(F.col("clicked")) == 1)
    listed = only_known(translate_ids(listed, mapping), articles)
    logged = only_known(clicks_only(logs), articles)
    both = _tagged(listed, "event_time", IMPRESSION_CLICK).unionByName(_tagged(logged, "timestamp", LOG_CLICK))
    return both.na.drop(subset=["user_id", "article_id", "timestamp"]).dropDuplicates(
        ["user_id", "article_id", "timestamp", "source"]
    )


def user_histories(interactions: DataFrame, time: str = "timestamp") -> DataFrame:
    """History of every user in long form: one row per user and article.

    Long form keeps a user with very many clicks spread over tasks; a list per user would not.
    """
    return interactions.groupBy("user_id", "article_id").agg(
        F.count(F.lit(1)).alias("clicks"), F.min(time).alias("first_time"), F.max(time).alias("last_time")
    )


def seen_pairs(interactions: DataFrame) -> DataFrame:
    return interactions.select("user_id", "article_id").distinct()


def pair_weights(interactions: DataFrame) -> DataFrame:
    return interactions.groupBy("user_id", "article_id").agg(F.count(F.lit(1)).alias("weight"))


def counts_by(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("rows"))


def training_articles(articles: DataFrame, interactions: DataFrame) -> DataFrame:
    return only_known(articles, interactions)
