"""Impression lists to one row per shown item."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from clickloom.functions.text import text_or

# An item looks like <reference>-<label>.
ITEM_PATTERN = r"^(.*)-[01]$"
LABEL_PATTERN = r".*-(\d)$"


def category_lookup(catalogue: DataFrame) -> DataFrame:
    """One category per catalogue id (the smallest, when rows disagree)."""
    return catalogue.groupBy(F.col("news_id").alias("article_ref")).agg(
        F.min(F.lower(text_or(F.col("category"), "general"))).alias("category")
    )


def explode_impressions(behaviours: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Clean behaviour rows: one per item, with click label and looked-up category."""
    items = (
        behaviours.select(
            "user_id", "time", "history", F.explode(F.split(text_or(F.col("impressions")), " ")).alias("item")
        )
        .where(F.trim("item") != "")
        .select(
            "user_id",
            "time",
            "history",
            F.regexp_extract("item", ITEM_PATTERN, 1).alias("article_ref"),
            F.regexp_extract("item", LABEL_PATTERN, 1).try_cast("int").alias("clicked"),
        )
    )
    return items.join(category_lookup(catalogue), "article_ref", "left").select(
        text_or(F.col("user_id")).alias("user_id"),
        text_or(F.col("time")).alias("event_time"),
        text_or(F.col("history")).alias("history"),
        text_or(F.col("article_ref")).alias("article_id"),
        text_or(F.col("category"), "general").alias("category"),
        F.coalesce("clicked", F.lit(0)).alias("clicked"),
    )
