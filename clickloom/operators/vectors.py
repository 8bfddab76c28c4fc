"""Per-user category counts, recent clicks and profiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from clickloom.functions.casts import utc_timestamp, whole_or_zero
from clickloom.functions.collections import (
    array_or_empty,
    click_list,
    counts_map,
    no_strings,
    top_column,
    top_key,
    total_of,
)
from clickloom.functions.text import blank_to_null, strip
from clickloom.operators.cleaning import clicks_only
from clickloom.operators.ordering import top_n
from clickloom.schemas import CATEGORIES, missing_columns, with_missing_columns

RECENT_CAP = 10


def union_clicks(logs: DataFrame, behaviours: DataFrame) -> DataFrame:
    """Clicks of both origins as ``user_id, article_id, category, event_time``."""
    from_logs = clicks_only(logs).select("user_id", "article_id", "category", F.col("timestamp").alias("event_time"))
    from_lists = behaviours.where(F.col("clicked") == 1).select("user_id", "article_id", "category", "event_time")
    return from_logs.unionByName(from_lists)


def category_counts(clicks: DataFrame, categories: list[str] = CATEGORIES) -> DataFrame:
    """One count column per listed category; other categories are left out."""
    name = F.lower("category")
    return (
        clicks.where(name.isin(categories))
        .groupBy("user_id")
        .agg(*[F.count(F.when(name == c, 1)).alias(c) for c in categories])
    )


def event_order(by_text: bool = False) -> list[Column]:
    """Newest first. ``by_text`` compares the raw time strings."""
    when = F.col("event_time") if by_text else utc_timestamp(F.col("event_time"))
    return [when.desc_nulls_last(), F.col("article_id")]


def recent_clicks(clicks: DataFrame, order: list[Column] | None = None, cap: int = RECENT_CAP) -> DataFrame:
    """``recent_clicks``: the newest ``cap`` article ids per user, newest first."""
    kept = top_n(clicks, ["user_id"], order or event_order(), cap, "_rn")
    # At most `cap` rows per user reach this list.
    listed = F.array_sort(F.collect_list(F.struct("_rn", F.col("article_id").cast("string").alias("id"))))
    return kept.groupBy("user_id").agg(F.transform(listed, lambda x: x["id"]).alias("recent_clicks"))


def user_vectors(
    clicks: DataFrame, order: list[Column] | None = None, categories: list[str] = CATEGORIES, cap: int = RECENT_CAP
) -> DataFrame:
    counts = category_counts(clicks, categories)
    joined = counts.join(recent_clicks(clicks, order, cap), "user_id", "full_outer")
    zero = F.lit(0).cast("bigint")
    return (
        with_missing_columns(joined, {c: zero for c in categories})
        .withColumn("recent_clicks", array_or_empty(F.col("recent_clicks")))
        .withColumn("total_clicks", total_of(categories))
        .withColumn("top_category", top_column(categories))
    )


def raw_log_recents(logs: DataFrame, cap: int = RECENT_CAP) -> DataFrame:
    """Recent clicks from raw logs, where only the exact text 'click' counts."""
    if missing_columns(logs, ["user_id", "article_id", "action", "timestamp"]):
        return logs.sparkSession.createDataFrame([], "user_id string, recent_clicks array<string>")
    clicks = clicks_only(logs, any_case=False).where(F.col("user_id").isNotNull())
    return recent_clicks(clicks, [F.col("timestamp").desc_nulls_last(), F.col("article_id")], cap)


def merge_recents(vectors: DataFrame, raw: DataFrame) -> DataFrame:
    """Vectors with ``recent_clicks`` replaced by the raw list wherever there is one."""
    fresh = raw.select("user_id", F.col("recent_clicks").alias("_raw"))
    joined = vectors.join(fresh, "user_id", "left")
    if "recent_clicks" not in vectors.columns:
        return joined.withColumn("recent_clicks", array_or_empty(F.col("_raw"))).drop("_raw")
    own = click_list(F.col("recent_clicks"), vectors.schema["recent_clicks"].dataType)
    return joined.withColumn("recent_clicks", F.coalesce("_raw", own)).drop("_raw")


def profile_items(merged: DataFrame, categories: list[str] = CATEGORIES) -> DataFrame:
    """Profile records: preference map, top category, recent clicks, total."""
    zero = F.lit(0).cast("bigint")
    df = merged.withColumns(
        {c: whole_or_zero(F.col(c)) if c in merged.columns else zero for c in categories}
    )
    recomputed_total = total_of(categories)
    total = F.coalesce(F.col("total_clicks").try_cast("bigint"), recomputed_total) if "total_clicks" in df.columns else recomputed_total
    prefs = counts_map(categories)
    top = top_key(prefs, categories)
    if "top_category" in df.columns:
        top = F.coalesce(F.when(blank_to_null(F.col("top_category"), strip).isNotNull(), F.col("top_category")), top)
    recents = (
        click_list(F.col("recent_clicks"), df.schema["recent_clicks"].dataType)
        if "recent_clicks" in df.columns
        else no_strings()
    )
    return df.select(
        F.col("user_id").cast("string").alias("user_id"),
        prefs.alias("category_preferences"),
        top.alias("top_category"),
        recents.alias("recent_clicks"),
        total.alias("total_clicks"),
    )
