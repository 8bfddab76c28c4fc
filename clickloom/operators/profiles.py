"""Click folding: profiles as mergeable parts.

A profile is two small long-form tables: the newest click per user and article, and clicks per user and
category. Folding clicks is an ordered top-20 and a sum, so parts from any number of batches merge in any
order to the same profile. A sequential move-to-front list with cap 20 gives the same result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from clickloom.functions.collections import no_strings, top_key
from clickloom.operators.ordering import top_n

CLICK_CAP = 20


# Fixed value: the start of the error text of a click on an unknown article.
UNKNOWN_ARTICLE = "Article not found: "


def parse_clicks(df: DataFrame, body: str = "body") -> tuple[DataFrame, DataFrame]:
    """Click records from JSON request bodies, and the rows whose body names no user or no article, with an error."""
    fields = F.from_json(F.col(body), "user_id string, article_id string")
    rows = df.withColumn("_b", fields)
    whole = F.coalesce(F.col("_b.user_id").isNotNull() & F.col("_b.article_id").isNotNull(), F.lit(False))
    good = rows.where(whole).select(*[c for c in df.columns if c != body], "_b.user_id", "_b.article_id")
    return good, rows.where(~whole).drop("_b").withColumn("error", F.lit("a click needs a user and an article"))


def validate_clicks(clicks: DataFrame, articles: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Clicks on known articles with their category, and the rejected rest with an error text."""
    facts = articles.select("article_id", F.coalesce(F.col("category"), F.lit("unknown")).alias("category"))
    accepted = clicks.join(facts, "article_id")
    rejected = clicks.join(facts.select("article_id"), "article_id", "left_anti").withColumn(
        "error", F.concat(F.lit(UNKNOWN_ARTICLE), F.col("article_id"))
    )
    return accepted, rejected


def recent_part(clicks: DataFrame, cap: int = CLICK_CAP) -> DataFrame:
    """The newest ``cap`` distinct articles per user."""
    newest = clicks.groupBy("user_id", "article_id").agg(F.max(F.struct("ts", "event_id")).alias("_o"))
    rows = newest.select("user_id", "article_id", "_o.ts", "_o.event_id")
    order = [F.col("ts").desc(), F.col("event_id").desc(), F.col("article_id")]
    return top_n(rows, ["user_id"], order, cap, "_rn").drop("_rn")


def count_part(clicks: DataFrame) -> DataFrame:
    return clicks.groupBy("user_id", "category").agg(F.count(F.lit(1)).alias("clicks"), F.max("ts").alias("last_ts"))


def merge_counts(parts: DataFrame) -> DataFrame:
    return parts.groupBy("user_id", "category").agg(F.sum("clicks").alias("clicks"), F.max("last_ts").alias("last_ts"))


def parts_of_profiles(profiles: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Parts of existing profiles; list positions stand in for click times older than any new click."""
    start = F.lit(0).cast("timestamp")
    recents = profiles.select("user_id", F.posexplode("recent_clicks").alias("_at", "article_id")).select(
        "user_id", "article_id", start.alias("ts"), (-F.col("_at")).cast("bigint").alias("event_id")
    )
    counts = profiles.select("user_id", F.explode("category_preferences").alias("category", "clicks")).select(
        "user_id", "category", "clicks", F.lit(None).cast("timestamp").alias("last_ts")
    )
    return recents, counts


def assemble(recents: DataFrame, counts: DataFrame, cap: int = CLICK_CAP) -> DataFrame:
    """Profiles from merged parts."""
    kept = recent_part(recents, cap)
    # At most `cap` rows per user, and one row per category.
    listed = F.sort_array(F.collect_list(F.struct("ts", "event_id", "article_id")), asc=False)
    lists = kept.groupBy("user_id").agg(F.transform(listed, lambda x: x["article_id"]).alias("recent_clicks"))
    maps = merge_counts(counts).groupBy("user_id").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("category", "clicks")))).alias("category_preferences"),
        F.sum("clicks").alias("total_clicks"),
        F.max("last_ts").alias("last_updated"),
    )
    return maps.join(lists, "user_id", "full_outer").select(
        "user_id",
        "category_preferences",
        top_key(F.col("category_preferences")).alias("top_category"),
        F.coalesce("recent_clicks", no_strings()).alias("recent_clicks"),
        "total_clicks",
        "last_updated",
    )


def update_profiles(profiles: DataFrame, clicks: DataFrame, cap: int = CLICK_CAP) -> DataFrame:
    """Profiles after folding valid clicks (``user_id, article_id, category, event_id, ts``)."""
    old_recents, old_counts = parts_of_profiles(profiles)
    recents = old_recents.unionByName(clicks.select("user_id", "article_id", "ts", "event_id"))
    return assemble(recents, old_counts.unionByName(count_part(clicks)), cap)
