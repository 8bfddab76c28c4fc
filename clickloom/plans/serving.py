"""Batch serving: ranked articles for a table of requests from the promoted model."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from clickloom.operators.recommend import clean_requests, recommend_for_requests, with_details
from clickloom.schemas import POPULARITY_MODEL
from clickloom.sources.writers import latest_model


def serve(spark: SparkSession, root: str, requests: DataFrame, profiles: DataFrame, articles: DataFrame) -> DataFrame:
    """Recommendations with article details for every valid request, by the promoted model."""
    model = latest_model(spark, root)
    popularity = spark.read.parquet(f"{model['path']}/popularity")
    items = None
    if model["best_model"] != POPULARITY_MODEL:
        items = spark.read.parquet(f"{model['path']}/items")
    recs = recommend_for_requests(clean_requests(requests), profiles, model["best_model"], popularity, items)
    return with_details(recs, articles).withColumn("model_type", F.lit(model["best_model"]))


def refuse_blank(requests: DataFrame) -> DataFrame:
    """Requests without a user, with the error they get."""
    return clean_requests(requests).where(~F.col("valid")).drop("valid").withColumn("error", F.lit("a request needs a user"))
