"""Explicit schemas and table contracts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


# Category order also settles ties between equal counts.
CATEGORIES = ["business", "entertainment", "technology", "health", "science"]

# Tags written into data_source, source and model_type columns.
LIVE_TAG = "newsapi"
CATALOGUE_TAG = "mind"
CATALOGUE_SOURCE = "microsoft_mind"
CATALOGUE_URL_PREFIX = "mind://"
IMPRESSION_CLICK = "mind_click"
LOG_CLICK = "simulated_click"
POPULARITY_MODEL = "popularity_baseline"
FACTOR_MODEL = "svd_matrix_factorisation"
TEXT_MODEL = "knn_content_based"
MODEL_TYPES = [POPULARITY_MODEL, FACTOR_MODEL, TEXT_MODEL]
# Item vectors that were given instead of fitted.
VECTOR_MODEL = "given_vectors"

# Labels shown for data sources.
SOURCE_LABELS = {
    "microsoft_mind": "MIND Dataset",
    "mind": "MIND Dataset",
    "newsapi": "Live News",
    "unknown": "Unknown",
}

LIVE_ARTICLE = T.StructType(
    [T.StructField("source", _strings("id", "name"))]
    + _strings("title", "description", "content", "url", "publishedAt", "category", "fetched_at").fields
)
CATALOGUE = _strings(
    "news_id", "category", "subcategory", "title", "abstract", "url", "title_entities", "abstract_entities"
)
BEHAVIOUR = _strings("impression_id", "user_id", "time", "history", "impressions")
USER_LOG = _strings("user_id", "article_id", "category", "action", "timestamp", "session_id")
ARTICLE = _strings(
    "article_id", "url", "title", "abstract", "content", "category", "source", "pub_date", "fetched_at", "data_source"
)
CLICK = T.StructType(
    _strings("user_id", "article_id").fields
    + [T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampType())]
)
RECENT_PART = T.StructType(
    _strings("user_id", "article_id").fields
    + [T.StructField("ts", T.TimestampType()), T.StructField("event_id", T.LongType())]
)
COUNT_PART = T.StructType(
    _strings("user_id", "category").fields
    + [T.StructField("clicks", T.LongType()), T.StructField("last_ts", T.TimestampType())]
)
INTERACTION = T.StructType(
    _strings("user_id", "article_id").fields
    + [
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("rating", T.DoubleType()),
        T.StructField("source", T.StringType()),
    ]
)
RUN = T.StructType(
    _strings("run_id", "status", "model_type").fields
    + [T.StructField(n, T.DoubleType()) for n in ("ndcg_at_10", "precision_at_5", "recall_at_10")]
    + [
        T.StructField(n, T.LongType())
        for n in ("train_size", "test_size", "unique_users", "unique_articles", "eval_users")
    ]
)


class MissingColumns(ValueError):
    """A table lacks columns that an operator needs."""


class EmptyTable(ValueError):
    """A table that must hold rows holds none."""


def missing_columns(df: DataFrame, names: list[str]) -> list[str]:
    return [n for n in names if n not in df.columns]


def require_columns(df: DataFrame, names: list[str], label: str = "table") -> DataFrame:
    lacking = missing_columns(df, names)
    if lacking:
        raise MissingColumns(f"{label} does not contain {', '.join(lacking)}")
    return df


def require_rows(df: DataFrame, label: str = "table") -> DataFrame:
    if df.isEmpty():
        raise EmptyTable(f"{label} holds no rows")
    return df


def with_missing_columns(df: DataFrame, defaults: dict[str, Column]) -> DataFrame:
    """Add absent columns, and replace nulls in present ones, by the given defaults."""
    return df.withColumns(
        {n: F.coalesce(F.col(n), d) if n in df.columns else d for n, d in defaults.items()}
    )


def empty_table(spark, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)
