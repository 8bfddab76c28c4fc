"""Deduplication and keyed upserts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from clickloom.functions.text import blank_to_null, strip
from clickloom.operators.ordering import top_n


def article_key(url: Column, article_id: Column) -> Column:
    """Lower-cased url, or the id of rows without a url."""
    return F.when(url != "", F.lower(url)).otherwise(article_id)


def keep_first(df: DataFrame, key: Column, order: list[Column]) -> DataFrame:
    """One row per key: the first under ``order``, remaining columns settle ties."""
    rest = [F.col(c).asc_nulls_last() for c in df.columns]
    return top_n(df.withColumn("_key", key), ["_key"], [*order, *rest], 1, "_rn").drop("_key", "_rn")


def latest_articles(df: DataFrame) -> DataFrame:
    """Newest version per article within one source."""
    return keep_first(
        df,
        article_key(F.col("url"), F.col("article_id")),
        [F.col("fetched_at").desc_nulls_last(), F.col("pub_date").desc_nulls_last()],
    )


def first_by_id(df: DataFrame) -> DataFrame:
    """Smallest article id per key, for static sources."""
    return keep_first(df, article_key(F.col("url"), F.col("article_id")), [F.col("article_id")])


def latest_across_sources(df: DataFrame) -> DataFrame:
    return keep_first(
        df,
        article_key(F.col("url"), F.col("article_id")),
        [F.col("fetched_at").desc_nulls_last(), F.col("pub_date").desc_nulls_last(), F.col("data_source").desc()],
    )


def distinct_on(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key set, always the same one: the smallest of the remaining columns."""
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.select(*keys).distinct()
    return keep_first(df, F.struct(*keys), [])


def dedup_where_present(df: DataFrame, column: str, row_id: str) -> DataFrame:
    """Keep one row per non-blank ``column`` value and every row where it is blank, in one pass."""
    value = blank_to_null(F.col(column), strip)
    key = F.struct(value.alias("v"), F.when(value.isNull(), F.col(row_id)).alias("r"))
    return keep_first(df, key, [F.col(row_id)])


def upsert(snapshot: DataFrame, changes: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """Snapshot with changed rows replaced: per key the last change wins."""
    last = top_n(changes, [key], order, 1, "_rn").drop("_rn").select(*snapshot.columns)
    return last.unionByName(snapshot.join(last, key, "left_anti"))


def quarantine(df: DataFrame, valid: Column) -> tuple[DataFrame, DataFrame]:
    """Split into rows to write and rows to report."""
    ok = F.coalesce(valid, F.lit(False))
    return df.where(ok), df.where(~ok)
