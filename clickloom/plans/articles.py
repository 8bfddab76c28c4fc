"""Article and user ETL jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame

from clickloom.operators.cleaning import clean_logs, flatten_source, standardise_catalogue, standardise_live
from clickloom.operators.dedup import latest_across_sources
from clickloom.operators.impressions import explode_impressions
from clickloom.operators.interactions import id_mapping, translate_ids
from clickloom.operators.vectors import merge_recents, profile_items, raw_log_recents, union_clicks, user_vectors
from clickloom.sources.writers import overwrite


def build_articles(live: DataFrame, catalogue: DataFrame, blank_is_missing: bool = True) -> DataFrame:
    """One clean article table from landed articles and the catalogue.

    The newest row of each key over both sources is also the newest of its own source, so one pass does.
    """
    landed = standardise_live(flatten_source(live), blank_is_missing)
    return latest_across_sources(landed.unionByName(standardise_catalogue(catalogue)))


def build_user_vectors(logs: DataFrame, behaviours: DataFrame, catalogue: DataFrame | None = None) -> DataFrame:
    """User vectors from cleaned logs and behaviours.

    With ``catalogue`` given, behaviour ids become content ids first, so that recent clicks match the
    article table; without it they stay raw.
    """
    if catalogue is not None:
        behaviours = translate_ids(behaviours, id_mapping(catalogue))
    return user_vectors(union_clicks(logs, behaviours))


def run_etl(live: DataFrame, catalogue: DataFrame, raw_logs: DataFrame, raw_behaviours: DataFrame, root: str) -> None:
    """Write ``articles``, ``users/logs``, ``users/behaviors`` and ``users/vectors`` below ``root``."""
    spark = live.sparkSession
    overwrite(build_articles(live, catalogue), f"{root}/articles")
    overwrite(clean_logs(raw_logs), f"{root}/users/logs")
    overwrite(explode_impressions(raw_behaviours, catalogue), f"{root}/users/behaviors")
    # Later steps read the written tables, so nothing upstream runs twice.
    logs = spark.read.parquet(f"{root}/users/logs")
    behaviours = spark.read.parquet(f"{root}/users/behaviors")
    overwrite(build_user_vectors(logs, behaviours), f"{root}/users/vectors")


def build_profiles(vectors: DataFrame, raw_logs: DataFrame) -> DataFrame:
    """Profile records from user vectors, with recent clicks taken from raw logs where there are any."""
    return profile_items(merge_recents(vectors, raw_log_recents(raw_logs)))
