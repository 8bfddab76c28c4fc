"""Profile updates from a click stream.

Micro-batches append mergeable parts (see ``operators.profiles``), so a batch costs as much as its own
clicks, not as much as all profiles. ``compact`` folds finished batches into a base version now and then.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from clickloom.operators.profiles import (
    assemble,
    count_part,
    merge_counts,
    parts_of_profiles,
    recent_part,
    validate_clicks,
)
from clickloom.schemas import CLICK, COUNT_PART, RECENT_PART
from clickloom.session import BUCKETS, bucket_of
from clickloom.sources.readers import read_since, versions

_FIRST = -1


def _store_base(root: str, version: int, recents: DataFrame, counts: DataFrame) -> None:
    """Counts go last: readers look for the newest counts version."""
    _write_part(recents, f"{root}/base_recents/v={version}")
    _write_part(counts, f"{root}/base_counts/v={version}")


def _write_part(df: DataFrame, path: str) -> None:
    """Parts lie by bucket of the user, so that a few users' state is read without the rest."""
    placed = df.withColumn("bucket", bucket_of("user_id")).repartition("bucket")
    placed.write.mode("overwrite").partitionBy("bucket").parquet(path)


def start_from(profiles: DataFrame, root: str) -> None:
    """Use existing profiles as the state before the first click."""
    recents, counts = parts_of_profiles(profiles)
    _store_base(root, _FIRST, recents, counts)


def state_parts(
    spark: SparkSession, root: str, upto: int | None = None, buckets: list[int] | None = None
) -> tuple[DataFrame, DataFrame]:
    """Recent-click and count parts: the newest base version and every later batch, in all or the given buckets."""
    buckets = list(range(BUCKETS)) if buckets is None else buckets
    done = [v for v in versions(spark, f"{root}/base_counts") if upto is None or v <= upto]
    version = done[-1] if done else None
    return tuple(
        read_since(spark, f"{root}/base_{kind}", f"{root}/{kind}", schema, version, upto, buckets)
        for kind, schema in (("recents", RECENT_PART), ("counts", COUNT_PART))
    )


def read_profiles(spark: SparkSession, root: str) -> DataFrame:
    return assemble(*state_parts(spark, root))


def compact(spark: SparkSession, root: str, upto: int) -> None:
    """Fold batches up to ``upto`` into a new base version. Older files stay until someone removes them."""
    recents, counts = state_parts(spark, root, upto)
    _store_base(root, upto, recent_part(recents), merge_counts(counts))


def fold_clicks(
    spark: SparkSession,
    source: str,
    articles: DataFrame,
    root: str,
    files_per_batch: int = 1000,
    once_within: str | None = None,
    refresh: Callable[[DataFrame, DataFrame], DataFrame] | None = None,
    compact_every: int = 16,
) -> None:
    """Fold every new click file below ``source`` into the profile state and stop.

    Clicks on unknown articles go to ``rejected``. ``once_within`` drops repeated event ids inside the
    given delay; by default a replayed click counts again. ``refresh(users, profiles)`` returns new
    recommendations for the users touched by a batch; only the buckets of these users are read. Every
    ``compact_every`` batches the parts are folded into a new base.
    """
    stream = (
        spark.readStream.schema(CLICK)
        .option("pathGlobFilter", "*.json")
        .option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][XXX]")
        .option("maxFilesPerTrigger", files_per_batch)
        .json(source)
    )
    if once_within:
        stream = stream.withWatermark("ts", once_within).dropDuplicatesWithinWatermark(["event_id"])

    def fold(batch: DataFrame, number: int) -> None:
        accepted, rejected = validate_clicks(batch, articles)
        accepted = accepted.persist()
        _write_part(recent_part(accepted), f"{root}/recents/batch={number}")
        _write_part(count_part(accepted), f"{root}/counts/batch={number}")
        rejected.write.mode("overwrite").parquet(f"{root}/rejected/batch={number}")
        if refresh is not None:
            touched = accepted.select("user_id").distinct()
            buckets = [r["bucket"] for r in touched.select(bucket_of("user_id")).distinct().collect()]  # at most BUCKETS rows
            recents, counts = state_parts(spark, root, number, buckets)
            mine = assemble(
                recents.join(touched, "user_id", "left_semi"), counts.join(touched, "user_id", "left_semi")
            )
            refresh(touched, mine).write.mode("overwrite").parquet(f"{root}/recommendations/batch={number}")
        accepted.unpersist()
        if (number + 1) % compact_every == 0:
            compact(spark, root, number)

    (
        stream.writeStream.foreachBatch(fold)
        .option("checkpointLocation", f"{root}/progress")
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def read_rejected(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(f"{root}/rejected").drop("batch")


def current_recommendations(spark: SparkSession, root: str) -> DataFrame:
    """The lists written by each user's latest batch."""
    rows = spark.read.parquet(f"{root}/recommendations")
    last = rows.groupBy("user_id").agg(F.max("batch").alias("batch"))
    return rows.join(last, ["user_id", "batch"]).drop("batch")
