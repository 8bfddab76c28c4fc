"""Incremental landing of article files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from clickloom.operators.cleaning import flatten_source, standardise_live
from clickloom.operators.dedup import latest_articles
from clickloom.schemas import ARTICLE, LIVE_ARTICLE
from clickloom.sources.readers import read_since, versions


def tag_landed(df: DataFrame, category: str | None = None) -> DataFrame:
    """Stamp records with fetch time (and category) where the feed did not."""
    now = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
    df = df.withColumn("fetched_at", F.coalesce("fetched_at", now))
    return df if category is None else df.withColumn("category", F.coalesce("category", F.lit(category)))


_CORRUPT = "_corrupt_record"


def land_articles(
    spark: SparkSession, source: str, root: str, files_per_batch: int = 1000, pattern: str = "*.json", category: str | None = None
) -> None:
    """Process every new file of JSON records below ``source`` and stop.

    Each micro-batch writes its newest versions below its own number; a repeated batch replaces
    its own output, so a restart neither loses nor doubles rows. What is no record goes to ``rejected``
    as it stands. ``category`` is given to records that have none.
    """
    stream = (
        spark.readStream.schema(T.StructType(LIVE_ARTICLE.fields + [T.StructField(_CORRUPT, T.StringType())]))
        .option("multiLine", True)
        .option("columnNameOfCorruptRecord", _CORRUPT)
        .option("pathGlobFilter", pattern)
        .option("maxFilesPerTrigger", files_per_batch)
        .json(source)
    )

    def write(batch: DataFrame, number: int) -> None:
        batch = batch.persist()
        bad = batch.where(F.col(_CORRUPT).isNotNull()).select(F.col(_CORRUPT).alias("record"))
        bad.write.mode("overwrite").parquet(f"{root}/rejected/batch={number}")
        good = batch.where(F.col(_CORRUPT).isNull()).drop(_CORRUPT)
        rows = latest_articles(standardise_live(flatten_source(tag_landed(good, category))))
        rows.write.mode("overwrite").parquet(f"{root}/articles/batch={number}")
        batch.unpersist()

    (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", f"{root}/progress")
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def rejected_files(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(f"{root}/rejected").select("record")


def landed_articles(spark: SparkSession, root: str, upto: int | None = None) -> DataFrame:
    """Newest version of every landed article: the newest base and every later batch."""
    done = [v for v in versions(spark, f"{root}/base") if upto is None or v <= upto]
    return latest_articles(
        read_since(spark, f"{root}/base", f"{root}/articles", ARTICLE, done[-1] if done else None, upto)
    )


def compact_landed(spark: SparkSession, root: str, upto: int) -> None:
    """Fold batches up to ``upto`` into a new base version. Older files stay until someone removes them."""
    landed_articles(spark, root, upto).write.mode("overwrite").parquet(f"{root}/base/v={upto}")
