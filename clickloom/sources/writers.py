"""Parquet, summary and model-registry sinks."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from clickloom.operators.dedup import quarantine
from clickloom.operators.ordering import top_n
from clickloom.schemas import POPULARITY_MODEL, RUN, EmptyTable
from clickloom.session import BUCKETS, bucket_of
from clickloom.sources.readers import folder_names, versions


def overwrite(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_counted(df: DataFrame, path: str) -> int:
    """Write ``df`` and return its rows, counted by the writing job itself.

    The count is taken right below the write, in the tasks whose results the driver accepts once each, so a task
    that runs again does not count twice.
    """
    seen = Observation()
    overwrite(df.observe(seen, F.count(F.lit(1)).alias("rows")), path)
    return seen.get["rows"]


def write_summary(summary: DataFrame, path: str) -> None:
    """A one-row summary as JSON."""
    summary.coalesce(1).write.mode("overwrite").json(path)


def upsert_version(
    spark: SparkSession, root: str, changes: DataFrame, key: str, order: list[Column], valid: Column, buckets: int = BUCKETS
) -> tuple[int, int]:
    """Write the next version of a keyed table: per key the last change wins.

    The table is laid out by a hash of the key in a fixed number of buckets, and a version holds the buckets
    that its changes touch; others stay where they are. Rows failing ``valid`` go to ``rejected`` and never
    stop the others. Returns rows written from ``changes`` and rows rejected.
    """
    done = versions(spark, f"{root}/items")
    number = done[-1] + 1 if done else 0
    good, bad = quarantine(changes, valid)
    overwrite(bad, f"{root}/rejected/v={number}")
    last = top_n(good, [key], order, 1, "_rn").drop("_rn")
    schema = last.schema
    overwrite(last, f"{root}/changes/v={number}")
    last = spark.read.schema(schema).parquet(f"{root}/changes/v={number}")
    touched = [r["bucket"] for r in last.select(bucket_of(key, buckets)).distinct().collect()]  # at most `buckets` rows
    paths = [p for b, p in _newest(spark, root).items() if b in touched]
    rows = last
    if paths:
        rows = last.unionByName(spark.read.schema(schema).parquet(*paths).join(last.select(key), key, "left_anti"))
    overwrite(rows.withColumn("bucket", bucket_of(key, buckets)).repartition("bucket"), f"{root}/items/v={number}", ["bucket"])
    return last.count(), spark.read.schema(bad.schema).parquet(f"{root}/rejected/v={number}").count()


def _newest(spark: SparkSession, root: str) -> dict[int, str]:
    """The folder of each bucket in the newest finished version that holds it."""
    out = {}
    for v in versions(spark, f"{root}/items"):
        for name in folder_names(spark, f"{root}/items/v={v}"):
            if name.startswith("bucket="):
                out[int(name.removeprefix("bucket="))] = f"{root}/items/v={v}/{name}"
    return out


def read_items(spark: SparkSession, root: str) -> DataFrame:
    """The newest state of a keyed table."""
    paths = list(_newest(spark, root).values())
    if not paths:
        raise EmptyTable(f"no rows below {root}/items")
    return spark.read.parquet(*paths)


ARRAY_CHARS = 32 << 20


def write_json_arrays(df: DataFrame, path: str) -> None:
    """Text files that each hold one JSON array of about ``ARRAY_CHARS`` characters, and a last smaller one per task."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0
        for pdf in batches:
            held.append(",\n".join(pdf["j"]))
            size += len(held[-1])
            if size >= ARRAY_CHARS:
                yield pd.DataFrame({"value": ["[" + ",\n".join(h for h in held if h) + "]"]})
                held, size = [], 0
        if size:
            yield pd.DataFrame({"value": ["[" + ",\n".join(h for h in held if h) + "]"]})

    arrays = df.select(F.to_json(F.struct(*df.columns)).alias("j")).mapInPandas(run, "value string")
    arrays.write.mode("overwrite").option("maxRecordsPerFile", 1).text(path)


def save_model(root: str, model_type: str, version: str, tables: dict[str, DataFrame]) -> str:
    """Write a model's tables below ``root/models/<type>/<version>``."""
    base = f"{root}/models/{model_type}/{version}"
    for name, df in tables.items():
        overwrite(df, f"{base}/{name}")
    return base


def promote(spark: SparkSession, root: str, record: DataFrame, models: list[str], version: str, stamp: str) -> None:
    """Publish a promotion.

    The tables of every model of ``version`` are copied below ``registry/all/<model>-<stamp>``, those of the
    best below ``registry/best_model_<stamp>``. The record joins the history in ``registry/metadata``; a
    repeated promotion of one stamp replaces itself. The pointer is written last, so readers never see a
    version without its tables.
    """
    best = record.first()["best_model"]
    popularity = f"{root}/models/{POPULARITY_MODEL}/{version}/popularity"
    for model in models:
        targets = [f"{root}/registry/all/{model}-{stamp}"] + [f"{root}/registry/best_model_{stamp}"] * (model == best)
        for target in targets:
            overwrite(spark.read.parquet(popularity), f"{target}/popularity")
            if model != POPULARITY_MODEL:
                overwrite(spark.read.parquet(f"{root}/models/{model}/{version}/items"), f"{target}/items")
    overwrite(record, f"{root}/registry/metadata/stamp={stamp}")
    pointer = record.select("best_model", F.concat(F.lit(f"{root}/"), "model_path").alias("path"), "timestamp", "data_version")
    overwrite(pointer, f"{root}/registry/latest")


def append_runs(runs: DataFrame, root: str, version: str) -> None:
    """Put the runs of a version on record; the same version again replaces its runs."""
    overwrite(runs, f"{root}/runs/version={version}")


def read_runs(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(RUN).parquet(f"{root}/runs").select(*RUN.names)


def latest_model(spark: SparkSession, root: str):
    """The promoted model's type and path (a one-row table)."""
    return spark.read.parquet(f"{root}/registry/latest").first()
