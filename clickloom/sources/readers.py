"""Scans of landed files. Schemas are explicit, so no scan runs twice to infer one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from clickloom.schemas import empty_table

_CORRUPT = "_corrupt_record"


def read_json_arrays(spark: SparkSession, path: str, schema: T.StructType, pattern: str = "*.json") -> DataFrame:
    """Files holding a JSON array of records, read as a stream of records per file. Unreadable payloads are ignored."""
    full = T.StructType(schema.fields + [T.StructField(_CORRUPT, T.StringType())])
    rows = (
        spark.read.schema(full)
        .option("multiLine", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", _CORRUPT)
        .option("pathGlobFilter", pattern)
        .json(path)
    )
    return rows.where(F.col(_CORRUPT).isNull()).drop(_CORRUPT)


def read_tsv(spark: SparkSession, path: str | list[str], schema: T.StructType, verbatim: bool = False) -> DataFrame:
    """Tab-separated files without a header; columns go by position. ``verbatim`` switches quoting off."""
    reader = spark.read.schema(schema).option("sep", "\t").option("header", "false")
    if verbatim:
        reader = reader.option("quote", "")
    return reader.csv(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def read_existing_tsv(spark: SparkSession, paths: list[str], schema: T.StructType, columns: list[str]) -> DataFrame:
    """Union of whichever files exist, only the given columns; an empty table when there are none."""
    found = [p for p in paths if path_exists(spark, p)]
    df = read_tsv(spark, found, schema) if found else empty_table(spark, schema)
    return df.select(*columns)


def versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the finished ``v=<number>`` folders below ``path``, ascending. A write that was broken off has
    left no success file, and its folder does not count."""
    names = [n for n in folder_names(spark, path) if n.startswith("v=")]
    return sorted(int(n.split("=", 1)[1]) for n in names if path_exists(spark, f"{path}/{n}/_SUCCESS"))


def folder_names(spark: SparkSession, path: str) -> list[str]:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


def read_since(
    spark: SparkSession,
    base: str,
    batches: str,
    schema: T.StructType,
    version: int | None,
    upto: int | None = None,
    buckets: list[int] | None = None,
) -> DataFrame:
    """Base version ``version`` (if any) and every later batch up to ``upto``; with ``buckets``, of tables laid
    out by ``bucket``, these only."""
    rows = empty_table(spark, schema)
    placed = [T.StructField("bucket", T.IntegerType())] if buckets is not None else []

    def chosen(df: DataFrame) -> DataFrame:
        return df if buckets is None else df.where(F.col("bucket").isin(buckets)).drop("bucket")

    if version is not None:
        rows = rows.unionByName(chosen(spark.read.schema(T.StructType(schema.fields + placed)).parquet(f"{base}/v={version}")))
    if path_exists(spark, batches):
        full = T.StructType(schema.fields + [T.StructField("batch", T.IntegerType())] + placed)
        new = chosen(spark.read.schema(full).parquet(batches))
        if version is not None:
            new = new.where(F.col("batch") > version)
        if upto is not None:
            new = new.where(F.col("batch") <= upto)
        rows = rows.unionByName(new.drop("batch"))
    return rows


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_table_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.parquet(path) if path_exists(spark, path) else empty_table(spark, schema)
