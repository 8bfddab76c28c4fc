"""Keyed tables whose buckets grow with the table (linear hashing).

Rows lie in numbered buckets by a hash of the key. With ``m`` buckets and ``p`` the largest power of two up to
``m``, a row goes to ``hash mod 2p`` where that bucket exists and to ``hash mod p`` where it does not, so the
buckets below ``m - p`` are split already and the next one to split is ``m - p``. Growing from ``m`` to more
buckets moves rows out of the buckets that split, and leaves all others where they lie. A bucket holds about
``rows_per_bucket`` rows, whatever the size of the table, and is written by one task.

Every upsert writes the buckets it touches below a folder of its own, and then one manifest: the number of buckets,
and for each bucket the folder of its newest rows and their number. A reader lists one folder of manifests and reads the newest
one; a write that was broken off has none. A manifest is put in place by a rename that fails if the version exists,
so of two writers at once one gets ``VersionTaken`` and nothing is lost. The manifest passes through the driver:
some 60 bytes a bucket.

The files carry Parquet's Bloom filters on the key, so that a look-up skips files without its keys also where a
file has too many keys for a dictionary. Null keys are rejected.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from clickloom.operators.dedup import quarantine
from clickloom.operators.ordering import top_n
from clickloom.schemas import EmptyTable
from clickloom.sources.readers import folder_names

ROWS_PER_BUCKET = 1_000_000
# Look-ups of up to so many keys name them in the filter, which Bloom filters need; more keys are joined.
NAMED_KEYS = 200


class VersionTaken(RuntimeError):
    """Another writer has finished this version first."""


@dataclass
class Manifest:
    version: int = -1
    buckets: int = 1
    # The folder of the upsert that wrote it.
    run: str = ""
    # Bucket to (folder of the upsert that wrote it, rows). Buckets without rows are absent.
    held: dict[int, tuple[str, int]] = field(default_factory=dict)

    @property
    def rows(self) -> int:
        return sum(n for _, n in self.held.values())

    def paths(self, root: str, wanted: set[int] | None = None) -> list[str]:
        return [f"{root}/items/{run}/bucket={b}" for b, (run, _) in sorted(self.held.items()) if wanted is None or b in wanted]


def bucket_in(key: str, buckets: int) -> Column:
    """The bucket of a key in a table of ``buckets`` buckets."""
    low = 1 << (buckets.bit_length() - 1)
    h = F.xxhash64(F.col(key))
    wide = F.pmod(h, F.lit(2 * low))
    return F.when(wide < buckets, wide).otherwise(F.pmod(h, F.lit(low))).cast("int").alias("bucket")


def parent(bucket: int) -> int:
    """The bucket that ``bucket`` was split from."""
    return bucket - (1 << (bucket.bit_length() - 1))


def split_sources(before: int, after: int) -> set[int]:
    """The buckets below ``before`` that lose rows when the table grows to ``after`` buckets."""
    sources = set()
    for b in range(before, after):
        while b >= before:
            b = parent(b)
        sources.add(b)
    return sources


def read_manifest(spark: SparkSession, root: str, version: int | None = None) -> Manifest:
    """The newest manifest, or that of ``version``; an empty one where nothing was written."""
    if version is None:
        found = [int(n[2:-5]) for n in folder_names(spark, f"{root}/manifest") if n.startswith("v=") and n.endswith(".json")]
        if not found:
            return Manifest()
        version = max(found)
    text = spark.read.text(f"{root}/manifest/v={version}.json", wholetext=True).first()["value"]
    read = json.loads(text)
    return Manifest(version, read["buckets"], read["run"], {int(b): (run, n) for b, (run, n) in read["held"].items()})


def _put_manifest(spark: SparkSession, root: str, made: Manifest) -> None:
    jvm = spark._jvm
    folder, final = f"{root}/manifest", f"{root}/manifest/v={made.version}.json"
    path, part = jvm.org.apache.hadoop.fs.Path(final), jvm.org.apache.hadoop.fs.Path(f"{folder}/_part-{uuid.uuid4().hex}")
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    out = fs.create(part)
    out.write(bytearray(json.dumps({"run": made.run, "buckets": made.buckets, "held": made.held}).encode()))
    out.close()
    if fs.exists(path) or not fs.rename(part, path):
        fs.delete(part, False)
        raise VersionTaken(final)


def upsert(
    spark: SparkSession,
    root: str,
    changes: DataFrame,
    key: str,
    order: list[Column],
    valid: Column | None = None,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> Manifest:
    """Write the next version: per key the first change under ``order`` replaces the row.

    Rows without a key or failing ``valid`` go to ``rejected`` and never stop the others. The table grows to one
    bucket for each ``rows_per_bucket`` of its rows and changes together, and never shrinks.
    """
    old = read_manifest(spark, root)
    number, run = old.version + 1, uuid.uuid4().hex
    ok = F.col(key).isNotNull() if valid is None else F.col(key).isNotNull() & valid
    good, bad = quarantine(changes, ok)
    bad.write.parquet(f"{root}/rejected/run={run}")
    last = top_n(good, [key], order, 1, "_rn").drop("_rn")
    schema = last.schema
    last.write.parquet(f"{root}/changes/{run}")
    last = spark.read.schema(schema).parquet(f"{root}/changes/{run}")
    buckets = max(old.buckets, -(-(old.rows + last.count()) // rows_per_bucket))
    # At most one row a bucket.
    touched = {r["bucket"] for r in last.select(bucket_in(key, old.buckets)).distinct().collect()}
    touched |= split_sources(old.buckets, buckets)
    paths = old.paths(root, touched)
    rows = last
    if paths:
        rows = last.unionByName(spark.read.schema(schema).parquet(*paths).join(last.select(key), key, "left_anti"))
    placed = rows.withColumn("bucket", bucket_in(key, buckets))
    target = f"{root}/items/{run}"
    (
        placed.repartition(max(len(touched), buckets - old.buckets, 1), "bucket")
        .write.option(f"parquet.bloom.filter.enabled#{key}", "true")
        .option(f"parquet.bloom.filter.expected.ndv#{key}", str(rows_per_bucket))
        .partitionBy("bucket")
        .parquet(target)
    )
    held = {b: at for b, at in old.held.items() if b not in touched}
    if last.head(1) or paths:
        written = spark.read.option("basePath", target).schema(f"`{key}` {schema[key].dataType.simpleString()}, bucket int").parquet(target)
        held |= {r["bucket"]: (run, r["n"]) for r in written.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).collect()}
    made = Manifest(number, buckets, run, held)
    _put_manifest(spark, root, made)
    return made


def read_items(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """The whole table, as of the newest or the given version."""
    paths = read_manifest(spark, root, version).paths(root)
    if not paths:
        raise EmptyTable(f"no rows below {root}/items")
    return spark.read.parquet(*paths)


def lookup(spark: SparkSession, root: str, keys: DataFrame, key: str) -> DataFrame:
    """The rows of ``keys`` (a table with the key column): only the buckets of these keys are opened."""
    manifest = read_manifest(spark, root)
    wanted = keys.select(key).distinct()
    # At most one row a bucket.
    buckets = {r["bucket"] for r in wanted.select(bucket_in(key, manifest.buckets)).distinct().collect()}
    paths = manifest.paths(root, buckets)
    if not paths:
        return read_items(spark, root).where("false")
    rows = spark.read.parquet(*paths)
    few = [r[key] for r in wanted.where(F.col(key).isNotNull()).limit(NAMED_KEYS + 1).collect()]
    if 0 < len(few) <= NAMED_KEYS:
        # Spark turns long IN lists into a range before they reach the files; alternatives go there as they are.
        return rows.where(reduce(or_, [F.col(key) == F.lit(k) for k in few]))
    return rows.join(wanted, key, "left_semi")


def rejected(spark: SparkSession, root: str) -> DataFrame:
    """The rejected rows of all finished upserts."""
    if read_manifest(spark, root).version < 0:
        raise EmptyTable(f"no rows below {root}/rejected")
    made = spark.read.text(f"{root}/manifest/v=*.json", wholetext=True)
    runs = made.select(F.get_json_object("value", "$.run").alias("run"))
    return spark.read.parquet(f"{root}/rejected").join(runs, "run", "left_semi").drop("run")
