"""Session settings and the shared work folder used to cut lineage."""

from __future__ import annotations

import gc
import os
import tempfile
import uuid
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

_LOCAL_ROOTS: dict[str, str] = {}
_SHIPPED: set[str] = set()


def local_session(cores: str | int = "*", app: str = "clickloom", partitions: int = 8) -> SparkSession:
    """A session for tests and benchmarks. Clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("CLICKLOOM_DRIVER_MEMORY", "12g"))
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


def work_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``. Only a local master may fall back
    to a temporary folder, because there every task runs on this machine.
    """
    sc = spark.sparkContext
    ship(spark)
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = _LOCAL_ROOTS.get(sc.applicationId)
    if not root:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        root = tempfile.mkdtemp(prefix="clickloom-")
        _LOCAL_ROOTS[sc.applicationId] = root
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root


def work_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared work folder."""
    return f"{work_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and cut its lineage.

    The rows survive the loss of executors, and partition numbers stay fixed.
    """
    work_root(df.sparkSession)
    return df.checkpoint(eager=True)


def write_scratch(df: DataFrame, label: str, plain: bool = False) -> tuple[DataFrame, str]:
    """``df`` written below the work folder and read back, and where it lies, for ``discard``. A checkpoint stays for
    good and is several times as large. ``plain`` is for numbers that do not compress."""
    path = work_path(df.sparkSession, label)
    options = {"parquet.enable.dictionary": "false", "compression": "none"} if plain else {}
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, *paths: str) -> None:
    """Remove folders that ``write_scratch`` made once nothing reads them, and have used shuffles removed."""
    for path in paths:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
    release(spark)


def spread(df: DataFrame, *keys: str, rows: int | None = None, rows_per_part: int = 20_000) -> DataFrame:
    """Spread rows by key before costly per-row work. The fixed number keeps small parts from being merged;
    with ``rows`` given, the number follows the size of the table."""
    spark = df.sparkSession
    ship(spark)
    parts = spark.sparkContext.defaultParallelism
    if rows is None:
        parts = max(parts, int(spark.conf.get("spark.sql.shuffle.partitions")))
    else:
        parts = max(parts, -(-rows // rows_per_part))
    return df.repartition(parts, *keys)


def use_all_cores(df: DataFrame) -> DataFrame:
    """``df``, read from tables, ready for costly work on each row: a table too small to be read in as many parts
    as there are cores is dealt out first. A large one is left where it lies."""
    spark = df.sparkSession
    part = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    cores = spark.sparkContext.defaultParallelism
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return df.repartition(cores) if int(str(size)) < cores * part else df


def release(spark: SparkSession) -> None:
    """Have the files of shuffles and checkpoints that nothing refers to any more removed.

    Spark's cleaner learns of them when the driver collects garbage, which a job of many small rounds does
    too seldom: until then their files and the driver's native buffers stay.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


BUCKETS = 64


def bucket_of(key: str, buckets: int = BUCKETS) -> Column:
    """The bucket that a keyed table keeps a row in."""
    return F.pmod(F.xxhash64(F.col(key)), F.lit(buckets)).cast("int").alias("bucket")


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application, so that they can import it."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="clickloom-"), "clickloom.zip")
    with zipfile.ZipFile(target, "w") as z:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(root)))
    sc.addPyFile(target)
    _SHIPPED.add(sc.applicationId)
