"""Top-n per group, global positions, seeded samples and splits."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from clickloom.session import materialise, write_scratch


def top_n(df: DataFrame, keys: list[str], order: list[Column], n: int, rank: str = "rank") -> DataFrame:
    """First ``n`` rows per key. Spark cuts each map partition to ``n`` rows per key before the shuffle,
    so a key that holds most of the table still sends few rows to one task."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= n)


def sort_rows(df: DataFrame, *order: Column) -> DataFrame:
    return df.orderBy(*order)


def head(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    """The first ``n`` rows under a total order."""
    return df.orderBy(*order).limit(n)


def global_index(df: DataFrame, order: list[Column], name: str = "index", start: int = 0) -> DataFrame:
    """Position of each row under a total order, without moving all rows into one task.

    Rows are range-partitioned, sorted and written once; the written partitions get offsets from
    their row counts (one number per partition).
    """
    placed = materialise(df.repartitionByRange(*order).sortWithinPartitions(*order))
    sizes = placed.groupBy(F.spark_partition_id().alias("pid")).agg(F.count(F.lit(1)).alias("n")).collect()
    offsets, total = {}, start
    for row in sorted(sizes, key=lambda r: r["pid"]):
        offsets[row["pid"]] = total
        total += row["n"]
    if not offsets:
        return placed.withColumn(name, F.lit(start).cast("bigint"))
    last = max(offsets)
    text = ",".join(str(offsets.get(pid, 0)) for pid in range(last + 1))
    table = F.split(F.lit(text), ",").cast("array<bigint>")  # one literal, however many partitions
    # The low 33 bits of monotonically_increasing_id count rows inside the partition.
    within = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    return placed.withColumn(name, F.get(table, F.spark_partition_id()) + within)


def seeded_hash(seed: int, *keys: Column) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(str(seed)), *[k.cast("string") for k in keys]), 256)


def sample_exact(df: DataFrame, keys: list[str], n: int, seed: int = 42) -> DataFrame:
    """A repeatable sample of at most ``n`` rows, independent of the table's layout."""
    h = seeded_hash(seed, *[F.col(k) for k in keys])
    return df.orderBy(h, *[F.col(k) for k in keys]).limit(n)


def split_by_hash(df: DataFrame, keys: list[Column], test_share: float = 0.2, seed: int = 42) -> DataFrame:
    """Add ``is_test`` from the row's own hash: no shuffle, sizes right in expectation."""
    limit = format(int(round(test_share * (1 << 32))), "08x") if test_share < 1 else "g"
    return df.withColumn("is_test", F.substring(seeded_hash(seed, *keys), 1, 8) < F.lit(limit))


def _nth_smallest(df: DataFrame, column: str, wanted: int, bits: int, digits: int = 16) -> int:
    """The ``wanted``-th smallest value of a column of numbers of at most ``bits`` bits.

    A histogram over a few leading bits (at most 65,536 rows) finds the bucket the value falls in; the next
    bits are looked at inside that bucket.
    """
    value, left = 0, wanted
    for low in range(bits - digits, -digits, -digits):
        low = max(low, 0)
        known = bits - low - digits
        inside = df if known <= 0 else df.where(F.col(column).between(value, value + (1 << (low + digits)) - 1))
        sizes = inside.groupBy(F.shiftright(column, low).alias("b")).agg(F.count(F.lit(1)).alias("n"))
        through = F.sum("n").over(Window.orderBy("b").rowsBetween(Window.unboundedPreceding, Window.currentRow))
        edge = sizes.withColumn("t", through).where(F.col("t") >= left).orderBy("b").first()
        left -= edge["t"] - edge["n"]
        value = edge["b"] << low
    return value


HASH_BITS = 48


def split_exact(df: DataFrame, keys: list[Column], test_share: float = 0.2, seed: int = 42) -> DataFrame:
    """Add ``is_test`` to exactly ``ceil(share * n)`` rows: those with the smallest hashes.

    ``keys`` must identify a row. The rows are written once with the beginnings of their hashes, which are compared
    with one threshold; whole hashes are worked out again only for rows that tie with it.
    """
    h = seeded_hash(seed, *keys)
    start = F.conv(F.substring(h, 1, HASH_BITS // 4), 16, 10).cast("bigint")
    rows = write_scratch(df.withColumn("_start", start), "split")[0]
    wanted = math.ceil(rows.count() * test_share)
    if wanted == 0:
        return rows.drop("_start").withColumn("is_test", F.lit(False))
    limit = _nth_smallest(rows.select("_start"), "_start", wanted, HASH_BITS)
    tied = rows.where(F.col("_start") <= limit).select(F.count(F.when(F.col("_start") < limit, 1)).alias("below")).first()
    among = rows.where(F.col("_start") == limit).orderBy(h).limit(wanted - tied["below"])
    last = among.agg(F.max(h)).first()[0]
    is_test = (F.col("_start") < limit) | ((F.col("_start") == limit) & (h <= F.lit(last)))
    return rows.withColumn("is_test", is_test).drop("_start")


def ideal_gains(k: int) -> list[float]:
    """Best possible discounted gain for 1..k relevant items."""
    total, out = 0.0, []
    for rank in range(1, k + 1):
        total += 1.0 / math.log2(rank + 1)
        out.append(total)
    return out
