import random

import pytest
from pyspark.sql import functions as F

from clickloom.schemas import EmptyTable
from clickloom.sources import keyed

SCHEMA = "k string, v int, at int"

def write(spark, root, data, **more):
    return keyed.upsert(spark, root, spark.createDataFrame(data, SCHEMA), "k", [F.col("at").desc()], F.col("v") >= 0, **more)


def held(spark, root, version=None):
    return {r["k"]: r["v"] for r in keyed.read_items(spark, root, version).collect()}


def test_growing_moves_rows_only_out_of_split_buckets(spark):
    rows = spark.range(3000).withColumns({f"b{m}": keyed.bucket_in("id", m) for m in (1, 2, 3, 5, 8, 11, 64)}).collect()
    sizes = (1, 2, 3, 5, 8, 11, 64)
    for before, after in [(a, b) for a in sizes for b in sizes if a < b]:
        sources = keyed.split_sources(before, after)
        for r in rows:
            x, y = r[f"b{before}"], r[f"b{after}"]
            assert 0 <= y < after and (x == y or (y >= before and x in sources))
    assert {r["b64"] for r in rows} == set(range(64))


def test_table_grows_from_one_to_64_buckets(spark, tmp_path):
    rng = random.Random(5)
    root, want, seen = str(tmp_path / "t"), {}, []
    for step, size in enumerate((10, 60, 200, 700, 700)):
        data = [(f"k{rng.randrange(1500)}", rng.randrange(100), step) for _ in range(size)]
        data = list({d[0]: d for d in data}.values())
        made = write(spark, root, data, rows_per_bucket=15)
        want |= {k: v for k, v, _ in data}
        seen.append(made.buckets)
        assert held(spark, root) == want and made.rows == len(want)
    assert seen[0] == 1 and seen == sorted(seen) and seen[-1] >= 64
    assert len(held(spark, root, 0)) <= 10


def test_an_upsert_rewrites_only_its_buckets(spark, tmp_path):
    root = str(tmp_path / "t")
    write(spark, root, [(f"k{i}", i, 0) for i in range(400)], rows_per_bucket=10)
    made = write(spark, root, [("k1", 7, 1)], rows_per_bucket=20)
    assert sum(run == made.run for run, _ in made.held.values()) == 1 and made.buckets == 40
    assert held(spark, root) == {f"k{i}": i for i in range(400)} | {"k1": 7}


def test_lookups_open_few_files(spark, tmp_path):
    root = str(tmp_path / "t")
    made = write(spark, root, [(f"k{i:05}", i, 0) for i in range(4000)], rows_per_bucket=50)
    keys = spark.createDataFrame([("k00003",), ("k00777",), ("gone",), (None,), ("k00003",)], "k string")
    got = keyed.lookup(spark, root, keys, "k")
    assert len(got.inputFiles()) <= 4 < made.buckets == 80
    assert sorted(r["v"] for r in got.collect()) == [3, 777]
    many = spark.range(0, 600).select(F.format_string("k%05d", "id").alias("k"))
    assert sorted(r["v"] for r in keyed.lookup(spark, root, many, "k").collect()) == list(range(600))
    assert keyed.lookup(spark, root, keys.where("k IS NULL"), "k").count() == 0


def scanned(df):
    """Rows that the scans of a finished query gave out."""
    plan = df._jdf.queryExecution().executedPlan()
    plan = plan.executedPlan() if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec" else plan
    leaves = plan.collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def test_lookups_skip_files_without_the_key(spark, tmp_path):
    """The absent key lies between the keys of its bucket, so that smallest and largest values cannot exclude it."""
    root = str(tmp_path / "t")
    write(spark, root, [(f"k{i:05}", i, 0) for i in range(3000)], rows_per_bucket=3000)
    absent = keyed.lookup(spark, root, spark.createDataFrame([("k01500x",)], "k string"), "k")
    there = keyed.lookup(spark, root, spark.createDataFrame([("k01500",)], "k string"), "k")
    assert absent.collect() == [] and there.count() == 1
    assert scanned(absent) == 0


def test_rejects_nulls_repeats_and_empty_changes(spark, tmp_path):
    root = str(tmp_path / "t")
    with pytest.raises(EmptyTable):
        keyed.read_items(spark, root)
    assert write(spark, root, []).rows == 0
    write(spark, root, [("a", 1, 1), ("a", 2, 2), (None, 5, 1), ("b", -1, 1), ("c", None, 1)])
    assert held(spark, root) == {"a": 2} and keyed.rejected(spark, root).count() == 3
    assert write(spark, root, []).rows == 1 and held(spark, root) == {"a": 2}


def test_a_broken_write_leaves_the_table_and_a_taken_version_is_an_error(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "t")
    write(spark, root, [("a", 1, 1)])

    def fail(*_):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(keyed, "_put_manifest", fail)
        with pytest.raises(OSError):
            write(spark, root, [("a", 9, 2), ("b", 9, 2), (None, 1, 1)])
    assert held(spark, root) == {"a": 1}
    made = write(spark, root, [("b", 3, 2), (None, 1, 1)])
    assert keyed.rejected(spark, root).count() == 1
    assert held(spark, root) == {"a": 1, "b": 3}
    with pytest.raises(keyed.VersionTaken):
        keyed._put_manifest(spark, root, made)
