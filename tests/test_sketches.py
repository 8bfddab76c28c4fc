from pyspark.sql import functions as F

from clickloom.operators import sketches
from clickloom.sources import writers


def test_merging_in_steps_equals_one_sketch(spark):
    rows = spark.range(60_000).select(
        (F.col("id") % 7).alias("batch"), (F.col("id") % 2).alias("half"), (F.col("id") % 9000).cast("string").alias("v"), F.lit(None).cast("string").alias("none")
    )
    parts = sketches.sketch_parts(rows, ["batch", "half"], ["v", "none"])
    stepped = sketches.merge_parts(sketches.merge_parts(parts, ["half"], ["v", "none"]), [], ["v", "none"])
    got = sketches.estimates(stepped, [], ["v", "none"]).first()
    assert got["rows"] == 60_000 and got["none"] == 0
    assert abs(got["v"] - 9000) <= 4 * sketches.STANDARD_ERROR * 9000
    at_once = sketches.estimates(sketches.sketch_parts(rows, [], ["v", "none"]), [], ["v", "none"]).first()
    assert abs(at_once["v"] - got["v"]) <= 0.01 * 9000


def test_counts_of_a_write(spark, tmp_path):
    rows = spark.range(1000).repartition(5).where("id % 3 = 0")
    assert writers.write_counted(rows, str(tmp_path / "a")) == 334 == spark.read.parquet(str(tmp_path / "a")).count()
    assert writers.write_counted(rows.groupBy((F.col("id") % 4).alias("k")).count(), str(tmp_path / "b")) == 4
    assert writers.write_counted(rows.where("false"), str(tmp_path / "c")) == 0


def test_exact_distinct_counts_copy_no_rows(rows):
    from clickloom.operators import reports

    made = rows([("x", "u1", "a"), ("x", "u1", "b"), ("y", "u1", None), ("y", "u2", "b"), (None, "u3", None)], "source string, user_id string, article_id string")
    counted = reports.distinct_counts(made, "source", ["user_id", "article_id"])
    got = {r["source"]: (r["rows"], r["user_id"], r["article_id"]) for r in counted.collect()}
    assert got == {"x": (2, 1, 2), "y": (2, 2, 1), None: (1, 1, 0), "all": (5, 3, 2)}
    assert "Expand" not in counted._jdf.queryExecution().executedPlan().toString()


def test_sketches_join_the_tables_once(spark):
    from clickloom.registered import users

    plan = users.distinct_sketches(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "Expand" not in plan and "lineitem" not in plan
