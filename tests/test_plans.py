"""Plans must keep the shape that lets them run on large, skewed tables."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from clickloom.operators import interactions as inter, popularity, vectors
from clickloom.registered import tables

SF = "/root/testdata/sf0.001"


def plan(df):
    text = df._jdf.queryExecution().toString()
    return text[text.index("== Physical Plan") :]


@pytest.mark.parametrize("name", ["recent_clicks", "dedup_latest", "build_articles", "seed_items", "conditional_dedup"])
def test_top_n_is_cut_before_the_shuffle(spark, name):
    text = plan(entry.queries()[name](spark, SF))
    assert re.search(r"WindowGroupLimit.*Partial", text)


@pytest.mark.parametrize("name", ["category_pivot", "pair_weights", "user_histories", "counts_by_source"])
def test_counts_are_partial_and_shuffle_once(spark, name):
    text = plan(entry.queries()[name](spark, SF))
    assert "partial_count" in text and text.count("Exchange hashpartitioning") == 1


def test_vectors_reuse_the_user_partitioning(spark):
    text = plan(entry.queries()["user_vectors"](spark, SF))
    assert text.count("Exchange hashpartitioning") == 2


@pytest.mark.parametrize("name", ["standardise_articles", "content_id", "article_text", "safe_casts", "scalar_functions"])
def test_projections_do_not_shuffle(spark, name):
    assert "Exchange" not in plan(entry.queries()[name](spark, SF))


def test_scans_read_needed_columns_and_push_filters(spark):
    text = plan(tables.document_clicks(spark, SF))
    assert "EqualTo(event_type,click)" in text and "value" not in re.search(r"ReadSchema: (.*)", text).group(1)
    text = plan(tables.interactions(spark, SF).groupBy("article_id").count())
    assert "l_extendedprice" not in text


@pytest.mark.parametrize("name", ["build_interactions", "recommend_popular", "recommend_item_knn", "text_knn", "exclude_seen"])
def test_no_cross_joins(spark, name):
    text = plan(entry.queries()[name](spark, SF))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_hot_keys_give_whole_results(spark):
    """One user and one article hold a third of all clicks."""
    n = 9000
    clicks = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("u"), (F.col("id") % 50).cast("string"))).alias("user_id"),
        F.when(F.col("id") % 3 == 1, "a0").otherwise(F.concat(F.lit("a"), F.col("id").cast("string"))).alias("article_id"),
        F.lit("health").alias("category"),
        F.timestamp_seconds("id").alias("event_time"),
    )
    made = {r["user_id"]: r for r in vectors.user_vectors(clicks, [F.col("event_time").desc(), F.col("article_id")]).collect()}
    assert made["hot"]["health"] == n // 3 and made["hot"]["recent_clicks"][0] == f"a{n - 3}"
    assert sum(r["total_clicks"] for r in made.values()) == n
    ranking = popularity.popularity_ranking(clicks)
    assert ranking.orderBy("pop_rank").first()["article_id"] == "a0"
    users = clicks.select("user_id").distinct().withColumn("k", F.lit(20))
    recs = popularity.recommend_popular(users, inter.seen_pairs(clicks), ranking)
    assert recs.groupBy("user_id").count().where("count = 20").count() == users.count()
    assert recs.join(clicks, ["user_id", "article_id"], "left_semi").count() == 0


def test_articles_are_built_in_one_shuffle(spark):
    text = plan(entry.queries()["build_articles"](spark, SF))
    assert text.count("Exchange hashpartitioning") == 1 and text.count("FileScan") == 2


def test_articles_are_written_once_for_their_uses(spark):
    text = plan(entry.queries()["training_articles"](spark, SF))
    assert "WindowGroupLimit" not in text.split("Scan ExistingRDD")[0] or "documents.parquet" not in text
