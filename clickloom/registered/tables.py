"""Domain tables derived from the given TPC-H-like, event and document tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from clickloom.functions.ids import catalogue_article_id
from clickloom.schemas import IMPRESSION_CLICK, LOG_CLICK

# Part types stand in for article categories; the sixth lies outside the fixed list.
PART_CATEGORIES = {
    "ECONOMY": "business",
    "SMALL": "entertainment",
    "MEDIUM": "technology",
    "LARGE": "health",
    "STANDARD": "science",
    "PROMO": "sports",
}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _category(p_type: Column) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for kv in PART_CATEGORIES.items() for x in kv]), p_type)


def interactions(spark: SparkSession, sf: str) -> DataFrame:
    """Order lines as clicks of customers on parts."""
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_shipdate", "l_linestatus")
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    parts = table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_type")
    return (
        lines.join(orders, "l_orderkey")
        .join(parts, "l_partkey")
        .select(
            F.col("o_custkey").cast("string").alias("user_id"),
            F.col("l_partkey").cast("string").alias("article_id"),
            _category(F.col("p_type")).alias("category"),
            F.col("l_shipdate").cast("timestamp").alias("timestamp"),
            F.when(F.col("l_linestatus") == "F", IMPRESSION_CLICK).otherwise(LOG_CLICK).alias("source"),
        )
    )


def distinct_interactions(spark: SparkSession, sf: str) -> DataFrame:
    columns = ["user_id", "article_id", "timestamp", "source"]
    return interactions(spark, sf).select(*columns).dropDuplicates(columns)


def catalogue(spark: SparkSession, sf: str) -> DataFrame:
    """Parts as raw catalogue rows, some without a url."""
    url = (
        F.when(F.col("p_size") < 8, F.lit(None))
        .when(F.col("p_size") < 12, F.lit("  "))
        .otherwise(F.concat(F.lit("https://Parts.example.com/"), F.replace("p_name", F.lit(" "), F.lit("-")), F.lit("/"), F.col("p_size").cast("string")))
    )
    return table(spark, sf, "part").select(
        F.concat(F.lit("N"), F.col("p_partkey").cast("string")).alias("news_id"),
        F.upper(_category(F.col("p_type"))).alias("category"),
        F.col("p_brand").alias("subcategory"),
        F.col("p_name").alias("title"),
        F.concat_ws(" ", "p_name", "p_brand", "p_type").alias("abstract"),
        url.alias("url"),
        F.lit("[]").alias("title_entities"),
        F.lit("[]").alias("abstract_entities"),
    )


def live_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as landed articles with a nested source, missing and blank urls, and their number."""
    title = F.split_part("text", F.lit("\n"), F.lit(1))
    lang = F.col("lang")

    def day(c: str) -> Column:
        return F.lpad((F.lit(1) + F.col(c) % 28).cast("string"), 2, "0")

    return table(spark, sf, "documents").select(
        "doc_id",
        F.struct(
            F.col("source").alias("id"), F.when(F.col("source") != "src3", F.col("source")).alias("name")
        ).alias("source"),
        title.alias("title"),
        F.when(lang == "en", "")
        .when(lang == "fr", "  ")
        .when(lang != "es", F.concat(title, F.lit(".")))
        .alias("description"),
        F.col("text").alias("content"),
        F.when(lang == "es", "  ")
        .when(lang != "de", F.concat(F.lit(" https://News.example.com/"), F.md5("text"), F.lit(" ")))
        .alias("url"),
        F.concat(F.lit("2024-01-"), day("n_chars"), F.lit("T00:00:00Z")).alias("publishedAt"),
        F.when(lang != "fr", F.upper("lang")).alias("category"),
        F.concat(F.lit("2024-02-"), day("doc_id"), F.lit("T06:00:00+00:00")).alias("fetched_at"),
    )


def live_articles(spark: SparkSession, sf: str) -> DataFrame:
    return live_documents(spark, sf).drop("doc_id")


def _k() -> Column:
    return F.get_json_object("props", "$.k").cast("bigint")


def raw_logs(spark: SparkSession, sf: str) -> DataFrame:
    """Events as raw log records on catalogue articles, with nulls and mixed case."""
    parts = catalogue(spark, sf).select(
        F.substring("news_id", 2, 20).cast("bigint").alias("k"),
        catalogue_article_id(F.col("url"), F.col("news_id")).alias("article_id"),
        F.initcap("category").alias("category"),
    )
    kind = F.col("event_type")
    return (
        table(spark, sf, "events")
        .withColumn("k", _k())
        .join(parts, "k")
        .select(
            F.when(kind != "error", F.concat(F.lit("U"), F.col("user_id").cast("string"))).alias("user_id"),
            "article_id",
            F.when(kind != "signup", F.col("category")).alias("category"),
            F.when((kind == "click") & (F.col("value") > 10), "Click").when(kind != "purchase", kind).alias("action"),
            F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00")).alias("timestamp"),
            F.col("event_id").cast("string").alias("session_id"),
        )
    )


def raw_behaviours(spark: SparkSession, sf: str) -> DataFrame:
    """Events as raw behaviour records, with odd labels, double blanks and empty lists."""
    kind, k = F.col("event_type"), F.col("k")
    item = lambda n, label: F.concat(F.lit("N"), (k + n).cast("string"), F.lit(label))
    return (
        table(spark, sf, "events")
        .withColumn("k", _k())
        .select(
            F.col("event_id").cast("string").alias("impression_id"),
            F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("user_id"),
            F.date_format("ts", "M/d/yyyy h:mm:ss a").alias("time"),
            item(0, "").alias("history"),
            F.when(kind == "click", F.concat(item(0, "-1"), F.lit(" "), item(1, "-0")))
            .when(kind == "view", F.concat(item(0, "-0"), F.lit("  "), item(1, "-1")))
            .when(kind == "purchase", F.concat(item(0, "-1"), F.lit(" "), item(7, "-5")))
            .when(kind == "signup", item(0, ""))
            .when(F.col("value") > 10, "")
            .alias("impressions"),
        )
    )


def document_clicks(spark: SparkSession, sf: str) -> DataFrame:
    """Click events on the item named in their properties."""
    return (
        table(spark, sf, "events")
        .where(F.col("event_type") == "click")
        .select(F.col("user_id").cast("string").alias("user_id"), _k().cast("string").alias("article_id"), "event_id", F.col("ts").cast("timestamp").alias("ts"))
    )


def document_texts(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("article_id"), "text")


def vectors(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "embeddings").select(F.col("vec_id").cast("string").alias("article_id"), "embedding")
