"""File scans, sinks and streams over data derived from the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from clickloom.operators import popularity, recommend
from clickloom.registered import query, tables, users
from clickloom.registered.sql import fill
from clickloom.schemas import BEHAVIOUR, CATALOGUE, POPULARITY_MODEL, USER_LOG
from clickloom.session import work_path
from clickloom.sources import arrays, keyed, readers, writers
from clickloom.streaming import clicks as click_stream
from clickloom.streaming import landing, state


@query(
    "scan_json",
    """SELECT user_id, article_id, category, action, "timestamp", session_id FROM rawlogs""",
)
def scan_json(spark, sf):
    path = work_path(spark, "logs-json")
    writers.write_json_arrays(tables.raw_logs(spark, sf).select(*USER_LOG.names), path)
    return readers.read_json_arrays(spark, path, USER_LOG, "*.txt")


@query("scan_json_lists", """SELECT user_id, article_id, action FROM rawlogs""")
def scan_json_lists(spark, sf):
    path = work_path(spark, "logs-lists")
    writers.write_json_arrays(tables.raw_logs(spark, sf).select(*USER_LOG.names), path)
    records, _ = arrays.read_ranges(spark, path, USER_LOG, "*.txt")
    return records.select("user_id", "article_id", "action")


@query(
    "scan_tsv",
    """SELECT 'mapping' AS part, news_id AS id, nullif(trim(coalesce(url, '')), '') AS value FROM cat
 UNION ALL SELECT 'behaviour', CAST(event_id AS VARCHAR), nullif(impressions, '') FROM
 (SELECT event_id, CASE event_type WHEN 'click' THEN 'N' || k || '-1 N' || (k + 1) || '-0' WHEN 'view' THEN 'N' || k || '-0  N' || (k + 1) || '-1'
  WHEN 'purchase' THEN 'N' || k || '-1 N' || (k + 7) || '-5' WHEN 'signup' THEN 'N' || k ELSE '' END AS impressions
 FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events))""",
)
def scan_tsv(spark, sf):
    path = work_path(spark, "tsv")
    for name, df in (("news", tables.catalogue(spark, sf)), ("behaviours", tables.raw_behaviours(spark, sf))):
        df.write.mode("overwrite").option("sep", "\t").option("emptyValue", "").csv(f"{path}/{name}")
    mapping = readers.read_existing_tsv(spark, [f"{path}/news", f"{path}/absent"], CATALOGUE, ["news_id", "url"])
    shown = readers.read_tsv(spark, f"{path}/behaviours", BEHAVIOUR)
    a = mapping.select(F.lit("mapping").alias("part"), F.col("news_id").alias("id"), F.nullif(F.trim("url"), F.lit("")).alias("value"))
    b = shown.select(F.lit("behaviour").alias("part"), F.col("impression_id").alias("id"), F.col("impressions").alias("value"))
    return a.unionByName(b)


@query("scan_parquet", "SELECT doc_id, lang, n_chars FROM documents")
def scan_parquet(spark, sf):
    return readers.read_table(spark, f"{sf}/documents.parquet").select("doc_id", "lang", "n_chars")


@query("sink_parquet", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders")
def sink_parquet(spark, sf):
    path = work_path(spark, "orders")
    rows = tables.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    writers.overwrite(rows, path, ["o_orderstatus"])
    return spark.read.parquet(path).select(*rows.columns)


_BALANCES = """SELECT c_custkey, c_name, balance, rejected FROM (SELECT c_custkey, c_name, c_nationkey, c_acctbal + coalesce(o_totalprice, 0) AS balance,
  row_number() OVER (PARTITION BY c_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM customer
  LEFT JOIN (SELECT * FROM orders WHERE o_orderstatus <> 'P') ON o_custkey = c_custkey) CROSS JOIN (SELECT count(*) AS rejected FROM orders WHERE o_orderstatus = 'P') WHERE rn = 1"""


def _balances(spark, sf):
    """Customers as the first rows of a keyed table, and their orders as changes to it."""
    customers = tables.table(spark, sf, "customer").select("c_custkey", "c_name", F.col("c_acctbal").alias("balance"))
    blank = customers.withColumns({"o_orderkey": F.lit(0).cast("bigint"), "o_orderdate": F.lit(None).cast("timestamp"), "o_orderstatus": F.lit("")})
    orders = tables.table(spark, sf, "orders").withColumnRenamed("o_custkey", "c_custkey")
    changes = orders.join(customers, "c_custkey").select(
        "c_custkey", "c_name", (F.col("balance") + F.col("o_totalprice")).alias("balance"), "o_orderkey", F.col("o_orderdate").cast("timestamp").alias("o_orderdate"), "o_orderstatus"
    )
    return blank, changes


def _newest_order():
    return [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()], F.col("o_orderstatus") != "P"


@query("upsert_versions", _BALANCES)
def upsert_versions(spark, sf):
    root = work_path(spark, "balances")
    blank, changes = _balances(spark, sf)
    at, valid = _newest_order()
    writers.upsert_version(spark, root, blank, "c_custkey", at, valid)
    _, rejected = writers.upsert_version(spark, root, changes, "c_custkey", at, valid)
    return writers.read_items(spark, root).select("c_custkey", "c_name", "balance", F.lit(rejected).cast("bigint").alias("rejected"))


# Small, so that the given tables fill several buckets and split some.
_PER_BUCKET = 1_000


def _grown(spark, sf):
    """A keyed table that starts with half of the customers and grows by the rest and by orders."""
    root = work_path(spark, "keyed")
    blank, changes = _balances(spark, sf)
    at, valid = _newest_order()
    half = F.col("c_custkey") % 2 == 0
    for part in (blank.where(half), blank.where(~half), changes):
        keyed.upsert(spark, root, part, "c_custkey", at, valid, _PER_BUCKET)
    rejected = keyed.rejected(spark, root).count()
    return root, F.lit(rejected).cast("bigint").alias("rejected")


@query("keyed_upserts", _BALANCES)
def keyed_upserts(spark, sf):
    root, rejected = _grown(spark, sf)
    return keyed.read_items(spark, root).select("c_custkey", "c_name", "balance", rejected)


@query("keyed_lookup", f"{_BALANCES} AND c_nationkey = 3")
def keyed_lookup(spark, sf):
    root, rejected = _grown(spark, sf)
    wanted = tables.table(spark, sf, "customer").where("c_nationkey = 3").select("c_custkey")
    return keyed.lookup(spark, root, wanted, "c_custkey").select("c_custkey", "c_name", "balance", rejected)


_COLUMNS = "article_id, url, title, abstract, content, category, source, pub_date, fetched_at, data_source"


@query("stream_landing", f"SELECT {_COLUMNS}, CAST(1 AS BIGINT) AS broken_files FROM livededup")
def stream_landing(spark, sf):
    root = work_path(spark, "landing")
    source = f"{root}/incoming"
    writers.write_json_arrays(tables.live_articles(spark, sf).repartition(4), source)
    spark.createDataFrame([("no record",)], "value string").write.mode("append").text(source)
    landing.land_articles(spark, source, root, files_per_batch=2, pattern="*.txt")
    broken = landing.rejected_files(spark, root).count()
    return landing.landed_articles(spark, root).withColumn("broken_files", F.lit(broken).cast("bigint"))


def _click_files(spark, sf, root):
    path = f"{root}/incoming"
    tables.document_clicks(spark, sf).repartition(4, "event_id").write.mode("overwrite").option(
        "timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
    ).json(path)
    return path


@query("stream_profile_update", users.PROFILE_SQL)
def stream_profile_update(spark, sf):
    root = work_path(spark, "clicks")
    click_stream.start_from(users.starting_profiles(spark, sf), root)
    click_stream.fold_clicks(spark, _click_files(spark, sf, root), users.known_articles(spark, sf), root, files_per_batch=2)
    click_stream.compact(spark, root, 0)
    return users.show_profiles(click_stream.read_profiles(spark, root))


@query("stream_state_profiles", users.PROFILE_SQL)
def stream_state_profiles(spark, sf):
    """As ``stream_profile_update``, held in the state store and read back from there."""
    root = work_path(spark, "state")
    state.start_from(users.starting_profiles(spark, sf), root)
    state.fold_clicks(spark, _click_files(spark, sf, root), users.known_articles(spark, sf), root, files_per_batch=2)
    return users.show_profiles(state.profiles_in_state(spark, root))


_LABELLED = "(SELECT * FROM dclicks WHERE article_id IN (SELECT CAST(doc_id AS VARCHAR) FROM labels))"
_LATEST = f"""(SELECT user_id, article_id FROM (SELECT user_id, article_id, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC, article_id) AS rn
 FROM (SELECT user_id, article_id, max(ts) AS ts, arg_max(event_id, ts) AS event_id FROM {_LABELLED} GROUP BY ALL)) WHERE rn <= 20)"""


@query(
    "refresh_recommendations",
    f"SELECT user_id, article_id, rank FROM ({fill(f'(SELECT DISTINCT user_id, 10 AS k FROM {_LABELLED})', None, _LATEST, 'dpop')})",
)
def refresh_recommendations(spark, sf):
    """New lists for the users of each batch; after the last batch every user has a list for all clicks."""
    root = work_path(spark, "refresh")
    ranking = popularity.popularity_ranking(tables.document_clicks(spark, sf))

    def refresh(touched, profiles):
        requests = recommend.clean_requests(touched.withColumn("k", F.lit(10)))
        return recommend.recommend_for_requests(requests, profiles, POPULARITY_MODEL, ranking)

    path = f"{root}/incoming"
    clicks = tables.document_clicks(spark, sf)
    # All clicks of a user lie in one file, so each user's list is written by the batch with all of them.
    clicks.repartition(2, "user_id").write.mode("overwrite").option(
        "timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
    ).json(path)
    click_stream.fold_clicks(spark, path, users.known_articles(spark, sf), root, files_per_batch=1, refresh=refresh)
    return click_stream.current_recommendations(spark, root).select("user_id", "article_id", "rank")
