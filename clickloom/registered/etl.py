"""Article cleaning, ids, deduplication and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from clickloom.functions import casts, collections as coll, ids
from clickloom.functions.text import strip, text_or
from clickloom.operators import cleaning, dedup, encoding, impressions, ordering, reports
from clickloom.plans import embedding
from clickloom.plans.articles import build_articles
from clickloom.registered import query, tables
from clickloom.registered.sql import first_row, strip as sql_strip
from clickloom.schemas import SOURCE_LABELS
from clickloom.session import work_path
from clickloom.sources import writers

_COLUMNS = "article_id, url, title, abstract, content, category, source, pub_date, fetched_at, data_source"


@query("flatten_source", "SELECT doc_id, coalesce(source_name, '') AS source_name FROM live")
def flatten_source(spark, sf):
    docs = tables.live_documents(spark, sf).select("doc_id", "source")
    return cleaning.flatten_source(docs).select("doc_id", text_or(F.col("source_name")).alias("source_name"))


@query(
    "struct_to_json",
    """SELECT doc_id, CASE WHEN source <> 'src3' THEN '{"id":"' || source || '","name":"' || source || '"}'
 ELSE '{"id":"' || source || '"}' END AS source_json FROM documents""",
)
def struct_to_json(spark, sf):
    return cleaning.source_as_json(tables.live_documents(spark, sf).select("doc_id", "source"))


@query("standardise_articles", f"SELECT {_COLUMNS} FROM livestd UNION ALL SELECT {_COLUMNS} FROM catstd")
def standardise_articles(spark, sf):
    live = cleaning.standardise_live(cleaning.flatten_source(tables.live_articles(spark, sf)))
    return live.unionByName(cleaning.standardise_catalogue(tables.catalogue(spark, sf)))


@query(
    "content_id",
    f"""SELECT page_id, sha256(lower(coalesce(nullif(trim(u), ''), concat_ws('||', html, '', lang)))) AS live_id,
 sha256(lower(coalesce(trim(u), concat_ws('||', html, '', lang)))) AS blank_kept_id,
 sha256(lower(coalesce(nullif({sql_strip('u')}, ''), nullif({sql_strip("'P' || page_id")}, '')))) AS catalogue_id,
 sha256(coalesce(nullif({sql_strip('u')}, ''), concat_ws('||', {sql_strip('html')}, lang, ''))) AS embedding_id
 FROM (SELECT page_id, html, CASE WHEN url LIKE 'http://%' THEN NULL WHEN url LIKE '%#top' THEN ' ' ELSE ' ' || upper(url) END AS u,
  CASE WHEN url LIKE '%/en/%' THEN 'en' ELSE 'other' END AS lang FROM pages)""",
)
def content_id(spark, sf):
    url = F.col("url")
    pages = tables.table(spark, sf, "pages").select(
        "page_id",
        "html",
        F.when(url.startswith("http://"), F.lit(None)).when(url.endswith("#top"), " ").otherwise(F.concat(F.lit(" "), F.upper(url))).alias("u"),
        F.when(url.contains("/en/"), "en").otherwise("other").alias("lang"),
    )
    u, html, lang, none = F.col("u"), F.col("html"), F.col("lang"), F.lit("")
    return pages.select(
        "page_id",
        ids.live_article_id(u, html, none, lang).alias("live_id"),
        ids.live_article_id(u, html, none, lang, blank_is_missing=False).alias("blank_kept_id"),
        ids.catalogue_article_id(u, F.concat(F.lit("P"), F.col("page_id").cast("string")), strip).alias("catalogue_id"),
        ids.embedding_article_id(u, html, lang, none).alias("embedding_id"),
    )


@query("dedup_latest", f"SELECT {_COLUMNS} FROM livededup")
def dedup_latest(spark, sf):
    return dedup.latest_articles(cleaning.standardise_live(cleaning.flatten_source(tables.live_articles(spark, sf))))


@query("dedup_deterministic", f"SELECT {_COLUMNS} FROM catdedup")
def dedup_deterministic(spark, sf):
    return dedup.first_by_id(cleaning.standardise_catalogue(tables.catalogue(spark, sf)))


@query(
    "dedup_cross_source",
    first_row(
        """(SELECT * FROM livestd UNION ALL SELECT sha256(lower(text)) AS article_id, 'https://News.example.com/' || md5(text) AS url,
 '' AS title, '' AS abstract, text AS content, 'general' AS category, role AS source, '' AS pub_date, '' AS fetched_at, 'mind' AS data_source FROM conversations)""",
        "fetched_at DESC NULLS LAST, pub_date DESC NULLS LAST, data_source DESC",
    ),
)
def dedup_cross_source(spark, sf):
    live = cleaning.standardise_live(cleaning.flatten_source(tables.live_articles(spark, sf)))
    blank = F.lit("")
    talk = tables.table(spark, sf, "conversations").select(
        ids.hashed_id(F.col("text")).alias("article_id"),
        F.concat(F.lit("https://News.example.com/"), F.md5("text")).alias("url"),
        blank.alias("title"),
        blank.alias("abstract"),
        F.col("text").alias("content"),
        F.lit("general").alias("category"),
        F.col("role").alias("source"),
        blank.alias("pub_date"),
        blank.alias("fetched_at"),
        F.lit("mind").alias("data_source"),
    )
    return dedup.latest_across_sources(live.unionByName(talk))


@query("build_articles", f"SELECT {_COLUMNS} FROM articles")
def build_articles_query(spark, sf):
    return build_articles(tables.live_articles(spark, sf), tables.catalogue(spark, sf))


@query(
    "distinct_subset",
    """SELECT l_orderkey, l_linenumber, min(l_partkey) AS l_partkey FROM lineitem GROUP BY ALL""",
)
def distinct_subset(spark, sf):
    lines = tables.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return dedup.distinct_on(lines, ["l_orderkey", "l_linenumber"])


@query(
    "conditional_dedup",
    """SELECT page_id, u FROM (SELECT page_id, u, row_number() OVER (PARTITION BY CASE WHEN trim(u) <> '' THEN trim(u) ELSE 'row ' || page_id END ORDER BY page_id) AS rn
 FROM (SELECT page_id, CASE WHEN url LIKE '%#top' THEN ' ' ELSE regexp_replace(url, '/[^/]*$', '') END AS u FROM pages)) WHERE rn = 1""",
)
def conditional_dedup(spark, sf):
    u = F.when(F.col("url").endswith("#top"), " ").otherwise(F.regexp_replace("url", "/[^/]*$", ""))
    return dedup.dedup_where_present(tables.table(spark, sf, "pages").select("page_id", u.alias("u")), "u", "page_id")


@query(
    "upsert_by_key",
    """SELECT c_custkey, c_name, balance FROM (SELECT c_custkey, c_name, c_acctbal + coalesce(o_totalprice, 0) AS balance,
  row_number() OVER (PARTITION BY c_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM customer LEFT JOIN orders ON o_custkey = c_custkey) WHERE rn = 1""",
)
def upsert_by_key(spark, sf):
    customers = tables.table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")
    orders = tables.table(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_orderdate", "o_totalprice")
    snapshot = customers.select("c_custkey", "c_name", F.col("c_acctbal").alias("balance"))
    changes = orders.join(customers, "c_custkey").withColumn("balance", F.col("c_acctbal") + F.col("o_totalprice"))
    return dedup.upsert(snapshot, changes, "c_custkey", [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()])


@query(
    "article_text",
    f"""SELECT doc_id, sha256({sql_strip("concat_ws(' ', " + sql_strip("title") + ", coalesce(nullif(" + sql_strip("description") + ", ''), " + sql_strip("content") + "))")}) AS embedding_text,
 sha256({sql_strip("title || ' ' || coalesce(description, '')")}) AS model_text FROM
 (SELECT doc_id, split_part(text, chr(10), 1) AS title, CASE lang WHEN 'en' THEN '' WHEN 'fr' THEN '  ' WHEN 'es' THEN NULL ELSE split_part(text, chr(10), 1) || '.' END AS description, text AS content FROM documents)
 WHERE {sql_strip('title')} <> ''""",
)
def article_text(spark, sf):
    docs = cleaning.drop_blank(tables.live_documents(spark, sf), "title")
    docs = cleaning.embedding_text(docs).withColumn("abstract", F.col("description"))
    docs = cleaning.model_text(docs)
    return docs.select("doc_id", F.sha2("embedding_text", 256).alias("embedding_text"), F.sha2("text", 256).alias("model_text"))


@query(
    "source_labels",
    """SELECT doc_id, CASE s WHEN 'newsapi' THEN 'Live News' WHEN 'mind' THEN 'MIND Dataset' WHEN 'unknown' THEN 'Unknown' ELSE s END AS label
 FROM (SELECT doc_id, CASE lang WHEN 'en' THEN 'newsapi' WHEN 'fr' THEN 'mind' WHEN 'de' THEN 'unknown' ELSE source END AS s FROM documents)""",
)
def source_labels(spark, sf):
    lang = F.col("lang")
    s = F.when(lang == "en", "newsapi").when(lang == "fr", "mind").when(lang == "de", "unknown").otherwise(F.col("source"))
    return tables.table(spark, sf, "documents").select("doc_id", cleaning.label_sources(s, SOURCE_LABELS).alias("label"))


@query(
    "duplicate_report",
    f"""SELECT 'documents' AS origin, count(*) - count(DISTINCT CAST(doc_id AS VARCHAR)) AS dup_ids,
  count(*) - count(DISTINCT nullif(lower({sql_strip('text')}), '')) AS dup_titles, count(*) - count(DISTINCT nullif(lower({sql_strip('source')}), '')) AS dup_urls FROM documents
 UNION ALL SELECT 'pages', count(*) - count(DISTINCT CAST(page_id AS VARCHAR)), count(*) - count(DISTINCT nullif(lower({sql_strip('html')}), '')),
  count(*) - count(DISTINCT nullif(lower({sql_strip('url')}), '')) FROM pages""",
)
def duplicate_report(spark, sf):
    lowered = ["dup_titles", "dup_urls"]
    docs = tables.table(spark, sf, "documents")
    pages = tables.table(spark, sf, "pages")
    a = reports.duplicate_report(docs, {"dup_ids": "doc_id", "dup_titles": "text", "dup_urls": "source"}, lowered)
    b = reports.duplicate_report(pages, {"dup_ids": "page_id", "dup_titles": "html", "dup_urls": "url"}, lowered)
    return a.withColumn("origin", F.lit("documents")).unionByName(b.withColumn("origin", F.lit("pages")))


@query(
    "stage_counts",
    """SELECT 'landed' AS stage, count(*) AS "rows" FROM livestd UNION ALL SELECT 'landed_unique', count(*) FROM livededup
 UNION ALL SELECT 'catalogue_unique', count(*) FROM catdedup UNION ALL SELECT 'articles', count(*) FROM articles""",
)
def stage_counts(spark, sf):
    landed = cleaning.standardise_live(cleaning.flatten_source(tables.live_articles(spark, sf)))
    # Deduplication keeps one row per key, so the keys alone tell its size.
    key = dedup.article_key(F.col("url"), F.col("article_id")).alias("key")
    found, listed = landed.select(key), cleaning.standardise_catalogue(tables.catalogue(spark, sf)).select(key)
    return reports.stage_counts(
        {
            "landed": landed,
            "landed_unique": found.distinct(),
            "catalogue_unique": listed.distinct(),
            "articles": found.unionByName(listed).distinct(),
        }
    )


@query(
    "counted_writes",
    """SELECT 'landed' AS stage, count(*) AS "rows" FROM livestd UNION ALL SELECT 'landed_unique', count(*) FROM livededup
 UNION ALL SELECT 'catalogue_unique', count(*) FROM catdedup""",
)
def counted_writes(spark, sf):
    """The stages written as tables, counted while they are written."""
    root = work_path(spark, "counted")
    landed = cleaning.standardise_live(cleaning.flatten_source(tables.live_articles(spark, sf)))
    counts = {"landed": writers.write_counted(landed, f"{root}/landed")}
    landed = spark.read.parquet(f"{root}/landed")
    counts["landed_unique"] = writers.write_counted(dedup.latest_articles(landed), f"{root}/landed_unique")
    listed = cleaning.standardise_catalogue(tables.catalogue(spark, sf))
    counts["catalogue_unique"] = writers.write_counted(dedup.first_by_id(listed), f"{root}/catalogue_unique")
    return spark.createDataFrame(list(counts.items()), "stage string, rows bigint")


_TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@query(
    "table_counts",
    " UNION ALL ".join(f"""SELECT '{t}' AS table_name, count(*) AS "rows", CAST(1 AS BIGINT) AS files FROM {t}""" for t in _TABLES),
)
def table_counts(spark, sf):
    out = None
    for name in _TABLES:
        one = reports.source_files(tables.table(spark, sf, name)).withColumn("table_name", F.lit(name))
        out = one if out is None else out.unionByName(one)
    return out


@query(
    "contract_checks",
    """SELECT 'events' AS table_name, 'session_id' AS missing, count(*) AS "rows" FROM events
 UNION ALL SELECT 'part', '', count(*) FROM part UNION ALL SELECT 'documents', 'title,url', count(*) FROM documents""",
)
def contract_checks(spark, sf):
    return reports.contract_report(
        {
            "events": (tables.table(spark, sf, "events"), ["event_id", "user_id", "session_id"]),
            "part": (tables.table(spark, sf, "part"), ["p_partkey", "p_name"]),
            "documents": (tables.table(spark, sf, "documents"), ["doc_id", "title", "url"]),
        }
    )


@query(
    "explode_impressions",
    "SELECT user_id, event_time, history, article_id, category, clicked FROM beh",
)
def explode_impressions(spark, sf):
    return impressions.explode_impressions(tables.raw_behaviours(spark, sf), tables.catalogue(spark, sf))


@query("clean_logs", """SELECT user_id, article_id, category, action, session_id, "timestamp" FROM logs""")
def clean_logs(spark, sf):
    return cleaning.clean_logs(tables.raw_logs(spark, sf))


@query(
    "click_filter",
    """SELECT session_id, lower(action) = 'click' AS any_case, coalesce(action = 'click', false) AS exact FROM rawlogs WHERE lower(action) = 'click'""",
)
def click_filter(spark, sf):
    raw = tables.raw_logs(spark, sf)
    loose = cleaning.clicks_only(raw).select("session_id", F.lit(True).alias("any_case"))
    exact = cleaning.clicks_only(raw, any_case=False).select("session_id", F.lit(True).alias("exact"))
    return loose.join(exact, "session_id", "left").fillna(False, subset=["exact"])


@query(
    "safe_casts",
    r"""SELECT event_id, coalesce(CAST(trunc(TRY_CAST(raw AS DOUBLE)) AS BIGINT), 0) AS whole, coalesce(TRY_CAST(raw AS DOUBLE), 0.0) AS num,
 strftime(CASE event_type WHEN 'error' THEN NULL WHEN 'view' THEN ts WHEN 'click' THEN date_trunc('second', ts) ELSE date_trunc('second', ts) - INTERVAL 2 HOUR END, '%Y-%m-%d %H:%M:%S.%f') AS parsed
 FROM (SELECT *, CASE event_type WHEN 'click' THEN json_extract_string(props, '$.k') WHEN 'view' THEN CAST(value AS VARCHAR) WHEN 'error' THEN props ELSE NULL END AS raw FROM events)""",
)
def safe_casts(spark, sf):
    kind = F.col("event_type")
    raw = F.when(kind == "click", F.get_json_object("props", "$.k")).when(kind == "view", F.col("value").cast("string")).when(kind == "error", F.col("props"))
    text = (
        F.when(kind == "error", F.col("props"))
        .when(kind == "view", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"))
        .when(kind == "click", F.date_format("ts", "M/d/yyyy h:mm:ss a"))
        .otherwise(F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.lit("+02:00")))
    )
    return tables.table(spark, sf, "events").select(
        "event_id",
        casts.whole_or_zero(raw).alias("whole"),
        casts.double_or(raw).alias("num"),
        F.date_format(casts.utc_timestamp(text), "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("parsed"),
    )


@query(
    "scalar_functions",
    """SELECT event_id, substr(md5(event_type || '_' || strftime(ts, '%Y%m%d_%H%M%S')), 1, 8) AS version,
 strftime(ts, '%Y%m%d_%H%M%S') AS stamp, strftime(ts - to_minutes(CAST(k AS INTEGER)), '%Y-%m-%d %H:%M:%S.%f') AS earlier,
 substr(props, 1, 4) AS short, CASE WHEN value = trunc(value) THEN CAST(CAST(value AS BIGINT) AS VARCHAR) ELSE CAST(value AS VARCHAR) END AS narrowed,
 CASE WHEN event_type = 'click' THEN k + 1 ELSE 1 END AS counted, round(log2(k + 2), 6) AS gain,
 event_type || ',' || CASE event_type WHEN 'click' THEN 'view' WHEN 'view' THEN 'click' ELSE 'click,view' END AS moved,
 CASE WHEN event_type = 'view' THEN 'view' ELSE 'click,view' END AS ended
 FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)""",
)
def scalar_functions(spark, sf):
    stamp = F.date_format("ts", "yyyyMMdd_HHmmss")
    k = F.col("k")
    pair = F.array(F.lit("click"), F.lit("view"))
    bumped = coll.add_counts(F.create_map(F.lit("click"), k), F.create_map(F.col("event_type"), F.lit(1).cast("bigint")))
    longer = F.when(F.col("event_type") == "view", F.array(F.lit("view"))).otherwise(F.concat(F.array(F.lit("error")), pair))
    return (
        tables.table(spark, sf, "events")
        .withColumn("k", F.get_json_object("props", "$.k").cast("bigint"))
        .select(
            "event_id",
            ids.data_version(F.col("event_type"), stamp).alias("version"),
            stamp.alias("stamp"),
            F.date_format(F.col("ts") - F.make_interval(mins=k.cast("int")), "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("earlier"),
            F.substring("props", 1, 4).alias("short"),
            casts.narrow_number(F.col("value")).alias("narrowed"),
            coll.count_of(bumped, F.col("event_type")).alias("counted"),
            F.round(F.log2(k + 2), 6).alias("gain"),
            F.array_join(coll.move_to_front(pair, F.col("event_type"), 20), ",").alias("moved"),
            F.array_join(coll.tail(longer, 2), ",").alias("ended"),
        )
    )


@query(
    "normalise_lists",
    """SELECT conv_id, turn, CASE WHEN role = 'user' THEN text || '|x' ELSE '' END AS from_list,
 CASE WHEN role = 'user' THEN '' ELSE regexp_replace(text, '^\\s+|\\s+$', '', 'g') END AS from_text, CAST(turn AS VARCHAR) AS from_number FROM conversations""".replace("\\\\", "\\"),
)
def normalise_lists(spark, sf):
    user = F.col("role") == "user"
    rows = tables.table(spark, sf, "conversations").select(
        "conv_id",
        "turn",
        F.when(user, F.array("text", F.lit(None), F.lit("x"))).alias("many"),
        F.when(user, F.when(F.col("turn") == 0, "  ").otherwise(" NaN ")).otherwise(F.concat(F.lit("\t"), "text", F.lit(" "))).alias("one"),
    )
    types = rows.schema
    return rows.select(
        "conv_id",
        "turn",
        F.array_join(coll.click_list(F.col("many"), types["many"].dataType), "|").alias("from_list"),
        F.array_join(coll.click_list(F.col("one"), types["one"].dataType), "|").alias("from_text"),
        F.array_join(coll.click_list(F.col("turn"), types["turn"].dataType), "|").alias("from_number"),
    )


@query(
    "head_limit",
    "SELECT doc_id, n_chars FROM documents ORDER BY n_chars DESC, doc_id LIMIT 100",
)
def head_limit(spark, sf):
    return ordering.head(tables.table(spark, sf, "documents").select("doc_id", "n_chars"), [F.col("n_chars").desc(), F.col("doc_id")], 100)


@query("sort_by_time", "SELECT event_id, user_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts FROM events ORDER BY ts")
def sort_by_time(spark, sf):
    rows = ordering.sort_rows(tables.table(spark, sf, "events"), F.col("ts"), F.col("event_id"))
    return rows.select("event_id", "user_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts"))


@query("dense_index", "SELECT p_partkey, row_number() OVER (ORDER BY p_name, p_partkey) - 1 AS ix FROM part")
def dense_index(spark, sf):
    parts = tables.table(spark, sf, "part").select("p_partkey", "p_name")
    return ordering.global_index(parts, [F.col("p_name"), F.col("p_partkey")], "ix").select("p_partkey", "ix")


@query(
    "sample_users",
    "SELECT user_id FROM (SELECT DISTINCT user_id FROM inter) ORDER BY sha256('42|' || user_id), user_id LIMIT 500",
)
def sample_users(spark, sf):
    return ordering.sample_exact(tables.interactions(spark, sf).select("user_id").distinct(), ["user_id"], 500)


@query(
    "embed_articles",
    r"""SELECT article_id, place, round(s / sqrt(sum(s * s) OVER (PARTITION BY article_id)), 6) AS value FROM (
 SELECT article_id, ('0x' || substr(md5(term), 1, 8))::BIGINT % 64 AS place, sum(CASE WHEN substr(md5(term), 9, 1) < '8' THEN 1.0 ELSE -1.0 END) AS s
 FROM (SELECT article_id, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}_]{2,}')) AS term FROM dtext) GROUP BY ALL) WHERE s <> 0""",
)
def embed_articles(spark, sf):
    vectors = encoding.encode(tables.document_texts(spark, sf), "text")
    rows = vectors.select("article_id", F.posexplode("embedding").alias("place", "value"))
    return rows.where(F.col("value") != 0).select("article_id", F.col("place").cast("bigint").alias("place"), F.round("value", 6).alias("value"))


_LETTERS = "abcdefghijklmnopqrstuvwxyz"


def letter_counts():
    """An encoder for the slot of a model: how often each letter occurs in the text."""

    def encode(texts: list[str]) -> list[list[float]]:
        return [[float(t.count(c)) for c in _LETTERS] for t in texts]

    return encode


@query(
    "embed_with_encoder",
    f"""SELECT article_id, i - 1 AS place, CAST(length(text) - length(replace(text, substr('{_LETTERS}', CAST(i AS INTEGER), 1), '')) AS DOUBLE) AS value
 FROM dtext CROSS JOIN range(1, 27) t(i)""",
)
def embed_with_encoder(spark, sf):
    """The encoder slot, with an encoder given from outside."""
    vectors = encoding.encode(tables.document_texts(spark, sf), "text", letter_counts)
    rows = vectors.select("article_id", F.posexplode("embedding").alias("place", "value"))
    return rows.select("article_id", F.col("place").cast("bigint").alias("place"), "value")


@query(
    "embedding_items",
    f"""SELECT article_id, title, url, category, source, abstract, pub_date, fetched_at, data_source, place, value, embedding_dim FROM (
 SELECT sha256(coalesce(nullif({sql_strip('url')}, ''), concat_ws('||', {sql_strip('title')}, {sql_strip("coalesce(source_name, '')")}, {sql_strip('publishedAt')}))) AS article_id,
  title, coalesce(url, '') AS url, coalesce(category, '') AS category, coalesce(source_name, '') AS source, coalesce(description, '') AS abstract, publishedAt AS pub_date, fetched_at,
  'newsapi' AS data_source, generate_subscripts(embedding, 1) - 1 AS place, unnest(list_transform(embedding, lambda x: round(CAST(x AS DOUBLE), 6))) AS value, CAST(len(embedding) AS INTEGER) AS embedding_dim
 FROM (SELECT doc_id, {sql_strip('title')} AS title, coalesce({sql_strip('url')}, '') AS url, category, source_name, description, publishedAt, fetched_at, content FROM live WHERE {sql_strip('title')} <> ''
   QUALIFY row_number() OVER (PARTITION BY CASE WHEN {sql_strip("coalesce(url, '')")} <> '' THEN {sql_strip("coalesce(url, '')")} ELSE 'row ' || doc_id END ORDER BY doc_id) = 1) u
 JOIN embeddings ON vec_id = doc_id
 WHERE doc_id IN (SELECT min(doc_id) FROM (SELECT doc_id, {sql_strip('title')} AS title, coalesce({sql_strip('url')}, '') AS url FROM live WHERE {sql_strip('title')} <> ''
   QUALIFY row_number() OVER (PARTITION BY CASE WHEN {sql_strip("coalesce(url, '')")} <> '' THEN {sql_strip("coalesce(url, '')")} ELSE 'row ' || doc_id END ORDER BY doc_id) = 1) GROUP BY title, url))""",
)
def embedding_items(spark, sf):
    live = cleaning.flatten_source(tables.live_documents(spark, sf))
    unique = reports.embedding_candidates(live, row_id="doc_id")
    vectors = tables.table(spark, sf, "embeddings").select(F.col("vec_id").alias("doc_id"), "embedding")
    items = encoding.embedding_items(encoding.with_embedding_ids(unique).join(vectors, "doc_id"))
    return items.select(*[c for c in items.columns if c != "embedding"], F.posexplode("embedding").alias("place", "value")).withColumn(
        "place", F.col("place").cast("bigint")
    )


_TITLED = f"""SELECT doc_id, {sql_strip('title')} AS title, coalesce({sql_strip('url')}, '') AS url, source_name, description, publishedAt, content FROM live WHERE {sql_strip('title')} <> ''
   QUALIFY row_number() OVER (PARTITION BY CASE WHEN {sql_strip("coalesce(url, '')")} <> '' THEN {sql_strip("coalesce(url, '')")} ELSE 'row ' || doc_id END ORDER BY doc_id) = 1"""


@query(
    "embedding_job",
    f"""SELECT article_id, title, place, round(s / sqrt(sum(s * s) OVER (PARTITION BY article_id)), 6) AS value FROM (
 SELECT article_id, title, ('0x' || substr(md5(term), 1, 8))::BIGINT % 64 AS place, sum(CASE WHEN substr(md5(term), 9, 1) < '8' THEN 1.0 ELSE -1.0 END) AS s
 FROM (SELECT article_id, title, unnest(regexp_extract_all(lower(body), '[\\p{{L}}\\p{{N}}_]{{2,}}')) AS term FROM (
   SELECT sha256(coalesce(nullif(url, ''), concat_ws('||', title, {sql_strip("coalesce(source_name, '')")}, {sql_strip('publishedAt')}))) AS article_id, title,
    concat_ws(' ', title, coalesce(nullif({sql_strip('description')}, ''), content)) AS body
   FROM ({_TITLED}) WHERE doc_id IN (SELECT min(doc_id) FROM ({_TITLED}) GROUP BY title, url)
   QUALIFY row_number() OVER (PARTITION BY article_id ORDER BY title, body) = 1))
 GROUP BY ALL) WHERE s <> 0""",
)
def embedding_job(spark, sf):
    """The embedding job on landed articles with the default encoder."""
    made = embedding.build_embedding_items(cleaning.flatten_source(tables.live_documents(spark, sf)), row_id="doc_id")
    rows = made.select("article_id", "title", F.posexplode("embedding").alias("place", "value"))
    return rows.where("value <> 0").withColumn("place", F.col("place").cast("bigint"))
