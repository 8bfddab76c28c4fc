import hashlib
import re

import pytest
from pyspark.sql import functions as F

from clickloom import schemas
from clickloom.operators import cleaning, dedup, encoding, impressions, ordering, reports
from clickloom.plans.articles import build_articles, run_etl
from clickloom.session import work_path

LIVE = schemas.LIVE_ARTICLE


def live(spark, *records):
    base = {n: None for n in LIVE.names}
    return spark.createDataFrame([tuple({**base, **r}[n] for n in LIVE.names) for r in records], LIVE)


def catalogue(spark, *records):
    base = {n: None for n in schemas.CATALOGUE.names}
    return spark.createDataFrame([tuple({**base, **r}[n] for n in schemas.CATALOGUE.names) for r in records], schemas.CATALOGUE)


def test_source_column_may_be_absent(rows):
    assert cleaning.flatten_source(rows([(1,)], "x int")).first()["source_name"] == "unknown"
    assert cleaning.source_as_json(rows([(1,)], "x int")).columns == ["x"]


def test_latest_version_wins_and_blank_urls_stay_apart(spark):
    raw = live(
        spark,
        {"url": "http://a", "title": "old", "fetched_at": "1", "publishedAt": "9"},
        {"url": "HTTP://A ", "title": "new", "fetched_at": "2"},
        {"url": "http://b", "title": "x", "fetched_at": "1", "publishedAt": "1"},
        {"url": "http://b", "title": "y", "fetched_at": "1", "publishedAt": "2"},
        {"url": " ", "title": "p"},
        {"url": "", "title": "q"},
    )
    std = cleaning.standardise_live(cleaning.flatten_source(raw))
    assert sorted(r["title"] for r in dedup.latest_articles(std).collect()) == ["new", "p", "q", "y"]
    merged = cleaning.standardise_live(cleaning.flatten_source(raw), blank_is_missing=False)
    assert len({r["article_id"] for r in merged.where("url = ''").collect()}) == 1


def test_cross_source_prefers_fetched_rows_then_source(spark):
    made = build_articles(
        live(spark, {"url": "http://a", "title": "live", "fetched_at": "2024"}, {"url": "http://b", "title": "live"}),
        catalogue(spark, {"news_id": "N1", "url": "http://A", "title": "cat"}, {"news_id": "N2", "title": "only"}, {"news_id": "N3", "url": "http://B", "title": "cat"}),
    )
    got = {(r["title"], r["url"], r["category"], r["data_source"]) for r in made.collect()}
    assert ("live", "http://a", "general", "newsapi") in got
    assert ("only", "mind://N2", "general", "mind") in got
    # Equal times: the larger data_source wins.
    assert ("live", "http://b", "general", "newsapi") in got and len(got) == 3


def test_impressions_follow_both_patterns(spark, rows):
    raw = rows(
        [
            ("1", "u", "t", "h", "N1-1 N2-0"),
            ("2", None, None, None, "N1-1  A-B-1"),
            ("3", "u", "t", "h", ""),
            ("4", "u", "t", "h", None),
            ("5", "u", "t", "h", "N3-5 N4"),
        ],
        "impression_id string, user_id string, time string, history string, impressions string",
    )
    cat = catalogue(spark, {"news_id": "N1", "category": "Sports"}, {"news_id": "N1", "category": "Sports"}, {"news_id": "A-B", "category": None})
    got = sorted((r["user_id"], r["article_id"], r["category"], r["clicked"]) for r in impressions.explode_impressions(raw, cat).collect())
    assert got == [
        ("", "A-B", "general", 1),
        ("", "N1", "sports", 1),
        ("u", "", "general", 0),
        ("u", "", "general", 5),
        ("u", "N1", "sports", 1),
        ("u", "N2", "general", 0),
    ]


def test_log_cleaning_defaults(rows):
    df = rows([(None, None, None, None, None, None)], "user_id string, article_id string, category string, action string, timestamp string, session_id string")
    assert cleaning.clean_logs(df).first().asDict() == {
        "user_id": "", "article_id": "", "category": "general", "action": "view", "session_id": "", "timestamp": ""
    }


def test_conditional_dedup_keeps_rows_without_value(rows):
    df = rows([(1, "a"), (2, "a "), (3, ""), (4, None), (5, " ")], "id int, url string")
    assert sorted(r["id"] for r in dedup.dedup_where_present(df, "url", "id").collect()) == [1, 3, 4, 5]


def test_upsert_last_write_wins(rows):
    old = rows([("a", 1), ("b", 1)], "k string, v int")
    new = rows([("b", 2, 1), ("b", 3, 2), ("c", 4, 1)], "k string, v int, at int")
    got = {r["k"]: r["v"] for r in dedup.upsert(old, new, "k", [F.col("at").desc()]).collect()}
    assert got == {"a": 1, "b": 3, "c": 4}


def test_quarantine_separates_bad_rows(rows):
    good, bad = dedup.quarantine(rows([("a", "1"), ("b", "x"), ("c", None)], "k string, v string"), F.col("v").try_cast("int") > 0)
    assert [r["k"] for r in good.collect()] == ["a"] and sorted(r["k"] for r in bad.collect()) == ["b", "c"]


def test_duplicate_report_counts_blanks(rows):
    df = rows([("1", "A", "u"), ("2", "a ", None), ("2", "", "")], "id string, title string, url string")
    got = reports.duplicate_report(df, {"dup_ids": "id", "dup_titles": "title", "dup_urls": "url"}, ["dup_titles", "dup_urls"]).first()
    assert tuple(got) == (1, 2, 2)


def test_contracts(rows, spark):
    df = rows([(1,)], "a int")
    with pytest.raises(schemas.MissingColumns):
        schemas.require_columns(df, ["a", "b"])
    with pytest.raises(schemas.EmptyTable):
        schemas.require_rows(df.where("a > 1"))
    assert schemas.empty_table(spark, schemas.ARTICLE).columns == schemas.ARTICLE.names


def test_global_index_is_dense_and_ordered(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("x"))
    got = ordering.global_index(df, [F.col("x").desc()], "ix").collect()
    assert sorted((r["ix"], r["x"]) for r in got) == [(i, 999 - i) for i in range(1000)]
    assert ordering.global_index(df.where("x < 0"), [F.col("x")], "ix").count() == 0


@pytest.mark.parametrize("n", [1, 4, 5, 333])
def test_exact_split_is_disjoint_complete_and_repeatable(spark, n):
    df = spark.range(n).select(F.col("id").cast("string").alias("k"))
    a = {r["k"]: r["is_test"] for r in ordering.split_exact(df, [F.col("k")]).collect()}
    b = {r["k"]: r["is_test"] for r in ordering.split_exact(df.repartition(7), [F.col("k")]).collect()}
    assert len(a) == n and a == b and sum(a.values()) == -(-n // 5)


def test_exact_split_compares_beginnings_and_settles_ties(spark, monkeypatch):
    df = spark.range(500).select(F.col("id").cast("string").alias("k"))
    want = {r["k"] for r in ordering.split_exact(df, [F.col("k")]).where("is_test").collect()}
    hashes = sorted((r["h"], r["k"]) for r in df.select("k", ordering.seeded_hash(42, F.col("k")).alias("h")).collect())
    assert want == {k for _, k in hashes[:100]}
    monkeypatch.setattr(ordering, "HASH_BITS", 4)  # many rows tie
    split = ordering.split_exact(df, [F.col("k")])
    assert {r["k"] for r in split.where("is_test").collect()} == want
    plan = split._jdf.queryExecution().optimizedPlan().toString()
    assert "_start" in plan and "RDD" not in plan and split.columns == ["k", "is_test"]


def test_hash_split_share(spark):
    got = ordering.split_by_hash(spark.range(5000), [F.col("id")]).where("is_test").count()
    assert 850 < got < 1150


def test_sample_is_repeatable(spark):
    df = spark.range(100)
    a = {r["id"] for r in ordering.sample_exact(df, ["id"], 10).collect()}
    assert len(a) == 10 and a == {r["id"] for r in ordering.sample_exact(df.repartition(9), ["id"], 10).collect()}


def test_encoder_slot_and_items(rows):
    arts = rows(
        [("http://A", "One two", "body", None), ("http://A", "One two", "x", None), ("", "Solo", "", "cc"), ("", " ", "no title", None)],
        "url string, title string, abstract string, content string",
    ).withColumn("row", F.monotonically_increasing_id())
    unique = reports.embedding_candidates(arts, row_id="row")
    items = encoding.embedding_items(encoding.encode(encoding.with_embedding_ids(unique), "embedding_text"))
    got = {r["title"]: r for r in items.collect()}
    assert set(got) == {"One two", "Solo"}
    assert got["Solo"]["embedding_dim"] == 64 and got["Solo"]["data_source"] == "newsapi"
    assert sum(x * x for x in got["One two"]["embedding"]) == pytest.approx(1.0, abs=1e-5)


def test_default_encoder(rows):
    df = rows([(1, "Red fish, red bird"), (2, ""), (3, None)], "id int, text string")
    got = {r["id"]: r["embedding"] for r in encoding.encode(df, "text").collect()}
    assert sum(x * x for x in got[1]) == pytest.approx(1) and max(map(abs, got[1])) == pytest.approx(2 / 6**0.5)
    assert got[2] == [0.0] * 64 and got[3] is None
    texts = ["a b cc dd", "Ärger 12 über", "cc " * 5000] * 40
    df = rows([(i, t, "x") for i, t in enumerate(texts)], "id int, text string, embedding string").repartition(3)
    got = {r["id"]: r["embedding"] for r in encoding.encode(df, "text").collect()}
    for i, t in enumerate(texts):
        sums = [0.0] * 64
        for w in re.findall(r"\w{2,}", t.lower()):
            d = hashlib.md5(w.encode()).hexdigest()
            sums[int(d[:8], 16) % 64] += 1 if d[8] < "8" else -1
        length = sum(x * x for x in sums) ** 0.5
        assert got[i] == pytest.approx([x / length for x in sums])


def test_encoder_gets_texts_of_equal_length_and_no_nulls(rows):
    def make():
        return lambda texts: [[float(len(t)), float(max(map(len, texts)))] for t in texts]

    df = rows([(i, None if i == 7 else "x" * (i * 37 % 400)) for i in range(400)], "id int, text string")
    got = {r["id"]: r["embedding"] for r in encoding.encode(df, "text", make, batch=16).collect()}
    assert all(v[0] == (0 if i == 7 else i * 37 % 400) for i, v in got.items()) and len(got) == 400
    assert sum(v[1] - v[0] for v in got.values()) < 400 * 100


def test_encoder_is_called_in_small_batches(rows):
    class Batches:
        def __call__(self, texts):
            return [[float(len(texts))] for _ in texts]

    df = rows([(i, str(i)) for i in range(300)], "id int, text string")
    sizes = [r["embedding"][0] for r in encoding.encode(df, "text", Batches, batch=64).collect()]
    assert max(sizes) <= 64 and len(sizes) == 300


def test_etl_writes_four_tables(spark, rows):
    root = work_path(spark, "etl")
    logs = rows([("u", "a1", "Health", "CLICK", "2024-01-01T00:00:00", "s")], "user_id string, article_id string, category string, action string, timestamp string, session_id string")
    beh = rows([("1", "u", "1/2/2024 9:00:00 AM", "", "N1-1")], "impression_id string, user_id string, time string, history string, impressions string")
    run_etl(live(spark, {"url": "http://a", "title": "t"}), catalogue(spark, {"news_id": "N1", "category": "Science"}), logs, beh, root)
    v = spark.read.parquet(f"{root}/users/vectors").first()
    assert (v["health"], v["science"], v["total_clicks"], v["recent_clicks"], v["top_category"]) == (1, 1, 2, ["N1", "a1"], "health")
    assert spark.read.parquet(f"{root}/articles").count() == 2


def test_a_folder_of_part_files_counts_as_one_file(spark, tmp_path):
    rows = spark.range(30)
    rows.repartition(3).write.parquet(f"{tmp_path}/many.parquet")
    rows.coalesce(1).write.parquet(f"{tmp_path}/plain")
    for name in ("many.parquet", "plain"):
        made = reports.source_files(spark.read.parquet(f"{tmp_path}/{name}")).first()
        assert (made["rows"], made["files"]) == (30, 1)
    parts = spark.read.parquet(f"{tmp_path}/many.parquet", f"{tmp_path}/plain")
    assert reports.source_files(parts).first()["files"] == 2


def test_default_encoder_takes_slices_of_a_batch(spark, monkeypatch):
    """Slices of a batch, with nulls in them, give what each row gives by itself."""
    texts = [None if i % 7 == 3 else " ".join(f"w{j}" for j in range(i % 5)) for i in range(60)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string").coalesce(1)
    show = lambda made: {r["id"]: r["embedding"] for r in made.collect()}
    alone = show(encoding.hashed_vectors(df.repartition(60, "id"), "text"))
    monkeypatch.setattr(encoding, "use_all_cores", lambda d: d)
    monkeypatch.setattr(encoding, "ROWS_AT_ONCE", 8)
    assert show(encoding.hashed_vectors(df, "text")) == alone
    assert sorted(i for i, v in alone.items() if v is None) == [i for i, t in enumerate(texts) if t is None]
    made = encoding.encode(spark.range(5000).selectExpr("id", "'ab' AS text"), "text", lambda: lambda t: [[1.0]] * len(t))
    most = made.groupBy(F.spark_partition_id().alias("p")).count().agg(F.max("count")).first()[0]
    assert most < 2 * encoding.ROWS_PER_PART
