import json
import os
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from clickloom import schemas
from clickloom.operators import interactions as inter, popularity, profiles, recommend
from clickloom.plans import embedding, serving, training
from clickloom.schemas import POPULARITY_MODEL
from clickloom.session import work_path
from clickloom.sources import arrays, readers, writers
from clickloom.sources.writers import latest_model
from clickloom.streaming import clicks as click_stream
from clickloom.streaming import landing

T0 = datetime(2024, 1, 1)


def put(path, name, payload):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w", encoding="utf-8") as f:
        f.write(payload if isinstance(payload, str) else json.dumps(payload))


def test_json_reader_skips_foreign_and_broken_files(spark, tmp_path):
    put(str(tmp_path), "a.json", [{"user_id": "1", "extra": 2}, {"user_id": "2"}])
    put(str(tmp_path), "b.txt", [{"user_id": "3"}])
    put(str(tmp_path), "c.json", "not json")
    got = readers.read_json_arrays(spark, str(tmp_path), schemas.USER_LOG)
    assert sorted(r["user_id"] for r in got.collect()) == ["1", "2"] and got.columns == schemas.USER_LOG.names


def test_payloads_that_are_no_list_are_ignored(spark, tmp_path):
    put(str(tmp_path), "a.json", json.dumps([{"user_id": "1"}, None, {"user_id": "2"}], indent=2))
    put(str(tmp_path), "b.json", {"user_id": "3"})
    put(str(tmp_path), "c.json", "[broken")
    put(str(tmp_path), "d.log", [{"user_id": "4"}])
    got, _ = arrays.read_ranges(spark, str(tmp_path), schemas.USER_LOG)
    assert sorted(r["user_id"] for r in got.collect()) == ["1", "2"]


def test_upsert_versions_count_good_and_bad_rows(spark, tmp_path):
    schema = "k string, v int, at int"
    order, valid = [F.col("at").desc()], F.col("v") >= 0
    root = str(tmp_path)
    first = spark.createDataFrame([("a", 1, 1), ("a", 2, 2), ("b", 1, 1), ("c", -1, 1), ("d", None, 1)], schema)
    assert writers.upsert_version(spark, root, first, "k", order, valid) == (2, 2)
    assert writers.upsert_version(spark, root, spark.createDataFrame([("b", 9, 1), ("e", 5, 1)], schema), "k", order, valid) == (2, 0)
    assert {r["k"]: r["v"] for r in writers.read_items(spark, root).collect()} == {"a": 2, "b": 9, "e": 5}


def test_embedding_records_from_an_article_table(spark):
    articles = spark.createDataFrame(
        [("1", "http://a", "A", "x", "s", "newsapi"), ("2", "http://a", "A", "y", "s", "newsapi"), ("3", "", "B", "", "s", "mind"), ("4", "", " ", "z", "s", "mind")],
        "article_id string, url string, title string, abstract string, source string, data_source string",
    )
    got = {r["title"]: r for r in embedding.build_embedding_items(articles).collect()}
    assert set(got) == {"A", "B"} and got["A"]["embedding_dim"] == 64 and len(got["B"]["article_id"]) == 64
    assert embedding.build_embedding_items(articles, limit=1).count() == 1
    with pytest.raises(schemas.EmptyTable):
        embedding.build_embedding_items(articles.where("false"))


def test_tsv_reader_quotes_and_blanks(spark, tmp_path):
    line = 'N1\tc\ts\t"t one"\t"a\tb"\t\tx\t\n'
    put(str(tmp_path), "news.tsv", line)
    row = readers.read_tsv(spark, str(tmp_path), schemas.CATALOGUE).first()
    assert (row["title"], row["abstract"], row["url"]) == ("t one", "a\tb", None)
    raw = readers.read_tsv(spark, str(tmp_path), schemas.CATALOGUE, verbatim=True).first()
    assert raw["title"] == '"t one"' and raw["abstract"] == '"a'


def test_missing_files_give_an_empty_mapping(spark, tmp_path):
    got = readers.read_existing_tsv(spark, [str(tmp_path / "no.tsv")], schemas.CATALOGUE, ["news_id", "url"])
    assert got.count() == 0 and got.columns == ["news_id", "url"]
    assert readers.read_table_or_empty(spark, str(tmp_path / "none"), schemas.ARTICLE).count() == 0


def test_summary_file(spark, tmp_path):
    writers.write_summary(spark.range(1).select(F.lit(3).alias("n")), str(tmp_path / "s"))
    assert spark.read.json(str(tmp_path / "s")).first()["n"] == 3


def test_landing_keeps_newest_over_several_runs(spark, tmp_path):
    source, root = str(tmp_path / "in"), str(tmp_path / "out")
    put(source, "1.json", [{"url": "http://a", "title": "old", "fetched_at": "1"}, {"url": "http://b", "title": "b", "fetched_at": "1"}])
    landing.land_articles(spark, source, root)
    put(source, "2.json", [{"url": "http://a", "title": "new", "fetched_at": "2"}, {"url": "http://c", "title": "c"}])
    landing.land_articles(spark, source, root)
    landing.compact_landed(spark, root, 0)
    landing.land_articles(spark, source, root)
    got = {r["title"]: r["fetched_at"] for r in landing.landed_articles(spark, root).collect()}
    assert set(got) == {"new", "b", "c"} and got["c"].startswith("20")


def test_click_stream_equals_batch_and_survives_compaction(spark, tmp_path):
    rng = random.Random(2)
    clicks = [(f"u{rng.randrange(6)}", f"a{rng.randrange(40)}", i, T0 + timedelta(seconds=i)) for i in range(400)]
    articles = spark.createDataFrame([(f"a{i}", ["health", "sports", None][i % 3]) for i in range(35)], "article_id string, category string")
    start = spark.createDataFrame([("u0", {"health": 2}, "health", ["x", "y"], 2)], "user_id string, category_preferences map<string,bigint>, top_category string, recent_clicks array<string>, total_clicks bigint")
    batch = spark.createDataFrame(clicks, schemas.CLICK)
    accepted, rejected = profiles.validate_clicks(batch, articles)
    want = sorted(map(str, profiles.update_profiles(start, accepted).collect()))

    source, root = str(tmp_path / "in"), str(tmp_path / "state")
    click_stream.start_from(start, root)
    for part in (0, 1, 2):
        lines = [json.dumps({"user_id": u, "article_id": a, "event_id": e, "ts": t.isoformat()}) for u, a, e, t in clicks if e % 3 == part]
        put(source, f"{part}.json", "\n".join(lines))
        click_stream.fold_clicks(spark, source, articles, root)
        if part == 1:
            click_stream.compact(spark, root, 0)
    assert sorted(map(str, click_stream.read_profiles(spark, root).collect())) == want
    click_stream.compact(spark, root, 2)
    assert sorted(map(str, click_stream.read_profiles(spark, root).collect())) == want
    assert click_stream.read_rejected(spark, root).count() == rejected.count() > 0


def test_replayed_clicks_count_unless_told_otherwise(spark, tmp_path):
    click = {"user_id": "u", "article_id": "a", "event_id": 1, "ts": "2024-01-01T00:00:00"}
    articles = spark.createDataFrame([("a", "health")], "article_id string, category string")
    for name, within, total in (("twice", None, 2), ("once", "1 hour", 1)):
        source, root = str(tmp_path / name), str(tmp_path / f"{name}-state")
        put(source, "1.json", json.dumps(click) + "\n" + json.dumps(click))
        click_stream.fold_clicks(spark, source, articles, root, once_within=within)
        assert click_stream.read_profiles(spark, root).first()["total_clicks"] == total


def test_refresh_follows_each_click(spark, tmp_path):
    ranking = spark.createDataFrame([(f"a{i}", i + 1) for i in range(5)], "article_id string, pop_rank int")
    articles = ranking.select("article_id", F.lit("health").alias("category"))
    source, root = str(tmp_path / "in"), str(tmp_path / "state")

    def refresh(touched, mine):
        requests = recommend.clean_requests(touched.withColumn("k", F.lit(2)))
        return recommend.recommend_for_requests(requests, mine, POPULARITY_MODEL, ranking)

    def lists():
        out = {}
        for r in click_stream.current_recommendations(spark, root).orderBy("user_id", "rank").collect():
            out.setdefault(r["user_id"], []).append(r["article_id"])
        return out

    put(source, "1.json", json.dumps({"user_id": "u", "article_id": "a0", "event_id": 1, "ts": "2024-01-01T00:00:00"}) + "\n" + json.dumps({"user_id": "v", "article_id": "a4", "event_id": 2, "ts": "2024-01-01T00:00:00"}))
    click_stream.fold_clicks(spark, source, articles, root, refresh=refresh)
    assert lists() == {"u": ["a1", "a2"], "v": ["a0", "a1"]}
    put(source, "2.json", json.dumps({"user_id": "u", "article_id": "a1", "event_id": 3, "ts": "2024-01-01T01:00:00"}))
    click_stream.fold_clicks(spark, source, articles, root, refresh=refresh)
    assert lists() == {"u": ["a2", "a3"], "v": ["a0", "a1"]}


@pytest.fixture(scope="module")
def trained(spark):
    """Users click inside their own topic, so neighbours should beat nothing at all."""
    rng = random.Random(7)
    topics = ["apple pear plum", "engine wheel brake", "violin cello flute"]
    articles = spark.createDataFrame(
        [(f"a{i:02d}", f"{topics[i % 3]} story {i}", f"about {topics[i % 3]}") for i in range(45)],
        "article_id string, title string, abstract string",
    )
    data = []
    for u in range(40):
        for j in range(14):
            data.append((f"u{u:02d}", f"a{(rng.randrange(15) * 3 + u % 3):02d}", T0 + timedelta(minutes=u * 100 + j), 1.0, "log"))
    rows = spark.createDataFrame(data, schemas.INTERACTION).dropDuplicates()
    root = work_path(spark, "trained")
    split = training.split_interactions(rows)
    runs = training.train_all(split, articles, root, "v1", components=8)
    best = training.promote_best(runs, root, "v1", "20240101_000000")
    return root, articles, split, runs, best


def test_training_logs_three_finished_runs(trained):
    _, _, split, runs, best = trained
    got = {r["model_type"]: r for r in runs.collect()}
    assert set(got) == set(schemas.MODEL_TYPES)
    top = max(got.values(), key=lambda r: (r["ndcg_at_10"], r["precision_at_5"], r["recall_at_10"]))
    assert best == top["model_type"] and top["ndcg_at_10"] > 0
    assert top["train_size"] == split.train.count() and top["test_size"] == split.test.count()
    assert got["knn_content_based"]["ndcg_at_10"] > got["popularity_baseline"]["ndcg_at_10"]


def test_end_to_end_serving(spark, trained):
    root, articles, split, _, best = trained
    hist = split.train.groupBy("user_id").agg(F.slice(F.array_sort(F.collect_set("article_id")), 1, 10).alias("recent_clicks"))
    requests = spark.createDataFrame([("u00", 5), ("stranger", 5), (" ", 5)], "user_id string, k int")
    got = serving.serve(spark, root, requests, hist, articles).collect()
    seen = {r["user_id"]: set(r["recent_clicks"]) for r in hist.collect()}
    for user in ("u00", "stranger"):
        mine = sorted((r["rank"], r["article_id"]) for r in got if r["user_id"] == user)
        assert [i for i, _ in mine] == [1, 2, 3, 4, 5]
        assert not {a for _, a in mine} & seen.get(user, set()) and len({a for _, a in mine}) == 5
    assert {r["model_type"] for r in got} == {best} and all(r["title"] for r in got)
    assert serving.refuse_blank(requests).first()["error"] == "a request needs a user"


def test_registry_holds_copies_and_history(spark, trained):
    root, _, split, runs, best = trained
    for model in schemas.MODEL_TYPES:
        assert spark.read.parquet(f"{root}/registry/all/{model}-20240101_000000/popularity").count()
    first = f"{root}/registry/best_model_20240101_000000"
    assert spark.read.parquet(f"{first}/popularity").count() > 0
    for stamp in ("20240102_000000", "20240102_000000"):
        training.promote_best(runs, root, "v1", stamp)
    history = spark.read.parquet(f"{root}/registry/metadata").collect()
    assert sorted(r["timestamp"] for r in history) == ["20240101_000000", "20240102_000000"]
    assert all(r["model_path"] == f"registry/best_model_{r['timestamp']}" and len(r["data_version"]) == 8 for r in history)
    assert latest_model(spark, root)["path"] == f"{root}/registry/best_model_20240102_000000"
    assert spark.read.parquet(f"{first}/popularity").count() > 0
    assert inter.pair_weights(split.train).count() > 0 and popularity.MAX_K == 20


def test_training_a_version_again_replaces_its_runs(spark, trained):
    _, articles, split, _, _ = trained
    root = work_path(spark, "again")
    for version in ("v1", "v1", "v2"):
        runs = training.evaluate_models(split, {}, root, version)
    assert sorted(r["run_id"] for r in runs.collect()) == ["popularity_baseline-v1", "popularity_baseline-v2"]


def test_every_request_is_answered(spark, trained):
    root, articles, split, _, _ = trained
    hist = split.train.groupBy("user_id").agg(F.slice(F.array_sort(F.collect_set("article_id")), 1, 10).alias("recent_clicks"))
    requests = spark.createDataFrame([(1, "u00", 3), (2, "u00", 5), (3, "u01", 4), (4, "", 4)], "request_id int, user_id string, k int")
    got = serving.serve(spark, root, requests, hist, articles).collect()
    assert sorted((r["request_id"], r["rank"]) for r in got) == [(q, i) for q, k in ((1, 3), (2, 5), (3, 4)) for i in range(1, k + 1)]
    assert [r["request_id"] for r in serving.refuse_blank(requests).collect()] == [4]


def test_broken_files_are_rejected_and_a_category_is_given(spark, tmp_path):
    source, root = str(tmp_path / "in"), str(tmp_path / "out")
    put(source, "1.json", [{"url": "http://a", "title": "a"}, {"url": "http://b", "title": "b", "category": "Health"}])
    put(source, "2.json", "not json")
    landing.land_articles(spark, source, root, category="sports")
    assert {r["title"]: r["category"] for r in landing.landed_articles(spark, root).collect()} == {"a": "sports", "b": "health"}
    assert [r["record"].strip() for r in landing.rejected_files(spark, root).collect()] == ["not json"]


def test_unfinished_versions_do_not_count(spark, tmp_path):
    root = str(tmp_path)
    order, valid = [F.col("at").desc()], F.col("v") >= 0
    writers.upsert_version(spark, root, spark.createDataFrame([("a", 1, 1)], "k string, v int, at int"), "k", order, valid)
    os.makedirs(f"{root}/items/v=1/_temporary/0")
    assert readers.versions(spark, f"{root}/items") == [0]
    assert writers.read_items(spark, root).count() == 1
    writers.upsert_version(spark, root, spark.createDataFrame([("b", 2, 1)], "k string, v int, at int"), "k", order, valid)
    assert {r["k"] for r in writers.read_items(spark, root).collect()} == {"a", "b"}


def test_unreadable_click_bodies_are_kept_apart(rows):
    bodies = [(1, '{"user_id": "u", "article_id": "a"}'), (2, "{"), (3, '{"user_id": "u"}'), (4, None)]
    good, bad = profiles.parse_clicks(rows(bodies, "event_id int, body string"))
    assert [tuple(r) for r in good.collect()] == [(1, "u", "a")]
    assert {r["event_id"] for r in bad.collect()} == {2, 3, 4}


def test_workers_can_import_the_package(tmp_path):
    """Run in a folder of its own, with the package on the driver's path only."""
    import subprocess
    import sys

    code = """
import sys
sys.path.insert(0, {root!r})
from clickloom.session import local_session
from clickloom.operators import neighbours, terms
spark = local_session(2, "away", partitions=2)
docs = spark.createDataFrame([("a", "red fish"), ("b", "red bird"), ("c", "blue fish")], "article_id string, text string")
print("ROWS", neighbours.sparse_neighbours(terms.tfidf_rows(docs)[0]).count())
""".format(root=os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    said = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=200)
    assert "ROWS 7" in said.stdout, said.stderr[-2000:]


def test_a_batch_of_one_user_reads_one_bucket(spark, tmp_path, monkeypatch):
    root, source = str(tmp_path / "state"), str(tmp_path / "in")
    articles = spark.createDataFrame([("a", "health")], "article_id string, category string")
    asked, parts = [], click_stream.state_parts

    def spy(spark, root, upto=None, buckets=None):
        asked.append(buckets)
        return parts(spark, root, upto, buckets)

    monkeypatch.setattr(click_stream, "state_parts", spy)
    lines = [json.dumps({"user_id": f"u{i}", "article_id": "a", "event_id": i, "ts": "2024-01-01T00:00:00"}) for i in range(200)]
    put(source, "1.json", "\n".join(lines))
    click_stream.fold_clicks(spark, source, articles, root, refresh=lambda touched, mine: touched)
    put(source, "2.json", lines[7])
    click_stream.fold_clicks(spark, source, articles, root, refresh=lambda touched, mine: mine.select("user_id"), compact_every=2)
    assert len(asked[0]) > 30 and len(asked[1]) == 1
    recents, _ = parts(spark, root, 0, asked[1])
    assert 0 < recents.count() < 20
    plan = recents._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "bucket" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert readers.versions(spark, f"{root}/base_counts") == [1]
    assert sorted({r["total_clicks"] for r in click_stream.read_profiles(spark, root).collect()}) == [1, 2]


def test_an_upsert_rewrites_touched_buckets_only(spark, tmp_path):
    root = str(tmp_path)
    order, valid = [F.col("at").desc()], F.col("v") >= 0
    first = spark.range(500).select(F.col("id").cast("string").alias("k"), F.lit(1).alias("v"), F.lit(1).alias("at"))
    writers.upsert_version(spark, root, first, "k", order, valid)
    writers.upsert_version(spark, root, spark.createDataFrame([("7", 2, 1)], "k string, v int, at int"), "k", order, valid)
    assert len(readers.folder_names(spark, f"{root}/items/v=0")) > 50
    assert len([n for n in readers.folder_names(spark, f"{root}/items/v=1") if n.startswith("bucket=")]) == 1
    got = {r["k"]: r["v"] for r in writers.read_items(spark, root).collect()}
    assert len(got) == 500 and got["7"] == 2 and sum(got.values()) == 501
