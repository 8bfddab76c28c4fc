import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from clickloom import schemas
from clickloom.operators import interactions as inter, profiles, vectors
from clickloom.plans.articles import build_user_vectors
from clickloom.schemas import CATEGORIES

T0 = datetime(2024, 1, 1)
CLICKS = "user_id string, article_id string, category string, event_time string"


def stamp(i):
    return (T0 + timedelta(minutes=i)).isoformat()


def test_vectors_of_ties_outsiders_and_long_histories(rows):
    data = [("tie", f"a{i}", c, stamp(i)) for i, c in enumerate(CATEGORIES)]
    data += [("out", "x", "sports", stamp(0))]
    data += [("long", f"b{i:02d}", "Health", stamp(i)) for i in range(15)]
    data += [(None, "n", "health", stamp(0))]
    got = {r["user_id"]: r for r in vectors.user_vectors(rows(data, CLICKS)).collect()}
    assert got["tie"]["top_category"] == "business" and got["tie"]["total_clicks"] == 5
    assert got["out"]["top_category"] == "unknown" and got["out"]["total_clicks"] == 0
    assert got["out"]["recent_clicks"] == ["x"] and got["out"]["health"] == 0
    assert got["long"]["recent_clicks"] == [f"b{i:02d}" for i in range(14, 4, -1)] and got["long"]["health"] == 15


def test_times_of_both_formats_share_one_order(rows):
    data = [("u", "early", "health", "1/1/2024 9:00:00 AM"), ("u", "late", "health", "2024-01-01T10:00:00+00:00")]
    df = rows(data, CLICKS)
    assert vectors.recent_clicks(df).first()["recent_clicks"] == ["late", "early"]
    assert vectors.recent_clicks(df, vectors.event_order(by_text=True)).first()["recent_clicks"] == ["late", "early"]
    swapped = rows([("u", "a", "x", "9/1/2024 9:00:00 AM"), ("u", "b", "x", "2024-12-01T10:00:00")], CLICKS)
    assert vectors.recent_clicks(swapped, vectors.event_order(by_text=True)).first()["recent_clicks"] == ["a", "b"]


def test_translated_ids(rows):
    logs = rows([], "user_id string, article_id string, category string, action string, timestamp string")
    beh = rows([("u", "1/1/2024 9:00:00 AM", "", "N1", "health", 1), ("u", "1/1/2024 9:00:00 AM", "", "N9", "health", 1)], "user_id string, event_time string, history string, article_id string, category string, clicked int")
    cat = rows([("N1", None, None, None, None, "http://a", None, None)], schemas.CATALOGUE)
    raw = build_user_vectors(logs, beh).first()["recent_clicks"]
    hashed = build_user_vectors(logs, beh, cat).first()["recent_clicks"]
    assert raw == ["N1", "N9"] and len(hashed) == 1 and len(hashed[0]) == 64


def test_raw_recents_replace_vector_lists(rows):
    old = rows([("a", ["1"]), ("b", ["2"]), ("c", None)], "user_id string, recent_clicks array<string>")
    logs = rows([("a", "9", "click", "2"), ("a", "8", "click", "1"), ("b", "7", "Click", "1")], "user_id string, article_id string, action string, timestamp string")
    got = {r["user_id"]: r["recent_clicks"] for r in vectors.merge_recents(old, vectors.raw_log_recents(logs)).collect()}
    assert got == {"a": ["9", "8"], "b": ["2"], "c": []}
    bare = vectors.raw_log_recents(logs.drop("timestamp"))
    assert bare.count() == 0 and vectors.merge_recents(old.drop("recent_clicks"), bare).where("size(recent_clicks) = 0").count() == 3


def test_profile_items_repair(rows):
    df = rows([("a", "2", None, " ", None), ("b", "x", 9, "science", 5)], "user_id string, health string, business int, top_category string, total_clicks int")
    got = {r["user_id"]: r for r in vectors.profile_items(df).collect()}
    assert got["a"]["category_preferences"]["health"] == 2 and got["a"]["top_category"] == "health" and got["a"]["total_clicks"] == 2
    assert got["b"]["category_preferences"]["health"] == 0 and got["b"]["top_category"] == "science" and got["b"]["total_clicks"] == 5
    assert got["a"]["recent_clicks"] == []


def test_interactions_drop_unknown_and_duplicate_clicks(rows):
    cat = rows([("N1", None, None, None, None, "http://a", None, None), ("N2", None, None, None, None, None, None, None)], schemas.CATALOGUE)
    mapping = inter.id_mapping(cat)
    ids = {r["news_id"]: r["article_id"] for r in mapping.collect()}
    articles = rows([(ids["N1"],), ("live",)], "article_id string")
    beh = rows([("u", "N1", 1, "1/1/2024 9:00:00 AM")] * 2 + [("u", "N1", 0, "1/1/2024 9:00:00 AM"), ("u", "N2", 1, "1/1/2024 9:00:00 AM"), ("u", "N7", 1, "1/1/2024 9:00:00 AM")], "user_id string, article_id string, clicked int, event_time string")
    logs = rows([("v", "live", "Click", "2024-01-01"), ("v", "live", "view", "2024-01-01"), ("v", "live", "click", "bad"), ("v", "gone", "click", "2024-01-01")], "user_id string, article_id string, action string, timestamp string")
    got = sorted((r["user_id"], r["article_id"], r["rating"], r["source"]) for r in inter.build_interactions(articles, beh, logs, mapping).collect())
    assert got == [("u", ids["N1"], 1.0, "mind_click"), ("v", "live", 1.0, "simulated_click")]


def fold(state, user, article, category):
    """One click after another."""
    p = state.setdefault(user, {"recent": [], "prefs": {}, "total": 0})
    p["recent"] = ([article] + [x for x in p["recent"] if x != article])[:20]
    p["prefs"][category] = p["prefs"].get(category, 0) + 1
    p["total"] += 1


def test_click_fold_equals_sequential_updates(rows):
    rng = random.Random(5)
    start = [("u0", {"health": 3}, "health", [f"old{i}" for i in range(20)], 3), ("u1", {}, "unknown", [], 0)]
    state = {u: {"recent": list(r), "prefs": dict(m), "total": t} for u, m, _, r, t in start}
    clicks = []
    for i in range(600):
        user, article = f"u{rng.randrange(4)}", rng.choice([f"old{rng.randrange(20)}", f"a{rng.randrange(30)}"])
        category = rng.choice(["health", "sports", "science"])
        clicks.append((user, article, category, i, T0 + timedelta(seconds=i // 2)))
        fold(state, user, article, category)
    profs = rows(start, "user_id string, category_preferences map<string,bigint>, top_category string, recent_clicks array<string>, total_clicks bigint")
    got = profiles.update_profiles(profs, rows(clicks, "user_id string, article_id string, category string, event_id bigint, ts timestamp"))
    for r in got.collect():
        want = state[r["user_id"]]
        assert r["recent_clicks"] == want["recent"]
        assert {k: v for k, v in r["category_preferences"].items() if v} == want["prefs"]
        assert r["total_clicks"] == want["total"]


def test_clicks_on_unknown_articles_are_rejected(rows):
    clicks = rows([("u", "a"), ("u", "b")], "user_id string, article_id string")
    ok, bad = profiles.validate_clicks(clicks, rows([("a", None)], "article_id string, category string"))
    assert [tuple(r) for r in ok.select("article_id", "category").collect()] == [("a", "unknown")]
    assert bad.first()["error"] == "Article not found: b"


def test_histories_are_long_form(rows):
    df = rows([("u", "a", T0), ("u", "a", T0 + timedelta(1)), ("u", "b", T0)], "user_id string, article_id string, timestamp timestamp")
    got = {r["article_id"]: (r["clicks"], r["last_time"]) for r in inter.user_histories(df).collect()}
    assert got == {"a": (2, T0 + timedelta(1)), "b": (1, T0)}
    assert inter.pair_weights(df).agg(F.sum("weight")).first()[0] == 3
