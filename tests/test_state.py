import json
import os
import random
from datetime import datetime, timedelta

import pytest

from clickloom import schemas
from clickloom.operators import profiles
from clickloom.streaming import state

T0 = datetime(2024, 1, 1)
PROFILE = "user_id string, category_preferences map<string,bigint>, top_category string, recent_clicks array<string>, total_clicks bigint"


def put(folder, name, clicks):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w", encoding="utf-8") as f:
        for user, article, event, ts in clicks:
            f.write(json.dumps({"user_id": user, "article_id": article, "event_id": event, "ts": ts and ts.isoformat()}) + "\n")


@pytest.fixture(scope="module")
def articles(spark):
    return spark.createDataFrame([(f"a{i}", ["health", "sports", None][i % 3]) for i in range(35)], "article_id string, category string")


def shown(df):
    return sorted(map(str, df.collect()))


def test_state_equals_batch_fold_over_restarts(spark, articles, tmp_path):
    """A hot user has two thirds of the clicks, times repeat, and each run is a restart on the same folder."""
    rng = random.Random(3)
    clicks = [
        ("hot" if rng.random() < 0.66 else f"u{rng.randrange(5)}", f"a{rng.randrange(40)}", i, T0 + timedelta(seconds=rng.randrange(200)))
        for i in range(600)
    ]
    start = spark.createDataFrame(
        [("u0", {"health": 2}, "health", ["x", "a1"], 2), ("idle", {"science": 1}, "science", ["y"], 1), ("bare", {}, "unknown", [], 0)], PROFILE
    )
    accepted, rejected = profiles.validate_clicks(spark.createDataFrame(clicks, schemas.CLICK), articles)
    want = profiles.update_profiles(start, accepted)
    source, root = str(tmp_path / "in"), str(tmp_path / "state")
    state.start_from(start, root)
    for part in range(3):
        put(source, f"{part}.json", clicks[part::3])
        state.fold_clicks(spark, source, articles, root, files_per_batch=1)
    state.fold_clicks(spark, source, articles, root)
    assert shown(state.profiles_in_state(spark, root)) == shown(want)
    touched = accepted.select("user_id").distinct()
    assert shown(state.changed_profiles(spark, root)) == shown(want.join(touched, "user_id", "left_semi").select(*want.columns))
    got = [tuple(r) for r in state.rejected_clicks(spark, root).collect()]
    assert sorted(got) == sorted(tuple(r) for r in rejected.select("user_id", "article_id", "event_id", "error").collect())


def test_a_batch_writes_only_the_users_it_touches(spark, articles, tmp_path):
    source, root = str(tmp_path / "in"), str(tmp_path / "state")
    put(source, "0.json", [(f"u{i}", "a0", i, T0) for i in range(50)])
    state.fold_clicks(spark, source, articles, root)
    put(source, "1.json", [("u7", "a1", 99, T0)])
    state.fold_clicks(spark, source, articles, root)
    last = spark.read.parquet(f"{root}/out/batch=1").collect()
    assert [(r["user_id"], r["recent"]) for r in last] == [("u7", ["a1", "a0"])]
    assert state.profiles_in_state(spark, root).count() == 50


def test_event_ids_count_once_until_their_timer(spark, articles, tmp_path):
    """A repeat within the delay is dropped, in one batch or in two; an id comes back when its time is over."""
    source, root = str(tmp_path / "in"), str(tmp_path / "state")

    def run(name, clicks):
        put(source, name, clicks)
        state.fold_clicks(spark, source, articles, root, once_within_seconds=60)
        return {r["user_id"]: r["total_clicks"] for r in state.profiles_in_state(spark, root).collect()}

    assert run("0.json", [("u", "a0", 1, T0), ("u", "a0", 1, T0)]) == {"u": 1}
    assert run("1.json", [("u", "a0", 1, T0 + timedelta(seconds=1)), ("u", "a1", None, T0), ("u", "a1", None, T0)]) == {"u": 3}
    assert run("2.json", [("v", "a0", 2, T0 + timedelta(seconds=300))]) == {"u": 3, "v": 1}
    assert run("3.json", [("u", "a0", 1, T0 + timedelta(seconds=290))])["u"] == 4
    assert run("4.json", [("u", "a2", 9, T0)])["u"] == 4


def test_replays_nulls_and_an_empty_source(spark, articles, tmp_path):
    source, root = str(tmp_path / "in"), str(tmp_path / "state")
    put(source, "0.json", [("u", "a0", 1, T0), ("u", "a0", 1, T0), (None, "a0", 2, T0), ("u", None, 3, T0), ("u", "a3", 4, None)])
    state.fold_clicks(spark, source, articles, root)
    row = state.profiles_in_state(spark, root).first()
    assert (row["user_id"], row["total_clicks"], row["recent_clicks"]) == ("u", 3, ["a0", "a3"])
    assert [r["event_id"] for r in state.rejected_clicks(spark, root).collect()] == [3]
    empty = str(tmp_path / "empty")
    put(empty, "0.json", [])
    state.fold_clicks(spark, empty, articles, str(tmp_path / "none"))
