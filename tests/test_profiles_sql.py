"""The profile queries against their SQL where a user has nothing counted."""

import os
import sys
from datetime import datetime, timedelta

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry  # noqa: E402
from compare import TABLES, difference, duck  # noqa: E402


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """User 1 bought only what counts for no category, user 2 also clicked, user 3 bought an article of a category."""
    at = datetime(2024, 1, 1)
    made = {
        "part": ([(10, "p a", "b", "PROMO", 1, 1.0), (11, "p b", "b", "LARGE", 1, 1.0)], "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"),
        "orders": ([(1, 1), (2, 2), (3, 3)], "o_orderkey long, o_custkey long"),
        "lineitem": ([(1, 10, "F", at), (1, 10, "O", at + timedelta(1)), (2, 10, "F", at), (3, 11, "F", at)], "l_orderkey long, l_partkey long, l_linestatus string, l_shipdate timestamp"),
        "events": ([(5, at, 2, "click", 1.0, '{"k": 7}'), (6, at, 1, "click", 1.0, '{"k": 8}')], "event_id long, ts timestamp, user_id long, event_type string, value double, props string"),
        "documents": ([(7, "text", "en", "src1", 4), (8, "text", "fr", "src1", 4)], "doc_id long, text string, lang string, source string, n_chars long"),
        "labels": ([(7, 1, 0)], "doc_id long, quality int, toxic int"),
    }
    path = str(tmp_path_factory.mktemp("tables"))
    for name in TABLES:
        rows, schema = made.get(name, ([], "x int"))
        spark.createDataFrame(rows, schema).coalesce(1).toPandas().to_parquet(f"{path}/{name}.parquet", coerce_timestamps="us")
    return path


@pytest.mark.parametrize("name", ["profile_update", "stream_profile_update", "stream_state_profiles"])
def test_users_without_counted_clicks(spark, folder, name):
    got = entry.queries()[name](spark, folder).toPandas()
    assert {r.top_category for r in got.itertuples() if r.user_id == "1"} == {"business"}
    assert difference(got, duck(folder).execute(entry.oracle_sql()[name]).df()) is None
