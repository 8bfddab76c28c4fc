import json
import os
import random

import pytest

from clickloom import schemas
from clickloom.sources import arrays

TRICKY = ['plain', 'a,b', 'brace } ] { [', 'quote " and \\" end\\', '\\', '"', ',",', 'line\nbreak', 'é, ü', '', '],[', '\\",{']


def put(folder, name, payload):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w", encoding="utf-8") as f:
        f.write(payload)


@pytest.fixture
def small_ranges(spark):
    """Ranges of some hundred bytes, so that records and strings cross them."""
    names = {"spark.sql.files.maxPartitionBytes": "150", "spark.sql.files.openCostInBytes": "0", "spark.sql.files.minPartitionNum": "1"}
    before = {n: spark.conf.get(n, None) for n in names}
    for n, v in names.items():
        spark.conf.set(n, v)
    yield
    for n, v in before.items():
        spark.conf.unset(n) if v is None else spark.conf.set(n, v)


@pytest.mark.parametrize("indent", [None, 2])
@pytest.mark.parametrize("sent", [arrays.SENT_RANGES, 0])
def test_ranges_give_what_a_whole_parse_gives(spark, tmp_path, small_ranges, monkeypatch, indent, sent):
    monkeypatch.setattr(arrays, "SENT_RANGES", sent)
    rng = random.Random(4)
    want = []
    for file in range(4):
        records = []
        for i in range(25 * file):
            one = {"user_id": f"{file}-{i}", "article_id": "".join(rng.choices(TRICKY, k=rng.randrange(4))), "action": rng.choice(TRICKY)}
            one |= {"more": [{"x": [1, "],"]}, rng.choice(TRICKY)]} if rng.random() < 0.3 else {}
            one |= {"session_id": "long, " * 200} if i == 7 else {}
            records.append(one)
            want.append((one["user_id"], one["article_id"], one["action"], one.get("session_id")))
        put(str(tmp_path), f"{file}.json", json.dumps(records, indent=indent, ensure_ascii=file % 2 == 0))
    got, rejected = arrays.read_ranges(spark, str(tmp_path), schemas.USER_LOG)
    assert sorted((r["user_id"], r["article_id"], r["action"], r["session_id"]) for r in got.collect()) == sorted(want, key=lambda w: w[:3])
    assert rejected.count() == 0
    assert got.columns == schemas.USER_LOG.names


def test_rejected_payloads(spark, tmp_path):
    good = [{"user_id": "1"}, None, {"user_id": "2"}]
    put(str(tmp_path), "a.json", json.dumps(good))
    put(str(tmp_path), "b.json", json.dumps({"user_id": "3"}))
    put(str(tmp_path), "c.json", '[{"user_id": "4"}')
    put(str(tmp_path), "d.json", '[{"user_id": "5"}, {broken}, {"user_id": "6"}]')
    put(str(tmp_path), "e.json", '[{"user_id": "7"}] [{"user_id": "8"}]')
    put(str(tmp_path), "f.json", '[{"user_id": "9, ]')
    put(str(tmp_path), "g.json", "")
    put(str(tmp_path), "h.json", " \n[ ]\n")
    put(str(tmp_path), "i.log", json.dumps(good))
    got, rejected = arrays.read_ranges(spark, str(tmp_path), schemas.USER_LOG)
    assert sorted(r["user_id"] for r in got.collect()) == ["1", "2", "5", "6"]
    seen = sorted((r["path"][-6:], r["value"] and r["value"].strip(), r["error"]) for r in rejected.collect())
    whole = [(f"{n}.json", None, "no closed list") for n in "bcef"]
    assert sorted(seen, key=str) == sorted(whole + [("d.json", "{broken}", "no record")], key=str)


def test_a_large_file_is_read_by_many_tasks(spark, tmp_path, small_ranges):
    put(str(tmp_path), "a.json", json.dumps([{"user_id": str(i)} for i in range(500)]))
    text = spark.read.option("lineSep", ",").text(str(tmp_path))
    assert text.rdd.getNumPartitions() > 20
    got, _ = arrays.read_ranges(spark, str(tmp_path), schemas.USER_LOG)
    assert sorted(int(r["user_id"]) for r in got.collect()) == list(range(500))
