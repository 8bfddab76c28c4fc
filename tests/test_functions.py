import hashlib
import math
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from clickloom.functions import casts, collections as coll, ids
from clickloom.functions.text import joined_text, strip, tokens


def one(df, column):
    return [r[0] for r in df.select(column).collect()]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_live_id_prefers_url_and_treats_blank_as_missing(rows):
    df = rows(
        [(" HTTP://A ", "t", "p", "s"), (None, "T", None, "S"), ("  ", "T", None, "S")],
        "url string, title string, published string, source string",
    )
    c = [F.col(n) for n in df.columns]
    assert one(df, ids.live_article_id(*c)) == [sha("http://a"), sha("t||||s"), sha("t||||s")]
    assert one(df, ids.live_article_id(*c, blank_is_missing=False))[2] == sha("")


def test_catalogue_id(rows):
    df = rows([("\tHttp://A\n", "N1"), (None, " N1 "), (" ", ""), ("", None)], "url string, news_id string")
    got = one(df, ids.catalogue_article_id(F.col("url"), F.col("news_id"), strip))
    assert got == [sha("http://a"), sha("n1"), None, None]


def test_embedding_id_keeps_case(rows):
    df = rows([(" Http://A", "T", "S", "D"), ("", " T ", "S", "D")], "url string, title string, source string, day string")
    assert one(df, ids.embedding_article_id(*[F.col(n) for n in df.columns])) == [sha("Http://A"), sha("T||S||D")]


def test_casts(rows):
    df = rows([("12",), ("1.9",), ("-3.7",), ("x",), ("nan",), (None,), ("",)], "x string")
    assert one(df, casts.whole_or_zero(F.col("x"))) == [12, 1, -3, 0, 0, 0, 0]
    assert one(rows([("0.5",), ("bad",), (None,)], "x string"), casts.double_or(F.col("x"), 7.0)) == [0.5, 7.0, 7.0]


def test_timestamps(rows):
    data = ["2024-01-02T03:04:05.678901+02:00", "11/11/2019 9:05:58 AM", "11/11/2019 12:05:58 PM", "garbage", "", None]
    got = one(rows([(x,) for x in data], "x string"), casts.utc_timestamp(F.col("x")))
    assert got == [
        datetime(2024, 1, 2, 1, 4, 5, 678901),
        datetime(2019, 11, 11, 9, 5, 58),
        datetime(2019, 11, 11, 12, 5, 58),
        None,
        None,
        None,
    ]


def test_strip_handles_every_blank(rows):
    assert one(rows([("\t a b  \n",)], "x string"), strip(F.col("x"))) == ["a b"]


def test_joined_text_takes_first_body_with_text(rows):
    df = rows([("T", " ", None, "c"), (None, "a", "b", "c"), ("T", None, None, None)], "t string, a string, b string, c string")
    assert one(df, joined_text(*[F.col(n) for n in df.columns])) == ["T c", "a", "T"]


def test_tokens(rows):
    assert one(rows([("Été x l'été, 12 a_b",)], "x string"), tokens(F.col("x"))) == [["été", "été", "12", "a_b"]]


@pytest.mark.parametrize(
    "value,schema,want",
    [
        (["a", None, "b"], "array<string>", ["a", "b"]),
        (None, "array<string>", []),
        ([], "array<string>", []),
        ([1, 2], "array<int>", ["1", "2"]),
        (" x ", "string", ["x"]),
        ("", "string", []),
        (" NaN ", "string", []),
        (None, "string", []),
        (7, "int", ["7"]),
        (float("nan"), "double", []),
    ],
)
def test_click_list(rows, value, schema, want):
    df = rows([(value,)], f"x {schema}")
    assert one(df, coll.click_list(F.col("x"), df.schema["x"].dataType)) == [want]


def test_tail_returns_short_arrays_whole(rows):
    df = rows([(list("abcd")[:n],) for n in range(5)], "x array<string>")
    assert one(df, coll.tail(F.col("x"), 3)) == [[], ["a"], ["a", "b"], ["a", "b", "c"], ["b", "c", "d"]]


def test_move_to_front(rows):
    df = rows([(["a", "b", "c"], "b"), (["a", "b", "c"], "z")], "x array<string>, y string")
    assert one(df, coll.move_to_front(F.col("x"), F.col("y"), 3)) == [["b", "a", "c"], ["z", "a", "b"]]


def test_top_key_ties_and_empty_maps(rows):
    df = rows(
        [({"zz": 2, "science": 2, "health": 2},), ({"b": 1, "a": 1},), ({"health": 0},), ({},)], "m map<string,bigint>"
    )
    assert one(df, coll.top_key(F.col("m"))) == ["health", "a", "unknown", "unknown"]


def test_cosine(rows):
    df = rows([([1.0, 0.0], [1.0, 1.0]), ([0.0, 0.0], [1.0, 0.0])], "a array<double>, b array<double>")
    got = one(df, coll.cosine(F.col("a"), F.col("b")))
    assert got[0] == pytest.approx(math.sqrt(0.5)) and got[1] == 0.0


def test_narrow_number(rows):
    assert one(rows([(2.0,), (2.5,), (None,)], "x double"), casts.narrow_number(F.col("x"))) == ["2", "2.5", None]


def test_rounded_vector(rows):
    assert one(rows([([0.1234567, 1.0],)], "x array<double>"), coll.rounded(F.col("x"))) == [[0.123457, 1.0]]
