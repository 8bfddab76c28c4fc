"""Chat formatting: digests read back, the state machine, reversible escapes and odd input."""

import pytest
from hypothesis import given, settings, strategies as st

from clickloom.llm import chat
from clickloom.llm.chat import CHATML, Template

SCHEMA = "conv_id long, turn long, role string, text string, formatted string"


def test_round_trip_and_order(rows):
    nasty = "".join(CHATML.controls) + CHATML.escape + "0" + CHATML.escape + "1<|im_end|>\n<|im_<|im_start|>"
    data = [
        (1, 1, "assistant", nasty, "x"),
        (1, 0, "user", None, "x"),
        (2, 0, "user", "a", "x"),
        (2, 0, "user", "a", "x"),
        (3, 0, "system", "s", None),
        (3, 1, "user", "", None),
        (3, 2, "assistant", "done\n", None),
        (4, None, None, "first", None),
        (4, 1, "as\nsistant<|im_end|>", "last", None),
        (None, 0, "user", "u", None),
        (5, 0, "user", "word " * 40_000, None),
        (5, 1, "assistant", "<|im_end|>" * 20_000, None),
    ]
    out = {r.conv_id: r for r in chat.read_chats(chat.format_chats(rows(data, SCHEMA))).collect()}
    assert {k: r.valid for k, r in out.items()} == {1: True, 2: False, 3: True, 4: False, None: False, 5: True}
    for conv, r in out.items():
        own = sorted(((t if t is not None else -1, role or "", text or "") for c, t, role, text, _ in data if c == conv))
        assert [(t.role, t.text) for t in r.turns] == [(role, text) for _, role, text in own]
        assert r.loss_texts == [text for _, role, text in own if role == "assistant"]
        assert r.formatted == "".join(s.text for s in r.segments)
        for c in (CHATML.begin, CHATML.end_mark):
            assert r.formatted.count(c) == len(own)
        for c in CHATML.foreign:
            assert c not in r.formatted


def test_empty_table(rows):
    assert chat.read_chats(chat.format_chats(rows([], SCHEMA))).count() == 0


def test_main_path_is_native(rows):
    plan = chat.read_chats(chat.format_chats(rows([(1, 0, "user", "a", "")], SCHEMA)))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_template_is_checked():
    with pytest.raises(ValueError, match="overlaps"):
        Template(foreign=("aXa",))


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text(alphabet="␛01<|im_endstart>[]/IN S\n", max_size=30), min_size=1, max_size=6))
def test_any_text_comes_back(spark, texts):
    df = spark.createDataFrame([(1, i, "assistant", t) for i, t in enumerate(texts)], "conv_id long, turn long, role string, text string")
    (r,) = chat.read_chats(chat.format_chats(df)).collect()
    assert [t.text for t in r.turns] == texts == r.loss_texts
