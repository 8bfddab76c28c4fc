"""Base patterns against plain regular expressions, the field on held-out strings, redaction and odd input."""

import random
import re

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from clickloom.llm import pii

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(x) > 255 for x in m[0].split(".")):
                continue
            if kind == "card" and not (12 <= len(digits) <= 19 and pii.luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((*m.span(), kind))
    return sorted(out, key=lambda s: (s[0], pii.KINDS.index(s[2])))


@settings(max_examples=1500, deadline=None)
@given(st.text(alphabet="a1.@ -+(29_5x0é", max_size=60))
def test_base_patterns(text):
    assert pii.base_spans(text) == plain(text)


def test_base_patterns_on_documents(spark):
    for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect():
        assert pii.base_spans(r.text) == plain(r.text)


@pytest.fixture(scope="module")
def field():
    return pii.fit(["the quick brown fox was born in 1984 and paid 12.50 for version 2.0.1 of it", "nothing to see here"])


def test_held_out_strings(field):
    hit = false = miss = 0
    for text, right in pii.examples(["some other words stand around the place here"], seed=1234):
        taken = [s for s in pii.base_spans(text) if not any(s[0] < e and s[1] > b for b, e, _ in right)]
        got, want = set(field.spans(text, taken)), set(right)
        hit, false, miss = hit + len(got & want), false + len(got - want), miss + len(want - got)
    assert hit / (hit + false) > 0.9 and hit / (hit + miss) > 0.85


def test_marginals_are_those_of_all_segmentations():
    spans, scores = [(0, 2), (1, 3), (2, 3), (0, 3)], np.array([[0.5, -1], [2, 0.1], [-0.3, 0.7], [0.2, 1.0]])
    ways = {(): 1.0}
    for r, row in enumerate(scores):
        for k, x in enumerate(row):
            for way in list(ways):
                if all(r != r2 and (spans[r][0] >= spans[r2][1] or spans[r2][0] >= spans[r][1]) for r2, _ in way):
                    ways[(*way, (r, k))] = ways[way] * np.exp(x)
    total = sum(ways.values())
    want = [[sum(w for way, w in ways.items() if (r, k) in way) / total for k in range(2)] for r in range(4)]
    assert pii._marginals(4, spans, scores) == pytest.approx(np.array(want))


TEXTS = [
    None,
    "",
    "mail jane.doe@mail.example.com or 10.0.0.255, card 4111 1111 1111 1111, call +49 (30) 1234-567.",
    "jane dot doe at mail dot example dot com; phone: (855) 555-4208",
    "x" * 100_000 + " 1.2.3.4",
    "1 2 3 " * 3000,
    "same a@b.c",
    "same a@b.c",
    "+1.2.3.4 5678901 4111111111111111@example.com",
]


def test_find_and_redact(rows, field):
    df = rows([(i, t, 3) for i, t in enumerate(TEXTS)], "doc_id long, text string, spans int")
    found = pii.find_pii(df, field)
    out = {r.doc_id: r for r in found.collect()}
    for i, t in enumerate(TEXTS):
        base = [(s.start, s.end, s.kind) for s in out[i].spans if s.base]
        assert base == plain(t or "")
        for s in out[i].spans:
            assert s.base or not any(a < s.end and s.start < b for a, b, _ in base)
    assert [(t.kind, TEXTS[3][t.start : t.end]) for t in out[3].spans] == [("email", "jane dot doe at mail dot example dot com"), ("phone", "(855) 555-4208")]
    redacted = {r.doc_id: r.text for r in pii.redact(found).collect()}
    assert redacted[0] is None and redacted[1] == ""
    assert redacted[2] == "mail <EMAIL> or <IP>, card <CARD>, call <PHONE>."
    assert pii.redact(found).columns == found.columns


def test_training_and_empty_tables(rows):
    empty = rows([], "doc_id long, text string")
    field = pii.train(empty)
    assert pii.find_pii(empty, field).count() == 0
    assert pii.train(rows([(1, None), (2, "call 555 1234"), (2, "")], "doc_id long, text string")).weights.shape == field.weights.shape


def test_long_runs_take_one_pass(field):
    text = "7" * 200_000 + " " + "(" * 200_000 + "+" * 100_000 + "- , " * 50_000
    assert pii.base_spans(text) == [] == field.spans(text, [])
