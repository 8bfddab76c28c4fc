"""BagMinHash signatures, classes against brute force, and components."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from clickloom.llm import neardup
from clickloom.llm.components import components


def bag(text):
    w = re.findall("[^ \t-\r]+", text or "")
    return Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()


def similarity(x, y):
    return sum((x & y).values()) / max(1, sum((x | y).values()))


def classes(data, threshold=0.8):
    top = {d: d for d, _ in data}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for i, (a, ta) in enumerate(data):
        for b, tb in data[:i]:
            if ta is not None and (ta == tb or (tb is not None and similarity(bag(ta), bag(tb)) >= threshold)):
                x, y = find(a), find(b)
                top[max(x, y)] = min(x, y)
    return {d: find(d) for d, _ in data}


def corpus(seed=2):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(500)]
    data = [(0, None), (1, None), (2, ""), (3, ""), (4, " \n"), (5, "one"), (6, "one"), (7, "one  "), (8, "a b c"), (9, "a b c d e")]
    for base in range(25):
        text = rng.choices(words, k=rng.randint(5, 300)) + ["echo"] * rng.choice([0, 0, 40])
        for _ in range(rng.choice([1, 1, 2, 4, 30])):
            copy = list(text)
            for _ in range(rng.choice([0, 0, 1, 2, 6])):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            data.append((len(data), " ".join(copy)))
    data += [(1000, "long " * 3 + " ".join(rng.choices(words, k=60_000)))]
    return data + [(1001, data[-1][1].replace("w7 ", "w8 ", 5))]


def test_signatures_are_unbiased():
    rng = np.random.default_rng(1)
    n, registers = 40, 2000
    x, y = rng.integers(0, 9, n), rng.integers(0, 9, n)
    names = rng.integers(0, 2**63, n).astype(np.uint64)
    text = np.repeat([0, 1], n)
    count = np.concatenate([x, y])
    some = count > 0
    s = neardup.bag_minhash(text[some], np.tile(names, 2)[some], count[some], 3, registers)
    want = np.minimum(x, y).sum() / np.maximum(x, y).sum()
    assert (s[0] == s[1]).mean() == pytest.approx(want, abs=4 * (want * (1 - want) / registers) ** 0.5)
    assert np.isinf(s[2]).all() and np.isfinite(s[:2]).all()


def test_overlaps():
    texts = [t or "" for _, t in corpus()]
    a, b = texts, texts[1:] + texts[:1]
    got = neardup.overlaps(pa.array(a), pa.array(b))
    assert got == pytest.approx([similarity(bag(x), bag(y)) for x, y in zip(a, b)])


@pytest.mark.parametrize("crowd", [16, 2])
def test_brute_force(rows, monkeypatch, crowd):
    monkeypatch.setattr(neardup, "CROWD", crowd)
    monkeypatch.setattr(neardup, "BLOCK", 4 * crowd)
    data = corpus()
    df = rows([(d, t, 1, "x") for d, t in data + data[20:23]], "doc_id long, text string, class_id int, bands string")
    got = neardup.near_duplicates(df).collect()
    assert len(got) == len(data) + 3
    want = classes(data)
    assert {r.doc_id: r.class_id for r in got} == want
    assert len(set(want.values())) < len(data) - 50


def test_empty_table_and_null_ids(rows):
    assert neardup.near_duplicates(rows([], "doc_id long, text string")).count() == 0
    got = neardup.near_duplicates(rows([(None, "a b"), (3, "a b"), (None, "c")], "doc_id long, text string")).collect()
    assert sorted(((r.doc_id or -1), r.class_id or -1) for r in got) == [(-1, -1), (-1, 3), (3, 3)]


def test_keep_one_judges_rows(rows):
    long = [" ".join(f"{w}{i}" for i in range(60)) for w in "abcd"]
    data = [(1, long[0], "a"), (1, long[1], "b"), (2, long[2], "c"), (2, long[2], "c"), (3, long[0] + " more", "d"), (None, long[3], "e")]
    data += [(None, long[3] + " end", "f"), (None, None, "g"), (4, long[3], "h"), (4, None, "i"), (None, None, "g"), (1, "", "j")]
    for shift in (0, (1 << 63) - 5):
        df = rows([(d if d is None else d + shift, t, x) for d, t, x in data], "doc_id long, text string, row_key string")
        kept = neardup.keep_one(df)
        assert kept.columns == df.columns
        got = sorted(r.row_key for r in kept.collect())
        # One of e, f and h, which have no number of their own, stays.
        assert [x for x in got if x not in "efh"] == ["b", "c", "d", "g", "i", "j"] if not shift else len(got) == 7
        assert sum(x in "efh" for x in got) == 1
    full = rows([(-(1 << 63), "a", "x"), ((1 << 63) - 1, "b", "y"), (None, "c", "z")], "doc_id long, text string, row_key string")
    with pytest.raises(ValueError, match="free number"):
        neardup.keep_one(full)


def test_components(rows):
    rng = random.Random(4)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(70)] + [(2000, 2001 + i) for i in range(50)]
    top = {}

    def find(x):
        while top.setdefault(x, x) != x:
            x = top[x]
        return x

    for a, b in links:
        x, y = find(a), find(b)
        top[max(x, y)] = min(x, y)
    want = {x: find(x) for x in top if any(x in link and link[0] != link[1] for link in links)}
    assert {r.id: r.class_id for r in components(rows(links, "a long, b long")).collect()} == want
    assert components(rows([], "a long, b long")).count() == 0


def test_long_bands_miss_no_more_than_short_ones():
    short, long = neardup.BANDS, neardup.LONG_BANDS
    assert (1 - 0.8**long.rows) ** long.count <= (1 - 0.8**short.rows) ** short.count
    # 1000 pairs of which each shares 80 of 100 shingles.
    rng = np.random.default_rng(5)
    names = rng.integers(0, 2**63, (1000, 100)).astype(np.uint64)
    both = np.stack([names[:, :90], np.concatenate([names[:, :80], names[:, 90:]], 1)], 1).reshape(2000, 90)
    signature = neardup.bag_minhash(np.repeat(np.arange(2000), 90), both.ravel(), np.ones(both.size, np.int64), 2000, long.registers)
    bands = neardup.band_names(signature, long).reshape(1000, 2, -1)
    assert (~(bands[:, 0] == bands[:, 1]).any(1)).sum() <= 2
