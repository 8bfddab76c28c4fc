import hashlib
import zlib

import pytest

from clickloom.llm import manifest

SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (*row[:4], text)))


def climb(nodes):
    """All levels of a tree."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i : i + 3]) for i in range(0, len(levels[-1]), 3)])
    return levels


def way(levels, at):
    out = []
    for nodes in levels[:-1]:
        run = at // 3 * 3
        out.append(("".join(nodes[run:at]), "".join(nodes[at + 1 : run + 3])))
        at //= 3
    return out


def brute(rows):
    by_source = {}
    for r in rows:
        by_source.setdefault(r[1], []).append(r)
    names = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in names:
        trees[s] = sorted(by_source[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[4])))
    levels = {s: climb([leaf(r, r[4]) for r in trees[s]]) for s in names}
    top = climb([levels[s][-1][0] for s in names])
    out = []
    for i, s in enumerate(names):
        for at, r in enumerate(trees[s]):
            steps = way(levels[s], at) + way(top, i)
            broken = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0
            now = leaf(r, r[4].replace("\n", "") if broken and r[4] is not None else r[4])
            for left, right in steps:
                now = h(left, now, right)
            out.append((r[0], s, at, leaf(r, r[4]), levels[s][-1][0], top[-1][0], h(*(a + b for a, b in steps)), now, now == top[-1][0]))
    return out


def check(spark, rows):
    got = manifest.manifest(spark.createDataFrame(rows, SCHEMA)).collect()
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted(brute(rows), key=key)


def test_many_rows_in_one_source(spark):
    rows = [(i * 37 % 100_003, "a", "en", i, f"line {i}\nline") for i in range(2300)]
    rows += [(i, "b", None, None, "x") for i in range(243)] + [(5, "c", "en", 1, "alone\n")]
    check(spark, rows)


@pytest.mark.parametrize("size", [1, 2, 3, 4, 9, 10, 27, 28, 729, 730])
def test_sizes_about_powers(spark, size):
    check(spark, [(i, "s", "en", i, "t\n") for i in range(size)])


def test_nulls_repeats_and_far_ids(spark):
    rows = [(None, "s", "en", 1, f"text {i}") for i in range(30)] + [(7, "s", "en", 2, f"other {i}\n") for i in range(40)]
    rows += [(7, "s", "en", 2, "same\n")] * 5 + [(8, "s", None, None, None), (9, "", "", 0, ""), (10, None, "ü", -3, "\n\nä\n"), (10, None, "ü", -3, "\n\nä\n")]
    rows += [(-(1 << 63), "s", "en", 1, "low"), ((1 << 63) - 1, "s", "en", 1, "high"), (-5, "s", "en", 1, "z" * 200_000)]
    rows += [(1 << k, "s", "en", k, "power\n") for k in range(62)]
    check(spark, rows)


def test_empty_and_clashing_columns(spark):
    assert manifest.manifest(spark.createDataFrame([], SCHEMA)).collect() == []
    rows = [(1, "a", "en", 1, "x\n", 9, "w"), (2, "a", "en", 1, "y\n", 9, "w"), (3, "b", "en", 1, "z\n", 9, "w")]
    got = manifest.manifest(spark.createDataFrame(rows, SCHEMA + ", pos int, leaf string")).collect()
    assert sorted(map(tuple, got)) == sorted(brute([r[:5] for r in rows]))


def test_directory_has_no_large_group(spark):
    rows = spark.createDataFrame([(i * 1_000_003, "s", "en", 1, "t") for i in range(500)], SCHEMA)
    words = manifest.bitmaps(manifest.leaf_rows(rows))
    ranks = {r["word"]: r["before"] for r in manifest.directory(words).collect()}
    assert [ranks[w] for w in sorted(ranks)] == list(range(500)) and {r["total"] for r in manifest.directory(words).collect()} == {500}
