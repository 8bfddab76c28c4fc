"""Removal of byte strings that repeat across documents, in rounds over longer strings.

Every byte covered by a string of ``length`` bytes that also starts in a document with a smaller id is
removed. This is not prefix doubling by range sorts: positions get names of the strings that start there, Spark
groups (name, position) pairs by a hash of the name into buckets, and NumPy sorts within a bucket. A position
whose name no other document has drops out; the rest are named anew by longer strings, up to the threshold:

1. Strings of about half the length, ranked at anchors only: the smallest-named of the short strings inside
   each window of ``length`` bytes. Equal windows have equal anchors, so a window whose anchor is unique is
   unique, and one anchor stands for a run of windows. This is the one round over all of the text.
2. The whole run that an anchor stands for. Runs that equal one in an earlier document go at once; runs whose
   anchor has no other run drop out.
3. The single windows of what is left: pairs of the ranks of two halves, at an offset of half the length.

Sources are hashed groups of documents of a few megabytes. A source sends each rank once, for its smallest
document, and settles its other documents itself, so a rank that a third of all documents share costs one
row per source. Positions travel as packed arrays; texts are shuffled once, and all rounds read that shuffle.

Ranks are 64-bit names; with n different strings compared in a round, about n^2 / 2^65 pairs collide.

Null texts are empty. Documents with equal ids do not cover each other; those with a null id come last.
Only the id and the text are read. Repeated rows each give a row.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from clickloom.llm.texts import flat, mix, name_spans, pieces, prefix_sums
from clickloom.session import ship

LENGTH = 50
# Text per source, and per bucket what it gives: grows with the root of the text, so that packed arrays stay worth packing.
LEAST_BYTES, MOST_BYTES, PACKED = 4 << 20, 64 << 20, 2048
LEAST_SOURCES = 64
NOWHERE = np.uint64((1 << 32) - 1)
_SENT = "bucket bigint, src bigint, blob binary"
_REPLY = "src bigint, blob binary"


def pack(*columns: np.ndarray) -> bytes:
    """Columns of unsigned numbers, the first ascending, as compressed byte planes of differences and offsets."""
    n = len(columns[0])
    parts = [np.array([n, len(columns)], np.uint32).tobytes()]
    for i, column in enumerate(columns):
        column = column.astype(np.uint64)
        base = column.min() if n else np.uint64(0)
        values = np.diff(column, prepend=base) if i == 0 and n else column - base
        width = (int(values.max()).bit_length() + 7) // 8 if n else 0
        parts += [base.tobytes(), bytes([width]), np.ascontiguousarray(values.view(np.uint8).reshape(n, 8)[:, :width].T).tobytes()]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(parts))


def unpack(blob: bytes) -> list[np.ndarray]:
    data = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
    n, count = data[:8].view(np.uint32)
    n, at, out = int(n), 8, []
    for i in range(count):
        base, width = data[at : at + 8].copy().view(np.uint64)[0], int(data[at + 8])
        planes = np.zeros((n, 8), np.uint8)
        planes[:, :width] = data[at + 9 : at + 9 + n * width].reshape(width, n).T
        values = planes.view(np.uint64)[:, 0]
        out.append((np.cumsum(values, dtype=np.uint64) if i == 0 else values) + base)
        at += 9 + n * width
    return out


def together(blobs: list[bytes], columns: int) -> list[np.ndarray]:
    """The columns of all blobs, end to end."""
    found = [unpack(b) for b in blobs]
    return [np.concatenate([f[i] for f in found]) if found else np.zeros(0, np.uint64) for i in range(columns)]


def leftmost_smallest(values: np.ndarray, n: int) -> np.ndarray:
    """The index of the smallest of each ``n`` neighbouring values, the leftmost of equals."""
    at, size = np.arange(len(values), dtype=np.int32), 1
    while size * 2 <= n:
        first = values[:-size] <= values[size:]
        at, values, size = np.where(first, at[:-size], at[size:]), np.where(first, values[:-size], values[size:]), size * 2
    if rest := n - size:
        at = np.where(values[:-rest] <= values[rest:], at[:-rest], at[rest:])
    return at


def anchors(offsets: np.ndarray, data: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Runs of windows with one anchor: first window, number of windows, anchor's place in it, anchor's name."""
    short = short_length(length)
    if len(data) < length:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),)
    start = np.arange(len(data) - short + 1)
    names = name_spans(prefix_sums(data), start, start + short)
    chosen = leftmost_smallest(names, length - short + 1)
    # Windows that start less than `length` before the end of their text are none.
    late = np.zeros(len(data) + 1, np.int32)
    np.add.at(late, np.maximum(offsets[1:] - length + 1, offsets[:-1]), 1)
    np.add.at(late, offsets[1:], -1)
    window = np.flatnonzero(np.cumsum(late)[: len(chosen)] == 0)
    if not len(window):
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),)
    at = chosen[window]
    new = np.ones(len(window), bool)
    new[1:] = (at[1:] != at[:-1]) | (window[1:] != window[:-1] + 1)
    first = np.flatnonzero(new)
    return window[first], np.diff(np.append(first, len(window))), at[first] - window[first], names[at[first]]


def short_length(length: int) -> int:
    return max(1, length // 2 - 1)


class Source:
    """The documents of one source, in order of id and text, with one byte array for all."""

    def __init__(self, table: pa.Table):
        self.table = table.sort_by([("doc_id", "ascending"), ("text", "ascending")])
        self.column = self.table["text"].combine_chunks()
        if isinstance(self.column, pa.ChunkedArray):
            self.column = pa.concat_arrays(self.column.chunks)
        offsets, data = flat(self.column)
        self.offsets, self.data = offsets - offsets[0], data[offsets[0] : offsets[-1]]
        ids = self.table["doc_id"].to_pylist()
        # Order-preserving unsigned keys; null comes last.
        self.keys = np.array([(1 << 64) - 1 if i is None else i + (1 << 63) for i in ids], np.uint64)

    def doc(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.offsets, at.astype(np.int64), "right") - 1


def groups(*sorted_columns: np.ndarray) -> np.ndarray:
    """The number of the group of equal rows that each row of sorted columns is in."""
    new = np.zeros(len(sorted_columns[0]), bool)
    for c in sorted_columns:
        new[1:] |= c[1:] != c[:-1]
    return np.cumsum(new)


def earliest(group: np.ndarray, key: np.ndarray) -> np.ndarray:
    """For each row the smallest key of its group; rows are sorted by group and key."""
    first = np.flatnonzero(np.diff(group, prepend=-1))
    return key[first][group]


class Plan:
    """Numbers that all tasks share, and the work of each round."""

    def __init__(self, length: int, buckets: int, bits: int):
        self.length, self.buckets, self.drop = length, buckets, np.uint64(64 - bits)

    def sent(self, src: int, names: np.ndarray, columns: list[np.ndarray], own: list[bytes]) -> pa.Table:
        """Rows for the buckets of sorted names, and rows that come back to this source unchanged."""
        bucket = ((names << self.drop) >> np.uint64(32)) * np.uint64(self.buckets) >> np.uint64(32)
        ends = np.searchsorted(bucket, np.arange(self.buckets + 1, dtype=np.uint64))
        rows = [(b, pack(names[i:j], *[c[i:j] for c in columns])) for b, (i, j) in enumerate(zip(ends[:-1], ends[1:])) if i < j]
        rows += [(-1 - src, blob) for blob in own]
        return pa.table({"bucket": pa.array([r[0] for r in rows], pa.int64()), "src": pa.array([src] * len(rows), pa.int64()), "blob": pa.array([r[1] for r in rows], pa.binary())})

    def replies(self, table: pa.Table, columns: int, settle) -> pa.Table:
        """What ``settle`` gives for the entries of one bucket, sent back to their sources."""
        sources, blobs = table["src"].to_numpy(), table["blob"].to_pylist()
        if table["bucket"][0].as_py() < 0:
            return pa.table({"src": pa.array(sources), "blob": pa.array(blobs, pa.binary())})
        found = [unpack(b) for b in blobs]
        src = np.repeat(sources, [len(f[0]) for f in found])
        answer = settle(*[np.concatenate([f[i] for f in found]) for i in range(columns)])
        at, out = answer[0], answer[1:]
        order = np.lexsort((out[0], src[at]))
        owner = src[at][order]
        ends = np.flatnonzero(np.append(owner[1:] != owner[:-1], True)) + 1 if len(owner) else []
        rows, i = [], 0
        for j in ends:
            rows.append((owner[i], pack(*[c[order[i:j]] for c in out])))
            i = j
        return pa.table({"src": pa.array([r[0] for r in rows], pa.int64()), "blob": pa.array([r[1] for r in rows], pa.binary())})

    # Round 1: anchors. Entries (name, documents, first window, windows, anchor's place).
    def send_anchors(self, src: int, source: Source) -> pa.Table:
        found = [[np.zeros(0, np.uint64)] for _ in range(4)]
        for first, offsets, data in pieces(source.column):
            base = source.offsets[first]
            at, count, place, names = anchors(offsets, data, self.length)
            for column, part in zip(found, (names >> self.drop, at + base, count, place)):
                column.append(part.astype(np.uint64))
        name, at, count, place = (np.concatenate(c) for c in found)
        order = np.argsort(name, kind="stable")
        name, at, count, place = name[order], at[order], count[order], place[order]
        doc, group = source.doc(at), groups(name)
        first = np.diff(group, prepend=-1) > 0
        last = np.append(first[1:], True)
        several = np.flatnonzero(source.keys[doc[first]] != source.keys[doc[last]]) if len(name) else np.zeros(0, int)
        shared = np.zeros(group[-1] + 1 if len(name) else 0, bool)
        shared[several] = True
        shared = shared[group]
        here = np.flatnonzero(shared)
        here = here[np.argsort(at[here])]
        own = [pack(at[here], count[here], place[here])] if len(here) else []
        kept = first | ~shared
        entries = [np.where(shared, 2, first).astype(np.uint64), np.where(shared, NOWHERE, at), count, place]
        return self.sent(src, name[kept], [e[kept] for e in entries], own)

    def settle_anchors(self, name, docs, at, count, place):
        order = np.argsort(name, kind="stable")
        group = groups(name[order])
        known = np.bincount(group, docs[order].astype(np.float64))[group] >= 2
        asked = order[known]
        asked = asked[at[asked] != NOWHERE]
        return asked, at[asked], count[asked], place[asked]

    # Round 2: runs. Entries (anchor's name, run's name, document, first window, windows).
    def send_runs(self, src: int, source: Source, blobs: list[bytes]) -> pa.Table:
        at, count, place = together(blobs, 3)
        sums = prefix_sums(source.data)
        a, n, p = at.astype(np.int64), count.astype(np.int64), place.astype(np.int64)
        name = name_spans(sums, a + p, a + p + short_length(self.length)) >> self.drop
        run = name_spans(sums, a, a + n - 1 + self.length)
        key = source.keys[source.doc(at)]
        order = np.lexsort((key, run, name))
        name, run, key, at, count = name[order], run[order], key[order], at[order], count[order]
        late = key > earliest(groups(name, run), key) if len(name) else np.zeros(0, bool)
        return self.sent(src, name[~late], [c[~late] for c in (run, key, at, count)], self.removed(at[late], count[late]))

    @staticmethod
    def removed(at: np.ndarray, count: np.ndarray) -> list[bytes]:
        order = np.argsort(at)
        return [pack(at[order], count[order], np.zeros(len(at)))] if len(at) else []

    def settle_runs(self, name, run, key, at, count):
        """Kind 0: a run to remove; 1: a run whose windows may recur in others; 2: one that only others can repeat."""
        order = np.lexsort((key, run, name))
        name, run, key = name[order], run[order], key[order]
        if not len(name):
            return order, at, count, count
        anchor, same = groups(name), groups(name, run)
        start, end = np.flatnonzero(np.diff(anchor, prepend=-1)), np.flatnonzero(np.diff(anchor, append=anchor[-1] + 1))
        contested = (same[start] != same[end])[anchor]
        smallest = np.minimum.reduceat(key, start)[anchor]
        late = key > earliest(same, key)
        kind = np.where(late, 0, np.where(key > smallest, 1, 2)).astype(np.uint64)
        asked = late | contested
        return order[asked], at[order[asked]], count[order[asked]], kind[asked]

    # Round 3: windows. Entries (window's name, document, window).
    def send_windows(self, src: int, source: Source, blobs: list[bytes]) -> pa.Table:
        at, count, kind = together(blobs, 3)
        own = self.removed(at[kind == 0], count[kind == 0])
        at, count, kind = (c[kind > 0].astype(np.int64) for c in (at, count, kind))
        window = np.repeat(at - np.cumsum(count) + count, count) + np.arange(count.sum())
        asks = np.repeat(kind == 1, count)
        half = (self.length + 1) // 2
        sums = prefix_sums(source.data)
        rank = name_spans(sums, window, window + half)
        further = name_spans(sums, window + self.length - half, window + self.length)
        name = mix(rank ^ mix(further + np.uint64(1)))
        key = source.keys[source.doc(window)]
        order = np.lexsort((key, name))
        name, key, window, asks = name[order], key[order], window[order].astype(np.uint64), asks[order]
        group = groups(name)
        late = key > earliest(group, key) if len(name) else np.zeros(0, bool)
        own += self.removed(window[late], np.ones(late.sum(), np.uint64))
        # One row of each window is enough for others; every asking one of the smallest document needs its answer.
        kept = ~late & (asks | (np.diff(group, prepend=-1) > 0))
        return self.sent_whole(src, name[kept], [key[kept], np.where(asks, window, NOWHERE)[kept]], own)

    def sent_whole(self, src: int, names: np.ndarray, columns: list[np.ndarray], own: list[bytes]) -> pa.Table:
        whole = Plan(self.length, self.buckets, 64)
        return whole.sent(src, names, columns, own)

    def settle_windows(self, name, key, at):
        order = np.lexsort((key, name))
        late = key[order] > earliest(groups(name[order]), key[order]) if len(name) else np.zeros(0, bool)
        asked = order[late]
        asked = asked[at[asked] != NOWHERE]
        return asked, at[asked], np.ones(len(asked), np.uint64), np.zeros(len(asked), np.uint64)

    def remove(self, source: Source, blobs: list[bytes]) -> pa.Table:
        at, count, _ = together(blobs, 3)
        size = len(source.data)
        change = np.zeros(size + 1, np.int32)
        np.add.at(change, at.astype(np.int64), 1)
        np.add.at(change, (at + count).astype(np.int64) - 1 + self.length, -1)
        gone = np.zeros(size + 1, bool)
        gone[1:] = np.cumsum(change[:-1]) > 0  # shifted by one
        total = np.concatenate([[0], np.cumsum(gone[1:])])
        begins = gone[1:] & ~gone[:-1]
        inner = source.offsets[:-1][source.offsets[:-1] < size]
        begins[inner] = gone[inner + 1]
        spans = np.concatenate([[0], np.cumsum(begins)])
        ends, starts = source.offsets[1:], source.offsets[:-1]
        removed = total[ends] - total[starts]
        left = source.data[~gone[1:]].tobytes()
        cut = np.concatenate([[0], np.cumsum(ends - starts - removed)])
        return pa.table(
            {
                "doc_id": source.table["doc_id"],
                "n_bytes": pa.array(ends - starts, pa.int64()),
                "n_removed": pa.array(removed, pa.int64()),
                "n_spans": pa.array(spans[ends] - spans[starts], pa.int64()),
                "kept": pa.array([left[i:j] for i, j in zip(cut[:-1], cut[1:])], pa.binary()),
            }
        )


def remove_repeats(docs: DataFrame, length: int = LENGTH, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``doc_id, n_bytes, n_removed, n_spans`` (maximal removed runs) and ``kept`` (the
    remaining bytes; a character of which a byte went is not whole any more)."""
    ship(docs.sparkSession)
    docs = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    total = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    share = min(MOST_BYTES, max(LEAST_BYTES, math.isqrt(total * PACKED)))
    sources = max(LEAST_SOURCES, -(-total // share))
    plan = Plan(length, sources, min(64, max(40, int(total).bit_length() + 10)))
    own = docs.withColumn("src", F.pmod(F.xxhash64("doc_id", "text"), F.lit(sources)))

    # Spark tells the kinds of grouped functions apart by their annotations; these have none.
    def first(key, table):
        return plan.send_anchors(key[0].as_py(), Source(table))

    def settle(columns: int, how):
        return lambda table: plan.replies(table, columns, how)

    def further(step):
        def run(key, texts, replies):
            return step(key[0].as_py(), Source(texts), replies["blob"].to_pylist())

        return run

    def again(replies: DataFrame, step, schema: str) -> DataFrame:
        return own.groupBy("src").cogroup(replies.groupBy("src")).applyInArrow(further(step), schema)

    sent = own.groupBy("src").applyInArrow(first, _SENT)
    replies = sent.groupBy("bucket").applyInArrow(settle(5, plan.settle_anchors), _REPLY)
    sent = again(replies, plan.send_runs, _SENT)
    replies = sent.groupBy("bucket").applyInArrow(settle(5, plan.settle_runs), _REPLY)
    sent = again(replies, plan.send_windows, _SENT)
    replies = sent.groupBy("bucket").applyInArrow(settle(3, plan.settle_windows), _REPLY)
    result = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary"
    return again(replies, lambda src, source, blobs: plan.remove(source, blobs), result)
