"""Byte-level BPE: encoding by a segment tree over byte positions, and decoding.

A piece of text starts as one token per byte. A segment tree over the byte positions holds, for each
position where a live token starts, the rank of the pair it forms with its right neighbour; the root
is the leftmost smallest rank. A merge changes three leaves: the merged pair, the token that went and
the left neighbour, each in logarithmic time.

Null texts are encoded as empty ones: no ids. Null id lists, and lists with an id outside the
vocabulary, decode to null.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import re
from array import array
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import tiktoken
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame

from clickloom.llm.texts import CACHES, add_columns, strings

# Letters, numbers and white space below U+0250, as the pattern's classes have them.
LATIN_LETTERS, LATIN_NUMBERS, LATIN_SPACES = r"A-Za-zªµºÀ-ÖØ-öø-ɏ", r"0-9²³¹¼-¾", r"\t-\r \x85\xa0"

SHIFT = 20
NONE = 1 << 62
# Pieces a worker remembers: in a job of its own, and beside other stages.
CACHED, CACHED_BESIDE = 400_000, 250_000


@dataclass(frozen=True)
class Merges:
    """``pairs`` has the rank of (left id, right id), packed; ``made`` the id that a rank makes."""

    key: str
    pairs: dict[int, int]
    made: list[int]
    byte_ids: list[int]


def merges_of_ranks(ranks: dict[bytes, int], key: str) -> Merges:
    """Any two neighbours whose bytes together are in the vocabulary merge, at that rank."""
    pairs = {}
    for token, rank in ranks.items():
        for cut in range(1, len(token)):
            left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
            if left is not None and right is not None:
                pairs[left << SHIFT | right] = rank
    return Merges(key, pairs, list(range(max(ranks.values()) + 1)), [ranks[bytes([b])] for b in range(256)])


def merge(piece: bytes, table: Merges) -> list[int]:
    """The token ids of one piece."""
    pairs, made = table.pairs, table.made
    ids = [table.byte_ids[b] for b in piece]
    n = len(ids)
    if n < 2:
        return ids
    size = 1 << (n - 2).bit_length() if n > 2 else 1
    width = n.bit_length() + 1
    get = pairs.get
    # A node is rank and position in one number, so that the smaller number is the leftmost smallest rank.
    tree = [NONE] * (2 * size)
    left = ids[0]
    for i in range(1, n):
        right = ids[i]
        rank = get(left << SHIFT | right)
        if rank is not None:
            tree[size + i - 1] = rank << width | i - 1
        left = right
    for i in range(size - 1, 0, -1):
        x, y = tree[2 * i], tree[2 * i + 1]
        tree[i] = x if x < y else y
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    mask = (1 << width) - 1
    while (best := tree[1]) != NONE:
        i = best & mask
        gone = after[i]
        right = after[gone]
        ids[i] = new = made[best >> width]
        ids[gone] = -1
        after[i] = right
        # Three leaves change: the token that went, the merged pair, its left neighbour.
        c = size + gone if gone < n - 1 else size + i
        tree[c] = NONE
        b = size + i
        if right < n:
            before[right] = i
            rank = get(new << SHIFT | ids[right])
            tree[b] = NONE if rank is None else rank << width | i
        else:
            tree[b] = NONE
        a = before[i]
        if a >= 0:
            rank = get(ids[a] << SHIFT | new)
            tree[size + a] = NONE if rank is None else rank << width | a
            a += size
        else:
            a = b
        # Their ancestors, level by level; shared ones once.
        while b > 1:
            a >>= 1
            b >>= 1
            c >>= 1
            x, y = tree[2 * b], tree[2 * b + 1]
            tree[b] = x if x < y else y
            if a != b:
                x, y = tree[2 * a], tree[2 * a + 1]
                tree[a] = x if x < y else y
            if c != b:
                x, y = tree[2 * c], tree[2 * c + 1]
                tree[c] = x if x < y else y
    return [x for x in ids if x >= 0]


def in_class(chars: str) -> str:
    """A character class of the given characters, in order, as ranges."""
    ranges: list[list[int]] = []
    for c in sorted(map(ord, chars)):
        if ranges and ranges[-1][1] == c - 1:
            ranges[-1][1] = c
        else:
            ranges.append([c, c])
    return "[" + "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in ranges) + "]"


class Pieces:
    """Cuts texts by a pattern whose letter and number classes are those of a given library.

    ``odd`` lists characters that the ``regex`` package takes for letters or numbers and that library
    does not, because their tables are of different ages. Latin texts take an equal, faster pattern.
    """

    def __init__(self, pattern: str, odd: tuple[str, str]):
        self.plain = regex.compile(pattern).findall
        wide = pattern
        for name, chars in zip("LN", odd, strict=True):
            if chars:
                wide = wide.replace(rf"\p{{{name}}}", rf"[\p{{{name}}}--{in_class(chars)}]")
        self.exact = regex.compile(wide, regex.V1).findall
        self.is_odd = re.compile(in_class("".join(odd))).search if any(odd) else lambda text: None
        latin = pattern
        for name, chars in ((r"[^\s\p{L}\p{N}]", f"[^{LATIN_SPACES}{LATIN_LETTERS}{LATIN_NUMBERS}]"), (r"\S", f"[^{LATIN_SPACES}]"), (r"\s", f"[{LATIN_SPACES}]"), (r"\p{L}", f"[{LATIN_LETTERS}]"), (r"\p{N}", f"[{LATIN_NUMBERS}]")):
            latin = latin.replace(name, chars)
        self.latin = re.compile(latin).findall
        self.beyond = re.compile("[ɐ-\U0010ffff]").search

    def __call__(self, text: str) -> list[str]:
        if text.isascii() or not self.beyond(text):
            return self.latin(text)
        return self.exact(text) if self.is_odd(text) else self.plain(text)


def odd_characters(is_letter, is_number) -> tuple[str, str]:
    """Characters that ``regex`` takes for letters, or numbers, against the given tests. Only characters that
    Python's own, older tables leave unassigned can be in dispute."""
    import unicodedata

    young = "".join(c for c in map(chr, chain(range(0xD800), range(0xE000, 0x110000))) if unicodedata.category(c) == "Cn")
    return (
        "".join(c for c in regex.findall(r"\p{L}", young) if not is_letter(c)),
        "".join(c for c in regex.findall(r"\p{N}", young) if not is_number(c)),
    )


@functools.cache
def tiktoken_odd(pattern: str) -> tuple[str, str]:
    """A vocabulary that merges 'a' or '1' with any first byte shows which characters tiktoken joins to them."""
    ranks = {bytes([b]): b for b in range(256)}
    for lead in range(0xC2, 0xF5):
        for head in b"a1":
            ranks[bytes([head, lead])] = len(ranks)
    probe = tiktoken.Encoding("probe", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    joined = lambda head: lambda c: len(probe(head + c)) == len(c.encode())
    return odd_characters(joined("a"), joined("1"))


@functools.cache
def load_ranks(path: str) -> tuple[dict[bytes, int], str]:
    """Tokens and ranks of a tiktoken file, on the driver, with a digest of the file."""
    with open(path, "rb") as f:
        data = f.read()
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines()) if a}, hashlib.sha256(data).hexdigest()


_SENT: dict[tuple, Broadcast] = {}


def send(df: DataFrame, key: tuple, value) -> Broadcast:
    """A broadcast of a vocabulary, made once per application. Vocabularies have a fixed size."""
    sc = df.sparkSession.sparkContext
    key = (sc.applicationId, *key)
    if key not in _SENT:
        _SENT[key] = sc.broadcast(value() if callable(value) else value)
    return _SENT[key]


_CUTS: dict[tuple, Pieces] = {}
_KNOWN: dict[str, dict] = {}
CACHES["pieces"] = _KNOWN.clear


def cutter(pattern: str, odd: tuple[str, str]) -> Pieces:
    """The cutter of this worker, compiled once."""
    if (pattern, odd) not in _CUTS:
        _CUTS[pattern, odd] = Pieces(pattern, odd)
    return _CUTS[pattern, odd]


class Remembered(dict):
    """Pieces met by this worker and what ``make`` gave for them; bounded, emptied when full."""

    def __init__(self, make, limit: int = CACHED):
        self.make, self.limit = make, limit

    def __missing__(self, piece: str):
        if len(self) >= self.limit:
            self.clear()
        value = self.make(piece)
        if len(piece) <= 64:
            self[piece] = value
        return value


def remembered(key: str, make, limit: int = CACHED) -> Remembered:
    if key not in _KNOWN:
        _KNOWN.clear()
        _KNOWN[key] = Remembered(make, limit)
    return _KNOWN[key]


def _encoder(df: DataFrame, path: str, pattern: str, limit: int = CACHED):
    """A function from texts to a column of id lists."""

    def vocabulary():
        ranks, key = load_ranks(path)
        return merges_of_ranks(ranks, key), tiktoken_odd(pattern)

    sent = send(df, ("ranks", load_ranks(path)[1], pattern), vocabulary)

    def run(texts: list[str]) -> pa.ListArray:
        table, odd = sent.value
        cut = cutter(pattern, odd)
        known = remembered("ids" + table.key, lambda piece: array("i", merge(piece.encode(), table)).tobytes(), limit)
        found = [b"".join(map(known.__getitem__, cut(t))) for t in texts]
        offsets = np.concatenate([[0], np.cumsum([len(f) // 4 for f in found])]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.Array.from_buffers(pa.int32(), int(offsets[-1]), [None, pa.py_buffer(b"".join(found))]))

    return run


def _decoder(df: DataFrame, path: str):
    """A function from a column of id lists to the bytes they stand for."""

    def tokens():
        ranks, _ = load_ranks(path)
        listed = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            listed[rank] = token
        return np.array([len(t) for t in listed]), np.frombuffer(b"".join(listed), np.uint8)

    sent = send(df, ("tokens", load_ranks(path)[1]), tokens)

    def run(lists: pa.ListArray) -> pa.Array:
        lengths, data = sent.value
        starts = np.cumsum(lengths) - lengths
        ids = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        rows = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False))])
        bad = (ids < 0) | (ids >= len(lengths))
        bad[~bad] = lengths[ids[~bad]] == 0
        known = np.where(bad, 0, ids)
        sizes = lengths[known]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        out = data[np.repeat(starts[known] - ends[:-1], sizes) + np.arange(ends[-1])]
        offsets = pa.py_buffer(ends[rows].astype(np.int32).tobytes())
        decoded = pa.Array.from_buffers(pa.binary(), len(lists), [None, offsets, pa.py_buffer(out.tobytes())])
        wrong = np.diff(np.concatenate([[0], np.cumsum(bad)])[rows]) > 0
        return pc.if_else(pc.or_(pc.is_null(lists), pa.array(wrong)), pa.scalar(None, pa.binary()), decoded)

    return run


def encode(df: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``df`` with the token ids of each whole text under the ranks of the tiktoken file at ``path``."""
    run = _encoder(df, path, pattern)
    return add_columns(df, lambda batch: {ids: run(strings(batch.column(text)))}, f"{ids} array<int>", "pieces")


def decode(df: DataFrame, path: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``df`` with the bytes that each list of token ids stands for."""
    run = _decoder(df, path)
    return add_columns(df, lambda batch: {decoded: run(batch.column(ids))}, f"{decoded} binary")


def encode_and_decode(df: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "ids", decoded: str = "decoded", keep: bool = True) -> DataFrame:
    """``decode`` of ``encode`` in one pass, for a check of the round trip.

    Workers ``keep`` the pieces they met from task to task, up to 200 MB each; in a job with other stages they
    rather give them back.
    """
    there, back = _encoder(df, path, pattern, CACHED if keep else CACHED_BESIDE), _decoder(df, path)

    def make(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        lists = there(strings(batch.column(text)))
        return {ids: lists, decoded: back(lists)}

    return add_columns(df, make, f"{ids} array<int>, {decoded} binary", "pieces", keep)
