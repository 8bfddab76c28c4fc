"""Helpers shared by the operators: added columns over Arrow batches, and texts as flat bytes."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, types as T

from clickloom.session import ship

PIECE_BYTES = 1 << 18
PART_BYTES = 1 << 20


def add_columns(df: DataFrame, make: Callable[[pa.RecordBatch], dict[str, pa.Array]], schema: str, cache: str | None = None, keep: bool = True) -> DataFrame:
    """``df`` with the columns of ``schema``, which ``make`` computes batch by batch.

    Input columns that bear the name of a new column are replaced where they stand. ``cache`` names the one of
    the worker's ``CACHES`` that ``make`` uses; others are emptied, and without ``keep`` that one too when a
    task ends.
    """
    ship(df.sparkSession)
    new = {f.name.lower(): f for f in T.StructType.fromDDL(schema)}
    fields = [new.get(f.name.lower(), f) for f in df.schema]
    fields += [f for f in new.values() if f not in fields]
    made_names = {f.name for f in new.values()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, forget in CACHES.items():
            if name != cache:
                forget()
        try:
            for batch in batches:
                for part in parts(batch):
                    made = make(part)
                    yield pa.RecordBatch.from_arrays([made[f.name] if f.name in made_names else part.column(f.name) for f in fields], names=[f.name for f in fields])
        finally:
            if cache and not keep:
                CACHES[cache]()
            tidy()

    return df.mapInArrow(run, T.StructType(fields))


def parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of a batch of about ``PART_BYTES``."""
    rows = max(1, batch.num_rows * PART_BYTES // max(1, batch.nbytes))
    for first in range(0, batch.num_rows, rows):
        yield batch.slice(first, rows)


# What workers keep from task to task, by name, and how to empty it.
CACHES: dict[str, Callable[[], None]] = {}


def tidy() -> None:
    """Give memory back when a task ends, as the worker lives on beside those of other operators."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores added until no column of ``df`` bears it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def strings(column: pa.Array) -> list[str]:
    """Texts with nulls as empty ones."""
    return [x or "" for x in column.to_pylist()]


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of a text column in UTF-8; nulls are empty."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    return offsets, np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)


def pieces(column: pa.Array, limit: int = PIECE_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Runs of whole texts of about ``limit`` bytes: first row, offsets from 0, bytes. A longer text stands alone."""
    offsets, data = flat(column)
    first, n = 0, len(column)
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
        yield first, offsets[first : last + 1] - offsets[first], data[offsets[first] : offsets[last]]
        first = last


# Multipliers and shifts of the splitmix64 finaliser.
_MIX1, _MIX2, _STEP = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    x = x + _STEP
    x ^= x >> np.uint64(30)
    x *= _MIX1
    x ^= x >> np.uint64(27)
    x *= _MIX2
    x ^= x >> np.uint64(31)
    return x


_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTES = mix(np.arange(256, dtype=np.uint64))


_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64; those of usual pieces are kept."""
    known = _POWERS.get(base)
    if known is None or len(known) < n:
        out = np.full(max(n, 2 * PIECE_BYTES), base, np.uint64)
        out[0] = 1
        known = np.multiply.accumulate(out)
        if len(known) <= 2 * PIECE_BYTES:
            _POWERS[base] = known
    return known[:n]


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Sums of scrambled bytes times powers of a base; differences of them name substrings."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTES[data] * powers(_BASE, len(data)), out=out[1:])
    return out


def name_spans(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit names of the byte spans [start, end), equal for equal bytes."""
    return mix((sums[end] - sums[start]) * powers(_INVERSE, len(sums))[start])


def word_spans(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, text number) of words, the runs of bytes that are not ASCII white space; none crosses texts."""
    solid = np.zeros(len(data) + 2, bool)
    solid[1:-1] = (data != 32) & ((data < 9) | (data > 13))
    starts = solid[1:-1] & ~solid[:-2]
    ends = solid[1:-1] & ~solid[2:]
    inner = offsets[1:-1]
    inner = inner[(inner > 0) & (inner < len(data))]
    starts[inner] = solid[1:-1][inner]
    ends[inner - 1] = solid[1:-1][inner - 1]
    start, end = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    return start, end, np.searchsorted(offsets, start, "right") - 1


SHINGLE_WORDS = 5


def shingle_names(offsets: np.ndarray, data: np.ndarray, words: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(text number, name) of every run of ``words`` words; a shorter text with words has one run of all of them."""
    start, end, text = word_spans(offsets, data)
    if not len(start):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    word = name_spans(prefix_sums(data), start, end)
    per_text = np.bincount(text, minlength=len(offsets) - 1)
    first = np.concatenate([[0], np.cumsum(per_text)])
    index = np.arange(len(word))
    length = np.minimum(per_text[text], words)
    whole = index + length <= first[text + 1]
    at = index[whole]
    name = np.zeros(len(at), np.uint64)
    for k in range(words):
        used = length[at] > k
        name[used] = mix(name[used] ^ word[at[used] + k])
    return text[at], name
