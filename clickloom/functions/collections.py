"""Array and map helpers."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, functions as F
from pyspark.sql import types as T

from clickloom.functions.text import strip
from clickloom.schemas import CATEGORIES

NO_STRINGS = "array<string>"


def no_strings() -> Column:
    return F.array().cast(NO_STRINGS)


def array_or_empty(c: Column) -> Column:
    return F.coalesce(c, no_strings())


def click_list(c: Column, dtype: T.DataType) -> Column:
    """Any of array, text or scalar to a clean array of strings."""
    if isinstance(dtype, T.ArrayType):
        kept = F.transform(F.filter(c, lambda x: x.isNotNull()), lambda x: x.cast("string"))
        return array_or_empty(kept)
    if isinstance(dtype, T.StringType):
        text = strip(c)
        empty = text.isNull() | (text == "") | (F.lower(text) == "nan")
    else:
        text = c.cast("string")
        empty = text.isNull()
        if isinstance(dtype, (T.DoubleType, T.FloatType)):
            empty = empty | F.isnan(c)
    return F.when(empty, no_strings()).otherwise(F.array(text))


def tail(c: Column, n: int) -> Column:
    """The last ``n`` elements, or all of a shorter array."""
    return F.slice(c, F.greatest(F.size(c) - F.lit(n - 1), F.lit(1)), n)


def move_to_front(c: Column, x: Column, cap: int) -> Column:
    return F.slice(F.array_prepend(F.array_remove(c, x), x), 1, cap)


def count_of(counts: Column, key: Column) -> Column:
    return F.coalesce(F.try_element_at(counts, key), F.lit(0).cast("bigint"))


def add_counts(left: Column, right: Column) -> Column:
    zero = F.lit(0).cast("bigint")
    return F.map_zip_with(left, right, lambda _k, a, b: F.coalesce(a, zero) + F.coalesce(b, zero))


def _place(name: Column, order: list[str]) -> Column:
    found = F.array_position(F.array(*[F.lit(o) for o in order]), name)
    return F.when(found > 0, found).otherwise(F.lit(len(order) + 1).cast("bigint"))


def _largest(counts: Column, order: list[str]) -> Column:
    entries = F.transform(
        F.map_entries(counts),
        lambda e: F.struct((-e["value"]).alias("neg"), _place(e["key"], order).alias("pos"), e["key"].alias("key")),
    )
    return F.array_min(entries)


def top_key(counts: Column, order: list[str] = CATEGORIES) -> Column:
    """Key with the largest count; ties by ``order``, then by name. Nothing counted gives 'unknown'."""
    best = _largest(counts, order)
    return F.when(best["neg"] < 0, best["key"]).otherwise(F.lit("unknown"))


def first_key(counts: Column, order: list[str] = CATEGORIES) -> Column:
    """As ``top_key``, but where nothing is counted the keys tie at zero. An empty map gives null."""
    return _largest(counts, order)["key"]


def top_column(names: list[str]) -> Column:
    """Name of the largest count column; ties by the given order, no counts gives 'unknown'."""
    best = F.array_min(
        F.array(*[F.struct((-F.col(n)).alias("neg"), F.lit(i).alias("pos"), F.lit(n).alias("key")) for i, n in enumerate(names)])
    )
    return F.when(best["neg"] < 0, best["key"]).otherwise(F.lit("unknown"))


def total_of(names: list[str]) -> Column:
    return reduce(lambda a, b: a + b, [F.col(n) for n in names])


def counts_map(names: list[str]) -> Column:
    return F.create_map(*[c for n in names for c in (F.lit(n), F.col(n).cast("bigint"))])


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` worked out once, also where ``body`` uses it per element."""
    return F.transform(F.array(value), body)[0]


def scaled(v: Column) -> Column:
    """``v`` scaled to length one; a zero vector stays zero."""
    return bind(norm(v), lambda n: F.when(n > 0, F.transform(v, lambda x: x / n)).otherwise(v))


def norm(v: Column) -> Column:
    return F.sqrt(F.aggregate(v, F.lit(0.0), lambda a, x: a + x * x))


def unit(v: Column) -> Column:
    return scaled(v.cast("array<double>"))


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity; 0 when either vector is zero."""
    return F.aggregate(F.zip_with(unit(a), unit(b), lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def rounded(v: Column, places: int = 6) -> Column:
    return F.transform(v.cast("array<double>"), lambda x: F.round(x, places))
