"""JSON arrays of any size, read in ranges.

Spark's text source cuts files at commas, so a large file is read by many tasks and a file on one line need not be
one string. Where a range starts inside the array is worked out in two passes:

1. Each range tells whether it flips between inside and outside of strings, and how deep its brackets lead under
   either beginning. Sums over the ranges of a file give every range its beginning.
2. Each range, told its beginning, gives out the records that lie in it whole, and the pieces of records that cross
   its ends. Pieces of one record are put together by their order; all else stays where it was read.

A file whose first significant character is not ``[``, or whose array is not closed at its end, is rejected as a
whole; so is one with text behind its array. A record that does not parse is rejected alone. A ``null`` among the
records is left out. Empty files hold nothing.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql import types as T

from clickloom.session import materialise, ship

# Up to so many ranges (some 100 bytes each) their beginnings are sent to all tasks; more are joined by a shuffle.
SENT_RANGES = 200_000
_CORRUPT = "_corrupt_record"
_ESCAPE = re.compile(r"\\.", re.S)
_MARK = re.compile(r'"(?:[^"\\]|\\.)*"|"|[\[\]{},]', re.S)
_STRING_END = re.compile(r'(?:[^"\\]|\\.)*"', re.S)
_SPACE = " \t\r\n"

_RUN = "path string, start bigint, pos bigint, flips int, outside bigint, inside bigint, first string, last string"
_PIECE = "path string, start bigint, kind int, value string"
WHOLE, HEAD, TAIL, BEYOND = 0, 1, 2, 3


def _by_range(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, list[str]]]:
    """Runs of the pieces of one range, in order; a long range comes as several runs. The facts of a run are those
    of its last piece."""
    for batch in batches:
        if not batch.num_rows:
            continue
        starts = batch.column("start").to_numpy()
        paths = batch.column("path").dictionary_encode().indices.to_numpy()
        ends = np.flatnonzero((np.diff(starts) != 0) | (np.diff(paths) != 0)) + 1
        facts = batch.select([n for n in batch.schema.names if n != "value"])
        for begin, end in zip([0, *ends], [*ends, batch.num_rows]):
            run = facts.slice(end - 1, 1).to_pylist()[0]
            yield run, batch.column("value").slice(begin, end - begin).to_pylist()


def _depth(text: str) -> int:
    return text.count("{") + text.count("[") - text.count("}") - text.count("]")


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row a run: where it leads under either beginning."""
    for run, values in _by_range(batches):
        # A comma never follows a backslash, so no escape crosses the ends of a run.
        text = ",".join(values)
        parts = _ESCAPE.sub("", text).split('"')
        bare = text.strip(_SPACE)
        yield pa.RecordBatch.from_pylist(
            [
                {
                    "path": run["path"],
                    "start": run["start"],
                    "pos": run["pos"],
                    "flips": (len(parts) - 1) % 2,
                    "outside": sum(map(_depth, parts[::2])),
                    "inside": sum(map(_depth, parts[1::2])),
                    "first": bare[:1],
                    "last": bare[-1:],
                }
            ],
            _SUMMARY,
        )


_SUMMARY = pa.schema(
    [("path", pa.string()), ("start", pa.int64()), ("pos", pa.int64()), ("flips", pa.int32()), ("outside", pa.int64())]
    + [("inside", pa.int64()), ("first", pa.string()), ("last", pa.string())]
)


class Cutter:
    """Cuts the text of one range, given in runs, into records. ``opened``: the file's array began before."""

    def __init__(self, quoted: bool, depth: int, opened: bool) -> None:
        self.quoted, self.depth, self.opened = quoted, depth, opened
        self.held: list[str] = []
        self.cuts = 0

    def feed(self, text: str) -> Iterator[tuple[int, str]]:
        begin = at = 0
        if self.quoted:
            end = _STRING_END.match(text)
            if end is None:
                self.held.append(text)
                return
            at, self.quoted = end.end(), False
        for m in _MARK.finditer(text, at):
            c = m.group()
            if c == '"':
                # A string that goes on in the next run.
                self.quoted = True
                break
            if c in "{[":
                if self.depth == 0:
                    if self.opened:
                        yield BEYOND, c
                    begin, self.opened = m.end(), True
                self.depth += 1
            elif c in "}]":
                self.depth -= 1
                if self.depth == 0:
                    yield self._cut(text[begin : m.start()])
                    begin = m.end()
            elif c == "," and self.depth == 1:
                yield self._cut(text[begin : m.start()])
                begin = m.end()
        self.held.append(text[begin:])

    def _cut(self, last: str) -> tuple[int, str]:
        value = "".join(self.held) + last
        self.held = []
        self.cuts += 1
        return (WHOLE if self.cuts > 1 else HEAD), value

    def rest(self) -> tuple[int, str]:
        value = "".join(self.held)
        if self.depth == 0 and not self.quoted:
            return BEYOND, value
        return (TAIL if self.cuts else HEAD), value


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("path", pa.string()), ("start", pa.int64()), ("kind", pa.int32()), ("value", pa.string())])
    at, cutter = None, None
    for run, values in _by_range(batches):
        rows = []
        if at != (run["path"], run["start"]):
            if cutter is not None:
                rows.append((*at, *cutter.rest()))
            at, cutter = (run["path"], run["start"]), Cutter(run["quoted"], run["depth"], run["start"] > 0)
        # Every piece but the last of its file was followed by a comma.
        closed = run["final"] and run["pos"] == run["last_pos"]
        text = ",".join(values) + ("" if closed else ",")
        rows += [(*at, *piece) for piece in cutter.feed(text)]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
    if cutter is not None:
        yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip((*at, *cutter.rest()), schema)], schema=schema)


def _ranges(runs: DataFrame) -> DataFrame:
    """Every range with its beginning (``quoted``, ``depth``) and whether its file is one whole array (``ok``)."""
    # Runs of a range, and ranges of a file, are as many as the file has megabytes.
    order = Window.partitionBy("path").orderBy("start", "pos")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    file = Window.partitionBy("path")
    quoted = runs.withColumn("quoted", F.coalesce(F.sum("flips").over(before), F.lit(0)) % 2 == 1)
    led = quoted.withColumn("gain", F.when(F.col("quoted"), F.col("inside")).otherwise(F.col("outside")))
    deep = led.withColumn("depth", F.coalesce(F.sum("gain").over(before), F.lit(0)))
    seen = F.col("first") != ""
    known = deep.withColumns(
        {
            "closed": (F.sum("gain").over(file) == 0) & (F.sum("flips").over(file) % 2 == 0),
            "opens": F.min(F.when(seen, F.struct("start", "pos", "first"))).over(file)["first"] == "[",
            "ends": F.max(F.when(seen, F.struct("start", "pos", "last"))).over(file)["last"] == "]",
            "final_start": F.max("start").over(file),
        }
    )
    first = F.struct("pos", "quoted", "depth")
    return known.groupBy("path", "start").agg(
        F.min(first).alias("_f"),
        F.max("pos").alias("last_pos"),
        F.first(F.col("closed") & F.col("opens") & F.col("ends")).alias("ok"),
        F.first(F.col("start") == F.col("final_start")).alias("final"),
    ).select("path", "start", "_f.quoted", "_f.depth", "last_pos", "final", F.coalesce("ok", F.lit(False)).alias("ok"))


def _bare() -> Column:
    return F.trim(F.translate("value", "\t\r\n", "   "))


def _stitch(pieces: DataFrame) -> DataFrame:
    """Records that cross the ends of ranges, from their pieces: a tail begins one, the heads that follow go on."""
    order = Window.partitionBy("path").orderBy("start", "kind")
    numbered = pieces.withColumn("record", F.sum((F.col("kind") == TAIL).cast("int")).over(order))
    # The pieces of one record.
    parts = F.array_sort(F.collect_list(F.struct("start", "kind", "value")))
    joined = numbered.groupBy("path", "record").agg(F.array_join(F.transform(parts, lambda p: p["value"]), "").alias("value"))
    return joined.select("path", "value")


def read_ranges(spark: SparkSession, path: str, schema: T.StructType, pattern: str = "*.json") -> tuple[DataFrame, DataFrame]:
    """The records of all arrays below ``path``, and what was rejected (``path, value, error``): files with a null
    value, records with their text."""
    ship(spark)
    text = spark.read.option("pathGlobFilter", pattern).option("lineSep", ",").text(path)
    lines = text.select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("pos"), "value"
    )
    runs = lines.mapInArrow(_describe, _RUN)
    ranges = materialise(_ranges(runs))
    few = ranges.count() <= SENT_RANGES
    begun = lines.join(F.broadcast(ranges) if few else ranges, ["path", "start"]).where("ok")
    begun = begun.select("path", "start", "pos", "quoted", "depth", "final", "last_pos", "value")
    if not few:
        begun = begun.repartition("path", "start").sortWithinPartitions("path", "start", "pos")
    pieces = materialise(begun.mapInArrow(_cut, _PIECE))
    beyond = pieces.where((F.col("kind") == BEYOND) & (_bare() != "")).select("path").distinct()
    crossing = _stitch(pieces.where(F.col("kind").isin(HEAD, TAIL)))
    texts = pieces.where(F.col("kind") == WHOLE).select("path", "value").unionByName(crossing)
    texts = texts.join(beyond, "path", "left_anti").where(_bare() != "")
    full = T.StructType(schema.fields + [T.StructField(_CORRUPT, T.StringType())])
    parsed = texts.select("path", "value", F.from_json("value", full, {"columnNameOfCorruptRecord": _CORRUPT}).alias("r"))
    nothing = _bare() == "null"
    broken = F.col("r").isNull() | F.col(f"r.{_CORRUPT}").isNotNull()
    records = parsed.where(~broken & ~nothing).select(*[F.col("r")[f.name].alias(f.name) for f in schema.fields])
    files = ranges.where("NOT ok").select("path").distinct().unionByName(beyond)
    rejected = files.select("path", F.lit(None).cast("string").alias("value"), F.lit("no closed list").alias("error"))
    bad = parsed.where(broken & ~nothing).select("path", "value", F.lit("no record").alias("error"))
    return records, rejected.unionByName(bad)
