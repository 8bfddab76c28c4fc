"""Profiles kept in Spark's own state store.

The stream is grouped by user, and ``transformWithState`` holds each user's newest clicks and category counts in
RocksDB state, checkpointed to the query's folder after every batch. A batch touches the state of its own users
only; there are no parts to merge and no base to compact, and the number of state partitions is the session's
``spark.sql.shuffle.partitions`` at the first start. Existing profiles enter as initial state. ``profiles_in_state``
reads all profiles back through the state store's data source; ``changed_profiles`` reads what batches emitted.

Same rules as ``operators.profiles``: newest ``CLICK_CAP`` distinct articles by (time, event id), then article id;
one count per valid click. A click on an unknown article is emitted with an error text and changes nothing. Clicks
without a user are left out of both. With ``once_within`` an event id is counted once for that long, by event time:
ids leave the state by a timer, and clicks older than the watermark are dropped as late. Without it nothing is late
and replayed clicks count again. A null event id is older than any other and is never taken for a repeat.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from heapq import nsmallest

from pyspark.sql import DataFrame, Row, SparkSession, functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

from clickloom.functions.collections import top_key
from clickloom.operators.profiles import CLICK_CAP, UNKNOWN_ARTICLE, assemble
from clickloom.schemas import CLICK
from clickloom.session import ship
from clickloom.sources.readers import read_table_or_empty



def _struct(**fields: T.DataType) -> T.StructType:
    """Schemas as objects: workers have no session to parse their text."""
    return T.StructType([T.StructField(n, t) for n, t in fields.items()])


_TEXT, _LONG = T.StringType(), T.LongType()
INITIAL = _struct(user_id=_TEXT, recent=T.ArrayType(_TEXT), categories=T.ArrayType(_TEXT), clicks=T.ArrayType(_LONG))
_OUT = T.StructType(INITIAL.fields + _struct(last_us=_LONG, article_id=_TEXT, event_id=_LONG, error=_TEXT).fields)
_OutRow = Row(*_OUT.names)
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
# Articles of one user held at once while a batch is read.
_HELD = 50 * CLICK_CAP
_OLDEST = -(1 << 63)


def _newest_first(item: tuple[str, tuple[int, int]]):
    article, (us, event) = item
    return -us, -event, article


class ProfileFold(StatefulProcessor):
    """Move-to-front list and category counts of one user. ``keep_us`` is how long an event id is remembered."""

    def __init__(self, keep_us: int | None = None) -> None:
        self.keep_us = keep_us

    def init(self, handle) -> None:
        self.handle = handle
        self.recents = handle.getListState("recents", _struct(article_id=_TEXT, us=_LONG, event_id=_LONG))
        # A list, not a map: one call reads or writes all of a user's categories.
        self.counts = handle.getListState("counts", _struct(category=_TEXT, clicks=_LONG, last_us=_LONG))
        if self.keep_us is not None:
            self.seen = handle.getMapState("seen", _struct(event_id=_LONG), _struct(until_us=_LONG))

    def handleInitialState(self, key, initialState: Row, timerValues) -> None:
        """List positions stand in for click times older than any new click."""
        recent = initialState["recent"] or []
        if recent:
            self.recents.put([(article, 0, -at) for at, article in enumerate(recent)])
        counts = list(zip(initialState["categories"] or [], initialState["clicks"] or []))
        if counts:
            self.counts.put([(category, clicks, None) for category, clicks in counts])

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        user = key[0]
        newest: dict[str, tuple[int, int]] = {}
        gained: dict[str, list] = {}
        for r in rows:
            if r["category"] is None:
                yield _OutRow(user, None, None, None, None, r["article_id"], r["event_id"], f"{UNKNOWN_ARTICLE}{r['article_id'] or ''}")
                continue
            us, event = r["us"], r["event_id"]
            if self.keep_us is not None and event is not None and not self._first(event, us):
                continue
            at = (us, _OLDEST if event is None else event)
            newest[r["article_id"]] = max(newest.get(r["article_id"], at), at)
            if len(newest) > _HELD:
                newest = dict(nsmallest(CLICK_CAP, newest.items(), key=_newest_first))
            entry = gained.setdefault(r["category"], [0, us])
            entry[0] += 1
            entry[1] = max(entry[1], us)
        if not gained:
            return
        for article, us, event in self.recents.get():
            newest[article] = max(newest.get(article, (us, event)), (us, event))
        kept = nsmallest(CLICK_CAP, newest.items(), key=_newest_first)
        self.recents.put([(article, us, event) for article, (us, event) in kept])
        for category, clicks, last in self.counts.get():
            entry = gained.setdefault(category, [0, last])
            entry[0] += clicks
            entry[1] = entry[1] if last is None else max(entry[1], last)
        totals = sorted((category, clicks, last) for category, (clicks, last) in gained.items())
        self.counts.put(totals)
        last = max(t[2] for t in totals if t[2] is not None)
        yield _OutRow(user, [a for a, _ in kept], [t[0] for t in totals], [t[1] for t in totals], last, None, None, None)

    def _first(self, event: int, us: int) -> bool:
        """Whether the event id is new; a new one is remembered until its time is over."""
        if self.seen.containsKey((event,)):
            return False
        until = us + self.keep_us
        self.seen.updateValue((event,), (until,))
        # Milliseconds rounded up to whole seconds, so that a busy user has few timers.
        self.handle.registerTimer(-(-until // 1_000_000) * 1000)
        return True

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now = expiredTimerInfo.getExpiryTimeInMs() * 1000
        for event in [k[0] for k, v in self.seen.iterator() if v[0] <= now]:
            self.seen.removeKey((event,))
        return iter([])

    def close(self) -> None:
        pass


def start_from(profiles: DataFrame, root: str) -> None:
    """Keep existing profiles as the state before the first click. Has no effect once a batch has run."""
    entries = F.map_entries("category_preferences")
    profiles.select(
        "user_id",
        F.col("recent_clicks").alias("recent"),
        F.transform(entries, lambda e: e["key"]).alias("categories"),
        F.transform(entries, lambda e: e["value"].cast("bigint")).alias("clicks"),
    ).write.mode("overwrite").parquet(f"{root}/initial")


@contextmanager
def _rocks(spark: SparkSession):
    """A query takes its state store from the session at its start."""
    before = spark.conf.get(_PROVIDER)
    spark.conf.set(_PROVIDER, _ROCKS)
    try:
        yield
    finally:
        spark.conf.set(_PROVIDER, before)


def fold_clicks(
    spark: SparkSession, source: str, articles: DataFrame, root: str, files_per_batch: int = 1000, once_within_seconds: int | None = None
) -> None:
    """Fold every new click file below ``source`` into the state and stop.

    What a batch emits, changed profiles and rejected clicks, lies below ``root/out/batch=<number>``; a repeated
    batch replaces its own output. A restart goes on from the last finished batch.
    """
    ship(spark)
    stream = (
        spark.readStream.schema(CLICK)
        .option("pathGlobFilter", "*.json")
        .option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][XXX]")
        .option("maxFilesPerTrigger", files_per_batch)
        .json(source)
        .where("user_id IS NOT NULL")
    )
    keep = None if once_within_seconds is None else once_within_seconds * 1_000_000
    if keep is not None:
        stream = stream.withWatermark("ts", f"{once_within_seconds} seconds")
    facts = articles.select("article_id", F.coalesce("category", F.lit("unknown")).alias("category"))
    # A click without a time is as old as the first instant.
    us = F.coalesce(F.unix_micros("ts"), F.lit(0).cast("bigint"))
    clicks = stream.join(facts, "article_id", "left").select("user_id", "article_id", "event_id", "ts", us.alias("us"), "category")
    initial = read_table_or_empty(spark, f"{root}/initial", INITIAL).groupBy("user_id")
    out = clicks.groupBy("user_id").transformWithState(
        ProfileFold(keep), _OUT, "Update", "None" if keep is None else "EventTime", initial
    )

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/out/batch={number}")

    with _rocks(spark):
        (
            out.writeStream.foreachBatch(write)
            .outputMode("update")
            .option("checkpointLocation", f"{root}/progress")
            .trigger(availableNow=True)
            .start()
            .awaitTermination()
        )


def _variable(spark: SparkSession, root: str, name: str) -> DataFrame:
    with _rocks(spark):
        return spark.read.format("statestore").option("stateVarName", name).load(f"{root}/progress")


def profiles_in_state(spark: SparkSession, root: str) -> DataFrame:
    """All profiles after the last finished batch, read from the state store itself."""
    recents = _variable(spark, root, "recents").select("key.user_id", "list_element.*")
    counts = _variable(spark, root, "counts").select("key.user_id", "list_element.*")
    return assemble(
        recents.select("user_id", "article_id", F.timestamp_micros("us").alias("ts"), "event_id"),
        counts.select("user_id", "category", "clicks", F.timestamp_micros("last_us").alias("last_ts")),
    )


def changed_profiles(spark: SparkSession, root: str) -> DataFrame:
    """The profiles that batches changed, each as its last batch left it."""
    rows = spark.read.parquet(f"{root}/out").where("error IS NULL")
    last = rows.groupBy("user_id").agg(F.max("batch").alias("batch"))
    prefs = F.map_from_arrays("categories", "clicks")
    return rows.join(last, ["user_id", "batch"]).select(
        "user_id",
        prefs.alias("category_preferences"),
        top_key(prefs).alias("top_category"),
        F.col("recent").alias("recent_clicks"),
        F.aggregate("clicks", F.lit(0).cast("bigint"), lambda a, x: a + x).alias("total_clicks"),
        F.timestamp_micros("last_us").alias("last_updated"),
    )


def rejected_clicks(spark: SparkSession, root: str) -> DataFrame:
    rows = spark.read.parquet(f"{root}/out").where("error IS NOT NULL")
    return rows.select("user_id", "article_id", "event_id", "error")
