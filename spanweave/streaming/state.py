"""Operators on streams that remember: copies of contents, and records that are locked.

Both keep their state in RocksDB (see use_rocksdb) by transformWithState, so it survives restarts with the query's
checkpoint and may be larger than memory. Rows of a key are added up in the task that reads them, before the
shuffle, so that a content which holds much of a stream is one row of each task.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from spanweave.operators.coverage import content_hash

_SEEN = "content_hash string, n bigint, first_id bigint, splits array<string>"
_DECIDED = "id bigint, ts timestamp, version string, accepted boolean"


def use_rocksdb(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def _partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each content of a batch: how often, its smallest id, its splits."""
    for b in batches:
        t = pa.Table.from_batches([b]).group_by("content_hash").aggregate([("record_id", "min"), ([], "count_all"), ("split", "distinct")])
        splits = pa.array([[x for x in s if x is not None] for s in t["split_distinct"].to_pylist()], pa.list_(pa.string()))
        columns = [t["content_hash"].combine_chunks(), t["count_all"].combine_chunks().cast(pa.int64()), t["record_id_min"].combine_chunks(), splits]
        yield pa.RecordBatch.from_arrays(columns, names=["content_hash", "n", "first_id", "splits"])


class _Copies(StatefulProcessor):
    def __init__(self, ttl_ms: int | None) -> None:
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", "n bigint, first_id bigint, splits string", self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        n, first, splits = 0, None, set()
        if self.seen.exists():
            n, first, held = self.seen.get()
            splits = set(held.split("\n")) if held else set()
        for frame in rows:
            n += int(frame["n"].sum())
            ids = [int(x) for x in frame["first_id"].dropna()]
            first = min([*ids, *([] if first is None else [first])], default=None)
            splits.update(s for some in frame["splits"] for s in some)
        self.seen.update((n, first, "\n".join(sorted(splits))))
        if n > 1:
            yield pd.DataFrame({"content_hash": [key[0]], "n": [n], "first_id": pd.array([first], "Int64"), "splits": [len(splits)]})

    def close(self) -> None:
        pass


def copies_stream(records: DataFrame, ttl_ms: int | None = None) -> DataFrame:
    """(content_hash, n, first_id, splits) of a stream of records(record_id, text, split), a row whenever a content occurs again.

    latest() of what was written is hash_duplicates() of all records, in whatever order and number of runs they came.
    ttl_ms: contents that have not been seen for so long are forgotten, and begin anew when they come back.
    """
    keyed = records.select(content_hash(F.col("text")).alias("content_hash"), F.col("record_id").cast("bigint"), "split")
    partial = keyed.mapInArrow(_partial, _SEEN)
    out = "content_hash string, n bigint, first_id bigint, splits bigint"
    return partial.groupBy("content_hash").transformWithStateInPandas(_Copies(ttl_ms), out, "Append", "ProcessingTime" if ttl_ms else "None")


def latest(copies: DataFrame) -> DataFrame:
    """The last row of every content."""
    last = copies.groupBy("content_hash").agg(F.max_by(F.struct("n", "first_id", "splits"), "n").alias("r"))
    return last.select("content_hash", "r.*")


class _Guard(StatefulProcessor):
    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "ts bigint, version string, locks boolean")
        self.locked = handle.getValueState("locked", "ts bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        for frame in rows:
            for ts, version, locks in zip(frame["ts_us"], frame["version"], frame["locks"], strict=True):
                self.waiting.appendValue((int(ts), version, bool(locks)))
                self.handle.registerTimer(int(ts) // 1000 + 1)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        closed = expiredTimerInfo.getExpiryTimeInMs() * 1000
        rows = sorted(self.waiting.get()) if self.waiting.exists() else []
        due = [r for r in rows if r[0] < closed]
        if not due:
            return
        lock = self.locked.get()[0] if self.locked.exists() else None
        told = []
        for ts, version, locks in due:
            accepted = lock is None or ts <= lock
            if accepted and locks and lock is None:
                lock = ts
            told.append((key[0], pd.Timestamp(ts, unit="us"), version, accepted))
        if lock is not None:
            self.locked.update((lock,))
        if rest := rows[len(due) :]:
            self.waiting.put(rest)
        else:
            self.waiting.clear()
        yield pd.DataFrame(told, columns=["id", "ts", "version", "accepted"])

    def close(self) -> None:
        pass


def guard_stream(changes: DataFrame, late: str = "1 hour") -> DataFrame:
    """(id, ts, version, accepted) of a stream of changes(id, ts, version, locked_at): a change of a locked record is refused.

    A change that comes with locked_at locks its record from its ts on; changes of that very time still count. Changes
    wait until the watermark has passed them and are then decided in the order of ts, so the result is that of
    guard_batch(), whatever order they came in; what comes later than the watermark is dropped.
    """
    rows = changes.select(F.col("id").cast("bigint"), "ts", "version", F.col("locked_at").isNotNull().alias("locks"), F.unix_micros("ts").alias("ts_us"))
    return rows.withWatermark("ts", late).groupBy("id").transformWithStateInPandas(_Guard(), _DECIDED, "Append", "EventTime")


def guard_batch(changes: DataFrame) -> DataFrame:
    """The same decisions over a table of changes."""
    locks = changes.filter("locked_at IS NOT NULL").groupBy("id").agg(F.min("ts").alias("lock"))
    told = changes.join(locks, "id", "left")
    return told.select(F.col("id").cast("bigint").alias("id"), "ts", "version", (F.col("lock").isNull() | (F.col("ts") <= F.col("lock"))).alias("accepted"))
