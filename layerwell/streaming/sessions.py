"""Event numbers per session, kept in state: no event is read twice.

A number is final once the watermark has passed the event, since nothing earlier can come any more. Until then the events
wait in state; a timer at the end of a minute that holds waiting events releases all that the watermark has passed, in order,
numbered on from their sessions' counters. The counter is all that remains of a session, and goes ``idle`` after the last
event: numbers start again after a pause of that length. Results are appended once and never change; without such pauses they
equal ``operators.sequence`` on all events that were not later than the watermark.

Sessions are dealt over ``buckets`` keys by their hash, and a bucket is numbered with whole columns: every call from Python
to the state store is a round trip, so short sessions with a key each would cost a dozen of them for a few events. A bucket's state
is its events of the watermark's delay and the counters of its sessions of the last ``idle``, packed as Arrow. Choose more
buckets where one of these grows beyond some hundred thousand. A session is in one bucket, so its events are numbered by one
task however they come. Where whole sessions of any size are numbered at once, use the batch operator, which cuts them.

Needs the RocksDB state store (``rocksdb_state``). The number of buckets belongs to a checkpoint and must not change.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from layerwell.operators.sequence import SESSION_KEYS
from layerwell.streaming.writers import Trigger, start_append

DELAY = "10 minutes"
IDLE = "1 day"
MINUTE_US = 60_000_000
BUCKETS = 1024
CHUNK = 20_000
WAITING = {"at": pa.int64(), "event_id": pa.string(), "session": pa.string(), "payload": pa.string()}
COUNTERS = {"session": pa.string(), "seq": pa.int64(), "at": pa.int64()}
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_TIMES = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


# The processor travels with its query, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


@contextmanager
def rocksdb_state(spark: SparkSession) -> Iterator[None]:
    """Queries started inside keep their state in RocksDB; a started query keeps its store, the session gets its setting back."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(_PROVIDER, before) if before is not None else spark.conf.unset(_PROVIDER)


def _packed(frame: pd.DataFrame, kinds: dict[str, pa.DataType]) -> bytes:
    table = pa.Table.from_pandas(frame, schema=pa.schema(list(kinds.items())), preserve_index=False)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as stream:
        stream.write_table(table)
    return sink.getvalue().to_pybytes()


def _unpacked(blobs: Sequence[bytes], kinds: dict[str, pa.DataType]) -> pd.DataFrame:
    tables = [pa.ipc.open_stream(bytes(b)).read_all() for b in blobs]
    return pa.concat_tables([pa.schema(list(kinds.items())).empty_table(), *tables]).to_pandas()


def number_due(due: pd.DataFrame, counters: pd.DataFrame, idle_us: int) -> tuple[pd.DataFrame, pd.DataFrame]:
    """Due events in order with ``seq`` and ``before`` (time of the session's previous event), and the counters after them."""
    due = due.sort_values(["session", "at", "event_id"], na_position="first", kind="stable").reset_index(drop=True)
    session, at = due["session"].to_numpy(dtype=object), due["at"].to_numpy(dtype=np.int64)
    first = np.append(True, session[1:] != session[:-1])
    held = counters.set_index("session")
    place = held.index.get_indexer(session[first])
    known = place >= 0
    prev, has, base = np.append(np.int64(0), at[:-1]), ~first, np.zeros(len(at), np.int64)
    heads = np.flatnonzero(first)[known]
    prev[heads], has[heads] = held["at"].to_numpy()[place[known]], True
    base[heads] = held["seq"].to_numpy()[place[known]]
    has &= ~(has & (at - prev >= idle_us))  # after a pause numbers start again
    start = first | ~has
    base[start & ~has] = 0
    row = np.arange(len(at))
    run = np.maximum.accumulate(np.where(start, row, 0))
    due["seq"] = row - run + 1 + base[run]
    due["before"] = pd.array(np.where(has, prev, 0), "Int64")
    due.loc[~has, "before"] = pd.NA
    ended = due.loc[np.append(first[1:], True), ["session", "seq", "at"]]
    rest = counters[~counters["session"].isin(ended["session"])]
    return due, pd.concat([rest, ended], ignore_index=True)


class SessionNumbers(StatefulProcessor):
    """Numbers the events of one bucket of sessions; rows are (time in microseconds, event id, session, other columns as JSON)."""

    def __init__(self, idle_us: int):
        self.idle_us = idle_us

    def init(self, handle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "rows binary")
        self.counters = handle.getValueState("counters", "rows binary")

    def _wait(self, frame: pd.DataFrame, keep: bool) -> None:
        blobs = [(_packed(frame.iloc[i : i + CHUNK][list(WAITING)], WAITING),) for i in range(0, len(frame), CHUNK)]
        if blobs:
            self.waiting.appendList(blobs) if keep else self.waiting.put(blobs)
            self.handle.registerTimer((int(frame["at"].min()) // MINUTE_US + 1) * MINUTE_US // 1000)
        elif not keep:
            self.waiting.clear()

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        parts = [part[list(WAITING)] for part in rows]
        if parts:
            self._wait(pd.concat(parts, ignore_index=True), True)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = max(timerValues.getCurrentWatermarkInMs(), expiredTimerInfo.getExpiryTimeInMs())
        until = passed * 1000 // MINUTE_US * MINUTE_US
        waiting = _unpacked([r[0] for r in self.waiting.get()] if self.waiting.exists() else [], WAITING)
        counters = _unpacked([self.counters.get()[0]] if self.counters.exists() else [], COUNTERS)
        now = waiting["at"] < until
        due = waiting[now]
        if len(due):
            due, counters = number_due(due, counters, self.idle_us)
            self._wait(waiting[~now], False)
        # What waits is later than the pause of a session that is left out here.
        active = counters[counters["at"] + self.idle_us > until]
        if len(active) == 0:
            self.counters.clear()
        elif len(due) or len(active) < len(counters):
            self.counters.update((_packed(active, COUNTERS),))
        if len(due):
            if len(active):
                idle_from = int(active["at"].max()) + self.idle_us
                self.handle.registerTimer(-(-idle_from // MINUTE_US) * MINUTE_US // 1000)
            yield due[["session", "at", "event_id", "payload", "seq", "before"]]


def number_sessions(
    events: DataFrame, keys: Sequence[str] = SESSION_KEYS, delay: str = DELAY, idle: str = IDLE, buckets: int = BUCKETS
) -> DataFrame:
    """A stream of events with ``seq`` (1-based) and ``prev_time`` within each session, each event once, when it is final.

    Events without a time are left out; events later than ``delay`` are dropped by the watermark; after a pause of ``idle`` or
    more the numbers of a session start again.
    """
    spark = events.sparkSession
    fixed = [*keys, "event_time", "event_id"]
    kinds = {f.name: f.dataType for f in events.schema.fields}
    rest = T.StructType([f for f in events.schema.fields if f.name not in fixed])
    owner = T.StructType([T.StructField(k, kinds[k]) for k in keys])
    payload = F.to_json(F.struct(*rest.names), _TIMES) if rest.names else F.lit("{}")
    rows = events.where(F.col("event_time").isNotNull()).withWatermark("event_time", delay)
    rows = rows.select(
        "event_time", F.unix_micros("event_time").alias("at"), "event_id", F.to_json(F.struct(*keys), _TIMES).alias("session"),
        payload.alias("payload"),
    )
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("session"), F.lit(buckets)))
    out = T.StructType(
        [T.StructField(n, t) for n, t in [("session", T.StringType()), ("at", T.LongType()), ("event_id", T.StringType()),
                                          ("payload", T.StringType()), ("seq", T.LongType()), ("before", T.LongType())]]
    )
    idle_us = spark.sql(f"SELECT unix_micros(timestamp '1970-01-01 00:00:00Z' + INTERVAL {idle})").first()[0]
    numbered = rows.groupBy("bucket").transformWithStateInPandas(SessionNumbers(idle_us), out, "Append", "EventTime")
    fields, owners = F.from_json("payload", rest, _TIMES), F.from_json("session", owner, _TIMES)
    return numbered.select(
        *(owners[k].alias(k) for k in keys), "event_id", F.timestamp_micros("at").alias("event_time"),
        *(fields[n].alias(n) for n in rest.names), "seq", F.timestamp_micros("before").alias("prev_time"),
    )


def write_numbered(
    events: DataFrame, path: str, checkpoint: str, trigger: Trigger, partition_by: Sequence[str] = (), **options
) -> StreamingQuery:
    """Append numbered events to a table directory; exactly once per checkpoint."""
    with rocksdb_state(events.sparkSession):
        return start_append(number_sessions(events, **options), path, checkpoint, trigger, partition_by)
