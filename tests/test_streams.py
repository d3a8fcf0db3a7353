"""Streams on file sources: restart, late rows, replacement, equality with the batch result."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from layerwell.operators.sequence import session_sequence
from layerwell.sources.events import table_stream
from layerwell.streaming.layers import (
    clean_events,
    flat_metrics,
    gold_table_sink,
    ingest_bronze,
    user_metrics,
    write_gold,
    write_sequenced_silver,
)
from layerwell.streaming.writers import AVAILABLE_NOW, append_evolving, fan_out, query_id, read_evolving, replace_rows

SCHEMA = (
    "event_id string, user_id string, session_id string, event_type string, event_time timestamp, amount double, "
    "user_region string, date string, user_segment string"
)
NOON = datetime(2024, 1, 15, 12)


def event(event_id, minutes, user="u", session="s", kind="purchase", amount=1.0):
    at = NOON + timedelta(minutes=minutes)
    return (event_id, user, session, kind, at, amount, "r", at.date().isoformat(), "seg")


@pytest.fixture()
def feed(spark, tmp_path):
    class Feed:
        path = str(tmp_path / "in")
        checkpoint = str(tmp_path / "ckpt")
        out = str(tmp_path / "out")

        def add(self, *rows):
            spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(self.path)

        def batch(self):
            return spark.read.schema(SCHEMA).parquet(self.path)

        def stream(self):
            return table_stream(spark, self.path, self.batch().schema)

    return Feed()


def run(query):
    query.awaitTermination()


def test_bronze_restarts_from_its_checkpoint(spark, feed):
    def ingest():
        raw = feed.stream().select(
            F.to_json(F.struct("event_id", "user_id", "event_type", "event_time", "amount")).cast("binary").alias("value"),
            F.col("event_time").alias("timestamp"),
        )
        run(ingest_bronze(raw, feed.out, feed.checkpoint, AVAILABLE_NOW))
        return sorted(r.event_id for r in spark.read.parquet(feed.out).collect())

    feed.add(event("1", 0), event("1", 0), event("2", 1, amount=-1.0), event(None, 1))
    assert ingest() == ["1"]
    feed.add(event("1", 1), event("3", 2), event("4", 2, amount=None))
    assert ingest() == ["1", "3", "4"]
    assert ingest() == ["1", "3", "4"]


def test_gold_holds_one_row_per_window_and_drops_late_events(spark, feed):
    def gold():
        run(write_gold(user_metrics(feed.stream()), [gold_table_sink(feed.out)], feed.checkpoint, AVAILABLE_NOW))
        rows = spark.read.parquet(feed.out).collect()
        return sorted((r.window_start.minute, r.event_count, r.total_revenue) for r in rows)

    feed.add(event("1", 0), event("2", 1, kind="view"), event("3", 7))
    assert gold() == [(0, 2, 1.0), (5, 1, 1.0)]
    feed.add(event("4", 2, amount=2.5), event("5", 40))
    assert gold() == [(0, 3, 3.5), (5, 1, 1.0), (40, 1, 1.0)]
    feed.add(event("late", 1), event("6", 41))
    assert gold() == [(0, 3, 3.5), (5, 1, 1.0), (40, 2, 2.0)]


def test_stream_equals_batch(spark, feed):
    feed.add(*(event(str(i), i, user=f"u{i % 3}") for i in range(30)))
    run(write_gold(user_metrics(feed.stream()), [gold_table_sink(feed.out)], feed.checkpoint, AVAILABLE_NOW))
    batch = flat_metrics(user_metrics(feed.batch()))
    stored = spark.read.schema(batch.schema).parquet(feed.out)
    assert stored.exceptAll(batch).isEmpty() and batch.exceptAll(stored).isEmpty()


def test_late_event_renumbers_its_session(spark, feed):
    def silver():
        run(write_sequenced_silver(feed.stream(), feed.batch, feed.out, feed.checkpoint, AVAILABLE_NOW))
        rows = spark.read.parquet(feed.out).collect()
        return sorted((r.session_id, r.seq, r.event_id) for r in rows)

    feed.add(event("1", 0), event("3", 2), event("x", 1, session="t"))
    assert silver() == [("s", 1, "1"), ("s", 2, "3"), ("t", 1, "x")]
    feed.add(event("2", 1), event("4", 60 * 24))
    assert silver() == [("s", 1, "1"), ("s", 2, "2"), ("s", 3, "3"), ("s", 4, "4"), ("t", 1, "x")]


def test_replacing_twice_under_one_batch_id_repeats_the_first_result(spark, tmp_path):
    path = str(tmp_path / "t")
    frame = lambda *rows: spark.createDataFrame(rows, "k string, v int, day string")
    replace_rows(frame(("a", 1, "d1"), ("b", 1, "d1"), ("c", 1, "d2"), (None, 1, "d1")), path, ["k"], ["day"], "0")
    replace_rows(frame(("a", 2, "d1"), (None, 2, "d1")), path, ["k"], ["day"], "1")
    want = {("a", 2), ("b", 1), ("c", 1), (None, 2)}
    assert {(r.k, r.v) for r in spark.read.parquet(path).collect()} == want
    # A batch that runs again publishes its finished stage, even over a damaged partition.
    spark.createDataFrame([("zz", 9, "d1")], "k string, v int, day string").write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy("day").parquet(path)
    replace_rows(frame(("a", 2, "d1"), (None, 2, "d1")), path, ["k"], ["day"], "1")
    assert {(r.k, r.v) for r in spark.read.parquet(path).collect()} == want


def test_a_fresh_checkpoint_does_not_repeat_an_older_batch(spark, feed, tmp_path):
    """Two queries on one path both count from batch 0; neither hides or replaces the other's rows."""
    rows = lambda: {(r.k, r.v) for r in spark.read.parquet(path).collect()}
    path = str(tmp_path / "t")
    frame = lambda *rows: spark.createDataFrame(rows, "k string, v int, day string")
    replace_rows(frame(("a", 1, "d1")), path, ["k"], ["day"], "first/0")
    replace_rows(frame(("b", 2, "d1")), path, ["k"], ["day"], "second/0")
    assert rows() == {("a", 1), ("b", 2)}
    target = str(tmp_path / "evolving")
    for number, query in enumerate(("first", "second")):
        append_evolving(spark.createDataFrame([(number,)], "a int"), target, f"{query}/0")
    assert spark.read.parquet(target).count() == 2


def test_a_row_that_changes_partition_leaves_the_old_one(spark, tmp_path):
    path = str(tmp_path / "t")
    frame = lambda *rows: spark.createDataFrame(rows, "k string, v int, day string, part string")
    replace_rows(frame(("a", 1, "d1", "old=1"), ("b", 1, "d1", "keep"), (None, 1, "d1", None)), path, ["k"], ["day", "part"], "q/0")
    replace_rows(frame(("a", 2, "d1", "new"), (None, 2, "d1", "new")), path, ["k"], ["day", "part"], "q/1")
    assert {tuple(r) for r in spark.read.parquet(path).select("k", "v", "part").collect()} == {("a", 2, "new"), ("b", 1, "keep"), (None, 2, "new")}
    assert sorted(p.name for p in (tmp_path / "t" / "day=d1").iterdir() if p.is_dir()) == ["part=keep", "part=new"]
    assert [p.name for p in (tmp_path / "t__staging" / "q").iterdir() if p.is_dir()] == ["1"]


def test_fan_out_computes_the_batch_once_and_repeats_safely(spark, feed, tmp_path):
    seen = []
    target = str(tmp_path / "evolving")

    def sink(batch, name):
        seen.append((name, batch.storageLevel.useMemory))
        append_evolving(batch, target, name)
        append_evolving(batch, target, name)

    feed.add(event("1", 0), event("2", 1))
    run(fan_out(feed.stream(), [sink, sink], feed.checkpoint, AVAILABLE_NOW))
    name = f"{query_id(spark, feed.checkpoint)}/0"
    assert seen == [(name, True), (name, True)]
    assert spark.read.parquet(target).count() == 2


def test_evolving_table_reads_all_columns(spark, tmp_path):
    path = str(tmp_path / "e")
    append_evolving(spark.createDataFrame([(1,)], "a int"), path)
    append_evolving(spark.createDataFrame([(2, "x")], "a int, b string"), path)
    assert sorted((r.a, r.b or "") for r in read_evolving(spark, path).collect()) == [(1, ""), (2, "x")]


def test_batch_cleaning(spark):
    rows = [event("1", 0), event("1", 0), event("2", 0, amount=None), event("3", 0, amount=-0.5), event("4", 0, user=None)]
    got = clean_events(spark.createDataFrame(rows, SCHEMA))
    assert sorted(r.event_id for r in got.collect()) == ["1", "2"]


def test_sequence_of_equal_times_follows_the_id(spark):
    rows = [event(i, 0) for i in ("b", "a", "c")]
    got = session_sequence(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r.seq, r.event_id, r.prev_time) for r in got if r.seq > 1) == [(2, "b", NOON), (3, "c", NOON)]
