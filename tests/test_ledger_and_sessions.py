"""Stateful numbering and the batch ledger: late events, restarts, crashes between sinks."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from layerwell.operators.sequence import session_sequence
from layerwell.sinks.external import append_jdbc, delete_statement
from layerwell.streaming.layers import user_metrics
from layerwell.streaming.ledger import BatchLedger, files, gold_targets, metrics_sink, write_targets
from layerwell.streaming.sessions import _PROVIDER, number_sessions, rocksdb_state, write_numbered
from layerwell.streaming.writers import AVAILABLE_NOW

SCHEMA = "event_id string, user_id string, session_id string, event_type string, event_time timestamp, amount double, user_region string, extra map<string,string>"
NOON = datetime(2024, 1, 15, 12)


def event(event_id, minutes, user="u", session="s", kind="purchase", amount=50.0, extra=None):
    return (event_id, user, session, kind, NOON + timedelta(minutes=minutes, microseconds=7), amount, "r", extra)


@pytest.fixture()
def feed(spark, tmp_path):
    class Feed:
        path, checkpoint, out = (str(tmp_path / n) for n in ("in", "ckpt", "out"))

        def add(self, *rows):
            spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(self.path)

        def stream(self):
            return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(self.path)

    return Feed()


def finish(query):
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


def numbers(frame):
    return sorted((r.session_id, r.seq, r.event_id, r.prev_time, r.extra) for r in frame.collect())


def test_late_events_get_the_numbers_of_the_batch(spark, feed):
    feed.add(event("a", 0), event("b", 5, extra={"k": "v"}), event("x", 3, session="t"))
    feed.add(event("c", 2), event("b2", 5), event("y", 1, session="t", amount=None))  # late, and a tie
    finish(write_numbered(feed.stream(), feed.out, feed.checkpoint, AVAILABLE_NOW))
    feed.add(event("d", 9), event("e", 4))  # after a restart, still within the delay
    feed.add(event("end", 100, session="end"))
    finish(write_numbered(feed.stream(), feed.out, feed.checkpoint, AVAILABLE_NOW))
    everything = spark.read.schema(SCHEMA).parquet(feed.path)
    got = spark.read.parquet(feed.out)
    assert set(got.columns) == set(everything.columns) | {"seq", "prev_time"}
    assert numbers(got) == numbers(session_sequence(everything).where("session_id <> 'end'"))


def test_events_later_than_the_watermark_are_dropped_and_idle_sessions_forgotten(spark, feed):
    feed.add(event("a", 0), event("b", 1))
    feed.add(event("pass", 60, session="other"))
    feed.add(event("pass", 61, session="other"))  # drops what is late by the watermark of the batch before
    feed.add(event("too late", 2), event("c", 90))
    feed.add(event("day", 90 + 2 * 1440, session="other"))
    feed.add(event("again", 91 + 2 * 1440))
    feed.add(event("end", 9000, session="end"))
    finish(write_numbered(feed.stream(), feed.out, feed.checkpoint, AVAILABLE_NOW))
    got = [(r.seq, r.event_id) for r in spark.read.parquet(feed.out).where("session_id = 's'").orderBy("event_time").collect()]
    assert got == [(1, "a"), (2, "b"), (3, "c"), (1, "again")]


def test_state_and_its_calls_follow_the_buckets_not_the_sessions(spark, feed):
    """a state key and timers per session cost a dozen round trips to the store for a few events each."""
    feed.add(*[event(f"{s:03d}-{i}", 3 * i + s % 3, session=f"s{s}") for s in range(300) for i in range(2)])
    feed.add(event("end", 100, session="end"))
    query = write_numbered(feed.stream(), feed.out, feed.checkpoint, AVAILABLE_NOW, buckets=4)
    finish(query)
    assert max(p.stateOperators[0].numRowsTotal for p in query.recentProgress) < 100
    everything = spark.read.schema(SCHEMA).parquet(feed.path)
    assert numbers(spark.read.parquet(feed.out)) == numbers(session_sequence(everything).where("session_id <> 'end'"))


def test_plan_reads_the_stream_only_and_the_session_keeps_its_setting(spark, feed):
    feed.add(event("a", 0))
    before = spark.conf.get(_PROVIDER, None)
    with rocksdb_state(spark):
        plan = number_sessions(feed.stream())._jdf.queryExecution().analyzed().toString()
    assert "TransformWithState" in plan and plan.count("StreamingRelation") == 1 and "Join" not in plan
    assert spark.conf.get(_PROVIDER, None) == before


def held(spark, path):
    return spark.read.parquet(path).agg(F.count("*"), F.sum("total_revenue")).first()


@pytest.mark.parametrize("after_write", [False, True])
def test_a_crash_between_two_sinks_doubles_nothing(spark, feed, tmp_path, after_write):
    paths = {n: str(tmp_path / n) for n in ("table", "metrics", "index", "hot")}
    ledger = BatchLedger(spark, str(tmp_path / "ledger"))
    targets = gold_targets(paths["table"], *(files(paths[n]) for n in ("metrics", "index", "hot")), 10)
    calls = {name: [] for name in targets}

    def counted(name, sink, fail):
        def put(batch, batch_name):
            calls[name].append(batch_name.rpartition("/")[2])
            if fail and not after_write:
                raise RuntimeError("lost")
            sink(batch, batch_name)
            if fail:
                raise RuntimeError("lost")

        return put

    def run(failing):
        sinks = {name: counted(name, sink, name == failing) for name, sink in targets.items()}
        query = write_targets(user_metrics(feed.stream()), sinks, ledger, feed.checkpoint, AVAILABLE_NOW)
        finish(query)

    feed.add(*[event(f"e{i}", i, user=f"u{i % 30}") for i in range(120)])
    with pytest.raises(Exception, match="lost"):
        run("index")
    assert calls == {"table": ["0"], "metrics": ["0"], "index": ["0"], "hot_users": []}
    assert {r.sink for r in ledger.entries().collect()} == {"table", "metrics"}
    run(None)
    # Batch 1 has no rows; it only moves the watermark.
    assert calls == {"table": ["0", "1"], "metrics": ["0", "1"], "index": ["0", "0", "1"], "hot_users": ["0", "1"]}
    assert tuple(held(spark, paths["table"])) == tuple(held(spark, paths["metrics"])) == (120, 6000.0)
    assert 0 < held(spark, paths["index"])[0] < 40 and held(spark, paths["hot"])[0] == 30
    given = ledger.entries().groupBy("sink").agg(F.sum("rows").alias("rows"), F.count("*").alias("batches"))
    assert {r.sink: (r.rows, r.batches) for r in given.collect()} == {n: (120, 2) for n in targets}


def test_ledger_without_entries_and_names(spark, tmp_path):
    ledger = BatchLedger(spark, str(tmp_path / "none"))
    assert ledger.entries().collect() == [] and not ledger.committed("a", "q/1")
    ledger.commit("a", "q/1", 3)
    ledger.commit("a", "q/1", 4)
    assert ledger.committed("a", "q/1") and not ledger.committed("a", "q/11") and not ledger.committed("b", "q/1")
    assert [(r.sink, r.batch, r.rows) for r in ledger.entries().collect()] == [("a", "q/1", 4)]


def test_only_metrics_tables_are_written(spark, tmp_path):
    batch = spark.createDataFrame([("u", 1.0)], "user_id string, total_revenue double")
    for table in ("user_metrics", "users"):
        metrics_sink(table, files(str(tmp_path / table)))(batch, "q/0")
    assert [spark.read.parquet(str(tmp_path / t)).count() for t in ("user_metrics", "users")] == [1, 0]
    assert append_jdbc(batch, "jdbc:none", "users", batch="q/0") is False
    assert delete_statement("dw.user_metrics") == "DELETE FROM dw.user_metrics WHERE batch_name = ?"
    with pytest.raises(ValueError):
        delete_statement("x; DROP TABLE y")
