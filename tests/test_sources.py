"""Reads: option building for databases, file kinds, scripts, event decoding."""

import pytest
from pyspark.sql import functions as F

from layerwell.sinks.external import append_jdbc
from layerwell.sources import jdbc
from layerwell.sources.batch import import_files, run_sql_script
from layerwell.sources.events import decode_events

URL = "jdbc:any:db"


def test_parallel_read_needs_all_bounds():
    options = jdbc.table_options(URL, "t", "id", 1, 100, 8)
    assert options["numPartitions"] == "8" and options["partitionColumn"] == "id"
    assert jdbc.table_options(URL, "t") == {"url": URL, "dbtable": "t", "fetchsize": "10000"}
    with pytest.raises(ValueError):
        jdbc.table_options(URL, "t", "id", 1)


def test_increment_is_a_half_open_day():
    query = jdbc.increment_options(URL, "orders", "order_date", "2024-02-29")["query"]
    assert query == "SELECT * FROM orders WHERE order_date >= DATE '2024-02-29' AND order_date < DATE '2024-03-01'"


def test_increment_rejects_text_that_is_not_a_day():
    with pytest.raises(ValueError):
        jdbc.increment_options(URL, "orders", "order_date", "2024-02-29' OR '1'='1")


def test_only_metrics_tables_go_to_the_database(spark):
    assert append_jdbc(spark.range(1), URL, "events") is False


def test_unknown_file_kind(spark):
    with pytest.raises(ValueError):
        import_files(spark, "xml", "/nowhere", "2024-01-01")


def test_script_edges(spark):
    rows = spark.range(3)
    with pytest.raises(ValueError):
        run_sql_script(spark, {"v": rows}, " ; ", {})
    assert run_sql_script(spark, {"v": rows.where("id < 0")}, "SELECT * FROM v", {}) is None
    assert run_sql_script(spark, {"v": rows}, "SELECT * FROM v WHERE id >= :low;", {"low": 2}).count() == 1
    assert not spark.catalog.tableExists("v")


def test_malformed_json_gives_null_fields(spark):
    raw = spark.createDataFrame([(bytearray(b'{"event_id":"1","amount":2.5,"properties":{"k":"v"}}'),), (bytearray(b"{oops"),)], "value binary")
    got = decode_events(raw.withColumn("timestamp", F.lit("2024-01-01").cast("timestamp"))).collect()
    assert (got[0].event_id, got[0].amount, got[0].properties) == ("1", 2.5, {"k": "v"})
    assert got[1].event_id is None and got[1].kafka_timestamp is not None
