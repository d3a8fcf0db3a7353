"""Plan graphs, the log of written parts, path jobs and scripts."""

import uuid
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from layerwell.plans.daily import Warehouse
from layerwell.plans.graph import CUSTOMER_PLAN, HISTORY, SALES_PLAN, Node, land, order, plan, run_graph
from layerwell.plans.paths import DAY, HISTORY as ALL_DAYS, PathJob, path_job
from layerwell.sinks import catalog
from layerwell.sinks.part_log import PartLog, backfill_log, logged_overwrite
from layerwell.sinks.tables import write_path
from layerwell.sources.batch import run_sql_script
from layerwell.specs import layer_databases, warehouse_specs

D, NEXT = "2024-02-14", "2024-02-15"


@pytest.fixture()
def house(spark, tmp_path):
    prefix = f"g{uuid.uuid4().hex[:8]}_"
    catalog.create_databases(spark, layer_databases(prefix), str(tmp_path / "db"))
    return Warehouse(spark, warehouse_specs(prefix), datetime(2024, 2, 15, 3), 1.0)


@pytest.fixture()
def log(spark, tmp_path):
    return PartLog(spark, str(tmp_path / "log"))


def rows(house, dt=D, n=5, extra=0):
    return house.spark.range(n).select("id", (F.col("id") % 2 + extra).alias("v"), F.lit(dt).alias("dt"))


def nodes(calls, fail=()):
    def made(name, keep):
        def build(house, dt, **inputs):
            calls.append(name)
            if name in fail:
                raise RuntimeError("broken")
            frame = None
            for i in inputs.values():
                part = i.select("id", "v")
                frame = part if frame is None else frame.unionByName(part)
            return frame.groupBy("id").agg(F.max("v").alias("v")).where(keep).withColumn("dt", F.lit(dt))

        return build

    return plan([
        Node("day_x", "ods", {"ods_x": 1}, made("day_x", "true"), stored=False),
        Node("dwd_x", "dwd", {"day_x": 1}, made("dwd_x", "true"), ("id",)),
        Node("dwd_y", "dwd", {"ods_y": 1, "day_x": 1}, made("dwd_y", "true"), ("id",)),
        Node("dws_x", "dws", {"dwd_x": 2}, made("dws_x", "true"), ("id",)),
        Node("dws_all", "dws", {"dwd_y": HISTORY, "dwd_x": 1}, made("dws_all", "true"), ("id",)),
    ])


def test_only_stale_tables_are_built(house, log):
    for name in ("ods_x", "ods_y"):
        land(house, name, rows(house))
    calls = []
    built = run_graph(house, log, nodes(calls), D)
    assert [r.table for r in built] == ["dwd_x", "dwd_y", "dws_all", "dws_x"] and all(r.ok and r.rows == 5 for r in built)
    assert calls.count("day_x") == 1, "two tables read the extract, it is made once"
    calls.clear()
    again = run_graph(house, log, nodes(calls), D, concurrent=True)
    assert calls == [] and {r.message for r in again} == {"fresh"}
    land(house, "ods_y", rows(house, n=7))  # a corrected day
    corrected = {r.table: r for r in run_graph(house, log, nodes(calls), D)}
    assert sorted(calls) == ["day_x", "dwd_y", "dws_all"] and corrected["dws_all"].rows == 7
    assert corrected["dwd_x"].message == corrected["dws_x"].message == "fresh"


def test_a_later_day_reads_windows_and_history(house, log):
    for dt in (D, NEXT):
        for name in ("ods_x", "ods_y"):
            land(house, name, rows(house, dt, 5 if dt == D else 2))
    calls = []
    for dt in (D, NEXT):
        run_graph(house, log, nodes(calls), dt)
    assert log.stats("dws_x", NEXT).first().total_records == 5, "two days of dwd_x"
    calls.clear()
    land(house, "ods_x", rows(house, D, 9))
    run_graph(house, log, nodes(calls), D)
    calls.clear()
    run_graph(house, log, nodes(calls), NEXT)
    assert sorted(calls) == ["dws_all", "dws_x"], "what looks back on the corrected day"
    assert log.stats("dws_x", NEXT).first().total_records == 9


def test_failures_stop_what_needs_them_only(house, log):
    for name in ("ods_x", "ods_y"):
        land(house, name, rows(house))
    done = {r.table: r for r in run_graph(house, log, nodes([], fail=("dwd_y",)), D)}
    assert done["dwd_x"].ok and done["dws_x"].ok and not done["dwd_y"].ok and "broken" in done["dwd_y"].message
    assert not done["dws_all"].ok and done["dws_all"].message == "dwd_y failed"
    missing = {r.table: r for r in run_graph(house, log, nodes([]), NEXT)}
    assert missing["dwd_y"].message == "no rows in ods_y" or missing["dwd_y"].message == "day_x failed"
    assert not any(r.ok for r in missing.values())


def test_duplicate_keys_fail_the_gate(house, log):
    land(house, "ods_x", rows(house).union(rows(house)))
    twice = plan([Node("dwd_t", "dwd", {"ods_x": 1}, lambda house, dt, ods_x: ods_x, ("id",))])
    result = run_graph(house, log, twice, D)[0]
    assert not result.ok and log.version("dwd_t", D) is None
    assert not house.spark.catalog.tableExists(f"{house.specs['dwd_dim_customer'].database}.dwd_t")


def test_order_of_tables():
    waves = order(plan(), ["dws_customer_summary", "dws_product_stats"])
    assert waves[0] == ["day_customers", "day_orders", "day_products", "dwd_dim_customer"]
    assert waves[-1][-1] in ("dws_customer_summary", "dws_product_stats")
    with pytest.raises(ValueError, match="unknown"):
        order(plan(), ["nothing"])
    circle = {n: Node(n, "dwd", {m: 1}, None) for n, m in (("a", "b"), ("b", "a"))}
    with pytest.raises(ValueError, match="need each other"):
        order(circle, ["a"])
    with pytest.raises(ValueError, match="two tables"):
        plan(CUSTOMER_PLAN, CUSTOMER_PLAN)
    assert len(plan()) == len(CUSTOMER_PLAN) + len(SALES_PLAN) + 5


def test_log_answers_without_reading_a_table(house, log):
    spark, spec = house.spark, house.specs["ods_customer"]
    people = spark.range(4).select(F.col("id").alias("customer_id"), F.lit(D).alias("dt"))
    assert log.entries().collect() == [] and not log.is_fresh("ods_customer", D)
    assert logged_overwrite(log, people, spec, D, "v1", 4, fill_missing=True) == 4
    assert log.is_fresh("ods_customer", D) and not log.is_fresh("ods_customer", NEXT) and log.version("ods_customer", D) == "v1"
    logged_overwrite(log, people.limit(0).withColumn("dt", F.lit(NEXT)), spec, NEXT, fill_missing=True)
    assert log.is_fresh("ods_customer", D), "a day without rows is not newer"
    ready = {r.table_name: (r.row_count, r.ready) for r in log.layer_ready("dwd", D, ["ods_customer", "ods_order"]).collect()}
    assert ready == {"ods_customer": (4, True), "ods_order": (0, False)}
    place = catalog.describe_table(spark, spec.qualified).where("col_name = 'Location'").first().data_type
    for frame in (log.stats("ods_customer", D), log.counts(["ods_customer"], D), log.layer_ready("dwd", D)):
        assert place.removeprefix("file:") not in frame._jdf.queryExecution().executedPlan().toString()


def test_log_of_days_written_before(house, log):
    spec = house.specs["ods_customer"]
    people = house.spark.range(4).select((F.col("id") % 3).alias("customer_id"), F.lit(D).alias("dt"))
    land(house, "ods_customer", people)
    backfill_log(log, spec, [D, NEXT])
    assert [(r.total_records, r.unique_keys) for r in log.stats("ods_customer", D).collect()] == [(4, 3)]
    assert log.stats("ods_customer", NEXT).collect() == []


def test_path_job(spark, tmp_path):
    raw, out = str(tmp_path / "raw"), str(tmp_path / "out")
    for dt, n in ((D, 3), (NEXT, 5)):
        write_path(spark.range(n).withColumn("etl_batch_date", F.lit(dt)), raw, partition_by=("etl_batch_date",))
    script = "SELECT d.id, count(h.id) AS seen, :load_date AS of FROM d JOIN h ON d.id = h.id GROUP BY d.id;"
    job = PathJob(script, {"d": (raw, DAY), "h": (raw, ALL_DAYS)}, out)
    assert {r.id: r.seen for r in path_job(spark, job, NEXT).collect()} == {0: 2, 1: 2, 2: 2, 3: 1, 4: 1}
    assert {r.seen for r in path_job(spark, job, D).collect()} == {1}, "history ends with the load day"
    assert spark.read.parquet(out).count() == 8
    empty = PathJob("SELECT * FROM d", {"d": (str(tmp_path / "none"), DAY)}, out)
    read = lambda s, path, day: s.range(0)
    assert path_job(spark, empty, D, read) is None and spark.read.parquet(out).count() == 8
    with pytest.raises(ValueError):
        path_job(spark, PathJob("SELECT 1", {"d": (raw, "week")}, out), D)


def test_scripts_leave_the_callers_views(spark):
    spark.range(3).createOrReplaceTempView("mine")
    try:
        got = run_sql_script(spark, {"mine": spark.range(7), "other": spark.range(1)}, "SELECT count(*) AS n FROM mine", {})
        assert got.first().n == 7 and spark.table("mine").count() == 3
        assert not any(t.name == "other" for t in spark.catalog.listTables())
        with pytest.raises(Exception):
            run_sql_script(spark, {"mine": spark.range(7)}, "SELECT nothing FROM mine", {})
        assert spark.table("mine").count() == 3
    finally:
        spark.catalog.dropTempView("mine")
