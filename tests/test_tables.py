"""Writes: other days stay, reruns repeat, a failed gate writes nothing, maintenance keeps rows."""

import uuid
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from layerwell.functions.columns import day_shift
from layerwell.operators import quality
from layerwell.plans import daily
from layerwell.sinks import catalog
from layerwell.sinks.tables import conform, land_ods, overwrite_partition, overwrite_partitions, write_path
from layerwell.sources.batch import read_partition, read_path_partition
from layerwell.specs import TableSpec, layer_databases, schema_of, warehouse_specs
from tests_support import dwd_ready_orders, product_rows, user_rows

D = "2024-02-14"
D1 = day_shift(D, -1)


@pytest.fixture()
def house(spark):
    prefix = f"t{uuid.uuid4().hex[:8]}_"
    catalog.create_databases(spark, layer_databases(prefix))
    return daily.Warehouse(spark, warehouse_specs(prefix), datetime(2024, 2, 15), null_limit=0.5)


@pytest.fixture()
def spec(house):
    return TableSpec("t", house.specs["ods_order"].database, "ods", schema_of("k bigint, v string, dt string"), keys=("k",))


def rows(spark, *values):
    return spark.createDataFrame(values, "k long, v string, dt string")


def content(spark, spec):
    return sorted(tuple(r) for r in spark.table(spec.qualified).collect())


def test_second_day_keeps_the_first_and_reruns_repeat(spark, spec):
    overwrite_partition(rows(spark, (1, "a", D1)), spec, D1)
    for _ in range(2):
        overwrite_partition(rows(spark, (2, "b", D)), spec, D)
    assert content(spark, spec) == [(1, "a", D1), (2, "b", D)]
    overwrite_partition(rows(spark, (2, "b", D)).where("k < 0"), spec, D)
    assert content(spark, spec) == [(1, "a", D1)]


def test_frame_without_day_gets_it(spark, spec):
    overwrite_partition(rows(spark, (1, "a", D)).drop("dt"), spec, D)
    assert content(spark, spec) == [(1, "a", D)]


def test_row_of_another_day_stops_the_write(spark, spec):
    overwrite_partition(rows(spark, (1, "a", D)), spec, D)
    with pytest.raises(Exception, match="outside partition"):
        overwrite_partition(rows(spark, (2, "b", D), (3, "c", D1)), spec, D)
    assert content(spark, spec) == [(1, "a", D)]


def test_table_without_the_overwrite_option_is_refused(spark, spec):
    spark.sql(f"CREATE TABLE {spec.qualified} (k BIGINT, v STRING, dt STRING) USING parquet PARTITIONED BY (dt)")
    with pytest.raises(ValueError, match="created elsewhere"):
        overwrite_partition(rows(spark, (1, "a", D)), spec, D)


def test_schema_mismatch_is_an_error(spark, spec):
    with pytest.raises(ValueError, match="missing"):
        conform(rows(spark, (1, "a", D)).drop("v"), spec)
    with pytest.raises(ValueError, match="is not"):
        conform(rows(spark, (1, "a", D)).withColumn("k", F.lit("1")), spec)


def test_several_partitions_are_replaced_together(spark, spec):
    overwrite_partitions(rows(spark, (1, "a", D), (2, "b", D1), (3, "c", "2024-01-01")), spec)
    overwrite_partitions(rows(spark, (9, "z", D), (8, "y", D1)), spec)
    assert content(spark, spec) == [(3, "c", "2024-01-01"), (8, "y", D1), (9, "z", D)]


def test_path_table(spark, tmp_path):
    path = str(tmp_path / "p")
    write_path(rows(spark, (1, "a", D), (2, "b", D1)), path, partition_by=("dt",))
    write_path(rows(spark, (3, "c", D)), path, mode="OVERWRITE", partition_by=("dt",))
    assert sorted((r.k, r.dt) for r in read_path_partition(spark, path).collect()) == [(2, D1), (3, D)]
    day = read_path_partition(spark, path, D)
    assert [(r.k, r.dt) for r in day.collect()] == [(3, D)] and day.schema["dt"].dataType.simpleString() == "string"


def test_day_read_prunes_other_partitions(spark, spec):
    overwrite_partitions(rows(spark, (1, "a", D), (2, "b", D1)), spec)
    day = read_partition(spark, spec, D)
    assert len(day.inputFiles()) == 1
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan and D in plan


def test_landing_fills_missing_columns_and_bounds_files(spark, house):
    spec = house.specs["ods_order"]
    df = spark.range(100, numPartitions=20).select(F.col("id").alias("order_id"), F.lit(D).alias("dt"))
    land_ods(df, spec, D, max_files=3)
    table = spark.table(spec.qualified)
    assert table.count() == 100 and len(table.inputFiles()) <= 3
    assert table.where("order_no IS NOT NULL").isEmpty()


def test_compaction_keeps_rows_and_other_days(spark, spec):
    overwrite_partition(spark.range(64).selectExpr("id AS k", "'v' AS v").repartition(16), spec, D)
    overwrite_partition(rows(spark, (7, "x", D1)), spec, D1)
    before, after = catalog.compact_partition(spark, spec, D, files=2)
    assert (before, after) == (16, 2)
    assert spark.table(spec.qualified).groupBy("dt").count().orderBy("dt").collect() == [(D1, 1), (D, 64)]
    tables = [t.tableName for t in spark.sql(f"SHOW TABLES IN {spec.database}").collect() if not t.isTemporary]
    assert tables == ["t"]


def test_expired_partitions_go_and_the_limit_day_stays(spark, spec):
    days = [D, day_shift(D, -90), day_shift(D, -91)]
    overwrite_partitions(rows(spark, *((i, "v", dt) for i, dt in enumerate(days))), spec)
    assert catalog.drop_expired(spark, spec.qualified, D) == [day_shift(D, -91)]
    assert catalog.partitions(spark, spec.qualified) == [day_shift(D, -90), D]


def test_freshness_ignores_empty_partitions(spark, spec):
    overwrite_partition(rows(spark, (1, "a", D1)), spec, D1)
    spark.sql(f"ALTER TABLE {spec.qualified} ADD PARTITION (dt = '{D}')")
    assert quality.is_fresh(spark, spec, D1) and not quality.is_fresh(spark, spec, D)


def landed(spark, house, orders=None):
    overwrite_partition(user_rows(spark), house.specs["ods_user_info"], D)
    overwrite_partition(product_rows(spark), house.specs["ods_product_info"], D)
    overwrite_partition(orders if orders is not None else dwd_ready_orders(spark), house.specs["ods_order_info"], D)


def test_daily_run_builds_both_layers(spark, house):
    landed(spark, house)
    results = daily.run_day(house, D)
    assert [r.table for r in results if r.ok] == [
        "dwd_user_info", "dwd_order_info", "dwd_product_info",
        "dws_user_subject", "dws_product_subject", "dws_region_subject",
    ]
    audit = spark.table(house.specs["data_quality_check_result"].qualified)
    assert audit.where("passed").count() == 6
    user = read_partition(spark, house.specs["dws_user_subject"], D).where("user_id = 1").first()
    assert (user.order_count_1d, user.order_amount_1d) == (2, Decimal("30.00"))


def test_failed_gate_writes_nothing_and_stops_the_next_layer(spark, house):
    landed(spark, house)
    assert all(r.ok for r in daily.run_day(house, D, ["dwd"]))
    before = read_partition(spark, house.specs["dwd_order_info"], D).collect()
    twice = dwd_ready_orders(spark).union(dwd_ready_orders(spark))
    overwrite_partition(twice, house.specs["ods_order_info"], D)
    results = daily.run_day(house, D)
    bad = [r for r in results if not r.ok]
    assert [r.table for r in bad] == ["dwd_order_info"] and "duplicate" in bad[0].message
    assert {r.layer for r in results} == {"dwd"}
    assert read_partition(spark, house.specs["dwd_order_info"], D).collect() == before


def test_missing_input_is_reported(spark, house):
    results = daily.run_day(house, D, ["dws"])
    assert not any(r.ok for r in results) and "no rows in" in results[0].message


def test_unknown_names_are_errors(house):
    with pytest.raises(ValueError):
        daily.run_day(house, D, ["ads"])
    with pytest.raises(ValueError):
        daily.run_day(house, D, tables=["nope"])


def test_backfill_and_rebuild_cover_a_range(spark, house):
    landed(spark, house)
    overwrite_partition(dwd_ready_orders(spark, D1), house.specs["ods_order_info"], D1)
    overwrite_partition(user_rows(spark, D1), house.specs["ods_user_info"], D1)
    overwrite_partition(product_rows(spark, D1), house.specs["ods_product_info"], D1)
    assert all(r.ok for r in daily.backfill(house, D1, D))
    days = spark.table(house.specs["dws_user_subject"].qualified).groupBy("dt").count().orderBy("dt").collect()
    assert [r.dt for r in days] == [D1, D]
    assert all(r.ok for r in daily.rebuild(house, D, D, ["dws"]))
    assert catalog.partitions(spark, house.specs["dws_user_subject"].qualified) == [D]
    assert catalog.partitions(spark, house.specs["dwd_user_info"].qualified) == [D1, D]


def test_days_of_a_closed_range():
    assert daily.days_between("2024-02-28", "2024-03-01") == ["2024-02-28", "2024-02-29", "2024-03-01"]
    assert daily.days_between(D, D1) == []


def test_order_lines_are_the_view_and_travel_once(spark, tmp_path):
    """the rows were shuffled for their numbers and again for the write."""
    from layerwell.fixtures import fixture
    from registry.tables import order_lines

    place = str(tmp_path)
    tables = {
        "region": ("r_regionkey int, r_name string", [(0, "R")]),
        "nation": ("n_nationkey int, n_name string, n_regionkey int", [(0, "N", 0)]),
        "customer": ("c_custkey long, c_name string, c_nationkey int", [(1, "a", 0), (2, "b", 0)]),
        "part": ("p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
                 [(i, f"p{i}", "B", "T", 1, 9.5) for i in range(7)]),
        "orders": ("o_orderkey long, o_custkey long, o_orderstatus string", [(i, 1 + i % 2, "FPO"[i % 3]) for i in range(60)] + [(7, 2, "F")]),
        "lineitem": ("l_orderkey long, l_partkey long, l_quantity double, l_extendedprice double, l_discount double",
                     [(i % 60, i * 5 % 7, float(i % 3), 100.0 + i % 2, 0.1) for i in range(240)]),
    }
    for name, (schema, rows_) in tables.items():
        spark.createDataFrame(rows_, schema).write.parquet(f"{place}/{name}.parquet")
    ours, view = order_lines(spark, place), fixture(spark, place, "ods_order_lines")
    plan = ours._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning(dt") == 1 and "hashpartitioning(order_id" not in plan
    day = ours.where(F.col("dt") == "2024-01-08")._jdf.queryExecution().optimizedPlan().toString()
    assert "2024-01-08" not in day.partition("Window")[0] and "2024-01-08" in day  # filtered before the rows travel
    assert ours.columns == view.columns and sorted(map(tuple, ours.collect()), key=repr) == sorted(map(tuple, view.collect()), key=repr)


def test_details_are_written_by_the_tasks_that_read_them(spark, house, monkeypatch):
    """the cleaned rows of a range were shuffled once more before they were written."""
    from layerwell.plans import daily
    from layerwell.sinks import tables as sinks

    plans, insert = [], sinks._insert
    monkeypatch.setattr(sinks, "_insert", lambda df, spec: (plans.append(df._jdf.queryExecution().analyzed().toString()), insert(df, spec))[1])
    for dt in (D1, D):
        land_ods(dwd_ready_orders(spark, dt), house.specs["ods_order_info"], dt)
    plans.clear()
    assert all(r.ok for r in daily.backfill_details(house, D1, D, ["dwd_order_info"]))
    assert len(plans) == 1 and "Rebalance" not in plans[0]
    got = spark.table(house.specs["dwd_order_info"].qualified).groupBy("dt").count().collect()
    assert {(r.dt, r["count"]) for r in got} == {(D1, 3), (D, 3)}


def base_tables(spark, place):
    """Base tables of the order lines with repeated and missing keys."""
    tables = {
        "region": ("r_regionkey int, r_name string", [(0, "R"), (1, "S")]),
        "nation": ("n_nationkey int, n_name string, n_regionkey int", [(0, "N", 0), (1, "M", 1)]),
        "customer": ("c_custkey long, c_name string, c_nationkey int", [(1, "a", 0), (2, "b", 1), (2, "b", 1), (None, "c", 0)]),
        "part": ("p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
                 [(i, f"p{i}", " " if i else None, "T", i, 9.5) for i in range(7)] + [(3, "p3", " ", "T", 3, 9.5), (None, "p", "B", "T", 1, 1.0)]),
        "orders": ("o_orderkey long, o_custkey long, o_orderstatus string",
                   [(i, 1 + i % 2, "FPO"[i % 3]) for i in range(60)] + [(7, 2, "F"), (9, None, "F"), (None, 1, "F"), (11, 1, None)]),
        "lineitem": ("l_orderkey long, l_partkey long, l_quantity double, l_extendedprice double, l_discount double",
                     [(i % 60, i * 5 % 7, float(i % 3), 100.0 + i % 2, 0.1) for i in range(240)] + [(None, 1, 1.0, 1.0, 0.0), (5, None, 1.0, 1.0, 0.0), (5, 3, None, None, None)]),
    }
    for name, (schema, rows_) in tables.items():
        spark.createDataFrame(rows_, schema).write.parquet(f"{place}/{name}.parquet")


def test_order_lines_travel_as_base_columns(spark, tmp_path):
    """the rows were shuffled as the view's 21 columns, texts made of keys and codes among them, and lines by customer."""
    from layerwell.fixtures import fixture
    from registry.tables import order_lines

    place, kept = str(tmp_path), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    base_tables(spark, place)
    # The setting belongs to this test's session only for the plan.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        ours = order_lines(spark, place)
        plan = ours._jdf.queryExecution().executedPlan().toString()
        logical = ours._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    moved = logical.partition("RepartitionByExpression")[2]
    assert moved and not any(f"AS {made}" in moved for made in ("order_id", "order_time", "pay_time", "finish_time", "final_amount", "payment_method"))
    assert plan.count("hashpartitioning(") == plan.count("hashpartitioning(dt") + 2 * 5  # five joins, one deal, nothing else
    view = fixture(spark, place, "ods_order_lines")
    assert ours.columns == view.columns
    assert sorted(map(tuple, ours.collect()), key=repr) == sorted(map(tuple, view.collect()), key=repr)


def test_details_are_not_stored_between_gate_and_write(spark, house, monkeypatch):
    """cleaned rows of a range were kept on disk beside the table they come from and the table they go to."""
    from pyspark.sql import DataFrame

    stored, persist = [], DataFrame.persist
    monkeypatch.setattr(DataFrame, "persist", lambda df, *level: (stored.append(df.columns), persist(df, *level))[1])
    for dt in (D1, D):
        land_ods(dwd_ready_orders(spark, dt), house.specs["ods_order_info"], dt)
    assert all(r.ok for r in daily.backfill_details(house, D1, D, ["dwd_order_info"])) and not stored
    assert spark.table(house.specs["dwd_order_info"].qualified).count() == 6
