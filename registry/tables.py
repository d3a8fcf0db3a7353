"""Sources, sinks, catalog maintenance and plans, each run on tables derived from the inputs.

Every query works in databases of its own below the shared folder.
"""

from __future__ import annotations

import uuid
from dataclasses import replace
from datetime import datetime

from pyspark.sql import Window
from pyspark.sql import functions as F

from layerwell.fixtures import FIRST_DATE, dealt_order_info, fixture
from layerwell.functions.columns import day_shift
from layerwell.operators import clean, quality
from layerwell.plans.daily import AUDIT_TABLE, Warehouse, backfill, backfill_subjects, rebuild, run_day
from layerwell.session import release, scratch_path
from layerwell.sinks import catalog, compaction
from layerwell.sinks.tables import (
    append_quality_result,
    conform,
    land_ods,
    overwrite_partition,
    overwrite_partitions,
    write_path,
)
from layerwell.sources.batch import import_files, read_partition, read_path_partition
from layerwell.specs import TableSpec, layer_databases, schema_of, warehouse_specs
from registry.aggregates import (
    PRODUCT_LABELS,
    REGION_LABELS,
    REGION_USER_COLUMNS,
    product_wide_sql,
    region_range_sql,
    region_wide_sql,
    user_range_sql,
    user_wide_sql,
)
from registry.cleaning import crm_fact, dwd_products
from registry.common import D, oracle, plain
from registry.quality import GATE_DATES

LOADED_AT = datetime(2024, 2, 15, 3, 0, 0)
NULL_LIMIT = 0.1
KEEP_DAYS = 30
ORDERS = "ods_order_info"
BAD_DAY = day_shift(D, -3)


def new_house(spark, label: str) -> Warehouse:
    prefix = f"{label}_{uuid.uuid4().hex[:8]}_"
    catalog.create_databases(spark, layer_databases(prefix), scratch_path(spark, label))
    return Warehouse(spark, warehouse_specs(prefix), LOADED_AT, NULL_LIMIT)


LINE_ORDER = (
    "product_id", "quantity", "total_amount", "discount_amount", "final_amount", "unit_price", "order_status", "order_time",
    "pay_time", "finish_time",
)
SLICES = 4


def order_lines(spark, sf):
    """The rows of the view ``ods_order_lines``, dealt over tasks by day and a hash of the order.

    An order's lines have one day (it follows from the order's key), so they are in one slice and get the view's numbers there.
    The slices are what a write by day needs, so the joined rows travel once and not again for the write, as base columns; of a
    single day's lines only that day's rows travel.
    """
    slice_ = F.pmod(F.xxhash64("o_orderkey"), F.lit(SLICES))
    rows = dealt_order_info(spark, sf, lambda joined: joined.withColumn("_slice", slice_).repartition("dt", "_slice"))
    # The order first: rows then sort by eight bytes that mostly differ.
    within = Window.partitionBy("o_orderkey", "dt", "_slice").orderBy(*(F.asc_nulls_first(c) for c in LINE_ORDER))
    number = F.row_number().over(within).cast("string")
    return rows.withColumn("order_id", F.concat("order_id", F.lit("-"), number)).drop("o_orderkey", "_slice")


def _land_orders(house, sf):
    """All days of the order heads in the ODS table."""
    overwrite_partitions(order_lines(house.spark, sf), house.specs[ORDERS], gather=False)
    release(house.spark)


def _landed(spark, sf, label: str) -> Warehouse:
    """ODS users and products of the run date and orders of all days."""
    house = new_house(spark, label)
    for name in ("ods_user_info", "ods_product_info"):
        land_ods(fixture(spark, sf, name), house.specs[name], D)
    _land_orders(house, sf)
    return house


def _per_day(df):
    return plain(
        df.groupBy("dt").agg(F.count("*").alias("n_rows"), F.sum("final_amount").alias("amount"))
    )


def _customers(spark, sf):
    """Customers as one load brings them: all under its day."""
    return fixture(spark, sf, "ods_customer").withColumn("dt", F.lit(D))


def _import(kind):
    def query(spark, sf):
        rows = fixture(spark, sf, "ods_customer")
        # Quotes, separators and a missing value in the address.
        odd = F.when(F.col("customer_id") % 3 == 0, F.concat(F.lit('"no, 1" '), "address")).when(F.col("customer_id") % 3 == 1, F.col("address"))
        rows = rows.withColumn("address", odd).drop("dt")
        path = scratch_path(spark, f"import-{kind}")
        rows.write.format(kind).option("header", True).option("escape", '"').save(path)
        return plain(import_files(spark, kind, path, D, rows.schema))

    return query


def _layer_tables(spark, sf):
    """Every typed layer table, created empty; customers landed in the first."""
    house = new_house(spark, "layers")
    specs = [s for s in house.specs.values() if s.layer in ("ods", "dwd", "dws")]
    catalog.create_tables(spark, specs)
    land_ods(_customers(spark, sf), house.specs["ods_customer"], D)
    return quality.layer_counts({s.name: spark.table(s.qualified) for s in specs}, D)


def _overwrite_partition(spark, sf):
    house = new_house(spark, "overwrite")
    _land_orders(house, sf)
    spec = house.specs[ORDERS]
    completed = order_lines(spark, sf).where((F.col("dt") == D) & (F.col("order_status") == "4"))
    overwrite_partition(completed, spec, D)
    return _per_day(spark.table(spec.qualified))


def _read_partition(spark, sf):
    house = new_house(spark, "read")
    _land_orders(house, sf)
    rows = read_partition(spark, house.specs[ORDERS], D)
    return plain(rows.select("order_id", "user_id", "product_id", "quantity", "final_amount", "dt"))


def _overwrite_partitions(spark, sf):
    house = new_house(spark, "months")
    spec = TableSpec(
        "fact_order", house.specs["dwd_fact_order"].database, "dwd",
        schema_of(
            "order_id bigint, customer_id bigint, order_amount decimal(15,2), payment_method string, dt string, "
            "order_year int, order_month int"
        ),
        keys=("order_id",), partition_by=("dt", "order_year", "order_month"),
    )
    facts = crm_fact(spark, sf).select(*spec.schema.names)
    overwrite_partitions(facts, spec)
    overwrite_partitions(facts.where("order_month = 2 AND payment_method = 'card'"), spec)
    table = spark.table(spec.qualified)
    return plain(
        table.groupBy("dt", "order_year", "order_month").agg(
            F.count("*").alias("n_rows"), F.sum("order_amount").alias("amount")
        )
    )


def _path_table(spark, sf):
    """Path of script orders by order day, with the last day written again without cancelled orders."""
    orders = clean.transform_orders(fixture(spark, sf, "orders_raw"), D)
    orders = orders.withColumn("dt", F.date_format("order_ts", "yyyy-MM-dd"))
    path = scratch_path(spark, "path-table")
    write_path(orders, path, partition_by=("dt",))
    write_path(orders.where((F.col("dt") == D) & (F.col("order_status") != "cancelled")), path, partition_by=("dt",))
    return path


def _write_path(spark, sf):
    history = read_path_partition(spark, _path_table(spark, sf))
    return plain(history.groupBy("dt").agg(F.count("*").alias("n_rows"), F.sum("order_amount").alias("amount")))


def _read_path(spark, sf):
    day = read_path_partition(spark, _path_table(spark, sf), D)
    return plain(day.select("order_id", "product_id", "order_amount", "order_status", "dt"))


def _land_ods(spark, sf):
    house = new_house(spark, "land")
    spec = house.specs["ods_customer"]
    land_ods(_customers(spark, sf), spec, D)
    return plain(spark.table(spec.qualified))


def _audit(spark, sf):
    house = new_house(spark, "audit")
    spec = house.specs["data_quality_check_result"]
    heads = clean.clean_orders(fixture(spark, sf, "ods_order_lines"))
    gates = [
        quality.quality_gate(heads, "dwd_order_info", ["order_id"], nullable_dates=GATE_DATES),
        quality.quality_gate(dwd_products(spark, sf), "dwd_product_info", ["product_id"]),
    ]
    for gate in gates:
        append_quality_result(gate, spec, D)
    return spark.table(spec.qualified).select("table_name", "total_rows", "duplicate_rows", "passed", "check_date")


def _statistics(spark, sf):
    """Row count kept by the catalog after the statistics run."""
    house = new_house(spark, "stats")
    spec = house.specs["ods_customer"]
    land_ods(_customers(spark, sf), spec, D)
    catalog.analyze_table(spark, spec.qualified)
    described = catalog.describe_table(spark, spec.qualified).where("col_name = 'Statistics'")
    return described.select(
        F.lit(spec.name).alias("table_name"),
        F.regexp_extract("data_type", r"(\d+) rows", 1).cast("bigint").alias("n_rows"),
    )


def _describe(spark, sf):
    """Columns of the landed table with the number of rows they hold."""
    house = new_house(spark, "describe")
    spec = house.specs["ods_customer"]
    land_ods(_customers(spark, sf), spec, D)
    columns = catalog.describe_table(spark, spec.qualified).where(F.col("col_name").isin(*spec.data_columns))
    filled = spark.table(spec.qualified).agg(*(F.count(c).alias(c) for c in spec.data_columns))
    filled = filled.unpivot([], spec.data_columns, "col_name", "n_values")
    return columns.select("col_name", "data_type").join(filled, "col_name")


def _repair(spark, sf):
    """Day directories written beside the catalog, then registered."""
    house = new_house(spark, "repair")
    spec = house.specs[ORDERS]
    catalog.create_tables(spark, [spec])
    location = (
        catalog.describe_table(spark, spec.qualified).where("col_name = 'Location'").first().data_type
    )
    write_path(conform(order_lines(spark, sf), spec), location, partition_by=("dt",), rebalance=False)
    catalog.repair_table(spark, spec.qualified)
    return _per_day(spark.table(spec.qualified))


def _compact(spark, sf):
    house = new_house(spark, "compact")
    spec = house.specs["ods_customer"]
    overwrite_partition(_customers(spark, sf).repartition(16), spec, D, fill_missing=True)
    before, after = catalog.compact_partition(spark, spec, D)
    return spark.table(spec.qualified).agg(
        F.count("*").alias("n_rows"), F.sum("customer_id").alias("id_sum"), F.lit(after < before).alias("fewer_files")
    )


def _compact_planned(spark, sf):
    """One file with half of the rows, many small ones: the large one stays, the others become one."""
    house = new_house(spark, "planned")
    spec = house.specs["ods_customer"]
    rows = _customers(spark, sf)
    middle = rows.agg(F.expr("percentile_approx(customer_id, 0.5)")).first()[0]
    part = F.when(F.col("customer_id") <= middle, -1).otherwise(F.col("customer_id") % 9)
    overwrite_partition(rows.repartitionByRange(10, part), spec, D, fill_missing=True)
    largest = max(compaction._folder(spark, spec, D).sizes().values())
    done = compaction.compact_planned(spark, spec, D, largest)
    spark.catalog.refreshTable(spec.qualified)
    left_alone = done.files_read < done.files_before
    return spark.table(spec.qualified).agg(
        F.count("*").alias("n_rows"), F.sum("customer_id").alias("id_sum"), F.lit(done.files_after < done.files_before).alias("fewer_files"),
        F.lit(left_alone).alias("large_left_alone"),
    )


def _clear(spark, sf):
    house = _landed(spark, sf, "clear")
    run_day(house, D, ["dwd"])
    catalog.clear_layers(spark, ["dwd"], house.specs)
    left = {
        name: spark.table(spec.qualified)
        for name, spec in house.specs.items()
        if spec.layer in ("ods", "dwd") and spark.catalog.tableExists(spec.qualified)
    }
    return quality.layer_counts(left, D)


def _expire(spark, sf):
    house = new_house(spark, "expire")
    _land_orders(house, sf)
    spec = house.specs[ORDERS]
    catalog.drop_expired(spark, spec.qualified, D, KEEP_DAYS)
    return _per_day(spark.table(spec.qualified))


def _fresh(spark, sf):
    house = new_house(spark, "fresh")
    _land_orders(house, sf)
    spec = house.specs[ORDERS]
    days = [D, day_shift(D, 1)]
    rows = [(spec.name, dt, quality.is_fresh(spark, spec, dt)) for dt in days]
    return spark.createDataFrame(rows, "table_name string, expected string, fresh boolean")


def _ready(spark, sf):
    house = _landed(spark, sf, "ready")
    run_day(house, D, ["dwd"], ["dwd_order_info"])
    before = quality.layer_ready(spark, "dwd", D, house.specs)
    return before.unionByName(quality.layer_ready(spark, "dws", D, house.specs))


def _built(spark, sf, label, concurrent=False):
    """All layers: details for every day of the inputs, subjects for the run date."""
    house = _landed(spark, sf, label)
    backfill(house, FIRST_DATE, D, ["dwd"])
    failed = [r for r in run_day(house, D, ["dws"], concurrent=concurrent) if not r.ok]
    if failed:
        raise RuntimeError(str(failed))
    return house


def _stats(spark, sf):
    house = _built(spark, sf, "tstats")
    parts = [
        quality.table_stats(spark, house.specs[name], D)
        for name in ("dws_user_subject", "dws_product_subject", "dws_region_subject")
    ]
    return plain(parts[0].unionByName(parts[1]).unionByName(parts[2]))


def _subject(house, name):
    return plain(read_partition(house.spark, house.specs[name], D).drop("dws_create_time"))


def _backfill(spark, sf):
    house = _landed(spark, sf, "backfill")
    backfill(house, FIRST_DATE, D, ["dwd"])
    return _per_day(spark.table(house.specs["dwd_order_info"].qualified))


def _backfill_audit(spark, sf):
    """One day of the range came twice: it fails, its audit row says so, and nothing is written."""
    house = _landed(spark, sf, "audit")
    day = order_lines(spark, sf).where(F.col("dt") == BAD_DAY)
    overwrite_partition(day.union(day), house.specs[ORDERS], BAD_DAY)
    results = backfill(house, FIRST_DATE, D, ["dwd"], ["dwd_order_info"])
    if all(r.ok for r in results) or spark.catalog.tableExists(house.specs["dwd_order_info"].qualified):
        raise RuntimeError("a bad day was written")
    audit = spark.table(house.specs[AUDIT_TABLE].qualified)
    return audit.select("table_name", F.col("check_date").cast("string").alias("check_date"), "total_rows", "passed")


RANGE_START = day_shift(D, -39)


def _ranged_subjects(spark, sf, label, table):
    """A subject table of 40 days, built in one go; users and products come every day."""
    house = new_house(spark, label)
    for name in ("ods_user_info", "ods_product_info"):
        rows = fixture(spark, sf, name).drop("dt").withColumn("dt", F.explode(F.expr(f"sequence(DATE '{RANGE_START}', DATE '{D}')")))
        overwrite_partitions(rows.withColumn("dt", F.col("dt").cast("string")), house.specs[name], fill_missing=True)
    _land_orders(house, sf)
    results = backfill(house, FIRST_DATE, D, ["dwd"])
    # In the first days most users have no order yet, so their order times are null.
    results += backfill_subjects(replace(house, null_limit=1.0), RANGE_START, D, [table])
    failed = [r for r in results if not r.ok]
    if failed:
        raise RuntimeError(str(failed[:3]))
    return plain(spark.table(house.specs[table].qualified).drop("dws_create_time"))


def _rebuild(spark, sf):
    house = _built(spark, sf, "rebuild")
    results = rebuild(house, D, D, ["dws"])
    if not all(r.ok for r in results):
        raise RuntimeError(str(results))
    return _subject(house, "dws_product_subject")


QUERIES = {
    "import_csv": _import("csv"),
    "import_json": _import("json"),
    "import_parquet": _import("parquet"),
    "read_partition": _read_partition,
    "read_path_partition": _read_path,
    "overwrite_partition": _overwrite_partition,
    "overwrite_partitions": _overwrite_partitions,
    "write_path": _write_path,
    "land_ods": _land_ods,
    "append_quality_result": _audit,
    "create_layer_tables": _layer_tables,
    "analyze_table": _statistics,
    "describe_table": _describe,
    "repair_table": _repair,
    "compact_partition": _compact,
    "compact_planned": _compact_planned,
    "clear_layers": _clear,
    "drop_expired": _expire,
    "is_fresh": _fresh,
    "layer_ready": _ready,
    "table_stats": _stats,
    "run_day": lambda s, d: _subject(_built(s, d, "day"), "dws_region_subject"),
    "run_day_concurrent": lambda s, d: _subject(_built(s, d, "par", concurrent=True), "dws_user_subject"),
    "backfill": _backfill,
    "backfill_audit": _backfill_audit,
    "rebuild": _rebuild,
    "backfill_subjects": lambda s, d: _ranged_subjects(s, d, "regions", "dws_region_subject"),
    "backfill_user_subjects": lambda s, d: _ranged_subjects(s, d, "users", "dws_user_subject"),
}

_IMPORT = oracle(
    "SELECT * REPLACE (CAST(registration_date AS VARCHAR) AS registration_date, CASE customer_id % 3 WHEN 0 THEN '\"no, 1\" ' || address "
    f"WHEN 1 THEN address END AS address, '{D}' AS dt) FROM ods_customer"
)
_DAYS = "SELECT dt, COUNT(*) AS n_rows, CAST(SUM(final_amount) AS DOUBLE) AS amount FROM {} GROUP BY dt"
_CUSTOMER_COUNT = "(SELECT COUNT(*) FROM ods_customer)"
_USERS, _PRODUCTS, _DAY_ORDERS = (
    "(SELECT COUNT(*) FROM ods_user_info)",
    "(SELECT COUNT(*) FROM ods_product_info)",
    f"(SELECT COUNT(*) FROM ods_order_lines WHERE dt = '{D}')",
)
_TABLES = [s.name for s in warehouse_specs().values() if s.layer in ("ods", "dwd", "dws")]
_SUBJECT_STATS = (
    "SELECT '{0}' AS table_name, '" + D + "' AS partition_date, COUNT(*) AS total_records, COUNT(*) AS unique_keys, "
    "'2024-02-15 03:00:00' AS min_create_time, '2024-02-15 03:00:00' AS max_create_time FROM {1}"
)

ORACLES = {
    "import_csv": _IMPORT,
    "import_json": _IMPORT,
    "import_parquet": _IMPORT,
    "read_partition": oracle(
        "SELECT order_id, user_id, product_id, quantity, CAST(final_amount AS DOUBLE) AS final_amount, dt "
        f"FROM ods_order_lines WHERE dt = '{D}'"
    ),
    "read_path_partition": oracle(
        f"SELECT order_id, product_id, CAST(order_amount AS DOUBLE) AS order_amount, order_status, '{D}' AS dt FROM script_orders "
        f"WHERE CAST(order_ts AS DATE) = DATE '{D}' AND order_status <> 'cancelled'"
    ),
    "overwrite_partition": oracle(
        _DAYS.format(f"(SELECT * FROM ods_order_lines WHERE dt <> '{D}' OR order_status = '4') t")
    ),
    "overwrite_partitions": oracle(
        "SELECT dt, order_year, order_month, COUNT(*) AS n_rows, CAST(SUM(order_amount) AS DOUBLE) AS amount FROM crm_fact "
        "WHERE order_month <> 2 OR payment_method = 'card' GROUP BY dt, order_year, order_month"
    ),
    "write_path": oracle(
        "SELECT CAST(CAST(order_ts AS DATE) AS VARCHAR) AS dt, COUNT(*) AS n_rows, CAST(SUM(order_amount) AS DOUBLE) AS amount "
        f"FROM script_orders WHERE CAST(order_ts AS DATE) <> DATE '{D}' OR order_status <> 'cancelled' GROUP BY 1"
    ),
    "land_ods": oracle(
        "SELECT customer_id, customer_code, customer_name, customer_type, CAST(registration_date AS VARCHAR) AS registration_date, "
        "status, phone, email, address, CAST(NULL AS VARCHAR) AS create_time, CAST(NULL AS VARCHAR) AS update_time, '2024-02-14' AS dt FROM ods_customer"
    ),
    "append_quality_result": oracle(f"""
SELECT 'dwd_order_info' AS table_name, COUNT(*) AS total_rows, COUNT(*) - COUNT(DISTINCT order_id) AS duplicate_rows,
  TRUE AS passed, '{D}' AS check_date FROM dwd_order_lines
UNION ALL SELECT 'dwd_product_info', COUNT(*), COUNT(*) - COUNT(DISTINCT product_id), TRUE, '{D}' FROM dwd_products"""),
    "create_layer_tables": oracle(
        " UNION ALL ".join(
            f"SELECT '{t}' AS table_name, {_CUSTOMER_COUNT if t == 'ods_customer' else 'CAST(0 AS BIGINT)'} AS row_count"
            for t in _TABLES
        )
    ),
    "analyze_table": oracle("SELECT 'ods_customer' AS table_name, COUNT(*) AS n_rows FROM ods_customer"),
    "describe_table": oracle(
        " UNION ALL ".join(
            f"SELECT '{f.name}' AS col_name, '{f.dataType.simpleString()}' AS data_type, "
            + ("COUNT(NULL)" if f.name in ("create_time", "update_time") else f"COUNT({f.name})")
            + " AS n_values FROM ods_customer"
            for f in warehouse_specs()["ods_customer"].schema.fields
            if f.name != "dt"
        )
    ),
    "repair_table": oracle(_DAYS.format("ods_order_lines")),
    "compact_partition": oracle(
        "SELECT COUNT(*) AS n_rows, CAST(SUM(customer_id) AS BIGINT) AS id_sum, TRUE AS fewer_files FROM ods_customer"
    ),
    "compact_planned": oracle(
        "SELECT COUNT(*) AS n_rows, CAST(SUM(customer_id) AS BIGINT) AS id_sum, TRUE AS fewer_files, TRUE AS large_left_alone FROM ods_customer"
    ),
    "clear_layers": oracle(
        f"SELECT 'ods_user_info' AS table_name, {_USERS} AS row_count UNION ALL SELECT 'ods_product_info', {_PRODUCTS} "
        f"UNION ALL SELECT 'ods_order_info', {_DAY_ORDERS}"
    ),
    "drop_expired": oracle(
        _DAYS.format(f"(SELECT * FROM ods_order_lines WHERE dt >= '{day_shift(D, -KEEP_DAYS)}') t")
    ),
    "is_fresh": oracle(
        f"SELECT 'ods_order_info' AS table_name, '{D}' AS expected, MAX(dt) = '{D}' AS fresh FROM ods_order_lines "
        f"UNION ALL SELECT 'ods_order_info', '{day_shift(D, 1)}', MAX(dt) = '{day_shift(D, 1)}' FROM ods_order_lines"
    ),
    "layer_ready": oracle(
        f"SELECT 'ods_user_info' AS table_name, {_USERS} AS row_count, TRUE AS ready "
        f"UNION ALL SELECT 'ods_product_info', {_PRODUCTS}, TRUE UNION ALL SELECT 'ods_order_info', {_DAY_ORDERS}, TRUE "
        f"UNION ALL SELECT 'dwd_user_info', 0, FALSE UNION ALL SELECT 'dwd_product_info', 0, FALSE "
        f"UNION ALL SELECT 'dwd_order_info', (SELECT COUNT(*) FROM dwd_order_lines WHERE dt = '{D}'), TRUE"
    ),
    "table_stats": oracle(
        _SUBJECT_STATS.format("dws_user_subject", "dwd_users")
        + " UNION ALL "
        + _SUBJECT_STATS.format("dws_product_subject", "dwd_products")
        + " UNION ALL "
        + _SUBJECT_STATS.format(
            "dws_region_subject",
            "(SELECT DISTINCT province, city FROM dwd_order_lines WHERE order_status = 'completed' "
            f"AND dt BETWEEN '{day_shift(D, -29)}' AND '{D}') t",
        )
    ),
    "run_day": region_wide_sql(REGION_LABELS, REGION_USER_COLUMNS, "dwd_order_lines"),
    "run_day_concurrent": user_wide_sql("dwd_order_lines"),
    "backfill": oracle(_DAYS.format("dwd_order_lines")),
    "backfill_audit": oracle(
        f"SELECT 'dwd_order_info' AS table_name, dt AS check_date, COUNT(*) * CASE dt WHEN '{BAD_DAY}' THEN 2 ELSE 1 END AS total_rows, "
        f"dt <> '{BAD_DAY}' AS passed FROM dwd_order_lines GROUP BY dt"
    ),
    "rebuild": product_wide_sql(PRODUCT_LABELS, "dwd_order_lines"),
    "backfill_subjects": region_range_sql("dwd_order_lines", RANGE_START),
    "backfill_user_subjects": user_range_sql("dwd_order_lines", RANGE_START),
}
