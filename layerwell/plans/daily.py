"""Daily build, backfill and rebuild of the warehouse layers."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from layerwell.functions.columns import day_shift
from layerwell.operators import clean, day_bitmaps, wide
from layerwell.operators.quality import NULL_RATIO_LIMIT, UPSTREAM, layer_ready, quality_gate
from layerwell.operators.shape import stamp
from layerwell.session import release
from layerwell.sinks.catalog import clear_layers
from layerwell.sinks.tables import append_quality_result, overwrite_partition, overwrite_partitions
from layerwell.sources.batch import read_days, read_partition
from layerwell.specs import TableSpec

LAYERS = ("dwd", "dws")
AUDIT_TABLE = "data_quality_check_result"
MAX_THREADS = 4


@dataclass(frozen=True)
class StepResult:
    """What happened to one table on one day."""

    layer: str
    table: str
    dt: str
    ok: bool
    rows: int = 0
    message: str = ""


@dataclass(frozen=True)
class Warehouse:
    """Session, table specs and load time of a run."""

    spark: SparkSession
    specs: dict[str, TableSpec]
    loaded_at: datetime
    null_limit: float = NULL_RATIO_LIMIT

    def day(self, table: str, dt: str) -> DataFrame:
        return read_partition(self.spark, self.specs[table], dt)

    def days(self, table: str, first: str, last: str) -> DataFrame:
        return read_days(self.spark, self.specs[table], first, last)

    def window(self, table: str, dt: str, days: int) -> DataFrame:
        return self.days(table, day_shift(dt, 1 - days), dt)


# Cleaning step and source of each detail table.
CLEANERS: dict[str, tuple[str, Callable]] = {
    "dwd_user_info": ("ods_user_info", clean.clean_users),
    "dwd_order_info": ("ods_order_info", clean.clean_orders),
    "dwd_product_info": ("ods_product_info", clean.clean_products),
}


def _dwd(table: str) -> Callable[[Warehouse, str], DataFrame]:
    source, cleaner = CLEANERS[table]
    return lambda house, dt: cleaner(house.day(source, dt), house.loaded_at)


def _users(house: Warehouse, dt: str) -> DataFrame:
    return wide.user_wide(house.day("dwd_user_info", dt), house.window("dwd_order_info", dt, 30), dt)


def _products(house: Warehouse, dt: str) -> DataFrame:
    return wide.product_wide(house.day("dwd_product_info", dt), house.window("dwd_order_info", dt, 30), dt)


def _regions(house: Warehouse, dt: str) -> DataFrame:
    return wide.region_wide(house.window("dwd_order_info", dt, 30), dt)


def _dws(build: Callable[[Warehouse, str], DataFrame]) -> Callable[[Warehouse, str], DataFrame]:
    return lambda house, dt: stamp(build(house, dt), house.loaded_at, "dws_create_time")


BUILDERS: dict[str, dict[str, Callable[[Warehouse, str], DataFrame]]] = {
    "dwd": {table: _dwd(table) for table in CLEANERS},
    "dws": {
        "dws_user_subject": _dws(_users),
        "dws_product_subject": _dws(_products),
        "dws_region_subject": _dws(_regions),
    },
}


def _chosen(layers: Sequence[str], tables: Sequence[str] | None) -> list[tuple[str, list[str]]]:
    """Chosen tables per layer, in layer order; unknown names are errors."""
    unknown = set(layers) - set(LAYERS)
    if unknown:
        raise ValueError(f"unknown layers: {sorted(unknown)}")
    known = {t for layer in LAYERS for t in BUILDERS[layer]}
    if tables is not None and set(tables) - known:
        raise ValueError(f"unknown tables: {sorted(set(tables) - known)}")
    return [
        (layer, [t for t in BUILDERS[layer] if tables is None or t in tables]) for layer in LAYERS if layer in layers
    ]


def build_table(house: Warehouse, layer: str, table: str, dt: str) -> StepResult:
    """Build one table for one day: compute once, gate, record the gate's result, write."""
    spec = house.specs[table]
    # Spilled to executor disks; a lost executor only recomputes its own blocks.
    frame = BUILDERS[layer][table](house, dt).persist(StorageLevel.DISK_ONLY)
    try:
        gate = quality_gate(frame, table, spec.keys, house.null_limit, spec.nullable_dates)
        result = gate.first()
        kept = house.spark.createDataFrame([result], gate.schema)
        append_quality_result(kept, house.specs[AUDIT_TABLE], dt)
        if not result.passed:
            return StepResult(layer, table, dt, False, result.total_rows, result.issues)
        overwrite_partition(frame, spec, dt)
        return StepResult(layer, table, dt, True, result.total_rows)
    finally:
        frame.unpersist()
        release(house.spark)


def run_day(
    house: Warehouse,
    dt: str,
    layers: Sequence[str] = LAYERS,
    tables: Sequence[str] | None = None,
    concurrent: bool = False,
    threads: int = MAX_THREADS,
) -> list[StepResult]:
    """Build the chosen layers and tables of a day, in layer order.

    Stops at the first layer with a failed table or with an empty input, and
    says so in the results. ``concurrent`` builds the tables of one layer from
    ``threads`` threads of the same session.
    """
    results: list[StepResult] = []
    for layer, names in _chosen(layers, tables):
        needed = [CLEANERS[t][0] for t in names] if layer == "dwd" else None
        missing = [
            r.table_name for r in layer_ready(house.spark, layer, dt, house.specs, needed).collect() if not r.ready
        ]
        if missing:
            results += [StepResult(layer, t, dt, False, 0, f"no rows in {', '.join(missing)}") for t in names]
            break

        def step(table: str, layer: str = layer) -> StepResult:
            try:
                return build_table(house, layer, table, dt)
            except Exception as error:  # the caller sees the failure in the result
                return StepResult(layer, table, dt, False, 0, str(error))

        def pooled(table: str) -> StepResult:
            # A scheduler pool per table; shares the cores evenly where the session schedules fairly.
            house.spark.sparkContext.setLocalProperty("spark.scheduler.pool", table)
            return step(table)

        if concurrent:
            with ThreadPoolExecutor(max_workers=threads) as pool:
                done = list(pool.map(pooled, names))
        else:
            done = [step(t) for t in names]
        results += done
        if not all(r.ok for r in done):
            break
    return results


def days_between(start: str, end: str) -> list[str]:
    """All days of a closed range."""
    days = []
    day = start
    while day <= end:
        days.append(day)
        day = day_shift(day, 1)
    return days


def backfill_details(
    house: Warehouse, start: str, end: str, tables: Sequence[str] | None = None
) -> list[StepResult]:
    """Rebuild detail tables for a range of days in one job each; one result per table and day.

    Cleaning looks at one row at a time, so the whole range is one read and one
    dynamic overwrite, and rows are written by the tasks that read them: a day gets at most
    as many files as tasks have read its source. Rows are cleaned for the gate and again for the write, which costs no more than
    to store them in between and takes no disk. Every day is gated on its own and leaves an audit row. A
    table is written only if all its days pass; days without source rows keep
    their old rows and are reported.
    """
    results = []
    for table in tables or CLEANERS:
        source, cleaner = CLEANERS[table]
        rows = cleaner(read_days(house.spark, house.specs[source], start, end), house.loaded_at)
        done = _write_range(house, "dwd", table, rows, days_between(start, end), f"no rows in {source}", stored=False)
        results += done
        if not all(r.ok for r in done):
            break
    return results


def _write_range(
    house: Warehouse, layer: str, table: str, rows: DataFrame, days: list[str], nothing: str, stored: bool = True
) -> list[StepResult]:
    """Gate every day of a frame on its own, leave audit rows, write the table if all its days pass.

    ``stored`` keeps the frame on disk between the gate and the write and gathers it by day for the write. Without it
    the frame is computed twice and written by the tasks it is in: for what is read and made row by row.
    """
    spec = house.specs[table]
    if stored:
        rows = rows.persist(StorageLevel.DISK_ONLY)
    try:
        gate = quality_gate(rows, table, spec.keys, house.null_limit, spec.nullable_dates, by="dt")
        checked = {r.check_date: r for r in gate.collect()}  # one row per day of the range
        if checked:
            append_quality_result(
                house.spark.createDataFrame(list(checked.values()), gate.schema), house.specs[AUDIT_TABLE]
            )
        done = []
        for dt in days:
            day = checked.get(dt)
            if day is None:
                done.append(StepResult(layer, table, dt, True, 0, nothing))
            else:
                done.append(StepResult(layer, table, dt, day.passed, day.total_rows, day.issues))
        if checked and all(r.ok for r in done):
            overwrite_partitions(rows, spec, gather=stored)
        return done
    finally:
        if stored:
            rows.unpersist()
        release(house.spark)


# Subject of each table, and its rows of a range of days.
RANGE_BUILDERS: dict[str, tuple[str, Callable[[Warehouse, DataFrame, str, str], DataFrame]]] = {
    "dws_user_subject": (
        "user",
        lambda house, cube, start, end: day_bitmaps.user_wide_range(house.days("dwd_user_info", start, end), cube, start, end),
    ),
    "dws_product_subject": (
        "product",
        lambda house, cube, start, end: day_bitmaps.product_wide_range(
            house.days("dwd_product_info", start, end), cube, start, end
        ),
    ),
    "dws_region_subject": ("region", lambda house, cube, start, end: day_bitmaps.region_wide_range(cube, start, end)),
}


def backfill_subjects(
    house: Warehouse, start: str, end: str, tables: Sequence[str] | None = None
) -> list[StepResult]:
    """Rebuild subject tables for a range of days from one read of the orders; one result per table and day.

    The days up to the first one without detail rows are built; that day is
    reported. A table is written only if all its days pass their gates.
    """
    names = list(tables or RANGE_BUILDERS)
    filled = {
        name: {r.dt for r in house.days(name, start, end).select("dt").distinct().collect()}  # one row per day
        if house.spark.catalog.tableExists(house.specs[name].qualified)
        else set()
        for name in UPSTREAM["dws"]
    }
    days = days_between(start, end)
    ready = [dt for dt in days if all(dt in found for found in filled.values())]
    until = next((dt for dt in days if dt not in ready), None)
    days = days if until is None else [dt for dt in days if dt < until]
    results = []
    if days:
        last = days[-1]
        orders = house.days("dwd_order_info", day_shift(start, -day_bitmaps.LOOKBACK), last)
        cube = day_bitmaps.day_cube(orders, start, last, tuple(RANGE_BUILDERS[t][0] for t in names))
        for table in names:
            rows = stamp(RANGE_BUILDERS[table][1](house, cube, start, last), house.loaded_at, "dws_create_time")
            done = _write_range(house, "dws", table, rows, days, "no rows")
            results += done
            if not all(r.ok for r in done):
                return results
    if until is not None:
        empty = ", ".join(name for name, found in filled.items() if until not in found)
        results += [StepResult("dws", t, until, False, 0, f"no rows in {empty}") for t in names]
    return results


def backfill(
    house: Warehouse,
    start: str,
    end: str,
    layers: Sequence[str] = LAYERS,
    tables: Sequence[str] | None = None,
    concurrent: bool = False,
) -> list[StepResult]:
    """Build or repair the chosen layers for a closed range of days.

    Both layers are built for the whole range at once; a single day of subjects
    runs as ``run_day``, which need not group by day.
    """
    results = []
    for layer, names in _chosen(layers, tables):
        if layer == "dwd":
            done = backfill_details(house, start, end, names)
            results += done
            if not all(r.ok for r in done):
                return results
            continue
        done = run_day(house, start, [layer], names, concurrent) if start == end else backfill_subjects(house, start, end, names)
        results += done
        if not all(r.ok for r in done):
            return results
    return results


def rebuild(house: Warehouse, start: str, end: str, layers: Sequence[str] = LAYERS) -> list[StepResult]:
    """Drop the tables of the chosen layers, then backfill them."""
    _chosen(layers, None)
    clear_layers(house.spark, layers, house.specs)
    return backfill(house, start, end, layers)
