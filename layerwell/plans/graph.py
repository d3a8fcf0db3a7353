"""A plan as a graph: every table names its inputs, a run rebuilds what is stale.

A node is a table, the days it reads of its inputs, and the function that makes it. Running targets for a day walks their inputs
in topological order. A part (table and day) has a version: a digest of its node and of the versions of the parts it is made
from; a landed table's version is that of its files. A part whose logged version is the one it would get now is fresh and is
neither read nor written. So a second run does nothing, and a landed day that was corrected rebuilds what hangs on it, only.

Nodes that are not stored (daily extracts) are computed when a stale table needs them; if several do, they are kept on
executor disks until the run is over, so that shared inputs are read once. Tables of one wave may be built concurrently. A
failed table stops what needs it, and nothing else.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerwell.functions.columns import day_shift
from layerwell.operators import clean, enrich, summary
from layerwell.operators.quality import quality_gate
from layerwell.operators.shape import add_etl_columns
from layerwell.plans.daily import AUDIT_TABLE, MAX_THREADS, StepResult, Warehouse
from layerwell.sinks.catalog import describe_table, partitions
from layerwell.sinks.part_log import PartLog, logged_overwrite
from layerwell.sinks.tables import append_quality_result, overwrite_partitions
from layerwell.specs import TableSpec

HISTORY = 0  # read all days up to the run day
LAYER_OF = {"ods": "ods_customer", "dwd": "dwd_dim_customer", "dws": "dws_customer_summary"}


@dataclass(frozen=True)
class Node:
    """A table of the plan: days read of each input (``HISTORY`` for all), and how it is made from them."""

    name: str
    layer: str
    inputs: Mapping[str, int]
    build: Callable[..., DataFrame] = field(repr=False)
    keys: tuple[str, ...] = ()
    stored: bool = True
    nullable_dates: tuple[str, ...] = ()
    null_limit: float | None = None
    revision: str = "1"  # raise it when the function changes


@dataclass
class _Run:
    house: Warehouse
    log: PartLog
    nodes: Mapping[str, Node]
    dt: str
    versions: dict[tuple[str, str], str | None] = field(default_factory=dict)
    shared: dict[str, DataFrame] = field(default_factory=dict)

    def spec(self, name: str) -> TableSpec:
        """The table's spec; tables without one live in the database of their layer."""
        if name in self.house.specs:
            return self.house.specs[name]
        layer = self.nodes[name].layer if name in self.nodes else "ods"
        database = self.house.specs[LAYER_OF[layer]].database
        return TableSpec(name, database, layer, T.StructType(), keys=self.nodes[name].keys if name in self.nodes else ())

    def window(self, name: str, days: int) -> list[str]:
        """Days of an input that a node of the run day reads."""
        if days != HISTORY:
            return [day_shift(self.dt, -n) for n in range(days)]
        if not self.house.spark.catalog.tableExists(self.spec(name).qualified):
            return [self.dt]
        return sorted({d for d in partitions(self.house.spark, self.spec(name).qualified) if d <= self.dt} | {self.dt})

    def version(self, name: str, dt: str) -> str | None:
        """Version of a part as it is now; None if there is none."""
        if (name, dt) not in self.versions:
            if name not in self.nodes:
                self.versions[name, dt] = self._landed(name, dt)
            elif not self.nodes[name].stored or dt == self.dt:
                self.versions[name, dt] = self.wanted(name)
            else:
                self.versions[name, dt] = self.log.version(name, dt)
        return self.versions[name, dt]

    def wanted(self, name: str) -> str:
        """Version that the run day's part gets if it is built from its inputs as they are."""
        node = self.nodes[name]
        parts = [(i, day, self.version(i, day)) for i, days in sorted(node.inputs.items()) for day in self.window(i, days)]
        return hashlib.sha256(repr((name, node.revision, self.dt, parts)).encode()).hexdigest()

    def _landed(self, name: str, dt: str) -> str | None:
        """Version of a landed day: its files, from one listing of its folder."""
        spark, table = self.house.spark, self.spec(name).qualified
        if not spark.catalog.tableExists(table):
            return None
        place = describe_table(spark, table).where("col_name = 'Location'").first().data_type
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{place}/dt={dt}")
        system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
        if not system.exists(folder):
            return None
        files = [(f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in system.listStatus(folder)]
        return hashlib.sha256(repr(sorted(files)).encode()).hexdigest()

    def read(self, name: str, days: int) -> DataFrame:
        """Rows of an input, from its table or, for an extract, from its own inputs."""
        if name in self.nodes and not self.nodes[name].stored:
            if name not in self.shared:
                self.shared[name] = self.make(name)
            return self.shared[name]
        table = self.house.spark.table(self.spec(name).qualified)
        first = F.lit(True) if days == HISTORY else F.col("dt") >= day_shift(self.dt, 1 - days)
        return table.where(first & (F.col("dt") <= self.dt))

    def make(self, name: str) -> DataFrame:
        node = self.nodes[name]
        frames = {i: self.read(i, days) for i, days in node.inputs.items()}
        return node.build(self.house, self.dt, **frames)


def order(nodes: Mapping[str, Node], targets: Sequence[str]) -> list[list[str]]:
    """The targets and all they need in waves: a table comes after its inputs. Unknown targets and circles are errors."""
    unknown = set(targets) - set(nodes)
    if unknown:
        raise ValueError(f"unknown tables: {sorted(unknown)}")
    depth: dict[str, int] = {}

    def walk(name: str, path: tuple[str, ...]) -> int:
        if name not in nodes:
            return -1
        if name in path:
            raise ValueError(f"tables need each other: {' -> '.join([*path, name])}")
        if name not in depth:
            depth[name] = 1 + max((walk(i, (*path, name)) for i in nodes[name].inputs), default=-1)
        return depth[name]

    for target in targets:
        walk(target, ())
    return [sorted(n for n in depth if depth[n] == d) for d in range(max(depth.values(), default=-1) + 1)]


def run_graph(
    house: Warehouse, log: PartLog, nodes: Mapping[str, Node], dt: str, targets: Sequence[str] | None = None, concurrent: bool = False,
    threads: int = MAX_THREADS,
) -> list[StepResult]:
    """Bring the targets (all stored tables, if none are named) up to date for a day; one result per stored table."""
    targets = list(targets or [n for n, node in nodes.items() if node.stored])
    waves = order(nodes, targets)
    run = _Run(house, log, nodes, dt)
    results: dict[str, StepResult] = {}
    failed: set[str] = set()
    stale = _stale(run, [n for wave in waves for n in wave])
    _share(run, stale)
    try:
        for wave in waves:
            todo = []
            for name in wave:
                node = nodes[name]
                broken = [i for i in node.inputs if i in failed]
                empty = [i for i, days in node.inputs.items() if i not in nodes and days == 1 and run.version(i, dt) is None]
                if broken or empty:
                    failed.add(name)
                    message = f"{', '.join(broken)} failed" if broken else f"no rows in {', '.join(empty)}"
                    results[name] = StepResult(node.layer, name, dt, False, 0, message)
                elif node.stored and name in stale:
                    todo.append(name)
                elif node.stored:
                    results[name] = StepResult(node.layer, name, dt, True, 0, "fresh")

            def step(name: str) -> StepResult:
                try:
                    return _build(run, name)
                except Exception as error:  # the caller sees the failure in the result
                    return StepResult(nodes[name].layer, name, dt, False, 0, str(error))

            if concurrent and len(todo) > 1:
                with ThreadPoolExecutor(max_workers=threads) as pool:
                    done = list(pool.map(step, todo))
            else:
                done = [step(name) for name in todo]
            results.update({r.table: r for r in done})
            failed.update(r.table for r in done if not r.ok)
    finally:
        for frame in run.shared.values():
            frame.unpersist()
    return [results[n] for wave in waves for n in wave if nodes[n].stored]


def _stale(run: _Run, names: Sequence[str]) -> set[str]:
    """Stored tables whose logged part is not the one that would be built now."""
    return {n for n in names if run.nodes[n].stored and run.log.version(n, run.dt) != run.wanted(n)}


def _share(run: _Run, stale: set[str]) -> None:
    """Extracts that several stale tables read are computed once."""
    readers: dict[str, int] = {}

    def count(name: str) -> None:
        for i in run.nodes[name].inputs:
            if i in run.nodes and not run.nodes[i].stored:
                readers[i] = readers.get(i, 0) + 1
                if readers[i] == 1:
                    count(i)

    for name in stale:
        count(name)
    for name, number in readers.items():
        missing = [i for i in run.nodes[name].inputs if i not in run.nodes and run.version(i, run.dt) is None]
        if number > 1 and not missing:
            run.shared[name] = run.make(name).persist(StorageLevel.DISK_ONLY)


def _build(run: _Run, name: str) -> StepResult:
    """Build one table for the day: compute once, gate, record the gate's result, write, log."""
    node, house = run.nodes[name], run.house
    frame = run.make(name)
    spec = run.spec(name)
    if not spec.schema.fields:
        columns = [f for f in frame.schema.fields if f.name != "dt"]
        spec = replace(spec, schema=T.StructType([T.StructField(f.name, f.dataType) for f in columns]).add("dt", "string"))
    frame = frame.select(*spec.schema.names).persist(StorageLevel.DISK_ONLY)
    try:
        limit = house.null_limit if node.null_limit is None else node.null_limit
        gate = quality_gate(frame, name, spec.keys, limit, (*spec.nullable_dates, *node.nullable_dates))
        result = gate.first()
        append_quality_result(house.spark.createDataFrame([result], gate.schema), house.specs[AUDIT_TABLE], run.dt)
        if not result.passed:
            return StepResult(node.layer, name, run.dt, False, result.total_rows, result.issues)
        logged_overwrite(run.log, frame, spec, run.dt, run.wanted(name), result.total_rows - result.duplicate_rows)
        return StepResult(node.layer, name, run.dt, True, result.total_rows)
    finally:
        frame.unpersist()


def _dated(df: DataFrame, dt: str) -> DataFrame:
    return df.withColumn("dt", F.lit(dt))


def _etl(df: DataFrame, house: Warehouse, dt: str) -> DataFrame:
    return add_etl_columns(df, f"batch_{dt}", house.loaded_at)


# Customer dimension, order fact and summary with surrogate keys.
CUSTOMER_PLAN = [
    Node("dwd_dim_customer", "dwd", {"ods_customer": 1},
         lambda house, dt, ods_customer: _etl(enrich.customer_dim(ods_customer), house, dt), ("customer_sk",)),
    Node("dwd_fact_order", "dwd", {"ods_order": 1, "dwd_dim_customer": 1},
         lambda house, dt, ods_order, dwd_dim_customer: _etl(enrich.order_fact(ods_order, dwd_dim_customer), house, dt), ("order_sk",)),
    Node("dws_customer_summary", "dws", {"dwd_fact_order": 1, "dwd_dim_customer": 1},
         lambda house, dt, dwd_fact_order, dwd_dim_customer: _etl(summary.customer_summary(dwd_fact_order, dwd_dim_customer, dt), house, dt),
         ("customer_id",)),
]
# Cleaned customers, enriched orders and their reports.
SEGMENT_PLAN = [
    Node("dwd_crm_customer", "dwd", {"crm_customers": 1}, lambda house, dt, crm_customers: clean.customer_clean(crm_customers), ("customer_id",)),
    Node("dwd_crm_order", "dwd", {"crm_orders": 1, "dwd_crm_customer": 1},
         lambda house, dt, crm_orders, dwd_crm_customer: enrich.order_enriched(crm_orders, dwd_crm_customer), ("order_id",)),
    Node("dws_segment_summary", "dws", {"dwd_crm_customer": 1},
         lambda house, dt, dwd_crm_customer: _dated(summary.segment_summary(dwd_crm_customer, dt), dt), ("age_group", "customer_status_desc")),
    Node("dws_order_stats", "dws", {"dwd_crm_order": 1},
         lambda house, dt, dwd_crm_order: _dated(summary.daily_order_stats(dwd_crm_order, dt), dt), ("order_date",), null_limit=1.0),
    Node("dws_customer_behavior", "dws", {"dwd_crm_order": 1, "dwd_crm_customer": 1},
         lambda house, dt, dwd_crm_order, dwd_crm_customer: _dated(summary.customer_behavior(dwd_crm_order, dwd_crm_customer, dt), dt),
         ("age_group", "order_size_category")),
]
# Daily extracts, their enrichment, and four statistics. Customers and products change on some days only.
SALES_PLAN = [
    Node("day_customers", "ods", {"customer_info": 1}, lambda house, dt, customer_info: enrich.daily_customers(customer_info, dt), stored=False),
    Node("day_orders", "ods", {"order_info": 1}, lambda house, dt, order_info: enrich.daily_orders(order_info, dt), stored=False),
    Node("day_products", "ods", {"product_info": 1}, lambda house, dt, product_info: enrich.daily_products(product_info, dt), stored=False),
    Node("dwd_tenure_customer", "dwd", {"day_customers": 1},
         lambda house, dt, day_customers: enrich.enrich_customers(day_customers, dt), ("customer_id",), null_limit=1.0),
    Node("dwd_margin_product", "dwd", {"day_products": 1},
         lambda house, dt, day_products: enrich.enrich_products(day_products, dt), ("product_id",), null_limit=1.0),
    Node("dwd_profit_order", "dwd", {"day_orders": 1, "day_customers": 1, "day_products": 1},
         lambda house, dt, day_orders, day_customers, day_products: enrich.enrich_orders(
             day_orders, day_customers.drop("dt"), day_products.drop("dt"), dt), null_limit=1.0),
    Node("dws_daily_sales", "dws", {"dwd_profit_order": 1},
         lambda house, dt, dwd_profit_order: _dated(summary.daily_sales(dwd_profit_order, dt), dt), ("report_date",), null_limit=1.0),
    Node("dws_customer_stats", "dws", {"dwd_profit_order": 1, "dwd_tenure_customer": 1},
         lambda house, dt, dwd_profit_order, dwd_tenure_customer: _dated(
             summary.customer_stats(dwd_profit_order, dwd_tenure_customer, dt), dt), ("customer_age_group", "state")),
    Node("dws_product_stats", "dws", {"dwd_profit_order": 1, "dwd_margin_product": 1},
         lambda house, dt, dwd_profit_order, dwd_margin_product: _dated(
             summary.product_stats(dwd_profit_order, dwd_margin_product, dt), dt), ("category", "brand", "price_category"), null_limit=1.0),
    Node("dws_monthly_trends", "dws", {"dwd_profit_order": HISTORY},
         lambda house, dt, dwd_profit_order: _dated(summary.monthly_trends(dwd_profit_order, dt), dt), ("order_year", "order_month"), null_limit=1.0),
]


def plan(*parts: Sequence[Node]) -> dict[str, Node]:
    """Nodes by name; two nodes of one name are an error."""
    nodes: dict[str, Node] = {}
    for node in [n for part in (parts or (CUSTOMER_PLAN, SEGMENT_PLAN, SALES_PLAN)) for n in part]:
        if node.name in nodes:
            raise ValueError(f"two tables are called {node.name}")
        nodes[node.name] = node
    return nodes


def land(house: Warehouse, name: str, rows: DataFrame) -> None:
    """Land raw rows with their ``dt`` in the ODS database, also of tables without a spec."""
    spec = house.specs.get(name)
    if spec is None:
        columns = [T.StructField(f.name, f.dataType) for f in rows.schema.fields if f.name != "dt"]
        spec = TableSpec(name, house.specs[LAYER_OF["ods"]].database, "ods", T.StructType(columns).add("dt", "string"), keys=())
    overwrite_partitions(rows, spec, fill_missing=True)
