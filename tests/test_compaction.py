"""Compaction by bytes: the plan, the files read, and swaps that were cut off."""

import json
import random
import uuid

import pytest
from pyspark.sql import functions as F

from layerwell.sinks import catalog, compaction
from layerwell.sinks.compaction import PLAN_FILE, compact_planned, finish_compaction, plan_bins
from layerwell.sinks.tables import overwrite_partition
from layerwell.specs import layer_databases, warehouse_specs

D, OTHER = "2024-02-14", "2024-02-13"


def test_plan_fits_and_leaves_large_and_lone_files():
    rng = random.Random(1)
    sizes = {f"f{i}": rng.choice([1, 7, 30, 60, 99, 100, 250]) for i in range(200)}
    bins = plan_bins(sizes, 100)
    placed = [n for b in bins for n in b]
    assert len(placed) == len(set(placed)) and all(sizes[n] < 100 for n in placed)
    assert all(len(b) > 1 and sum(sizes[n] for n in b) <= 100 for b in bins)
    small = sum(s for s in sizes.values() if s < 100)
    assert len(bins) + sum(s < 100 for n, s in sizes.items() if n not in placed) <= 1.3 * small / 100 + 1
    assert plan_bins({"a": 60, "b": 60, "c": 100, "d": 500}, 100) == [] and plan_bins({}, 100) == []


@pytest.fixture()
def table(spark, tmp_path):
    prefix = f"c{uuid.uuid4().hex[:8]}_"
    catalog.create_databases(spark, layer_databases(prefix), str(tmp_path / "db"))
    spec = warehouse_specs(prefix)["ods_customer"]
    for dt, n in ((D, 3000), (OTHER, 10)):
        rows = spark.range(n).select(F.col("id").alias("customer_id"), F.uuid().alias("address"), F.lit(dt).alias("dt"))
        # One file with most rows, many with few.
        part = F.when(F.col("customer_id") < n // 2, 0).otherwise(F.col("customer_id") % 11 + 1)
        overwrite_partition(rows.repartitionByRange(12, part), spec, dt, fill_missing=True)
    return spec


def content(spark, spec):
    spark.catalog.refreshTable(spec.qualified)
    return sorted(tuple(r) for r in spark.table(spec.qualified).select("dt", "customer_id", "address").collect())


def test_only_small_files_are_read(spark, table):
    folder = compaction._folder(spark, table, D)
    before, sizes = content(spark, table), folder.sizes()
    target = max(sizes.values())
    done = compact_planned(spark, table, D, target)
    after = folder.sizes()
    assert content(spark, table) == before
    assert done.files_before == len(sizes) and done.files_after == len(after) < len(sizes)
    assert done.files_read == len(sizes) - 1, "the large file is not read"
    large = max(sizes, key=sizes.get)
    assert after[large] == sizes[large] and done.bytes_after == sum(after.values())
    again = compact_planned(spark, table, D, min(after.values()))
    assert again.files_read == 0 and content(spark, table) == before


def test_footers_do_not_fill_bins(spark, table):
    folder = compaction._folder(spark, table, OTHER)
    before, sizes = content(spark, table), folder.sizes()
    rows = {name: size - folder.footer_bytes(name, size) for name, size in sizes.items()}
    target = 2 * min(sizes.values()) - 1
    assert len(sizes) > 2 and all(0 < n < sizes[name] / 2 for name, n in rows.items()), "mostly footers, no two files fit with theirs"
    done = compact_planned(spark, table, OTHER, target)
    assert done.files_after < done.files_before and content(spark, table) == before
    assert max(folder.sizes().values()) <= target


@pytest.mark.parametrize("steps", [0, 1, 3])
def test_a_swap_that_was_cut_off_is_completed(spark, table, monkeypatch, steps):
    folder = compaction._folder(spark, table, D)
    before = content(spark, table)

    def cut(folder, plan):
        for name in plan["add"][:steps]:
            folder.system.rename(folder.at(f"_{name}"), folder.at(name))
        if steps > 1:
            folder.system.delete(folder.at(plan["remove"][0]), False)
        raise RuntimeError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(compaction, "_swap", cut)
        with pytest.raises(RuntimeError, match="lost"):
            compact_planned(spark, table, D, 1 << 20)
    assert json.loads(folder.read(spark, PLAN_FILE))["remove"]
    assert finish_compaction(spark, table, D) and not finish_compaction(spark, table, D)
    assert content(spark, table) == before and len(folder.sizes()) == 1


def test_a_copy_that_differs_replaces_nothing(spark, table, monkeypatch):
    before, files = content(spark, table), compaction._folder(spark, table, D).sizes()
    monkeypatch.setattr(compaction, "plan_bins", lambda sizes, target: [sorted(sizes)[:2], sorted(sizes)[:1]])
    with pytest.raises(RuntimeError, match="differs"):
        compact_planned(spark, table, D)
    assert content(spark, table) == before and compaction._folder(spark, table, D).sizes() == files
