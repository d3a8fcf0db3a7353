"""Exact quantiles, overlapping address ranges, row digests, time-split reads."""

import math
import random
import re
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from layerwell.functions.geo import BUCKET_BITS, ip_region, most_specific
from layerwell.operators.quality import column_profile, generic_quality, quality_report
from layerwell.operators.quantiles import exact_quantiles
from layerwell.sources.jdbc import increment_predicates


def test_exact_quantiles(spark):
    rng = random.Random(2)
    rows = [(rng.choice(["a", "b", None]), rng.choice([1, None]), rng.choice([rng.randrange(-5, 6), rng.randrange(-(10**12), 10**12)])) for _ in range(900)]
    rows += [("hot", 1, rng.randrange(1000)) for _ in range(2000)] + [("one", 1, 7), ("null", 1, None), ("a", 1, None)]
    asked = {"least": "0", "tenth": "0.1", "half": "0.5", "most": "0.9", "all": "1"}
    got = {(r.k, r.l): tuple(r[n] for n in asked) for r in exact_quantiles(spark.createDataFrame(rows, "k string, l int, v long"), ["k", "l"], "v", asked).collect()}
    groups = {}
    for k, l, v in rows:
        if v is not None:
            groups.setdefault((k, l), []).append(v)
    ranks = {"least": (0, 1), "tenth": (1, 10), "half": (1, 2), "most": (9, 10), "all": (1, 1)}
    want = {g: tuple(sorted(vs)[max(1, math.ceil(a * len(vs) / b)) - 1] for a, b in ranks.values()) for g, vs in groups.items()}
    assert got == want


@pytest.mark.parametrize("values", [[], [5], [5, 5, 5], [None, None], [-(2**40), 2**40]])
def test_quantiles_of_few_values(spark, values):
    got = exact_quantiles(spark.createDataFrame([("g", v) for v in values], "k string, v long"), ["k"], "v", {"half": "0.5"}).collect()
    kept = sorted(v for v in values if v is not None)
    assert [r.half for r in got] == ([kept[math.ceil(len(kept) / 2) - 1]] if kept else [])


def test_the_narrowest_range_wins(spark):
    rng, size = random.Random(3), 1 << BUCKET_BITS
    ranges = [(0, 5 * size - 1, "world"), (size, 2 * size - 1, "second"), (100, 100, "host"), (100, 100, "again"), (90, 120, None), (9, 3, "none")]
    for i in range(60):
        first = rng.randrange(4 * size)
        ranges.append((first, first + rng.choice([0, 5, 300, size, 2 * size]), f"r{i % 7}"))
    frame = spark.createDataFrame(ranges, "ip_from long, ip_to long, region string")
    flat = sorted(tuple(r) for r in most_specific(frame).collect())
    assert all(a[1] < b[0] for a, b in zip(flat, flat[1:])), "disjoint"
    asked = sorted({x + d for f, t, _ in ranges for x in (f, t) for d in (-1, 0, 1)} | {rng.randrange(7 * size) for _ in range(300)})
    asked = [a for a in asked if a >= 0]
    got = {r.ip: r.user_region for r in ip_region(spark.createDataFrame([(a,) for a in asked], "ip long"), most_specific(frame), "ip").collect()}
    assert len(got) == len(asked)
    for a in asked:
        holding = [(t - f, f, n is None, n or "", n) for f, t, n in ranges if f <= a <= t]
        assert got[a] == (min(holding)[4] if holding else None), a
    assert most_specific(frame.limit(0)).collect() == []


ODD = [("ab", "c", 0.0, 1), ("a", "bc", 0.0, 1), ("ab", "c", -0.0, 1), (None, "c", 0.0, None), ("N", "c", 0.0, None), ("", None, None, 1), (None, "", None, 1), ("1:a", "2:b", 1.5, 2)]


def test_rows_are_compared_by_digest(spark):
    frame = spark.createDataFrame([(*r, {"k": r[0] or "", "j": "x"}, datetime(2024, 1, 1)) for r in ODD + ODD[:1]], "a string, b string, c double, d int, e map<string,string>, load_time timestamp").repartition(3)
    got = {r.column_name: r for r in generic_quality(frame).collect()}
    assert {(r.total_records, r.unique_records, r.duplicate_records) for r in got.values()} == {(9, 7, 2)}  # 0.0 equals -0.0
    assert (got["a"].null_count, got["b"].null_count, got["c"].null_count, got["d"].null_count) == (2, 1, 2, 2)
    report = quality_report(frame, "t", datetime(2024, 1, 2)).first()
    assert (report.total_records, report.duplicate_count, report.hours_old) == (9, 2, 24)
    assert report.null_counts["a"] == 3 and report.null_counts["b"] == 2, "empty texts count as missing"
    for checked in (generic_quality(frame), quality_report(frame, "t", datetime(2024, 1, 2))):
        plan = checked._jdf.queryExecution().executedPlan().toString()
        for line in plan.splitlines():
            if "hashpartitioning" in line:
                assert "_row" in line and not re.search(r"\b[abde]#", line), line


def test_wide_tables_use_several_masks(spark):
    names = [f"c{i}" for i in range(130)]
    rows = [tuple(None if (i + j) % 9 == 0 else j for j in range(130)) for i in (0, 0, 1)]
    got = {r.column_name: r for r in generic_quality(spark.createDataFrame(rows, ", ".join(f"{n} int" for n in names))).collect()}
    assert len(got) == 130 and got["c0"].unique_records == 2
    assert all(got[f"c{j}"].null_count == sum(r[j] is None for r in rows) for j in range(130))


def test_profile_counts_equal_zeros_once(spark):
    frame = spark.createDataFrame([(0.0, 0.0), (-0.0, -0.0), (1.0, None)], "a double, b float")
    assert {r.column_name: r.distinct_count for r in column_profile(frame).collect()} == {"a": 2, "b": 2}


def test_time_ranges_have_no_gap_and_no_overlap():
    parts = increment_predicates("o.changed_at", "2024-02-28", "2024-03-01", 5)
    edges = [p.split("'")[1::2] for p in parts]
    assert len(parts) == 15 and edges[0][0] == "2024-02-28 00:00:00" and edges[-1][1] == "2024-03-02 00:00:00"
    assert all(a[1] == b[0] for a, b in zip(edges, edges[1:]))
    assert datetime.fromisoformat(edges[0][1]) - datetime.fromisoformat(edges[0][0]) == timedelta(hours=4, minutes=48)
    assert increment_predicates("d", "2024-01-01", "2024-01-01") == ["d >= TIMESTAMP '2024-01-01 00:00:00' AND d < TIMESTAMP '2024-01-02 00:00:00'"]
    for column, many in (("d; DROP", 1), ("d", 0)):
        with pytest.raises(ValueError):
            increment_predicates(column, "2024-01-01", "2024-01-01", many)
