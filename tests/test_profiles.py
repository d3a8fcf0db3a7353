"""Stored day profiles, merged over ranges, against exact counts."""

import bisect
import random

from pyspark.sql import functions as F

from layerwell.operators.profiles import DISTINCT_ERROR, RANK_ERROR, day_profiles, profile_range, store_profiles

SCHEMA = "dt string, id long, price double, name string, tags map<string,string>, empty int, flag boolean"


def rows(seed=3, n=6000):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        dt = "2024-01-01" if rng.random() < 0.4 else f"2024-01-{rng.randrange(2, 9):02d}"
        out.append((dt, rng.randrange(3000), rng.choice([None, 0.0, -0.0, rng.gauss(0, 50)]), f"n{rng.randrange(40)}", {"b": "1", "a": str(i % 3)}, None, None if i % 5 else True))
    return out


def test_ranges_are_unions_of_days(spark, tmp_path):
    data, path = rows(), str(tmp_path / "profiles")
    frame = spark.createDataFrame(data, SCHEMA).repartition(4)
    store_profiles(frame, path)
    for first, last in (("2024-01-01", "2024-01-08"), ("2024-01-03", "2024-01-05"), ("2024-01-01", "2024-01-01")):
        kept = [r for r in data if first <= r[0] <= last]
        got = {r.column_name: r for r in profile_range(spark, path, first, last).collect()}
        assert set(got) == {"id", "price", "name", "tags", "empty", "flag"}
        for i, name in enumerate(["id", "price", "name", "tags", "empty", "flag"], 1):
            values = [r[i] for r in kept if r[i] is not None]
            r = got[name]
            assert (r.row_count, r.null_count) == (len(kept), len(kept) - len(values))
            distinct = len({str(sorted(v.items())) if isinstance(v, dict) else v for v in values})
            assert abs(r.distinct_estimate - distinct) <= max(1, DISTINCT_ERROR * distinct), name
            if name in ("id", "price"):
                assert (r.low, r.high) == (min(values), max(values))
                values.sort()
                for share, q in zip((0.5, 0.9), r.quantiles):
                    ranks = bisect.bisect_left(values, q) / len(values), bisect.bisect_right(values, q) / len(values)
                    assert ranks[0] - RANK_ERROR <= share <= ranks[1] + RANK_ERROR
            else:
                assert r.quantiles is None


def test_a_day_is_replaced_and_others_stay(spark, tmp_path):
    path = str(tmp_path / "profiles")
    frame = spark.createDataFrame(rows(), SCHEMA)
    store_profiles(frame, path)
    rest = lambda: profile_range(spark, path, "2024-01-02", "2024-01-09").drop("quantiles").orderBy("column_name").collect()
    before = rest()
    store_profiles(frame.where("dt = '2024-01-01'").limit(7), path)
    assert {r.row_count for r in profile_range(spark, path, "2024-01-01", "2024-01-01").collect()} == {7}
    assert rest() == before, "quantile sketches merge at random, all else does not"
    assert profile_range(spark, path, "2025-01-01", "2025-01-09").collect() == []


def test_sketches_are_made_in_one_pass(spark):
    plan = day_profiles(spark.createDataFrame(rows(n=50), SCHEMA))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Expand" not in plan
    assert day_profiles(spark.createDataFrame([], SCHEMA)).collect() == []
