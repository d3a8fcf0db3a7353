"""Data quality: profiles, row scores, the gate before a write, business rules.

A profile reads its input once for all columns. Duplicate and distinct counts
group first by the compared columns and then globally, so equal rows combine in
the map tasks and no single value collects in one place.
"""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerwell.functions.columns import E164_PATTERN, EMAIL_PATTERN, EMAIL_RULE_PATTERN
from layerwell.sinks.catalog import partitions
from layerwell.specs import TableSpec

# Thresholds and penalties.
CUSTOMER_GRADES = (0.8, 0.6)
ORDER_GRADES = (0.75, 0.5)
FIRST_VALID_DATE = "2020-01-01"
NULL_RATIO_LIMIT = 0.05
NULL_PENALTY = 30
DUPLICATE_PENALTY = 20
NULL_TEXTS = ("", "null")


class QualityError(Exception):
    """A frame failed the gate; nothing was written."""


def _text_columns(df: DataFrame) -> set[str]:
    return {f.name for f in df.schema.fields if isinstance(f.dataType, (T.StringType, T.VarcharType, T.CharType))}


def _empty(df: DataFrame, texts: tuple[str, ...]) -> dict[str, Column]:
    """Per column: is the cell null or, in text columns, one of the given texts."""
    text = _text_columns(df)
    return {
        name: (F.col(name).isNull() | F.col(name).isin(*texts)) if name in text and texts else F.col(name).isNull()
        for name in df.columns
    }


def _same_zero(df: DataFrame, name: str) -> Column:
    """The column, with 0.0 for -0.0: as numbers they are equal, as text they are not."""
    floating = isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType))
    return F.col(name) + F.lit(0.0).cast(df.schema[name].dataType) if floating else F.col(name)


MASK_BITS = 62


def row_digest(df: DataFrame) -> Column:
    """SHA-256 of a row: each cell's text with its length before it, null as ``N``, so no two rows read alike."""
    cells = []
    for f, col in zip(df.schema.fields, _group_cols(df)):
        if isinstance(f.dataType, T.BinaryType):
            text = F.hex(col)
        elif isinstance(f.dataType, (T.MapType, T.ArrayType, T.StructType)):
            text = F.to_json(F.struct(col))
        else:
            text = _same_zero(df, f.name).cast("string")
        cells.append(F.when(F.col(f.name).isNull(), F.lit("N")).otherwise(F.concat(F.length(text).cast("string"), F.lit(":"), text)))
    return F.unhex(F.sha2(F.concat(*cells), 256))


def _unique_rows(df: DataFrame, empty: dict[str, Column], **extra: Column) -> tuple[DataFrame, dict[str, Column]]:
    """One row per distinct row with ``_copies`` and the extra columns, and which of its cells are empty.

    Rows travel as 32 bytes of digest and one bit per column, not as themselves.
    """
    masks, flags = {}, {}
    for first in range(0, len(df.columns), MASK_BITS):
        bits = [F.when(empty[c], F.lit(1 << i)).otherwise(F.lit(0)).cast("long") for i, c in enumerate(df.columns[first : first + MASK_BITS])]
        masks[f"_mask{first}"] = reduce(Column.bitwiseOR, bits)
        flags |= {c: F.getbit(F.col(f"_mask{first}"), F.lit(i)) == 1 for i, c in enumerate(df.columns[first : first + MASK_BITS])}
    rows = df.select(row_digest(df).alias("_row"), *(m.alias(n) for n, m in masks.items()), *(x.alias(n) for n, x in extra.items()))
    return rows.groupBy("_row", *masks, *extra).agg(F.count("*").alias("_copies")), flags


def _as_rows(df: DataFrame, entries: list[Column]) -> DataFrame:
    """One row per struct of a list, from a one-row frame."""
    return df.select(F.inline(F.array(*entries)))


def _group_cols(df: DataFrame) -> list[Column]:
    """Columns to compare whole rows by; maps have no equality, so their sorted entries stand in."""
    out = []
    for f in df.schema.fields:
        col = F.col(f.name)
        out.append(F.array_sort(F.map_entries(col)).alias(f.name) if isinstance(f.dataType, T.MapType) else col)
    return out


def _percent(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part * F.lit(100.0), whole), F.lit(0.0))


def null_profile(df: DataFrame) -> DataFrame:
    """Row count and nulls per column; a partition passes if it has rows."""
    counts = [F.count_if(F.col(c).isNull()).alias(c) for c in df.columns]
    one = df.agg(F.count("*").alias("_rows"), *counts)
    return _as_rows(
        one,
        [
            F.struct(
                F.lit(c).alias("column_name"),
                F.col(c).alias("null_count"),
                F.col("_rows").alias("row_count"),
                (F.col("_rows") > 0).alias("passed"),
            )
            for c in df.columns
        ],
    )


def _scored(df: DataFrame, checks: dict[str, Column], grades: tuple[float, float], min_score: float) -> DataFrame:
    good, fair = grades
    flags = {f"dq_{name}_valid": F.coalesce(test, F.lit(False)) for name, test in checks.items()}
    flagged = df.withColumns(flags)
    passed = reduce(Column.__add__, [F.col(name).cast("int") for name in flags])
    score = F.col("dq_score")
    return (
        flagged.withColumn("dq_score", passed / F.lit(float(len(flags))))
        .withColumn("dq_status", F.when(score >= good, "GOOD").when(score >= fair, "FAIR").otherwise("POOR"))
        .where(score >= min_score)
    )


def score_customers(crm_customers: DataFrame, min_score: float = 0.6) -> DataFrame:
    """Five checks per customer, their share passed, a status; rows below the minimum are dropped."""
    c = F.col
    checks = {
        "customer_id": c("customer_id").isNotNull() & (c("customer_id").cast("string") != ""),
        "customer_name": F.length(F.trim("customer_name")) >= 2,
        "email": c("email").rlike(EMAIL_PATTERN),
        "phone": c("phone").rlike(E164_PATTERN),
        "age": c("age").between(0, 120),
    }
    return _scored(crm_customers, checks, CUSTOMER_GRADES, min_score)


def score_orders(crm_orders: DataFrame, as_of: str, min_score: float = 0.5) -> DataFrame:
    """Four checks per order; dates must lie between 2020 and the given day."""
    c = F.col
    first, last = F.lit(FIRST_VALID_DATE).cast("date"), F.lit(as_of).cast("date")
    checks = {
        "order_id": c("order_id").isNotNull(),
        "customer_id": c("customer_id").isNotNull(),
        "order_amount": c("order_amount") > 0,
        "order_date": c("order_date").between(first, last),
    }
    return _scored(crm_orders, checks, ORDER_GRADES, min_score)


def quality_rollup(scored: DataFrame) -> DataFrame:
    """Rows and mean score per status."""
    return scored.groupBy("dq_status").agg(F.count("*").alias("record_count"), F.avg("dq_score").alias("avg_score"))


def generic_quality(df: DataFrame) -> DataFrame:
    """Total, unique and duplicate rows, and nulls with percentage per column; rows are compared by their digests."""
    unique, is_null = _unique_rows(df, {c: F.col(c).isNull() for c in df.columns})
    copies = F.col("_copies")
    nulls = [F.sum(F.when(is_null[c], copies).otherwise(0)).alias(c) for c in df.columns]
    one = unique.agg(
        F.coalesce(F.sum(copies), F.lit(0)).alias("_total"),
        F.count("*").alias("_unique"),
        *nulls,
    )
    total = F.col("_total")
    return _as_rows(
        one,
        [
            F.struct(
                F.lit(c).alias("column_name"),
                F.coalesce(F.col(c), F.lit(0)).alias("null_count"),
                _percent(F.coalesce(F.col(c), F.lit(0)), total).alias("null_pct"),
                total.alias("total_records"),
                F.col("_unique").alias("unique_records"),
                (total - F.col("_unique")).alias("duplicate_records"),
            )
            for c in df.columns
        ],
    )


def quality_gate(
    df: DataFrame,
    name: str,
    keys: list[str] | tuple[str, ...],
    null_limit: float = NULL_RATIO_LIMIT,
    nullable_dates: tuple[str, ...] = (),
    by: str | None = None,
) -> DataFrame:
    """One row: null cells, duplicate keys, null dates, and whether the frame may be written.

    Cells count as null when null, empty or the text ``null``. Null cells are
    summed per row first, so only the keys and a few counters are shuffled. With
    ``by`` (a day column) there is one row per value, named ``check_date``, and keys
    are compared within it: a good day cannot make up for a bad one.
    """
    empty = _empty(df, NULL_TEXTS)
    dates = [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)) and f.name not in nullable_dates
    ]
    key_names = [f"_key{i}" for i in range(len(keys))]
    day = ["check_date"] if by else []
    rows = df.select(
        *([F.col(by).alias("check_date")] if by else []),
        *(F.col(k).alias(alias) for k, alias in zip(keys, key_names)),
        reduce(Column.__add__, [test.cast("bigint") for test in empty.values()]).alias("_null_cells"),
        *(F.col(d).isNull().cast("bigint").alias(d) for d in dates),
    )
    counters = [F.sum(c).alias(c) for c in ("_null_cells", *dates)]
    if keys:
        per_key = rows.groupBy(*day, *key_names).agg(F.count("*").alias("_rows"), *counters)
        one = per_key.groupBy(*day).agg(F.sum("_rows").alias("_rows"), F.count("*").alias("_distinct"), *counters)
    else:
        one = rows.groupBy(*day).agg(F.count("*").alias("_rows"), F.count("*").alias("_distinct"), *counters)

    zero = F.lit(0).cast("bigint")
    one = one.select(*day, *(F.coalesce(F.col(c), zero).alias(c) for c in one.columns if c not in day))
    total = F.col("_rows")
    duplicates = total - F.col("_distinct")
    cells = total * len(df.columns)
    null_ratio = F.coalesce(F.try_divide(F.col("_null_cells").cast("double"), cells.cast("double")), F.lit(0.0))
    duplicate_ratio = F.coalesce(F.try_divide(duplicates.cast("double"), total.cast("double")), F.lit(0.0))
    issues = F.array_compact(
        F.array(
            F.when(null_ratio > null_limit, "null ratio above limit"),
            F.when(duplicates > 0, F.concat(F.lit("duplicate rows: "), duplicates.cast("string"))),
            *(
                F.when(F.col(d) > 0, F.concat(F.lit(f"null dates in {d}: "), F.col(d).cast("string")))
                for d in dates
            ),
        )
    )
    return one.select(
        *day,
        F.lit(name).alias("table_name"),
        total.alias("total_rows"),
        F.col("_null_cells").alias("null_cells"),
        null_ratio.alias("null_ratio"),
        duplicates.alias("duplicate_rows"),
        duplicate_ratio.alias("duplicate_ratio"),
        (F.size(issues) == 0).alias("passed"),
        F.concat_ws(";", issues).alias("issues"),
    )


def require_quality(df: DataFrame, name: str, keys, **options) -> dict:
    """Run the gate; raise ``QualityError`` on failure, else return the gate's row."""
    result = quality_gate(df, name, keys, **options).first().asDict()
    if not result["passed"]:
        raise QualityError(f"{name}: {result['issues']}")
    return result


def range_profile(df: DataFrame) -> DataFrame:
    """Minimum, maximum and mean of every numeric column."""
    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    stats = []
    for c in numeric:
        stats += [F.min(c).alias(f"{c}_min"), F.max(c).alias(f"{c}_max"), F.avg(c).alias(f"{c}_avg")]
    one = df.agg(*stats)
    return _as_rows(
        one,
        [
            F.struct(
                F.lit(c).alias("column_name"),
                *(F.col(f"{c}_{s}").cast("double").alias(f"{s}_value") for s in ("min", "max", "avg")),
            )
            for c in numeric
        ],
    )


def column_profile(df: DataFrame, approximate: bool = False) -> DataFrame:
    """Nulls, distinct values, null percentage and uniqueness of every column.

    The exact form turns cells into (column, value) pairs and counts equal pairs
    before the shuffle. With ``approximate`` one pass without a shuffle of values
    estimates the distinct counts.
    """
    empty = _empty(df, ("",))
    if approximate:
        counts = []
        for c in df.columns:
            counts += [
                F.count_if(empty[c]).alias(f"{c}_nulls"),
                (F.approx_count_distinct(c) + F.max(F.col(c).isNull()).cast("int")).alias(f"{c}_distinct"),
            ]
        one = df.agg(F.count("*").alias("_rows"), *counts)
        profile = _as_rows(
            one,
            [
                F.struct(
                    F.lit(c).alias("column_name"),
                    F.col("_rows").alias("total_count"),
                    F.col(f"{c}_nulls").alias("null_count"),
                    F.col(f"{c}_distinct").alias("distinct_count"),
                )
                for c in df.columns
            ],
        )
    else:
        cells = df.select(
            F.inline(
                F.array(
                    *(
                        F.struct(F.lit(i).alias("_pos"), _same_zero(df, c).cast("string").alias("_value"))
                        for i, c in enumerate(df.columns)
                    )
                )
            )
        )
        pairs = cells.groupBy("_pos", "_value").agg(F.count("*").alias("_n"))
        is_text = F.array(*(F.lit(c in _text_columns(df)) for c in df.columns))
        blank = F.col("_value").isNull() | ((F.col("_value") == "") & F.element_at(is_text, F.col("_pos") + 1))
        names = F.array(*(F.lit(c) for c in df.columns))
        profile = (
            pairs.groupBy("_pos")
            .agg(
                F.sum("_n").alias("total_count"),
                F.sum(F.when(blank, F.col("_n")).otherwise(0)).alias("null_count"),
                F.count("*").alias("distinct_count"),
            )
            .select(F.element_at(names, F.col("_pos") + 1).alias("column_name"), "*")
            .drop("_pos")
        )
    total = F.col("total_count")
    return profile.withColumns(
        {
            "null_percentage": _percent(F.col("null_count"), total),
            "uniqueness_ratio": F.try_divide(F.col("distinct_count").cast("double"), total.cast("double")),
        }
    )


def quality_report(df: DataFrame, name: str, now: datetime) -> DataFrame:
    """One row per table: counts, null counts by column, duplicates, freshness, score of 0 to 100.

    Freshness comes from the first column whose name contains ``time`` or ``date``.
    """
    empty = _empty(df, NULL_TEXTS)
    dated = next((c for c in df.columns if "time" in c.lower() or "date" in c.lower()), None)
    unique, is_empty = _unique_rows(df, empty, **({"_dated": F.col(dated)} if dated else {}))
    copies = F.col("_copies")
    latest = F.max("_dated") if dated else F.lit(None)
    one = unique.agg(
        F.coalesce(F.sum(copies), F.lit(0)).alias("_total"),
        F.count("*").alias("_unique"),
        latest.try_cast("timestamp").alias("_latest"),
        *(F.coalesce(F.sum(F.when(is_empty[c], copies)), F.lit(0)).alias(f"{c}_nulls") for c in df.columns),
    )
    total = F.col("_total")
    duplicates = total - F.col("_unique")
    nulls = reduce(Column.__add__, [F.col(f"{c}_nulls") for c in df.columns])
    null_share = F.try_divide(nulls.cast("double"), (total * len(df.columns)).cast("double"))
    penalty = null_share * NULL_PENALTY + F.try_divide(duplicates.cast("double"), total.cast("double")) * (
        DUPLICATE_PENALTY
    )
    hours = F.floor((F.unix_timestamp(F.lit(now)) - F.unix_timestamp("_latest")) / 3600)
    counts = [part for c in df.columns for part in (F.lit(c), F.col(f"{c}_nulls"))]
    return one.select(
        F.lit(name).alias("table_name"),
        total.alias("total_records"),
        F.lit(len(df.columns)).alias("total_columns"),
        F.create_map(*counts).alias("null_counts"),
        duplicates.alias("duplicate_count"),
        F.col("_latest").alias("latest_timestamp"),
        hours.alias("hours_old"),
        F.coalesce(F.greatest(F.lit(0.0), F.lit(100.0) - penalty), F.lit(0.0)).alias("quality_score"),
    )


def _violations(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    one = df.agg(*(F.count_if(broken).alias(rule) for rule, broken in rules.items()))
    return _as_rows(
        one, [F.struct(F.lit(rule).alias("rule"), F.col(rule).alias("violations")) for rule in rules]
    )


def order_rules(df: DataFrame, today: str) -> DataFrame:
    """Amount and quantity must be positive, the order date not in the future."""
    return _violations(
        df,
        {
            "ORDER_001": F.col("total_amount") <= 0,
            "ORDER_002": F.col("quantity") <= 0,
            "ORDER_003": F.col("order_date") > F.lit(today).cast("date"),
        },
    )


def customer_rules(df: DataFrame) -> DataFrame:
    """Emails must be well formed (nulls pass), active customers need a phone."""
    return _violations(
        df,
        {
            "CUSTOMER_001": ~F.col("email").rlike(EMAIL_RULE_PATTERN),
            "CUSTOMER_002": (F.col("is_active") == 1) & F.col("phone").isNull(),
        },
    )


def product_rules(df: DataFrame) -> DataFrame:
    """Price must exceed cost and be positive."""
    return _violations(
        df, {"PRODUCT_001": F.col("price") <= F.col("cost"), "PRODUCT_002": F.col("price") <= 0}
    )


def is_fresh(spark: SparkSession, spec: TableSpec, dt: str) -> bool:
    """Is the newest load date with rows the expected one.

    One job; only the partition column is read, so data columns stay untouched.
    """
    newest = spark.table(spec.qualified).agg(F.max(spec.partition_by[0])).first()[0]
    return newest is not None and str(newest) == dt


# Tables each layer reads from the layer below.
UPSTREAM = {
    "dwd": ("ods_user_info", "ods_order_info", "ods_product_info"),
    "dws": ("dwd_user_info", "dwd_order_info", "dwd_product_info"),
    "ads": ("dws_user_subject", "dws_product_subject", "dws_region_subject"),
}


def layer_ready(spark: SparkSession, layer: str, dt: str, specs: dict[str, TableSpec], tables=None) -> DataFrame:
    """Rows of the day in each table the layer needs; a missing table counts as not ready.

    A layer without tables below it has nothing to wait for and gives no rows.
    """
    counts = [spark.createDataFrame([], "table_name string, row_count bigint, ready boolean")]
    for name in tables or UPSTREAM.get(layer, ()):
        spec = specs[name]
        if spark.catalog.tableExists(spec.qualified):
            rows = spark.table(spec.qualified).where(F.col("dt") == dt).agg(F.count("*").alias("row_count"))
        else:
            rows = spark.range(1).select(F.lit(0).cast("bigint").alias("row_count"))
        counts.append(rows.select(F.lit(name).alias("table_name"), "row_count", (F.col("row_count") > 0).alias("ready")))
    return reduce(DataFrame.unionByName, counts)


def layer_counts(tables: dict[str, DataFrame], dt: str) -> DataFrame:
    """Row count of one day for each table, over all layers."""
    parts = [
        df.where(F.col("dt") == dt).agg(F.count("*").alias("row_count")).select(F.lit(n).alias("table_name"), "row_count")
        for n, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def key_issues(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows with a null key column, and number of key values that occur more than once."""
    per_key = df.groupBy(*keys).agg(F.count("*").alias("_rows"))
    any_null = reduce(Column.__or__, [F.col(k).isNull() for k in keys])
    one = per_key.agg(
        F.coalesce(F.sum(F.when(any_null, F.col("_rows"))), F.lit(0)).alias("_nulls"),
        F.count_if(F.col("_rows") > 1).alias("_repeated"),
    )
    return _as_rows(
        one,
        [
            F.struct(F.lit("NULL_KEYS").alias("issue"), F.col("_nulls").alias("issue_count")),
            F.struct(F.lit("DUPLICATE_KEYS").alias("issue"), F.col("_repeated").alias("issue_count")),
        ],
    )


def table_stats(spark: SparkSession, spec: TableSpec, dt: str) -> DataFrame:
    """Rows, distinct keys, first and last write time of a table's day."""
    written = F.col(spec.time_column) if spec.time_column else F.lit(None).cast("timestamp")
    per_key = (
        spark.table(spec.qualified)
        .where(F.col("dt") == dt)
        .groupBy(*spec.keys)
        .agg(F.count("*").alias("_rows"), F.min(written).alias("_first"), F.max(written).alias("_last"))
    )
    return per_key.agg(
        F.lit(spec.name).alias("table_name"),
        F.lit(dt).alias("partition_date"),
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("total_records"),
        F.count("*").alias("unique_keys"),
        F.min("_first").alias("min_create_time"),
        F.max("_last").alias("max_create_time"),
    )
