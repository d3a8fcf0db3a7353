"""Explicit schema, partitioning and keys of every warehouse table."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import types as T

_TYPE_NAMES = {"bigint": "long", "int": "integer"}


def schema_of(columns: str) -> T.StructType:
    """Schema from ``name type`` pairs separated by commas; every column is nullable."""
    schema = T.StructType()
    for column in columns.replace("\n", " ").split(", "):
        name, kind = column.split()
        schema.add(name, _TYPE_NAMES.get(kind, kind), True)
    return schema


@dataclass(frozen=True)
class TableSpec:
    """A layer table: schema (partition columns last), partition and key columns."""

    name: str
    database: str
    layer: str
    schema: T.StructType = field(repr=False)
    keys: tuple[str, ...]
    business_keys: tuple[str, ...] = ()
    partition_by: tuple[str, ...] = ("dt",)
    # Date columns that may be null; the quality gate checks the other ones.
    nullable_dates: tuple[str, ...] = ()
    # Column holding the write time, used by table statistics.
    time_column: str | None = None

    @property
    def qualified(self) -> str:
        return f"{self.database}.{self.name}"

    @property
    def data_columns(self) -> list[str]:
        return [c for c in self.schema.names if c not in self.partition_by]

    def in_database(self, database: str) -> TableSpec:
        return replace(self, database=database)


_ETL = "etl_create_time timestamp, etl_update_time timestamp, etl_batch_id string"
_DWD = "dwd_create_time timestamp, dwd_update_time timestamp"
_GOODS = "product_name string, category_id bigint, category_name string, brand_id bigint, brand_name string"


def _window_columns(counts: str, quantity: str, amount: str) -> str:
    parts = []
    for window in ("1d", "7d", "30d"):
        parts += [f"{c}_count_{window} bigint" for c in counts.split()]
        parts += [
            f"{quantity}_{window} bigint",
            f"{amount}_{window} decimal(15,2)",
            f"avg_order_amount_{window} decimal(10,2)",
        ]
    return ", ".join(parts)


_SPECS = [
    TableSpec(
        "ods_customer", "ods_db", "ods",
        schema_of(
            "customer_id bigint, customer_code string, customer_name string, customer_type string, "
            "registration_date date, status string, phone string, email string, address string, "
            "create_time timestamp, update_time timestamp, dt string"
        ),
        keys=("customer_id",), business_keys=("customer_code",), nullable_dates=("create_time", "update_time"),
    ),
    TableSpec(
        "ods_order", "ods_db", "ods",
        schema_of(
            "order_id bigint, order_no string, customer_id bigint, order_date date, order_amount decimal(15,2), "
            "currency string, order_status string, payment_method string, create_time timestamp, "
            "update_time timestamp, dt string"
        ),
        keys=("order_id",), business_keys=("order_no",), nullable_dates=("create_time", "update_time"),
    ),
    TableSpec(
        "ods_user_info", "ods_db", "ods",
        schema_of(
            "user_id bigint, username string, email string, phone string, gender string, age int, city string, "
            "province string, registration_time string, last_login_time string, user_status string, dt string"
        ),
        keys=("user_id",),
    ),
    TableSpec(
        "ods_order_info", "ods_db", "ods",
        schema_of(
            f"order_id string, user_id bigint, product_id string, {_GOODS}, order_time string, pay_time string, "
            "finish_time string, order_status string, payment_method string, quantity int, "
            "unit_price decimal(10,2), total_amount decimal(12,2), discount_amount decimal(12,2), "
            "final_amount decimal(12,2), province string, city string, dt string"
        ),
        keys=("order_id",),
    ),
    TableSpec(
        "ods_product_info", "ods_db", "ods",
        schema_of(
            f"product_id string, {_GOODS}, price decimal(10,2), cost decimal(10,2), weight decimal(8,2), "
            "dimensions string, description string, product_status string, dt string"
        ),
        keys=("product_id",),
    ),
    TableSpec(
        "dwd_dim_customer", "dwd_db", "dwd",
        schema_of(
            "customer_sk bigint, customer_id bigint, customer_code string, customer_name string, "
            "customer_type string, registration_date date, status string, phone string, email string, "
            "address string, effective_date date, expiry_date date, is_current int, data_source string, "
            f"{_ETL}, dt string"
        ),
        keys=("customer_sk",), business_keys=("customer_id",), time_column="etl_update_time",
    ),
    TableSpec(
        "dwd_fact_order", "dwd_db", "dwd",
        schema_of(
            "order_sk bigint, order_id bigint, order_no string, customer_sk bigint, customer_id bigint, "
            "order_date date, order_amount decimal(15,2), order_amount_usd decimal(15,2), currency string, "
            f"order_status string, payment_method string, {_ETL}, dt string"
        ),
        keys=("order_sk",), business_keys=("order_id",), time_column="etl_update_time",
    ),
    TableSpec(
        "dwd_user_info", "dwd_db", "dwd",
        schema_of(
            "user_id bigint, username string, email string, phone string, gender string, age int, city string, "
            "province string, registration_time timestamp, last_login_time timestamp, user_status string, "
            f"version int, is_active boolean, {_DWD}, dt string"
        ),
        keys=("user_id",), nullable_dates=("registration_time", "last_login_time"), time_column="dwd_update_time",
    ),
    TableSpec(
        "dwd_order_info", "dwd_db", "dwd",
        schema_of(
            f"order_id string, user_id bigint, product_id string, {_GOODS}, order_time timestamp, "
            "pay_time timestamp, finish_time timestamp, order_status string, payment_method string, quantity int, "
            "unit_price decimal(10,2), total_amount decimal(10,2), discount_amount decimal(10,2), "
            f"final_amount decimal(10,2), province string, city string, {_DWD}, dt string"
        ),
        keys=("order_id",), nullable_dates=("pay_time", "finish_time"), time_column="dwd_update_time",
    ),
    TableSpec(
        "dwd_product_info", "dwd_db", "dwd",
        schema_of(
            f"product_id string, {_GOODS}, price decimal(10,2), cost decimal(10,2), weight decimal(8,2), "
            f"dimensions string, description string, product_status string, {_DWD}, dt string"
        ),
        keys=("product_id",), time_column="dwd_update_time",
    ),
    TableSpec(
        "dws_customer_summary", "dws_db", "dws",
        schema_of(
            "customer_id bigint, customer_name string, customer_type string, total_orders bigint, "
            "total_amount_usd decimal(15,2), avg_order_amount decimal(15,2), last_order_date date, "
            f"first_order_date date, stat_date string, customer_level string, {_ETL}, dt string"
        ),
        keys=("customer_id", "stat_date"), business_keys=("customer_id",), time_column="etl_update_time",
    ),
    TableSpec(
        "dws_user_subject", "dws_db", "dws",
        schema_of(
            "user_id bigint, username string, email string, phone string, gender string, age int, city string, "
            "province string, registration_time timestamp, last_login_time timestamp, user_status string, "
            f"{_window_columns('order product', 'quantity', 'order_amount')}, first_order_time_30d timestamp, "
            "last_order_time_30d timestamp, prefer_category_name string, prefer_brand_name string, "
            "prefer_payment_method string, frequency_label string, value_label string, activity_score bigint, "
            "dws_create_time timestamp, dt string"
        ),
        keys=("user_id",),
        nullable_dates=("registration_time", "last_login_time", "first_order_time_30d", "last_order_time_30d"),
        time_column="dws_create_time",
    ),
    TableSpec(
        "dws_product_subject", "dws_db", "dws",
        schema_of(
            f"product_id string, {_GOODS}, price decimal(10,2), cost decimal(10,2), weight decimal(8,2), "
            f"product_status string, {_window_columns('order user', 'sales_quantity', 'sales_amount')}, "
            "first_sale_time_30d timestamp, last_sale_time_30d timestamp, sales_level string, "
            "revenue_level string, popularity_score double, profit_margin decimal(5,2), "
            "dws_create_time timestamp, dt string"
        ),
        keys=("product_id",), nullable_dates=("first_sale_time_30d", "last_sale_time_30d"),
        time_column="dws_create_time",
    ),
    TableSpec(
        "dws_region_subject", "dws_db", "dws",
        schema_of(
            f"province string, city string, "
            f"{_window_columns('order user product', 'sales_quantity', 'sales_amount')}, "
            "first_order_time_30d timestamp, last_order_time_30d timestamp, total_user_count bigint, "
            "active_user_count bigint, new_user_count bigint, region_tier string, "
            "user_activity_rate decimal(5,2), new_user_rate decimal(5,2), avg_user_consumption decimal(10,2), "
            "dws_create_time timestamp, dt string"
        ),
        keys=("province", "city"), nullable_dates=("first_order_time_30d", "last_order_time_30d"),
        time_column="dws_create_time",
    ),
    TableSpec(
        "data_quality_check_result", "dws_db", "audit",
        schema_of(
            "table_name string, total_rows bigint, null_cells bigint, null_ratio double, duplicate_rows bigint, "
            "duplicate_ratio double, passed boolean, issues string, check_date string"
        ),
        keys=(), partition_by=("check_date",),
    ),
]

# Databases of the layers.
LAYER_DATABASES = ("raw_db", "ods_db", "dwd_db", "dws_db", "dm_db")


def warehouse_specs(prefix: str = "") -> dict[str, TableSpec]:
    """All table specs by name; a prefix on the database names keeps warehouses apart."""
    return {spec.name: spec.in_database(prefix + spec.database) for spec in _SPECS}


def layer_databases(prefix: str = "") -> list[str]:
    return [prefix + name for name in LAYER_DATABASES]
