"""Small source rows for the table tests."""

from decimal import Decimal

from layerwell.specs import warehouse_specs

D = "2024-02-14"
SPECS = warehouse_specs()


def _frame(spark, table, rows):
    schema = SPECS[table].schema
    return spark.createDataFrame([tuple(r[c] for c in schema.names) for r in rows], schema)


def user_rows(spark, dt=D):
    base = dict(
        username="a", email="a@b.co", phone="13812345678", gender="M", age=30, city="c", province="p",
        registration_time="2024-01-01 00:00:00", last_login_time="2024-01-01 00:00:00", user_status="1", dt=dt,
    )
    return _frame(spark, "ods_user_info", [{**base, "user_id": i} for i in (1, 2)])


def product_rows(spark, dt=D):
    base = dict(
        product_name="n", category_id=1, category_name="c", brand_id=1, brand_name="b", price=Decimal("10.00"),
        cost=Decimal("4.00"), weight=Decimal("1.00"), dimensions="1x1", description="d", product_status="1", dt=dt,
    )
    return _frame(spark, "ods_product_info", [{**base, "product_id": p} for p in ("p", "q")])


def dwd_ready_orders(spark, dt=D):
    base = dict(
        product_name="n", category_id=1, category_name="c", brand_id=1, brand_name="b", order_time=f"{dt} 10:00:00",
        pay_time=None, finish_time=None, order_status="4", payment_method="cash", quantity=1,
        unit_price=Decimal("10.00"), discount_amount=Decimal("0.00"), province="p", city="c", dt=dt,
    )
    rows = [("1", 1, "p", "10.00"), ("2", 1, "q", "20.00"), ("3", 2, "p", "5.00")]
    return _frame(
        spark,
        "ods_order_info",
        [
            {**base, "order_id": f"{dt}-{o}", "user_id": u, "product_id": p, "total_amount": Decimal(a), "final_amount": Decimal(a)}
            for o, u, p, a in rows
        ],
    )
