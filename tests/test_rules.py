"""Rules on tiny hand-made frames: nulls, blanks, boundary values, malformed text, ties."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from layerwell.functions import age_years, clean_phone, ip_number, ip_region
from layerwell.operators import clean, enrich, quality, summary, wide
from layerwell.operators.shape import add_surrogate_key
from layerwell.sinks.external import export_kv, flatten_window, sample_rows

D = "2024-02-14"
USER = (
    "user_id long, username string, email string, phone string, gender string, age int, city string, province string, "
    "registration_time string, last_login_time string, user_status string, dt string"
)
ORDER = (
    "order_id string, user_id long, product_id string, product_name string, category_id long, category_name string, "
    "brand_id long, brand_name string, order_time string, pay_time string, finish_time string, order_status string, "
    "payment_method string, quantity int, unit_price decimal(10,2), total_amount decimal(12,2), "
    "discount_amount decimal(12,2), final_amount decimal(12,2), province string, city string, dt string"
)
DWD = (
    "order_id string, user_id long, product_id string, category_name string, brand_name string, payment_method string, "
    "order_time timestamp, order_status string, quantity int, final_amount decimal(10,2), province string, city string, dt string"
)


def user(**over):
    row = dict(
        user_id=1, username="a", email="a@b.co", phone="13812345678", gender="m", age=30, city="c", province="p",
        registration_time="2024-01-01 00:00:00", last_login_time="2024-01-01 00:00:00", user_status="1", dt=D,
    )
    return tuple({**row, **over}.values())


def order(**over):
    row = dict(
        order_id="o", user_id=1, product_id="p", product_name="n", category_id=1, category_name="c", brand_id=1,
        brand_name="b", order_time="2024-02-14 10:00:00", pay_time=None, finish_time="bad", order_status="4",
        payment_method="alipay", quantity=1, unit_price=Decimal("1"), total_amount=Decimal("1"),
        discount_amount=Decimal("0"), final_amount=Decimal("1"), province="p", city="c", dt=D,
    )
    return tuple({**row, **over}.values())


def detail(**over):
    row = dict(
        order_id="o", user_id=1, product_id="p", category_name="c", brand_name="b", payment_method="cash",
        order_time=datetime(2024, 2, 14, 10), order_status="completed", quantity=1, final_amount=Decimal("1.00"),
        province="P", city="C", dt=D,
    )
    return tuple({**row, **over}.values())


def test_user_cleaning(spark):
    rows = [
        user(username="  ", email="x", phone="1281", gender="FeMale", age=-1, city=None, registration_time="bad", user_status="Active"),
        user(username=None, email=None, phone=None, gender=None, age=121, province=" ", user_status=None),
        user(username=" bob ", gender="male", age=0, user_status="inactive"),
        user(age=120, gender="?", user_status="9"),
    ]
    got = clean.clean_users(spark.createDataFrame(rows, USER)).collect()
    assert [r.username for r in got] == ["unknown_user", "unknown_user", "bob", "a"]
    assert [r.email for r in got] == [None, None, "a@b.co", "a@b.co"]
    assert [r.phone for r in got] == [None, None, "13812345678", "13812345678"]
    assert [r.gender for r in got] == ["F", "U", "M", "U"]
    assert [r.age for r in got] == [None, None, 0, 120]
    assert (got[0].city, got[1].province, got[0].registration_time) == ("unknown", "unknown", None)
    assert [r.user_status for r in got] == ["active", "unknown", "inactive", "unknown"]


def test_user_cleaning_stamps_times(spark):
    at = datetime(2024, 2, 15)
    row = clean.clean_users(spark.createDataFrame([user()], USER), at).first()
    assert row.dwd_create_time == row.dwd_update_time == at


def test_order_cleaning(spark):
    rows = [
        order(order_status="1", payment_method="WeChat", quantity=0, final_amount=Decimal("-1"), product_name=" "),
        order(order_status="9", payment_method="card", quantity=None, total_amount=None, brand_name=None, city=""),
        order(order_id=None), order(user_id=None), order(product_id=None),
    ]
    got = clean.clean_orders(spark.createDataFrame(rows, ORDER)).collect()
    assert len(got) == 2
    assert [r.order_status for r in got] == ["created", "unknown"]
    assert [r.payment_method for r in got] == ["wechat", "other"]
    assert [r.quantity for r in got] == [0, 0]
    assert (got[0].final_amount, got[1].total_amount) == (Decimal("0.00"), Decimal("0.00"))
    assert (got[0].product_name, got[1].brand_name, got[1].city) == ("unknown_product", "unknown_brand", "unknown")
    assert got[0].finish_time is None


@pytest.mark.parametrize(
    "age, label",
    [(17, "Minor"), (18, "Young Adult"), (35, "Young Adult"), (36, "Middle Age"), (50, "Middle Age"), (51, "Senior"), (None, "Senior")],
)
def test_age_bands(spark, age, label):
    schema = (
        "customer_id long, customer_name string, age int, email string, phone string, address string, city string, "
        "state string, customer_status string, registration_date date, last_login_date date, dt string"
    )
    row = (1, "n", age, None, None, None, None, None, "A", None, None, D)
    assert clean.customer_clean(spark.createDataFrame([row], schema)).first().age_group == label


@pytest.mark.parametrize(
    "amount, label", [("99.99", "Small"), ("100", "Medium"), ("500", "Medium"), ("500.01", "Large"), ("1000", "Large"), ("1000.01", "XLarge")]
)
def test_size_bands(spark, amount, label):
    orders = spark.createDataFrame(
        [(1, 1, date(2024, 2, 11), Decimal(amount), "F", "card", D)],
        "order_id long, customer_id long, order_date date, order_amount decimal(15,2), order_status string, "
        "payment_method string, dt string",
    )
    people = spark.createDataFrame(
        [(1, "2024-02-13", "old", "Senior"), (1, D, "new", "Minor")],
        "customer_id long, dt string, customer_name string, age_group string",
    )
    rows = enrich.order_enriched(orders, people).collect()
    assert [(r.order_size_category, r.customer_name, r.order_day_of_week) for r in rows] == [(label, "new", 1)]


def test_usd_rounds_half_up_once(spark):
    orders = spark.createDataFrame(
        [(1, "n", 5, date(2024, 1, 1), Decimal("0.07"), "CNY", "F", "c", D), (2, "n", None, date(2024, 1, 1), Decimal("3.50"), "USD", "F", "c", D)],
        "order_id long, order_no string, customer_id long, order_date date, order_amount decimal(15,2), currency string, "
        "order_status string, payment_method string, dt string",
    )
    dim = spark.createDataFrame([(5, D, 55)], "customer_id long, dt string, customer_sk long")
    got = {r.order_id: (r.order_amount_usd, r.customer_sk) for r in enrich.order_fact(orders, dim).collect()}
    assert got == {1: (Decimal("0.01"), 55), 2: (Decimal("3.50"), None)}


def test_margin_of_zero_price_is_null(spark):
    df = spark.createDataFrame([(Decimal("0.00"), Decimal("1.00")), (Decimal("200.00"), Decimal("50.00"))], "price decimal(10,2), cost decimal(10,2)")
    got = enrich.enrich_products(df, D).collect()
    assert [(r.profit_margin, r.price_category) for r in got] == [(None, "Low"), (Decimal("75.00"), "High")]


def test_user_wide_windows_and_labels(spark):
    users = clean.clean_users(spark.createDataFrame([user(), user(user_id=2)], USER))
    orders = spark.createDataFrame(
        [
            detail(order_id="a", final_amount=Decimal("50.00")),
            detail(order_id="a", product_id="q", final_amount=Decimal("49.99")),
            detail(order_id="b", dt="2024-02-08", order_time=datetime(2024, 2, 8)),
            detail(order_id="c", dt="2024-02-07", order_time=datetime(2024, 2, 7)),
            detail(order_id="d", dt="2024-01-16", order_time=datetime(2024, 1, 16)),
            detail(order_id="e", dt="2024-01-15"),
            detail(order_id="f", order_status="paid"),
        ],
        DWD,
    )
    got = {r.user_id: r for r in wide.user_wide(users, orders, D).collect()}
    one, none = got[1], got[2]
    assert (one.order_count_1d, one.order_count_7d, one.order_count_30d) == (1, 2, 4)
    assert (one.product_count_1d, one.product_count_30d) == (2, 2)
    assert one.order_amount_30d == Decimal("102.99") and one.avg_order_amount_1d == Decimal("50.00")
    assert one.first_order_time_30d == datetime(2024, 1, 16) and one.last_order_time_30d == datetime(2024, 2, 14, 10)
    assert (one.frequency_label, one.value_label, one.activity_score) == ("medium_frequency", "low_value", 54)
    assert (none.order_count_30d, none.order_amount_30d, none.frequency_label) == (0, Decimal("0.00"), "inactive")
    assert (none.value_label, none.activity_score, none.first_order_time_30d) == ("no_purchase", 0, None)


def test_order_on_several_days_counts_once_per_window(spark):
    orders = spark.createDataFrame([detail(), detail(dt="2024-02-10"), detail(dt="2024-01-20")], DWD)
    row = wide.region_wide(orders, D).first()
    assert (row.order_count_1d, row.order_count_7d, row.order_count_30d) == (1, 1, 1)
    assert (row.sales_quantity_1d, row.sales_quantity_7d, row.sales_quantity_30d) == (1, 2, 3)


def test_preference_tie_goes_to_smallest_names(spark):
    rows = [detail(order_id=str(i), category_name=c, brand_name=b) for i, (c, b) in enumerate([("z", "a"), ("y", "b"), ("y", "a")])]
    row = wide.user_preference(spark.createDataFrame(rows, DWD), D).first()
    assert (row.prefer_category_name, row.prefer_brand_name) == ("y", "a")


@pytest.mark.parametrize("amount, tier", [("100000", "tier_1"), ("50000", "tier_2"), ("10000", "tier_3"), ("1000", "tier_4"), ("999.99", "tier_5")])
def test_region_tiers(spark, amount, tier):
    df = spark.createDataFrame([detail(final_amount=Decimal(amount), city=None)], DWD)
    row = wide.region_wide(df, D).first()
    assert (row.region_tier, row.city, row.new_user_rate) == (tier, "Unknown", Decimal("100.00"))


def test_region_active_users_need_five_rows(spark):
    rows = [detail(user_id=1)] * 5 + [detail(user_id=2)] * 4
    row = wide.region_users(spark.createDataFrame(rows, DWD), D).first()
    assert (row.total_user_count, row.active_user_count, row.new_user_count) == (2, 1, 2)


def test_user_lifetime_keeps_users_without_orders(spark):
    users = spark.createDataFrame([(1, "f", "l", "e", "M", None, D), (2, "f", "l", "e", "F", None, D)], "user_id long, first_name string, last_name string, email string, gender string, registration_date date, dt string")
    orders = spark.createDataFrame([("o", 1, datetime(2024, 1, 1), Decimal("2.00"), D), ("x", 1, datetime(2024, 3, 1), Decimal("9.00"), "2024-03-01")], "order_id string, user_id long, order_ts timestamp, order_amount decimal(18,2), dt string")
    got = {r.user_id: (r.total_lifetime_spend, r.total_lifetime_orders) for r in summary.user_lifetime(users, orders, D).collect()}
    assert got == {1: (Decimal("2.00"), 1), 2: (None, 0)}


@pytest.mark.parametrize(
    "birth, as_of, age",
    [("2000-02-29", "2023-02-28", 22), ("2000-02-29", "2023-03-01", 23), ("2000-05-05", "2020-05-05", 20), ("bad", "2020-01-01", None), (None, "2020-01-01", None)],
)
def test_age_years(spark, birth, as_of, age):
    df = spark.createDataFrame([(birth,)], "b string")
    assert df.select(age_years(F.col("b"), F.lit(as_of).cast("date")).alias("a")).first().a == age


def test_phone_and_ip(spark):
    df = spark.createDataFrame([("+86 (1) 2-3", "1.2.3.4"), (None, "1.2.3"), ("", "1.2.3.256"), ("x", None), ("9", "a.b.c.d")], "p string, ip string")
    got = df.select(clean_phone(F.col("p")).alias("p"), ip_number(F.col("ip")).alias("n")).collect()
    assert [r.p for r in got] == ["86123", None, "", "", "9"]
    assert [r.n for r in got] == [16909060, None, None, None, None]


def test_ip_ranges_meet_inside_a_bucket(spark):
    ranges = spark.createDataFrame([(0, 99, "a"), (100, 200_000, "b")], "ip_from long, ip_to long, region string")
    events = spark.createDataFrame([(n,) for n in (0, 99, 100, 65536, 200_000, 200_001)] + [(None,)], "ip_num long")
    got = {r.ip_num: r.user_region for r in ip_region(events, ranges).collect()}
    assert got == {0: "a", 99: "a", 100: "b", 65536: "b", 200_000: "b", 200_001: None, None: None}


def test_surrogate_key_is_the_same_in_any_layout(spark):
    df = spark.range(1000)
    a = {r.id: r.sk for r in add_surrogate_key(df, ["id"], "sk").collect()}
    b = {r.id: r.sk for r in add_surrogate_key(df.repartition(7), ["id"], "sk").collect()}
    assert a == b and len(set(a.values())) == 1000


def test_customer_scores_at_the_limits(spark):
    schema = "customer_id long, customer_name string, email string, phone string, age int"
    rows = [
        (1, "ab", "a@b.co", "+123", 120), (2, "x", "a@b.co", "123", 30), (3, "x", "bad", "123", 30),
        (4, "x", "bad", "0123", 30), (None, None, None, None, None),
    ]
    got = {r.customer_id: (r.dq_score, r.dq_status) for r in quality.score_customers(spark.createDataFrame(rows, schema)).collect()}
    assert got == {1: (1.0, "GOOD"), 2: (0.8, "GOOD"), 3: (0.6, "FAIR")}


def test_order_scores(spark):
    schema = "order_id long, customer_id long, order_amount decimal(15,2), order_date date"
    rows = [(1, 1, Decimal("1"), date(2020, 1, 1)), (2, None, Decimal("0"), date(2024, 2, 14)), (3, None, Decimal("0"), date(2024, 2, 15))]
    got = {r.order_id: r.dq_status for r in quality.score_orders(spark.createDataFrame(rows, schema), D).collect()}
    assert got == {1: "GOOD", 2: "FAIR"}


def test_gate_reports_each_issue(spark):
    df = spark.createDataFrame([(1, "", None), (1, "null", None), (2, "x", date(2024, 1, 1))], "k int, t string, d date")
    row = quality.quality_gate(df, "t", ["k"]).first()
    assert not row.passed and (row.total_rows, row.null_cells, row.duplicate_rows) == (3, 4, 1)
    assert row.issues == "null ratio above limit;duplicate rows: 1;null dates in d: 2"
    assert quality.quality_gate(df.where("k = 2"), "t", ["k"]).first().passed
    with pytest.raises(quality.QualityError):
        quality.require_quality(df, "t", ["k"])


def test_profiles_of_an_empty_frame(spark):
    df = spark.createDataFrame([], "a int, b string, seen_time timestamp")
    assert not quality.null_profile(df).first().passed
    assert quality.quality_gate(df, "t", ["a"]).first().total_rows == 0
    assert quality.generic_quality(df).first().total_records == 0
    assert quality.quality_report(df, "t", datetime(2024, 1, 1)).first().quality_score == 0.0


def test_report_counts_duplicates_and_age(spark):
    at = datetime(2024, 1, 1, 12)
    df = spark.createDataFrame([(1, "null", at), (1, "null", at), (2, "x", at)], "a int, b string, seen_time timestamp")
    row = quality.quality_report(df, "t", datetime(2024, 1, 2, 13, 30)).first()
    assert (row.duplicate_count, row.hours_old, row.null_counts) == (1, 25, {"a": 0, "b": 2, "seen_time": 0})
    assert row.quality_score == pytest.approx(100 - 30 * 2 / 9 - 20 / 3)


def test_column_profile_counts_null_as_a_value(spark):
    df = spark.createDataFrame([(1, ""), (None, "x"), (1, None)], "a int, b string")
    exact = {r.column_name: (r.null_count, r.distinct_count) for r in quality.column_profile(df).collect()}
    assert exact == {"a": (1, 2), "b": (2, 3)}
    rough = {r.column_name: (r.null_count, r.distinct_count) for r in quality.column_profile(df, approximate=True).collect()}
    assert rough == exact


def test_maps_can_be_compared(spark):
    df = spark.createDataFrame([({"a": "1", "b": "2"},), ({"b": "2", "a": "1"},)], "m map<string,string>")
    assert quality.generic_quality(df).first().duplicate_records == 1


def test_sample_is_stable_and_near_its_share(spark):
    df = spark.range(20_000)
    first = {r.id for r in sample_rows(df, ["id"]).collect()}
    assert first == {r.id for r in sample_rows(df.repartition(5), ["id"]).collect()}
    assert 1700 < len(first) < 2300


def test_export_opens_one_client_per_partition(spark, tmp_path):
    folder = str(tmp_path)

    def put_all(pairs):
        import uuid

        with open(f"{folder}/{uuid.uuid4().hex}", "w") as out:
            out.writelines(f"{k}={v}\n" for k, v in pairs)

    export_kv(spark.range(10, numPartitions=3).selectExpr("id", "id * 2 AS v"), put_all)
    files = list(tmp_path.iterdir())
    assert len(files) == 3
    assert sorted(line for f in files for line in f.read_text().split()) == sorted(f"{i}={2 * i}" for i in range(10))


def test_window_struct_is_flattened(spark):
    df = spark.sql("SELECT named_struct('start', 1, 'end', 2) AS w, 3 AS n")
    assert flatten_window(df).columns == ["w_start", "w_end", "n"]


def test_cleaning_twice_changes_nothing(spark):
    orders = spark.createDataFrame([order(product_name=" x ", quantity=-1, city=" ")], ORDER)
    once = clean.clean_orders(orders)
    again = clean.clean_orders(
        once.withColumns(
            {
                **{c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ("order_time", "pay_time", "finish_time")},
                "order_status": F.lit("4"),
            }
        )
    )
    assert once.collect() == again.collect()


def test_times_are_parsed_as_by_the_formatter_but_well_formed_ones_are_cast(spark):
    """the formatter was called for every cell."""
    from layerwell.functions.columns import TIMESTAMP_FORMAT, parse_time

    texts = [
        "2024-02-14 10:00:00", "2024-02-30 10:00:00", "2023-02-29 00:00:00", "2024-02-29 23:59:59", "2024-02-14 24:00:00", "2024-02-14 23:59:60",
        "0000-01-01 00:00:00", "0001-01-01 00:00:00", "9999-12-31 23:59:59", "1582-10-10 00:00:00", "2024-13-01 00:00:00", "2024-00-10 00:00:00",
        "bad-ts", "", None, " 2024-02-14 10:00:00", "2024-02-14 10:00:00 ", "2024-02-14 10:00:00\n", "2024-02-14T10:00:00", "2024-2-4 1:00:00",
        "2024-02-14 10:00:00.5", "12024-02-14 10:00:00", "-2024-02-14 10:00:00", "2024-02-14", "\u0662024-02-14 10:00:00",
    ]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    seen = frame.select("t", parse_time(F.col("t")).cast("string").alias("a"), F.try_to_timestamp("t", F.lit(TIMESTAMP_FORMAT)).cast("string").alias("b"))
    assert [r for r in seen.collect() if r.a != r.b] == []
    plan = frame.select(parse_time(F.col("t")))._jdf.queryExecution().analyzed().toString()
    assert "cast(t" in plan


def test_texts_without_the_marks_of_a_time_do_not_reach_the_formatter(spark):
    """the formatter raised and caught an error for each of them."""
    from layerwell.functions.columns import TIMESTAMP_FORMAT, parse_time

    texts = ["bad-ts", "", None, "::--", "-- ::", "1-1-1 1:1:1", "+12024-02-14 10:00:00", "2024-02-14 10:00", "20240214 10:00:00", "2024-02-14  10:00:00"]
    frame = spark.createDataFrame([(t,) for t in texts], "t string").repartition(1)
    both = frame.select(parse_time(F.col("t")).cast("string").alias("a"), F.try_to_timestamp("t", F.lit(TIMESTAMP_FORMAT)).cast("string").alias("b"))
    assert [r for r in both.collect() if r.a != r.b] == []
    assert "LIKE %-%-% %:%:%" in frame.select(parse_time(F.col("t")))._jdf.queryExecution().analyzed().toString()
