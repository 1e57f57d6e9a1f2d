"""Band limits, flags and NULL paths of the silver tables."""

import datetime as dt
from decimal import Decimal

import pytest

from tallyhouse.plans import silver

AS_OF = dt.date(2001, 8, 1)
CUSTOMER = ("customer_id bigint, email string, first_name string, last_name string, state string, phone string, "
            "registration_date date, last_purchase_date date")


def customer(spark, **fields):
    base = dict(customer_id=1, email="a@b.com", first_name="x", last_name="y", state="ca", phone=None,
                registration_date=AS_OF, last_purchase_date=AS_OF)
    base.update(fields)
    return silver.customers(spark.createDataFrame([tuple(base.values())], CUSTOMER), AS_OF).first()


@pytest.mark.parametrize("days, label", [(89, "New"), (90, "Established"), (364, "Established"), (365, "Loyal"),
                                         (729, "Loyal"), (730, "VIP"), (-1, "New")])
def test_tenure(spark, days, label):
    assert customer(spark, registration_date=AS_OF - dt.timedelta(days=days)).tenure_category == label


@pytest.mark.parametrize("days, label", [(29, "Active"), (30, "Recent"), (89, "Recent"), (90, "Lapsed"), (179, "Lapsed"), (180, "Dormant")])
def test_recency(spark, days, label):
    assert customer(spark, last_purchase_date=AS_OF - dt.timedelta(days=days)).recency_category == label


def test_missing_dates_fall_to_the_last_band(spark):
    row = customer(spark, registration_date=None, last_purchase_date=None)
    assert (row.tenure_category, row.recency_category) == ("VIP", "Dormant")


@pytest.mark.parametrize("phone, want", [("(555) 123-4567", "15551234567"), ("+1 555 123 4567", "15551234567"), ("555", None),
                                         (None, None), ("123456789012", None), ("", None)])
def test_phone(spark, phone, want):
    assert customer(spark, phone=phone).phone == want


@pytest.mark.parametrize("email, state, score", [(" A.B@X.ORG ", " tx ", 100.0), ("bad", "tx", 50.0), ("a@b.c", "zz", 0.0), (None, "tx", None)])
def test_quality_score(spark, email, state, score):
    row = customer(spark, email=email, state=state)
    assert row.dq_score == score
    if email:
        assert row.email == email.strip().lower() and row.state == state.strip().upper()


def test_names_are_capitalised(spark):
    row = customer(spark, first_name="  anna MARIA ", last_name="o'NEIL")
    assert (row.first_name, row.last_name) == ("Anna Maria", "O'neil")


TX = ("transaction_id bigint, customer_id bigint, store_id int, transaction_date date, transaction_timestamp timestamp_ntz, "
      "transaction_type string, payment_method string, channel string, num_items int, year_month string")
LINES = "transaction_id bigint, product_id bigint, quantity int, unit_price decimal(10,2), discount_percent decimal(5,2), line_total decimal(12,2)"


def transaction(spark, lines, day=dt.date(2001, 7, 30), hour=10, num_items=1):
    head = spark.createDataFrame(
        [(1, 1, 1, day, dt.datetime(day.year, day.month, day.day, hour), "purchase", "cash", "online", num_items, "2001-07")], TX)
    items = spark.createDataFrame([(1, 5, 1, Decimal("1.00"), Decimal(d), Decimal(t)) for t, d in lines], LINES)
    return silver.transactions(head, silver.sales_lines(items, head)).first()


@pytest.mark.parametrize("amount, bucket", [("24.99", "Small (<$25)"), ("25.00", "Medium ($25-$100)"), ("99.99", "Medium ($25-$100)"),
                                            ("100.00", "Large ($100-$500)"), ("499.99", "Large ($100-$500)"), ("500.00", "XLarge ($500+)")])
def test_amount_bucket(spark, amount, bucket):
    assert transaction(spark, [(amount, "0")]).amount_bucket == bucket


@pytest.mark.parametrize("hour, part", [(5, "Night"), (6, "Morning"), (11, "Morning"), (12, "Afternoon"), (17, "Afternoon"),
                                        (18, "Evening"), (21, "Evening"), (22, "Night")])
def test_time_of_day(spark, hour, part):
    assert transaction(spark, [("1.00", "0")], hour=hour).time_of_day == part


@pytest.mark.parametrize("day, dow, weekend", [(dt.date(2001, 7, 28), 7, True), (dt.date(2001, 7, 29), 1, True), (dt.date(2001, 7, 30), 2, False)])
def test_weekend(spark, day, dow, weekend):
    row = transaction(spark, [("1.00", "0")], day=day)
    assert (row.transaction_day_of_week, row.is_weekend) == (dow, weekend)


def test_transaction_without_lines_has_null_flags(spark):
    row = transaction(spark, [])
    assert row.transaction_amount == 0 and row.dq_valid_amount is False
    assert row.dq_has_items is None and row.dq_consistent_items is None


def test_negative_total_and_discounts(spark):
    row = transaction(spark, [("-5.00", "10"), ("2.00", "5")], num_items=2)
    assert row.transaction_amount == Decimal("-3.00") and row.dq_valid_amount is False and row.dq_consistent_items is True
    assert row.calculated_avg_discount == 7.5 and row.calculated_max_discount == Decimal("10.00")
    assert row.amount_bucket == "Small (<$25)"


def product(spark, price="10.00", cost="4.00", totals=()):
    head = spark.createDataFrame([(1, Decimal(price), Decimal(cost))], "product_id bigint, base_price decimal(10,2), cost_price decimal(10,2)")
    items = spark.createDataFrame([(i, 1, 2, Decimal("1.00"), Decimal("0"), Decimal(t)) for i, t in enumerate(totals)], LINES)
    return silver.products(head, silver.sales_lines(items, spark.createDataFrame([], TX))).first()


@pytest.mark.parametrize("revenue, tier", [("99999.99", "Gold"), ("100000", "Platinum"), ("49999.99", "Silver"), ("50000", "Gold"),
                                           ("9999.99", "Bronze"), ("10000", "Silver"), ("0.01", "Bronze"), ("0", "New"), ("-1", "New")])
def test_revenue_tier(spark, revenue, tier):
    assert product(spark, totals=[revenue]).revenue_tier == tier


@pytest.mark.parametrize("price, tier", [("500", "Premium"), ("499.99", "Mid-Range"), ("100", "Mid-Range"), ("99.99", "Value"), ("25", "Value"), ("24.99", "Budget")])
def test_price_tier(spark, price, tier):
    assert product(spark, price=price).price_tier == tier


def test_unsold_product(spark):
    row = product(spark)
    assert (row.times_sold, row.units_sold, row.total_revenue, row.unique_transactions) == (0, 0, 0, 0)
    assert row.revenue_per_transaction == 0 and row.avg_units_per_transaction == 0 and row.avg_selling_price is None


@pytest.mark.parametrize("price, cost, margin", [("8.00", "2.41", Decimal("69.88")), ("0.00", "1.00", None), ("0.01", "100.00", None)])
def test_margin_rounds_half_up_and_overflow_is_null(spark, price, cost, margin):
    assert product(spark, price=price, cost=cost).profit_margin == margin
