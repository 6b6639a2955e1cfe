from __future__ import annotations

from datetime import datetime

import pytest
from hypothesis import HealthCheck, given
from hypothesis import settings as budget
from hypothesis import strategies as st

from cartflow.operators.dedup import first_per_key, last_per_key
from cartflow.operators.upsert import upsert
from cartflow.plans import staging

SCHEMA = "k string, a int, b int"


def as_dict(rows):
    return {r["k"]: (r["a"], r["b"]) for r in rows.collect()}


def test_frozen_columns_keep_their_first_value(spark):
    old = spark.createDataFrame([("x", 1, 1), ("gone", 5, 5), ("frozen null", None, 1)], SCHEMA)
    new = spark.createDataFrame([("x", 2, 2), ("fresh", 3, 3), ("frozen null", 9, 9)], SCHEMA)
    found = as_dict(upsert(old, new, "k", ["b"]))
    assert found == {"x": (1, 2), "gone": (5, 5), "fresh": (3, 3), "frozen null": (None, 9)}


def test_null_overwrites(spark):
    old = spark.createDataFrame([("x", 1, 1)], SCHEMA)
    new = spark.createDataFrame([("x", None, None)], SCHEMA)
    assert as_dict(upsert(old, new, "k")) == {"x": (None, None)}


def test_without_old_rows(spark):
    new = spark.createDataFrame([("x", 1, 2)], SCHEMA)
    assert as_dict(upsert(None, new, "k")) == {"x": (1, 2)}


ROWS = st.dictionaries(st.sampled_from("abcdef"), st.tuples(st.none() | st.integers(0, 9), st.none() | st.integers(0, 9)))


@budget(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(before=ROWS, after=ROWS)
def test_any_two_runs(spark, before, after):
    old = spark.createDataFrame([(k, *v) for k, v in before.items()], SCHEMA)
    new = spark.createDataFrame([(k, *v) for k, v in after.items()], SCHEMA)
    expected = {**before, **{k: (before[k][0] if k in before else a, b) for k, (a, b) in after.items()}}
    assert as_dict(upsert(old, new, "k", ["b"])) == expected


@budget(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(st.tuples(st.sampled_from("abc"), st.integers(0, 50), st.integers(0, 3)), min_size=1))
def test_first_and_last_per_key(spark, rows):
    frame = spark.createDataFrame(rows, SCHEMA)
    first = {r["k"]: (r["a"], r["b"], r["load_copies"]) for r in first_per_key(frame, ["k"], ["a", "b"]).collect()}
    last = as_dict(last_per_key(frame, ["k"], ["a", "b"]))
    for key in {k for k, _, _ in rows}:
        group = sorted((a, b) for k, a, b in rows if k == key)
        assert first[key] == (*group[0], len(group))
        assert last[key] == group[-1]
    assert len(first) == len(last) == len({k for k, _, _ in rows})


def raw(spark, orders, items=(), reviews=(), payments=(), sellers=(("s", "c", "SP"),), customers=(("c", "x", "SP"),)):
    return {
        "orders": spark.createDataFrame(
            list(orders),
            "order_id string, customer_id string, order_status string, order_purchase_timestamp timestamp_ntz, "
            "order_approved_at timestamp_ntz, order_delivered_customer_date timestamp_ntz, "
            "order_estimated_delivery_date timestamp_ntz",
        ),
        "order_items": spark.createDataFrame(
            [(o, n, p, s, None if price is None else price) for o, n, p, s, price in items],
            "order_id string, order_item_id int, product_id string, seller_id string, price string",
        ).selectExpr("order_id", "order_item_id", "product_id", "seller_id", "cast(price as decimal(10,2)) price"),
        "order_reviews": spark.createDataFrame(list(reviews), "review_id string, order_id string, review_score smallint"),
        "order_payments": spark.createDataFrame(
            list(payments), "order_id string, payment_sequential int, payment_value string"
        ).selectExpr("order_id", "payment_sequential", "cast(payment_value as decimal(10,2)) payment_value"),
        "sellers": spark.createDataFrame(list(sellers), "seller_id string, seller_city string, seller_state string"),
        "customers": spark.createDataFrame(
            list(customers), "customer_id string, customer_city string, customer_state string"
        ),
        "products": spark.createDataFrame(
            [("p", "toys"), ("q", None)], "product_id string, product_category_name string"
        ),
        "category_translation": spark.createDataFrame(
            [("toys", "Toys")], "product_category_name string, product_category_name_english string"
        ),
    }


def at(day, hour=0):
    return datetime(2018, 1, day, hour)


def order(key, delivered, estimated, customer="c", bought=at(1)):
    return (key, customer, "done", bought, None, delivered, estimated)


def test_on_time_rate_counts_items_and_reviews_and_may_exceed_hundred(spark):
    tables = raw(
        spark,
        [order("o", at(2), at(3)), order("late", at(5), at(3))],
        items=[("o", 1, "p", "s", "10.00"), ("o", 2, "p", "s", "1.00"), ("late", 1, "q", "s", "5.00")],
        reviews=[("r1", "o", 5), ("r2", "o", 0), ("r3", "o", None)],
    )
    row = staging.seller_performance(tables).first()
    # 2 items x 3 reviews on time over 2 orders; scores outside 1..5 count here.
    assert float(row["on_time_rate"]) == 300.0
    assert float(row["total_revenue"]) == 38.0
    assert float(row["avg_review_score"]) == 2.5
    assert row["total_orders"] == 2
    grain = staging.seller_performance_order_grain(tables).first()
    assert (float(grain["on_time_rate"]), float(grain["total_revenue"])) == (50.0, 16.0)


def test_sellers_without_items_and_items_without_order_drop_out(spark):
    tables = raw(
        spark,
        [order("o", at(2), at(3))],
        items=[("o", 1, "p", "s", "10.00"), ("none", 1, "p", "t", "1.00"), ("o", 2, "p", None, "1.00")],
        sellers=[("s", "c", "SP"), ("t", "c", "SP"), ("idle", "c", "SP")],
    )
    assert [r["seller_id"] for r in staging.seller_performance(tables).collect()] == ["s"]


@pytest.mark.parametrize(
    ("delivered", "estimated", "late", "days"),
    [
        (at(3, 12), at(3), True, 0),
        (at(3), at(3, 12), False, 0),
        (at(3), at(3), False, 0),
        (at(5, 1), at(3), True, 2),
        (None, at(3), False, None),
        (at(3), None, False, None),
    ],
)
def test_delay(spark, delivered, estimated, late, days):
    row = staging.orders_enriched(raw(spark, [order("o", delivered, estimated)])).first()
    assert (row["is_delayed"], row["delay_days"]) == (late, days)


def test_orders_enriched_rules(spark):
    tables = raw(
        spark,
        [order("a", at(2), at(3)), order("b", at(2), at(3), customer="unknown"), order("c", at(2), at(3), customer=None)],
        reviews=[("1", "a", 1), ("2", "a", 2), ("3", "a", 2), ("4", "a", 7), ("5", "b", 9)],
        payments=[("a", 1, "0.10"), ("a", 2, "0.20")],
    )
    rows = {r["order_id"]: r for r in staging.orders_enriched(tables).collect()}
    assert set(rows) == {"a", "b"}
    assert (float(rows["a"]["total_payment"]), float(rows["a"]["avg_review_score"])) == (0.3, 1.67)
    assert rows["a"]["customer_state"] == "SP"
    b = rows["b"]
    assert (float(b["total_payment"]), b["item_count"], b["avg_review_score"], b["customer_state"]) == (0.0, 0, None, None)


def test_product_revenue_rules(spark):
    tables = raw(
        spark,
        [],
        items=[("o1", 1, "p", "s", "0.01"), ("o1", 2, "p", "s", "0.02"), ("o2", 1, "p", "s", None), ("o2", 2, "q", "s", None)],
    )
    rows = {r["product_id"]: r for r in staging.product_revenue(tables).collect()}
    assert rows["p"]["product_category_name_english"] == "Toys"
    assert (rows["p"]["total_orders"], float(rows["p"]["total_revenue"]), float(rows["p"]["avg_price"])) == (2, 0.03, 0.02)
    assert rows["q"]["product_category_name_english"] == "unknown"
    assert (rows["q"]["total_revenue"], rows["q"]["avg_price"]) == (None, None)
