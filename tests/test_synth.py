from __future__ import annotations

from starmart.operators.synth import CATEGORIES, STATES, mock_orders


def test_values_and_types(spark):
    df = mock_orders(spark.range(500))
    assert dict(df.dtypes) == {
        "order_id": "string",
        "customer_id": "string",
        "product_id": "string",
        "category": "string",
        "price": "double",
        "delivery_days": "int",
        "review_score": "int",
        "year": "int",
        "month": "int",
        "customer_state": "string",
    }
    rows = df.orderBy("order_id").collect()
    assert rows[0]["order_id"] == "order_00000" and rows[-1]["order_id"] == "order_00499"
    assert {r["customer_id"] for r in rows} == {f"customer_{i:04d}" for i in range(100)}
    assert {r["product_id"] for r in rows} == {f"product_{i:03d}" for i in range(50)}
    assert all(20 <= r["price"] <= 500 for r in rows)
    assert {r["category"] for r in rows} == set(CATEGORIES)
    assert {r["customer_state"] for r in rows} == set(STATES)
    assert {r["delivery_days"] for r in rows} == set(range(1, 31))
    assert {r["review_score"] for r in rows} == {1, 2, 3, 4, 5}
    assert {r["month"] for r in rows} == set(range(1, 13)) and {r["year"] for r in rows} == {2018}


def test_same_rows_for_any_partitioning_and_other_rows_for_another_seed(spark):
    one = sorted(map(tuple, mock_orders(spark.range(0, 1000, 1, 1)).collect()))
    many = sorted(map(tuple, mock_orders(spark.range(0, 1000, 1, 9)).collect()))
    assert one == many
    assert one != sorted(map(tuple, mock_orders(spark.range(1000), seed=2).collect()))


def test_large_ids(spark):
    rows = mock_orders(spark.range(5_000_000_000, 5_000_000_010)).collect()
    assert len({r["order_id"] for r in rows}) == 10
