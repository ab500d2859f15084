"""Cleaned tables against plain Python over random dirty rows."""

from __future__ import annotations

import math
import random
from collections import Counter
from datetime import datetime
from decimal import ROUND_HALF_UP, Decimal

import pytest

from starmart.plans import silver
from starmart.sources.schemas import RAW_COLUMNS

MARK = datetime(2018, 2, 1)


def ddl(table):
    return ", ".join(f"{name} {kind}" for name, kind in RAW_COLUMNS[table].items())


def dirty(seed, makers, n=400):
    """Rows from value makers; about a third of them occur again as exact copies."""
    draw = random.Random(seed)
    rows = [tuple(make(draw) for make in makers) for _ in range(n)]
    return rows + draw.choices(rows, k=n // 3)


def pick(*values):
    return lambda draw: draw.choice(values)


def stamp(draw):
    kind = draw.random()
    if kind < 0.1:
        return None
    if kind < 0.2:
        return draw.choice(["n/a", "", "2018-13-45"])
    day = f"2018-0{draw.randint(1, 3)}-{draw.randint(1, 28):02d}"
    return day if kind < 0.4 else f"{day} {draw.randint(0, 23):02d}:{draw.randint(0, 59):02d}:07"


def parsed(text):
    for form in ("%Y-%m-%d %H:%M:%S", "%Y-%m-%d"):
        try:
            return datetime.strptime(text or "", form)
        except ValueError:
            continue
    return None


def half_up(value, places):
    return float(Decimal(repr(value)).quantize(Decimal(1).scaleb(-places), ROUND_HALF_UP))


def bag(df):
    return Counter(tuple(r) for r in df.collect())


def test_orders(spark):
    rows = dirty(
        1,
        [
            pick(None, "a", "b", "c", "d"),
            pick(None, "x", "y"),
            pick(None, "shipped", "delivered"),
            *[stamp] * 5,
        ],
    )
    expected = set()
    for key, customer, status, *texts in rows:
        bought, approved, carrier, delivered, estimate = map(parsed, texts)
        if key is None or customer is None or status is None or not bought or bought <= MARK:
            continue
        days = (delivered.date() - bought.date()).days if delivered else None
        if days is not None and days < 0:
            continue
        late = int(bool(delivered and estimate and delivered > estimate))
        stamps = (bought, approved, carrier, delivered, estimate)
        parts = (bought.year, bought.month, (bought.month + 2) // 3, bought.day)
        expected.add((key, customer, status, *stamps, *parts, days, late))
    got = bag(silver.orders(spark.createDataFrame(rows, ddl("orders")), MARK))
    assert got == Counter(expected) and len(expected) > 20


def test_reviews(spark):
    rows = dirty(
        2,
        [
            pick(None, "r1", "r2", "r3"),
            pick(None, "o1", "o2"),
            pick(None, 0, 1, 2, 3, 4, 5, 6),
            pick(None, "title"),
            pick(None, "", "   ", ' say "hi"\nbye '),
            stamp,
            stamp,
        ],
    )
    expected = set()
    for key, order, score, title, message, created, answered in rows:
        at = parsed(created)
        if key is None or order is None or score is None or not 1 <= score <= 5:
            continue
        if at is None or at <= MARK:
            continue
        mood = "positive" if score >= 4 else "neutral" if score == 3 else "negative"
        spoken = int(bool((message or "").strip(" ")))
        expected.add((key, order, score, at, parsed(answered), title, message, mood, spoken))
    got = bag(silver.reviews(spark.createDataFrame(rows, ddl("reviews")), MARK))
    assert got == Counter(expected) and len(expected) > 20


def test_order_items(spark):
    rows = dirty(
        3,
        [
            pick(None, "a", "b"),
            pick(None, 1, 2),
            pick(None, "p", "q"),
            pick(None, "s", "t"),
            stamp,
            pick(None, -1.0, 0.0, 0.01, 10.0, 99.99, 33.335),
            pick(None, -0.01, 0.0, 3.33, 12.5),
        ],
    )
    expected = set()
    for key, line, product, seller, limit, price, freight in rows:
        if None in (key, product, seller, price, freight) or price <= 0 or freight < 0:
            continue
        total, ratio = half_up(price + freight, 2), half_up(freight / price, 4)
        expected.add((key, line, product, seller, parsed(limit), price, freight, total, ratio))
    got = bag(silver.order_items(spark.createDataFrame(rows, ddl("order_items"))))
    assert got == Counter(expected) and len(expected) > 20


def test_payments(spark):
    rows = dirty(
        4,
        [
            pick(None, "a", "b", "c"),
            pick(1, 2, 3),
            pick(None, " Credit_Card ", "BOLETO"),
            pick(None, 0, 1, 2),
            pick(None, -5.0, 0.0, 0.01, 49.99, 50.0, 99.99, 100.0, 499.99, 500.0),
        ],
    )
    expected = set()
    for key, sequence, kind, times, value in rows:
        if key is None or value is None or value <= 0:
            continue
        label = next(
            (name for bound, name in ((50, "0-50"), (100, "50-100"), (500, "100-500")) if value < bound),
            "500+",
        )
        clean = kind and kind.strip(" ").lower()
        expected.add((key, sequence, clean, times, value, int((times or 0) > 1), label))
    got = bag(silver.payments(spark.createDataFrame(rows, ddl("payments"))))
    assert got == Counter(expected) and len(expected) > 20


def test_products(spark):
    rows = dirty(
        5,
        [
            pick(None, "p", "q"),
            pick(None, " Toys", "TOYS "),
            pick(None, 5),
            pick(None, 7),
            pick(None, 1),
            pick(None, 0.5, 1000.0, 1234.5, 4999.9996),
            pick(None, 2.0, 2000.0),
            pick(None, 3.0, 3000.0),
            pick(None, 4.0),
        ],
    )
    kept = {row for row in rows if row[0] is not None}
    expected = Counter()
    for key, category, name, text, photos, grams, *sides in kept:
        clean = category and category.strip(" ").lower()
        kilos = None if grams is None else half_up(grams / 1000, 3)
        volume = None if None in sides else math.prod(sides)
        expected[(key, clean, name, text, photos, grams, kilos, *sides, volume)] += 1
    assert bag(silver.products(spark.createDataFrame(rows, ddl("products")))) == expected


@pytest.mark.parametrize("table", ["customers", "sellers"])
def test_people_keep_rows_that_differ_only_in_case(spark, table):
    names = list(RAW_COLUMNS[table])
    texts = [pick(None, "k1", "k2") for _ in names[:-2]]
    rows = dirty(6, [*texts, pick(None, " Recife ", "RECIFE"), pick(None, "pe", " PE")])
    required = 2 if table == "customers" else 1
    kept = {row for row in rows if None not in row[:required]}
    expected = Counter(
        (*row[:-2], row[-2] and row[-2].strip().lower(), row[-1] and row[-1].strip().upper())
        for row in kept
    )
    build = getattr(silver, table)
    assert bag(build(spark.createDataFrame(rows, ddl(table)))) == expected
    assert max(expected.values()) > 1


def test_geolocation(spark):
    rows = dirty(
        7,
        [
            pick(None, "01001", "02002"),
            pick(None, float("nan"), -23.5, -22.25),
            pick(None, float("nan"), -46.5, -43.0),
            pick(None, " São Paulo", "SÃO PAULO"),
            pick(None, "sp", "SP "),
        ],
    )
    groups = {}
    for zip_code, lat, lng, city, state in rows:
        if None in (zip_code, lat, lng) or math.isnan(lat) or math.isnan(lng):
            continue
        key = (zip_code, city and city.strip().lower(), state and state.strip().upper())
        groups.setdefault(key, []).append((lat, lng))
    got = {tuple(r)[:3]: tuple(r)[3:] for r in silver.geolocation(
        spark.createDataFrame(rows, ddl("geolocation"))
    ).collect()}
    assert got.keys() == groups.keys()
    for key, points in groups.items():
        lat, lng, location = got[key]
        assert lat == pytest.approx(sum(p[0] for p in points) / len(points))
        assert lng == pytest.approx(sum(p[1] for p in points) / len(points))
        assert location == "_".join(part for part in (key[0], key[2]) if part is not None)


def test_category_translation(spark):
    rows = dirty(8, [pick(None, " Toys", "toys"), pick(None, "Games ")])
    expected = Counter((a.strip().lower(), b.strip().lower()) for a, b in {r for r in rows if None not in r})
    got = bag(silver.category_translation(spark.createDataFrame(rows, ddl("category_translation"))))
    assert got == expected
