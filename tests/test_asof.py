import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from shelfline.operators.asof import asof_carry, asof_interval, asof_rows, latest_receipts


def day(n: int) -> dt.date:
    return dt.date(2025, 1, 1) + dt.timedelta(days=n)


def brute_force(rows, supply):
    out = []
    for sku, when, q in rows:
        earlier = [(d, v) for s, d, v in supply if s == sku and d <= when]
        if earlier:
            out.append((sku, when, q, max(earlier)[1]))
    return sorted(out)


ROWS = "mat_sku string, movement_date date, q int"
SUPPLY = "mat_sku string, rcvd_date date, ven_acc string"


def strategies():
    return {
        "rows": lambda rows, receipts: asof_rows(rows, receipts),
        "interval": asof_interval,
    }


@pytest.mark.parametrize("name", strategies())
def test_edges(spark, name):
    rows = [
        ("A", day(0), 1),  # before the first receipt
        ("A", day(5), 2),  # same day, tie of two receipts
        ("A", day(6), 3),
        ("A", day(9), 4),  # after the second receipt
        ("B", day(5), 5),  # no receipts
    ]
    supply = [("A", day(5), "V1"), ("A", day(5), "V2"), ("A", day(8), "V0"), ("C", day(1), "V9")]
    receipts = latest_receipts(spark.createDataFrame(supply, SUPPLY))
    got = strategies()[name](spark.createDataFrame(rows, ROWS), receipts).collect()
    assert sorted((r.q, r.ven_acc) for r in got) == [(2, "V2"), (3, "V2"), (4, "V0")]


@pytest.mark.parametrize("name", strategies())
def test_against_brute_force_with_a_hot_key(spark, name):
    rnd = random.Random(7)
    sku = lambda: "hot" if rnd.random() < 0.4 else f"S{rnd.randrange(15)}"
    rows = [(sku(), day(rnd.randrange(60)), i) for i in range(800)]
    supply = [(sku(), day(rnd.randrange(60)), f"V{rnd.randrange(9)}") for _ in range(120)]
    receipts = latest_receipts(spark.createDataFrame(supply, SUPPLY))
    got = strategies()[name](spark.createDataFrame(rows, ROWS), receipts).collect()
    assert sorted((r.mat_sku, r.movement_date, r.q, r.ven_acc) for r in got) == brute_force(rows, supply)


def test_missing_sku_never_matches(spark):
    rows = spark.createDataFrame([(None, day(3), 1)], ROWS)
    receipts = latest_receipts(spark.createDataFrame([("A", day(1), "V1")], SUPPLY))
    assert asof_rows(rows, receipts).count() == 0
    assert asof_interval(rows, receipts).count() == 0


def test_carry_keeps_row_columns(spark):
    daily = spark.createDataFrame([("A", day(3), 8)], ROWS)
    receipts = latest_receipts(spark.createDataFrame([("A", day(1), "V1")], SUPPLY))
    got = asof_carry(daily, receipts)
    assert got.columns == ["mat_sku", "movement_date", "q", "ven_acc", "day_number"]
    assert got.select("q", "ven_acc").first() == (8, "V1")
    assert got.where(F.col("day_number") == F.unix_date("movement_date")).count() == 1
