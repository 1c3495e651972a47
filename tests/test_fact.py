import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from shelfline import schemas
from shelfline.operators.asof import asof_rows, latest_receipts
from shelfline.plans.dims import calendar_from_days, load_items, load_vendors
from shelfline.plans.fact import build_fact, daily_movements, grouped_fact, item_measures, rolling_usage
from shelfline.schemas import QUANTITIES

CLEAN = "source_file string, mat_sku string, movement_date date, " + ", ".join(f"{q} double" for q in QUANTITIES)
SUPPLY = "mat_sku string, rcvd_date date, ven_acc string"
NATURAL = ("movement_date", "mat_sku", "ven_acc")


def day(n: int) -> dt.date:
    return dt.date(2025, 1, 1) + dt.timedelta(days=n)


def movement(sku, when, opened=10.0, received=0.0, issued=1.0, closed=9.0, file="f1"):
    return (file, sku, when, opened, received, issued, closed)


@pytest.fixture(scope="module")
def dims(spark):
    items = spark.createDataFrame(
        [("A", "alpha", "T1", None, 2.5, 1), ("B", "beta", "T2", None, 1.0, 1)],
        "medicine_sku string, medicine_name string, type_description string, storage_type string,"
        " unit_cost double, expiration_months int",
    ).withColumn("unit_cost", F.col("unit_cost").cast("decimal(18,2)"))
    vendors = spark.createDataFrame(
        [("V1", "one", None, None, None), ("V2", "two", None, None, None)],
        "vendor_account string, vendor_name string, vendor_type string, country_name string, vendor_status string",
    )
    return load_items(items), load_vendors(vendors)


def fact(spark, dims, rows, supply, scope=()):
    movements = spark.createDataFrame(rows, CLEAN)
    daily = daily_movements(movements, scope)
    receipts = spark.createDataFrame(supply, SUPPLY)
    return build_fact(daily, receipts, dims[0], calendar_from_days(movements), dims[1], scope, (*scope, *NATURAL))


EARLY = [("A", day(0), "V1"), ("B", day(0), "V2")]


def test_stored_schema_and_measures(spark, dims):
    df = fact(spark, dims, [movement("A", day(1), 10.0, 30.0, 4.0, 36.0)], EARLY)
    assert [(f.name, f.dataType) for f in df.schema if f.name not in NATURAL] == [
        (f.name, f.dataType) for f in schemas.FACT
    ]
    row = {k: float(v) for k, v in df.first().asDict().items() if k in schemas.FACT_MEASURES}
    assert row == {
        "opening_qty": 10.0,
        "received_qty": 30.0,
        "issued_qty": 4.0,
        "closed_qty": 36.0,
        "stock_availability_pct": 90.0,
        "valuasi": 90.0,
        "pengeluaran": 10.0,
        "wastage_ratio_pct": 86.67,
        "turnover_ratio": 0.4,
        "stock_coverage_days": 9.0,
    }


def test_zero_and_negative_stock_are_gated(spark, dims):
    df = fact(spark, dims, [movement("A", day(1), 0.0, 0.0, 0.0, -5.0), movement("B", day(1), 3.0, 0.0, 5.0, -2.0)], EARLY)
    for row in df.collect():
        assert (row.stock_availability_pct, row.valuasi, row.wastage_ratio_pct, row.stock_coverage_days) == (0, 0, 0, 0)


def test_unknown_items_vendors_and_early_movements_are_dropped(spark, dims):
    rows = [
        movement("A", day(1)),
        movement("Z", day(1)),
        movement(None, day(1)),
        movement("B", day(0)),
        movement("B", day(5)),
    ]
    supply = [("A", day(0), "V1"), ("Z", day(0), "V1"), ("B", day(1), "V2"), ("B", day(4), "V_unknown")]
    assert [r.mat_sku for r in fact(spark, dims, rows, supply).collect()] == ["A"]


def test_vendor_drop_comes_after_item_measures(spark, dims):
    rows = [movement("A", day(1), issued=2.0), movement("A", day(5), issued=6.0)]
    supply = [("A", day(0), "V1"), ("A", day(4), "V_unknown")]
    only = fact(spark, dims, rows, supply).collect()
    assert [(r.movement_date, float(r.turnover_ratio)) for r in only] == [(day(1), 0.8)]


def test_availability_above_three_digits_is_kept(spark, dims):
    row = fact(spark, dims, [movement("A", day(1), 0.0, 1.0, 0.0, 2500.0)], EARLY).first()
    assert float(row.stock_availability_pct) == 250000.0


def test_trailing_window_holds_thirty_dates(spark):
    grouped = spark.createDataFrame(
        [("A", day(0), 100.0), ("A", day(29), 10.0), ("A", day(30), 20.0)],
        "mat_sku string, movement_date date, issued_qty double",
    )
    got = {r.movement_date: r.avg_issued_30d for r in rolling_usage(grouped).collect()}
    assert got == {day(0): 100.0, day(29): 55.0, day(30): 15.0}


def test_one_row_per_key_across_files(spark, dims):
    rows = [movement("A", day(1), file="f1"), movement("A", day(1), file="f2")]
    assert [float(r.issued_qty) for r in fact(spark, dims, rows, EARLY).collect()] == [2.0]


def test_file_scope_confines_windows(spark, dims):
    rows = [movement("A", day(1), issued=2.0, file="f1"), movement("A", day(2), issued=6.0, file="f2")]
    got = {r.source_file: float(r.turnover_ratio) for r in fact(spark, dims, rows, EARLY, ("source_file",)).collect()}
    assert got == {"f1": 0.2, "f2": 0.6}
    assert {float(r.turnover_ratio) for r in fact(spark, dims, rows, EARLY).collect()} == {0.8}


def random_inputs(seed, n=600):
    rnd = random.Random(seed)
    rows = [
        movement(
            f"S{rnd.randrange(6)}", day(rnd.randrange(50)), *[float(rnd.randrange(20)) for _ in range(4)], f"f{rnd.randrange(3)}"
        )
        for _ in range(n)
    ]
    supply = [(f"S{rnd.randrange(6)}", day(rnd.randrange(50)), f"V{rnd.randrange(4)}") for _ in range(40)]
    return rows, supply


def test_summing_before_the_join_changes_nothing(spark):
    rows, supply = random_inputs(1)
    movements, receipts = spark.createDataFrame(rows, CLEAN), spark.createDataFrame(supply, SUPPLY)
    early = grouped_fact(daily_movements(movements), receipts)
    late = (
        asof_rows(movements, latest_receipts(receipts))
        .groupBy("movement_date", "mat_sku", "ven_acc")
        .agg(*[F.sum(q).alias(q) for q in QUANTITIES])
    )
    columns = [*NATURAL, *QUANTITIES]
    assert sorted(early.select(columns).collect()) == sorted(late.select(columns).collect())


def test_order_of_input_does_not_matter(spark):
    rows, supply = random_inputs(2)

    def measured(data):
        grouped = grouped_fact(daily_movements(spark.createDataFrame(data, CLEAN)), spark.createDataFrame(supply, SUPPLY))
        return sorted(item_measures(grouped).collect())

    assert measured(rows) == measured(rows[::-1])
