import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from shelfline.operators.dedupe import keep_one
from shelfline.operators.merge import accumulate, insert_ignore, upsert
from shelfline.operators.surrogate import assign_ids
from shelfline.plans.dims import load_calendar
from shelfline.schemas import FACT_MEASURES
from shelfline.sources import clean_items

DAY = dt.date(2025, 3, 1)
KEYS = ["day", "item", "vendor"]
FACT = "day date, item string, vendor string, " + ", ".join(f"{m} decimal(18,2)" for m in FACT_MEASURES)


def test_keep_one_takes_the_smallest_row(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "z"), ("a", 1, None), ("b", 5, "q")], "k string, n int, t string")
    assert sorted(keep_one(df, ["k"]).collect()) == [("a", 1, None), ("b", 5, "q")]


def test_ids_are_dense_unique_and_repeatable(spark):
    df = spark.range(1000).select(F.concat(F.lit("k"), "id").alias("k"))
    first = assign_ids(df, "k", "pk", after=10)
    again = assign_ids(df.repartition(13), "k", "pk", after=10)
    ids = {r.k: r.pk for r in first.collect()}
    assert sorted(ids.values()) == list(range(11, 1011))
    assert ids == {r.k: r.pk for r in again.collect()}


def test_upsert_keeps_ids_and_updates(spark):
    old = spark.createDataFrame([(1, "a", "old"), (2, "b", "old")], "pk bigint, k string, v string")
    new = spark.createDataFrame([("b", None), ("c", "new"), ("d", "new")], "k string, v string")
    got = {r.k: (r.pk, r.v) for r in upsert(old, new, "k", "pk").collect()}
    assert got["a"] == (1, "old") and got["b"] == (2, None)
    assert sorted([got["c"][0], got["d"][0]]) == [3, 4] and got["c"][1] == "new"


def test_second_upsert_is_stable(spark):
    old = spark.createDataFrame([(1, "a", "x")], "pk bigint, k string, v string")
    new = spark.createDataFrame([("a", "y"), ("b", "y")], "k string, v string")
    once = upsert(old, new, "k", "pk")
    assert sorted(upsert(once, new, "k", "pk").collect()) == sorted(once.collect())


def test_insert_ignore_leaves_known_rows(spark):
    old = load_calendar(spark.createDataFrame([(DAY,)], "movement_date date")).withColumn("month_name", F.lit("kept"))
    days = spark.createDataFrame([(DAY,), (DAY + dt.timedelta(1),), (DAY,)], "movement_date date")
    got = sorted((r.date_id_pk, r.month_name) for r in load_calendar(days, old).collect())
    assert got == [(20250301, "kept"), (20250302, "March")]


def test_insert_ignore_can_assign_ids(spark):
    old = spark.createDataFrame([(7, "a")], "pk bigint, k string")
    new = spark.createDataFrame([("a",), ("b",)], "k string")
    assert sorted(insert_ignore(old, new, "k", "pk").collect()) == [(7, "a"), (8, "b")]


def test_items_default_and_keep_codes(spark):
    raw = spark.createDataFrame(
        [("007", "n", "t", "s", None, None), ("007", "n", "t", "s", "1.005", "3")],
        "MED_ID string, MED_NAME string, TYPE_DES string, STRG_DES string, COST_UN string, EXP_MON string",
    )
    row = clean_items(raw).first()
    assert (row.medicine_sku, row.unit_cost, row.expiration_months) == ("007", Decimal("0.00"), 0)


def row(item, opened, received, issued, closed, availability=0, surplus=0, value=0, day=DAY, vendor="V"):
    numbers = [opened, received, issued, closed, availability, value, value, surplus, 0, 0]
    return (day, item, vendor, *[Decimal(n) for n in numbers])


@pytest.fixture
def merged(spark):
    def run(old, new):
        frames = [spark.createDataFrame(rows, FACT) for rows in (old, new)]
        out = accumulate(*frames, KEYS, "item", "day").collect()
        return {(r.day, r.item, r.vendor): {m: float(r[m]) for m in FACT_MEASURES} for r in out}

    return run


def test_accumulate_adds_and_recomputes_ratios(merged):
    got = merged([row("A", 10, 0, 2, 8, value=5)], [row("A", 10, 20, 3, 27, value=6)])[(DAY, "A", "V")]
    assert (got["opening_qty"], got["received_qty"], got["issued_qty"], got["closed_qty"]) == (20, 20, 5, 35)
    assert (got["valuasi"], got["pengeluaran"]) == (11, 11)
    assert got["stock_availability_pct"] == 87.5
    assert got["wastage_ratio_pct"] == 75.0
    assert got["turnover_ratio"] == 0.25
    assert got["stock_coverage_days"] == 7.0


def test_accumulate_ratios_are_not_gated_and_default_to_zero(merged):
    got = merged([row("A", 10, 1, 9, -30), row("B", 0, 0, 1, -1)], [row("A", 0, 0, 1, 0), row("B", 0, 0, 1, -1)])
    assert got[(DAY, "A", "V")]["stock_availability_pct"] == -272.73
    assert got[(DAY, "A", "V")]["wastage_ratio_pct"] == -900.0
    assert got[(DAY, "B", "V")]["stock_availability_pct"] == 0.0
    assert got[(DAY, "B", "V")]["wastage_ratio_pct"] == 0.0


def test_accumulate_keeps_stored_ratios_of_single_rows(merged):
    got = merged([row("A", 1, 1, 1, 1, availability=12, surplus=34)], [row("B", 1, 1, 1, 1)])
    assert got[(DAY, "A", "V")]["stock_availability_pct"] == 12
    assert got[(DAY, "A", "V")]["wastage_ratio_pct"] == 34


def test_accumulate_totals_usage_over_vendors(merged):
    later = DAY + dt.timedelta(days=1)
    got = merged([row("A", 4, 0, 1, 6)], [row("A", 4, 0, 3, 6, vendor="W"), row("A", 4, 0, 2, 6, day=later)])
    assert got[(DAY, "A", "V")]["stock_coverage_days"] == 1.5
    assert got[(later, "A", "V")]["stock_coverage_days"] == 2.0
    assert {r["turnover_ratio"] for r in got.values()} == {1.5}
