"""Shape of the physical plans that matter at scale."""

import datetime as dt
import re

from pyspark.sql import functions as F

from shelfline.operators.asof import latest_receipts
from shelfline.plans.fact import daily_movements, grouped_fact, item_measures
from shelfline.schemas import QUANTITIES
from shelfline.sources import fixtures, type_movements, type_supply

SF_DIR = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def measured(spark):
    movements = type_movements(fixtures.raw_movements(spark, SF_DIR))
    return item_measures(grouped_fact(daily_movements(movements), type_supply(fixtures.raw_supply(spark, SF_DIR))))


def test_item_windows_share_one_shuffle_and_sort(spark):
    plan = plan_of(measured(spark))
    above_union = plan.split("Union", 1)[0]
    assert above_union.count("Exchange hashpartitioning") == 1
    assert len(re.findall(r"\bSort \[", above_union)) == 1
    assert above_union.count("Window [") == 3


def test_raw_rows_are_summed_before_the_first_shuffle(spark):
    plan = plan_of(daily_movements(type_movements(fixtures.raw_movements(spark, SF_DIR))))
    after_shuffle, before_shuffle = plan.split("Exchange", 1)
    assert "partial_sum" in before_shuffle and "partial_sum" not in after_shuffle


def test_scan_reads_needed_columns_only(spark):
    plan = plan_of(latest_receipts(type_supply(fixtures.raw_supply(spark, SF_DIR))))
    schema = plan.split("ReadSchema: struct<", 1)[1]
    assert "l_quantity" not in schema and "l_extendedprice" not in schema
    assert "PushedFilters: [IsNotNull(l_returnflag), EqualTo(l_returnflag,N)]" in plan


def test_a_hot_item_shrinks_to_one_row_per_date(spark):
    day = F.date_add(F.lit(dt.date(2025, 1, 1)), F.pmod("id", F.lit(40)).cast("int"))
    sku = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("S"), "id"))
    rows = spark.range(30_000).select(
        sku.alias("mat_sku"), day.alias("movement_date"), *[F.lit(1.0).alias(q) for q in QUANTITIES]
    )
    daily = daily_movements(rows).where("mat_sku = 'hot'")
    assert daily.count() == 40
    assert daily.agg(F.sum("issued_qty")).first()[0] == 10_000.0


def test_raw_receipts_are_hashed_not_sorted(spark):
    plan = plan_of(latest_receipts(type_supply(fixtures.raw_supply(spark, SF_DIR))))
    from_scan = plan.split("Exchange")[-1]
    assert "HashAggregate" in from_scan and "SortAggregate" not in from_scan


def test_windows_under_file_scope_hold_a_row_per_item_and_date(spark):
    day = F.date_add(F.lit(dt.date(2025, 1, 1)), F.pmod("id", F.lit(30)).cast("int"))
    rows = spark.range(6000).select(
        F.concat(F.lit("file"), F.pmod(F.col("id"), F.lit(200))).alias("source_file"),
        F.lit("hot").alias("mat_sku"),
        day.alias("movement_date"),
        *[F.lit(1.0).alias(q) for q in QUANTITIES],
    )
    supply = spark.createDataFrame([("hot", dt.date(2025, 1, 3), "V")], "mat_sku string, rcvd_date date, ven_acc string")
    daily = daily_movements(rows, ("source_file",))
    got = grouped_fact(daily, supply, ("source_file",))
    below_window = plan_of(got).split("Window [", 1)[1]
    assert "functions=[])" in below_window or "keys=[mat_sku" in below_window  # distinct (SKU, date) feed the window
    assert got.count() == daily.where("movement_date >= '2025-01-03'").count()


def test_selection_reads_its_months_only(spark):
    from shelfline import registry

    plan = plan_of(registry.filtered_selection(spark, SF_DIR))
    scan = next(line for line in plan.splitlines() if "FileScan" in line and "Vendor_Name" in line)
    assert "Month_Start" in scan.split("PartitionFilters: [", 1)[1].split("PushedFilters", 1)[0]
