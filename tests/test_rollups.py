"""Panels from roll-ups against the same panels over the wide table."""

import datetime as dt
import random
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from shelfline.plans import dashboard, rollups
from shelfline.plans.rollups import Selection
from shelfline.session import TASK_BYTES, TASK_ROWS, bulk_write

DAY = dt.date(2025, 1, 1)
ADVISED = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
GROUPS = ("0-17", "18-40", "41+")
WIDE = (
    "Date date, Medicine_Name string, Medicine_Type string, Vendor_Name string, Age_Group string,"
    " Received_Qty long, Issued_Qty long, Remaining_Qty long, Total_Value long"
)


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    rnd, path = random.Random(3), str(tmp_path_factory.mktemp("rollups"))
    rows = [
        (
            DAY + dt.timedelta(rnd.randrange(120)),
            rnd.choice(["aspirin", "balm", "cream", "drops", None]),
            rnd.choice(["T1", "T2", None]),
            rnd.choice(["V1", "V2", "V3"]),
            rnd.choice([*GROUPS, None]),
            rnd.randrange(9),
            rnd.randrange(9),
            rnd.randrange(-3, 9),
            rnd.randrange(-100, 900),
        )
        for _ in range(3000)
    ]
    wide = dashboard.by_month(spark.createDataFrame(rows, WIDE))
    wide.write.partitionBy(dashboard.MONTH).parquet(f"{path}/wide")
    wide = spark.read.parquet(f"{path}/wide")
    return wide, rollups.write_rollups(wide, f"{path}/rollups")


CHOICES = [
    Selection(),
    Selection(DAY + dt.timedelta(20), DAY + dt.timedelta(80)),
    Selection(types=("T1",)),
    Selection(vendors=("V1", "V3"), end=DAY + dt.timedelta(40)),
    Selection(DAY + dt.timedelta(31), DAY + dt.timedelta(31), ("T2",), ("V2",)),
    Selection(types=()),
    Selection(start=DAY + dt.timedelta(500)),
]


@pytest.mark.parametrize("selection", CHOICES)
def test_panels_and_cards_equal_the_wide_tables(tables, selection):
    wide, kept = tables
    rows = selection.of(wide)
    assert sorted(rollups.panels(kept, selection, GROUPS).collect()) == sorted(dashboard.panels(rows, GROUPS).collect())
    today = F.lit(DAY + dt.timedelta(60))
    assert rollups.cards(kept, selection, today).collect() == dashboard.cards(rows, today).collect()
    assert rollups.critical_items(kept, selection).collect() == dashboard.critical_items(rows).collect()


def test_the_smallest_covering_rollup_is_read(tables):
    _, kept = tables
    assert kept.covering() == "by_date" and kept.covering("Vendor_Name") == "by_vendor"
    assert kept.covering("Vendor_Name", "Medicine_Type") == "by_type_vendor"
    assert kept.covering("Medicine_Type", "Age_Group") == "by_type_vendor_group"
    assert all(kept.rows["by_date"] <= n for name, n in kept.rows.items() if name != "critical")
    with pytest.raises(ValueError, match="no roll-up"):
        kept.covering("Age_Group", "Medicine_Name")


def test_panels_never_open_the_wide_table(tables):
    _, kept = tables
    plan = rollups.panels(kept, CHOICES[3], GROUPS)._jdf.queryExecution().executedPlan().toString()
    assert "/rollups/" in plan and "/wide" not in plan


def test_bitmaps_hold_many_items(spark, tmp_path):
    many = spark.range(70_000).select(
        F.lit(DAY).alias("Date"), F.concat(F.lit("i"), F.col("id") % 40_000).alias("Medicine_Name"), F.lit("T").alias("Medicine_Type"),
        F.lit("V").alias("Vendor_Name"), F.lit("g").alias("Age_Group"), F.lit(1).cast("long").alias("Received_Qty"),
        F.lit(5).cast("long").alias("Issued_Qty"), (F.col("id") % 10).alias("Remaining_Qty"), F.lit(1).cast("long").alias("Total_Value"),
    )
    kept = rollups.write_rollups(dashboard.by_month(many), str(tmp_path / "r"))
    assert rollups.critical_items(kept, Selection()).collect() == dashboard.critical_items(many).collect()


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def test_all_rollups_come_from_one_exchange(tables):
    plan = final_plan(rollups._all_sums(tables[0]))
    assert "Exchange rangepartitioning" in plan and "Exchange hashpartitioning" not in plan
    assert plan.count("ReusedExchange") == len(rollups.ROLLUPS) - 1


def test_tasks_get_rows_by_number(tables, monkeypatch):
    """Like rows take few bytes in a shuffle, so that tasks merged by bytes would spill."""
    monkeypatch.setattr(rollups, "TASK_ROWS", 1000)
    plan = final_plan(rollups._all_sums(tables[0]))
    deals = [line for line in plan.splitlines() if " Exchange rangepartitioning" in line]
    assert deals and all(", 5), REPARTITION_BY_NUM" in line for line in deals) and "coalesced" not in plan


def shuffle_files(spark):
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {f for folder in folders for f in Path(folder.toString()).rglob("shuffle_*")}


def test_written_rollups_leave_no_shuffle_files(spark, tables, tmp_path):
    spark._jvm.System.gc()
    before, partitions = shuffle_files(spark), spark.conf.get("spark.sql.shuffle.partitions")
    rollups.write_rollups(tables[0], str(tmp_path / "r"))
    end = time.time() + 20
    while (left := shuffle_files(spark) - before) and time.time() < end:  # they go without being waited for
        time.sleep(0.1)
    assert not left and spark.conf.get("spark.sql.shuffle.partitions") == partitions


def test_a_bulk_write_has_partitions_by_rows(spark):
    usual = int(spark.conf.get("spark.sql.shuffle.partitions"))
    with bulk_write(spark, 100 * TASK_ROWS):
        assert spark.conf.get("spark.sql.shuffle.partitions") == "100"
        assert spark.conf.get(ADVISED) == f"{TASK_BYTES}b"
    spark.conf.set(ADVISED, "8m")
    with bulk_write(spark, 10):
        assert spark.conf.get("spark.sql.shuffle.partitions") == str(usual)
        assert spark.conf.get(ADVISED) == f"{8 << 20}b"
    assert spark.conf.get(ADVISED) == "8m"
    spark.conf.unset(ADVISED)
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_a_critical_item_takes_a_word_not_a_page(tables):
    wide, kept = tables
    stored = kept.read(rollups.CRITICAL)
    assert stored.schema["ids"].dataType.simpleString() == "bigint"
    short = wide.where("Issued_Qty > Remaining_Qty and Medicine_Name is not null")
    groups = short.select("Date", "Medicine_Type", "Vendor_Name").distinct()
    assert stored.count() == groups.count() == kept.rows[rollups.CRITICAL]
    named = short.select("Date", "Medicine_Type", "Vendor_Name", "Medicine_Name").distinct()
    assert stored.agg(F.sum(F.bit_count("ids"))).first()[0] == named.count()
