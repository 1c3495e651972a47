import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from shelfline import schemas
from shelfline.plans import kpis
from shelfline.plans.quality import star_report
from shelfline.plans.warehouse import (
    Star,
    deploy_schema,
    publish,
    read_star,
    refresh_tables,
    register_views,
    write_fact,
    write_table,
)

D1, D31, D32 = dt.date(2025, 1, 1), dt.date(2025, 1, 31), dt.date(2025, 2, 1)


def key(day: dt.date) -> int:
    return int(day.strftime("%Y%m%d"))


def fact_row(day, item, vendor, opened=0, received=0, issued=0, closed=0, avail=0, value=0, spend=0, surplus=0, turn=0, cover=0):
    numbers = (opened, received, issued, closed, avail, value, spend, surplus, turn, cover)
    return (key(day), item, vendor, *[Decimal(str(n)) for n in numbers])


@pytest.fixture(scope="module")
def make_star(spark):
    items = spark.createDataFrame(
        [(i, f"S{i}", name, kind, None, Decimal("2.00"), 0) for i, name, kind in [(1, "a", "T"), (2, "b", "T"), (3, "a", "T"), (4, "c", "U")]],
        schemas.DIM_ITEM,
    )
    vendors = spark.createDataFrame([(1, "V1", "one", None, None, None), (2, "V2", "two", None, None, None)], schemas.DIM_VENDOR)

    def build(rows, days=(D1, D31, D32)):
        calendar = spark.createDataFrame(
            [(key(d), d, d.year, 1, d.month, d.strftime("%B"), d.day, d.strftime("%A")) for d in days], schemas.DIM_CALENDAR
        )
        return Star(items, vendors, calendar, spark.createDataFrame(rows, schemas.FACT))

    return build


def test_availability_merges_equal_names_and_sorts_nulls_last(make_star):
    star = make_star(
        [
            fact_row(D32, 1, 1, opened=10, issued=5),
            fact_row(D32, 3, 1, opened=10, issued=1),
            fact_row(D32, 2, 1),
            fact_row(D32, 4, 1, opened=1, issued=2),
            fact_row(D31, 4, 1, opened=99),
        ]
    )
    got = [tuple(r) for r in kpis.raw_availability(star).collect()]
    assert got == [("c", "U", -100.0), ("a", "T", 70.0), ("b", "T", None)]


def test_newest_date_comes_from_the_calendar(make_star):
    star = make_star([fact_row(D31, 1, 1, opened=10)])
    assert kpis.raw_availability(star).count() == 0
    assert kpis.stored_availability(star).count() == 0


def test_value_is_exact(make_star):
    star = make_star([fact_row(D32, 1, 1, opened="0.1", received="0.2"), fact_row(D32, 2, 1, opened=1, value="0.3")])
    (row,) = kpis.raw_value(star).collect()
    assert (row.current_stock_qty, row.total_valuasi_idr) == (Decimal("1.30"), Decimal("39000.00"))
    assert kpis.stored_value(star, rate=10).first().total_valuasi_idr == 3


def test_monthly_order(make_star):
    star = make_star([fact_row(D1, 1, 1, issued=1), fact_row(D31, 4, 1, issued=5), fact_row(D32, 1, 1, issued=9)])
    got = [(r.month_name, r.type_description, int(r.total_qty_issued)) for r in kpis.raw_monthly_issued(star).collect()]
    assert got == [("January", "U", 5), ("January", "T", 1), ("February", "T", 9)]
    assert kpis.stored_monthly_issued(star).columns == ["year", "month_name", "type_description", "total_pengeluaran"]


def test_turnover_uses_mean_over_fact_rows_and_puts_null_first(make_star):
    star = make_star([fact_row(D1, 1, 1, opened=1, issued=4), fact_row(D31, 3, 1, opened=2, issued=5), fact_row(D32, 2, 1, issued=1)])
    got = [(r.medicine_name, r.avg_opening, r.turnover_ratio) for r in kpis.raw_turnover(star).collect()]
    assert got == [("b", 0.0, None), ("a", 1.5, 6.0)]


def test_coverage_window_holds_thirty_one_dates(make_star):
    before = D32 - dt.timedelta(days=31)
    edge = D32 - dt.timedelta(days=30)
    rows = [
        fact_row(before, 1, 1, issued=1000),
        fact_row(edge, 1, 1, issued=3),
        fact_row(D32, 1, 1, opened=30, issued=1),
    ]
    (row,) = kpis.raw_coverage(make_star(rows, days=(before, edge, D32))).collect()
    assert (row.coverage_days, row.status) == (14.5, "YELLOW (Reorder Warning)")


@pytest.mark.parametrize(
    ("opened", "issued", "band"),
    [(16, 1, "YELLOW (Reorder Warning)"), (31, 1, "YELLOW (Reorder Warning)"), (14, 1, "RED (Urgent Stockout Risk)"), (15, 1, "YELLOW (Reorder Warning)")],
)
def test_raw_band_edges(make_star, opened, issued, band):
    (row,) = kpis.raw_coverage(make_star([fact_row(D32, 1, 1, opened=opened, issued=issued)])).collect()
    assert row.status == band


def test_raw_band_uses_the_unrounded_value_and_null_is_red(make_star):
    # 30.004 days rounds to 30.00 but lies above the band.
    rows = [fact_row(D32, 1, 1, opened="7751", issued="250"), fact_row(D32, 2, 1, opened=5)]
    got = {r.medicine_name: (r.coverage_days, r.status) for r in kpis.raw_coverage(make_star(rows)).collect()}
    assert got == {"a": (30.0, "GREEN (Safe)"), "b": (None, "RED (Urgent Stockout Risk)")}


def test_stored_band_uses_the_rounded_value(make_star):
    rows = [fact_row(D32, 1, 1, cover="30.00"), fact_row(D32, 2, 1, cover="13.99"), fact_row(D32, 4, 1, cover="30.01"), fact_row(D32, 3, 1)]
    got = [(r.medicine_name, r.status) for r in kpis.stored_coverage(make_star(rows)).collect()]
    assert got == [("b", "RED (Kritis - Risiko Kosong)"), ("a", "YELLOW (Beli Baru)"), ("c", "GREEN (Aman)")]


def test_surplus_ranks_vendors_without_receipts_first(make_star):
    rows = [
        fact_row(D1, 1, 1, received=10, issued=15),
        fact_row(D1, 1, 2, issued=5),
        fact_row(D1, 4, 1, received=10, issued=1),
    ]
    got = [(r.vendor_name, r.wastage_ratio_pct) for r in kpis.raw_surplus(make_star(rows)).collect()]
    assert got == [("two", None), ("one", 90.0), ("one", -50.0)]


def test_stored_surplus_lists_single_rows(make_star):
    rows = [fact_row(D1, 1, 1, surplus=5), fact_row(D31, 1, 1, surplus=7), fact_row(D32, 1, 1)]
    assert [float(r.wastage_ratio_pct) for r in kpis.stored_surplus(make_star(rows)).collect()] == [7.0, 5.0]


def test_ties_at_the_limit_are_resolved_by_name(make_star):
    rows = [
        fact_row(D32, 4, 1, surplus=5, avail=5, turn=5),
        fact_row(D32, 2, 1, surplus=5, avail=5, turn=5),
        fact_row(D32, 1, 2, surplus=5, avail=5, turn=5),
        fact_row(D32, 1, 1, surplus=9, avail=1, turn=9),
        fact_row(D32, 3, 1, surplus=1, avail=9, turn=1),
    ]
    star = make_star(rows)
    surplus = [(r.type_description, r.vendor_name) for r in kpis.stored_surplus(star, limit=3).collect()]
    assert surplus == [("T", "one"), ("T", "one"), ("T", "two")]
    assert [r.medicine_name for r in kpis.stored_availability(star, limit=3).collect()] == ["a", "a", "b"]
    assert [r.medicine_name for r in kpis.stored_turnover(star, limit=3).collect()] == ["a", "a", "b"]
    assert kpis.stored_turnover(star, limit=50).count() == 5


def test_quality_report_finds_each_kind(make_star):
    rows = [fact_row(D1, 1, 1, avail=1000), fact_row(D1, 1, 1), fact_row(D1, 99, 1), fact_row(dt.date(2030, 1, 1), 1, 77)]
    found = {(r.rule, r.column_name): r.violations for r in star_report(make_star(rows)).where("violations > 0").collect()}
    assert found == {
        ("overflow", "stock_availability_pct"): 1,
        ("unique", "date_id_fk+medicine_id_fk+vendor_id_fk"): 1,
        ("reference", "medicine_id_fk"): 1,
        ("reference", "vendor_id_fk"): 1,
        ("reference", "date_id_fk"): 1,
    }


@pytest.fixture(scope="module")
def written(spark, make_star, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("star"))
    star = make_star([fact_row(D1, 1, 1, opened=4, issued=1), fact_row(D32, 1, 1, opened=4, issued=2), fact_row(D32, 4, 2, opened=8)])
    for name, df in (("dim_item", star.items), ("dim_vendor", star.vendors), ("dim_calendar", star.calendar)):
        write_table(df, f"{path}/{name}")
    assert write_fact(star.fact, f"{path}/fact_inventory") == 3
    publish(spark, path)
    return path


def test_latest_date_reads_one_partition(spark, written):
    latest = kpis.latest_fact(read_star(spark, written))
    plan = latest._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan" in line and "medicine_id_fk" in line)
    assert "month_id" in scan.split("PartitionFilters: [", 1)[1].split("PushedFilters", 1)[0]
    assert {r.date_id_fk for r in latest.collect()} == {key(D32)}


def test_views_answer_sql(spark, written):
    star = read_star(spark, written)
    register_views(star, {"fact_inventory": "stock", "dim_item": "goods", "dim_calendar": "days"})
    got = spark.sql(
        "SELECT g.medicine_name, CAST(SUM(s.issued_qty) AS INT) AS issued FROM stock s"
        " JOIN goods g ON s.medicine_id_fk = g.medicine_id_pk JOIN days d ON s.date_id_fk = d.date_id_pk"
        " WHERE d.full_date = (SELECT MAX(full_date) FROM days) GROUP BY 1 ORDER BY 1"
    ).collect()
    assert [tuple(r) for r in got] == [("a", 2), ("c", 0)]


def test_deployed_tables_see_the_files(spark, written):
    spark.sql("CREATE DATABASE IF NOT EXISTS mart")
    deploy_schema(spark, written, "mart")
    deploy_schema(spark, written, "mart")
    refresh_tables(spark, "mart")
    assert spark.table("mart.fact_inventory").where(F.col("date_id_fk") == key(D32)).count() == 2
    assert spark.table("mart.dim_item").count() == 4
    spark.sql("CREATE TABLE mart.extra AS SELECT 1 AS x")
    deploy_schema(spark, written, "mart", replace=True)
    refresh_tables(spark, "mart")
    assert spark.table("mart.dim_item").count() == 4 and spark.table("mart.fact_inventory").count() == 3
    created = spark.sql("SHOW CREATE TABLE mart.dim_item").first()[0]
    assert "DEFAULT 0" in created
    spark.sql("DROP DATABASE mart CASCADE")


def test_append_mode_adds_rows(spark, make_star, tmp_path):
    fact = make_star([fact_row(D1, 1, 1)]).fact
    write_fact(fact, str(tmp_path / "f"))
    write_fact(fact.withColumn("medicine_id_fk", F.lit(2).cast("bigint")), str(tmp_path / "f"), mode="append")
    assert spark.read.parquet(str(tmp_path / "f")).count() == 2


def test_rows_without_an_item_take_no_place(spark, make_star):
    """The list is cut after the lookup: unlisted items, however extreme, don't shorten it."""
    star = make_star(
        [fact_row(D32, 100 + k, 1, avail=0, turn=99, cover=1, surplus=99) for k in range(20)]
        + [fact_row(D32, 1 + k % 4, 1 + k % 2, avail=5 + k, turn=1 + k, cover=5 + k, surplus=1 + k) for k in range(27)]
    )
    assert kpis.stored_availability(star).count() == 10
    assert kpis.stored_turnover(star).count() == 10
    assert kpis.stored_coverage(star).count() == 15
    assert kpis.stored_surplus(star).count() == 15
    assert kpis.stored_availability(star).first().stock_availability_pct == 5
