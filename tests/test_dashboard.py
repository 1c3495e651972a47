import datetime as dt

import pytest
from pyspark.sql import functions as F

from shelfline.plans import dashboard

TODAY = dt.date(2025, 3, 10)
FACT = (
    "Date date, Medicine_ID bigint, Staff_ID bigint, Vendor_ID bigint, Patient_ID bigint,"
    " Opening_Qty bigint, Received_Qty bigint, Issued_Qty bigint, Unit_Cost bigint"
)


def back(days: int) -> dt.date:
    return TODAY - dt.timedelta(days=days)


@pytest.fixture(scope="module")
def wide(spark):
    rows = [
        (TODAY, 1, 1, 1, 1, 10, 0, 6, 2),
        (TODAY, 1, 1, 1, 2, 10, 5, 1, 2),
        (back(1), 2, 1, 2, 1, 4, 0, 3, 5),
        (back(30), 2, 1, 2, 3, 7, 0, 0, 1),
        (back(31), 3, 1, 1, 3, 9, 0, 9, 1),
        (TODAY, 1, 1, 77, 1, 1, 1, 1, 1),  # unknown vendor
    ]
    return dashboard.wide_fact(
        spark.createDataFrame(rows, FACT),
        spark.createDataFrame([(1, "a", "T"), (2, "b", "U"), (3, "c", "T")], "Medicine_ID bigint, Medicine_Name string, Medicine_Type string"),
        spark.createDataFrame([(1, "s")], "Staff_ID bigint, Staff_Name string"),
        spark.createDataFrame([(1, "x"), (2, "y")], "Vendor_ID bigint, Vendor_Name string"),
        spark.createDataFrame([(1, "60+"), (2, "0-17"), (3, "other")], "Patient_ID bigint, Age_Group string"),
    ).cache()


def test_wide_fact_derives_stock_and_drops_unmatched(wide):
    assert wide.count() == 5
    assert wide.where(F.col("Received_Qty") == 5).select("Remaining_Qty", "Total_Value").first() == (14, 28)


def test_filter_is_inclusive_and_combines(wide):
    recent = dashboard.last_days(wide, dashboard.newest_date(wide))
    assert recent.count() == 4
    assert dashboard.filter_fact(wide, back(31), back(1), ["T"], ["x"]).count() == 1
    assert dashboard.filter_fact(wide, types=[]).count() == 0
    assert dashboard.filter_fact(wide).count() == 5


def test_cards_agree_with_single_panels(wide):
    today = F.lit(TODAY)
    one = dashboard.cards(wide, today).first()
    issued = dashboard.issued_today(wide, today).first()
    assert one.total_inventory_value == dashboard.total_value(wide).first()[0]
    assert (one.issued_today, one.issued_delta) == (issued.issued_today, issued.issued_delta) == (7, 4)
    assert issued.issued_delta_abs == 4
    assert one.n_critical == dashboard.critical_items(wide).first()[0] == 3


def test_empty_selection_gives_zero(wide):
    none = dashboard.filter_fact(wide, types=[])
    assert dashboard.total_value(none).first()[0] == 0
    assert tuple(dashboard.cards(none, F.lit(TODAY)).first()) == (0, 0, 0, 0)
    assert tuple(dashboard.issued_today(none, F.lit(TODAY)).first()) == (0, 0, 0, 0)


def test_today_outside_the_selection_counts_as_zero(wide):
    got = dashboard.issued_today(dashboard.filter_fact(wide, end=back(1)), F.lit(TODAY)).first()
    assert tuple(got) == (0, 3, -3, 3)


def test_top_items_are_shown_ascending(wide):
    got = [tuple(r) for r in dashboard.top_items_by_stock(wide, n=2).collect()]
    assert got == [("b", 8), ("a", 18)]


def test_usage_follows_the_given_order(wide):
    got = [(r.Age_Group, r.Issued_Qty, r.share_pct) for r in dashboard.usage_by_group(wide).collect()]
    assert got == [("0-17", 1, 5.26), ("60+", 9, 47.37), ("other", 9, 47.37)]


def test_trend_vendors_and_options(wide):
    assert [r.Issued_Qty for r in dashboard.demand_trend(wide).collect()] == [9, 0, 3, 7]
    assert [tuple(r) for r in dashboard.vendor_received(wide).collect()] == [("y", 0), ("x", 5)]
    got = [tuple(r) for r in dashboard.filter_options(wide, wide).collect()]
    assert got == [("type", "T"), ("type", "U"), ("vendor", "x"), ("vendor", "y")]


def test_calendar_range_ends_today(spark):
    demand = spark.createDataFrame([(TODAY, 5)], "Date date, Issued_Qty long")
    got = dashboard.calendar_range(F.lit(TODAY), demand, 3).orderBy("Date").collect()
    assert [tuple(r) for r in got] == [
        (back(2), 8, "March", 2025, "Saturday", 0),
        (back(1), 9, "March", 2025, "Sunday", 0),
        (TODAY, 10, "March", 2025, "Monday", 5),
    ]


def test_wide_fact_moves_names_last(spark, wide):
    """Joins on the large dimensions come before the ones that add several texts, if none is broadcast."""
    fact = spark.createDataFrame([(1, 1, 1, 1, 5, 0, 2, 3)], "Medicine_ID int, Staff_ID int, Vendor_ID int, Patient_ID int, Opening_Qty long, Received_Qty long, Issued_Qty long, Unit_Cost long")
    dims = [spark.createDataFrame([(1, "x")], f"{key} int, {text} string") for key, text in (
        ("Medicine_ID", "Medicine_Name"), ("Staff_ID", "Staff_Name"), ("Vendor_ID", "Vendor_Name"), ("Patient_ID", "Age_Group"))]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = dashboard.wide_fact(fact, *dims)
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # outermost first: staff and vendors are joined after items, items after patients
    keys = ["Staff_ID", "Vendor_ID", "Medicine_ID", "Patient_ID"]
    places = [plan.index(f"SortMergeJoin [{k}") for k in keys]
    assert places == sorted(places)
    assert joined.columns == [
        "Patient_ID", "Vendor_ID", "Staff_ID", "Medicine_ID", "Opening_Qty", "Received_Qty", "Issued_Qty", "Unit_Cost",
        "Remaining_Qty", "Total_Value", "Medicine_Name", "Staff_Name", "Vendor_Name", "Age_Group",
    ]


LINK_KEYS = {"Patient_ID": "Visit", "Staff_ID": "Vendor_ID"}


def known_size(spark, names, rows):
    """Rows whose size the planner knows."""
    values = ", ".join("(" + ", ".join("null" if v is None else repr(v) for v in row) + ")" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t({names})")


@pytest.mark.parametrize("limit", ["-1", "1100", "10m"])
def test_links_and_gathering_change_no_rows(spark, limit):
    """Keys found by way of links give the rows of a fact that has them, whatever is broadcast; keys repeat or are null."""
    fact = spark.createDataFrame(
        [(TODAY if n % 3 else None, n % 4, n % 3 or None, n % 5, 9, n, 2, 3) for n in range(60)],
        "Date date, Medicine_ID int, Vendor_ID int, Visit int, Opening_Qty long, Received_Qty long, Issued_Qty long, Unit_Cost long",
    )
    links = {
        "Patient_ID": known_size(spark, "Visit, Patient_ID", [(0, 7), (1, 7), (2, 8), (2, 9), (3, None), (None, 7)]),
        "Staff_ID": known_size(spark, "Vendor_ID, Staff_ID", [(0, 1), (1, 1), (1, 2), (2, 2), (None, 1)]),
    }
    dims = [known_size(spark, f"{key}, {text}", rows) for key, text, rows in (
        ("Medicine_ID", "Medicine_Name", [(0, "a"), (1, "b"), (1, "c"), (None, "d")]), ("Staff_ID", "Staff_Name", [(1, "s"), (2, "t")]),
        ("Vendor_ID", "Vendor_Name", [(0, "x"), (1, "y"), (2, "y"), (None, "z")]),
        ("Patient_ID", "Age_Group", [(n % 9, "g" * (n % 2 + 1)) for n in range(70)]))]
    full = fact
    for key, link in links.items():
        full = full.join(link, LINK_KEYS[key])
    want = dashboard.by_month(dashboard.wide_fact(full.drop("Visit"), *dims))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    try:
        got = dashboard.wide_fact(fact, *dims, links, gathered=True)
        rows = sorted(got.collect(), key=str)
        plan = got._jdf.queryExecution().sparkPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got.columns == want.columns
    assert rows and rows == sorted(want.collect(), key=str)
    above = plan.split("REBALANCE_PARTITIONS_BY_COL")[0].count("Join [")
    assert above == {"-1": 0, "1100": 4, "10m": 6}[limit]  # what is broadcast is joined after the rows are gathered


def test_rows_move_once_for_large_links_and_patients(spark):
    fact = spark.createDataFrame([(TODAY, 1, 1, 5, 9, 1, 2, 3)], "Date date, Medicine_ID int, Vendor_ID int, Visit int, Opening_Qty long, Received_Qty long, Issued_Qty long, Unit_Cost long")
    links = {"Patient_ID": spark.createDataFrame([(5, 7)], "Visit int, Patient_ID int"),
             "Staff_ID": spark.createDataFrame([(1, 1)], "Vendor_ID int, Staff_ID int")}
    items, staff, vendors, patients = (spark.createDataFrame([(1, "x")], f"{key}_ID int, {key}_Name string") for key in ("Medicine", "Staff", "Vendor", "Patient"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = dashboard.wide_fact(fact, items, staff, vendors, patients, links)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    moves = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    # on the way of the fact: by visit, item and vendor
    assert sum("hashpartitioning(Patient_ID" in line for line in moves) == 2 and sum("hashpartitioning(Visit" in line for line in moves) == 2
