"""Dashboard data: the wide fact, its filter and the panels over the filtered frame."""

from collections.abc import Collection, Mapping
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.constants import AGE_GROUPS
from shelfline.functions import ratio, round2
from shelfline.session import fits_broadcast


#: First day of a row's month, the partition column of the written wide table.
MONTH = "Month_Start"


def wide_fact(
    fact: DataFrame,
    items: DataFrame,
    staff: DataFrame,
    vendors: DataFrame,
    patients: DataFrame,
    links: Mapping[str, DataFrame] | None = None,
    gathered: bool = False,
) -> DataFrame:
    """Fact rows with the attributes of all four dimensions, remaining quantity and total value.

    Where the fact lacks the key of a dimension, ``links`` has rows (a key of the
    fact, that key) under its name; they meet a large dimension before the fact,
    which then moves once for both. ``gathered`` rows carry MONTH and are
    gathered by it.

    What is too large to broadcast is joined first, so that the exchanges for it
    and the gathering move keys and quantities but few texts; what follows from
    other columns is added last.
    """
    remaining = F.col("Opening_Qty") + F.col("Received_Qty") - F.col("Issued_Qty")
    order = ["Patient_ID", "Vendor_ID", "Staff_ID", "Medicine_ID"]
    lookups = [("Patient_ID", patients), ("Medicine_ID", items), ("Vendor_ID", vendors), ("Staff_ID", staff)]
    texts = [c for dim in (items, staff, vendors, patients) for c in dim.columns if c not in order]
    large, small, spare = [], [], []
    for key, dim in lookups:
        fits = fits_broadcast(dim)
        if key in (links or {}):
            link = links[key]
            fact_key = next(c for c in link.columns if c != key)
            spare += [fact_key] if fact_key not in order else []
            if fits:
                (small if fits_broadcast(link) else large).append((fact_key, link))
            else:
                key, dim = fact_key, link.join(dim, key)
        (small if fits else large).append((key, dim))
    measures = [c for c in fact.columns if c not in order + spare]
    rows = reduce(lambda r, found: r.join(found[1], found[0]), large, fact)
    if gathered:
        rows = by_month(rows).hint("rebalance", MONTH)
    return (
        reduce(lambda r, found: r.join(found[1], found[0]), small, rows)
        .withColumn("Remaining_Qty", remaining)
        .withColumn("Total_Value", F.col("Remaining_Qty") * F.col("Unit_Cost"))
        .select(*order, *measures, "Remaining_Qty", "Total_Value", *texts, *([MONTH] if gathered else []))
    )


def by_month(wide: DataFrame) -> DataFrame:
    return wide.withColumn(MONTH, F.trunc("Date", "month"))


def newest_date(wide: DataFrame) -> Column:
    return wide.agg(F.max("Date")).scalar()


def filter_fact(
    wide: DataFrame,
    start: Column | date | None = None,
    end: Column | date | None = None,
    types: Collection[str] | None = None,
    vendors: Collection[str] | None = None,
) -> DataFrame:
    """Rows inside an inclusive date range, of the selected types and vendors.

    ``None`` leaves a bound or selection open; an empty selection keeps nothing.
    Rows that carry MONTH, as the written table's partitions do, are filtered by
    it as well, so that only the months of the range are read.
    """
    bounds = [(start, F.col("Date").__ge__, F.col(MONTH).__ge__), (end, F.col("Date").__le__, F.col(MONTH).__le__)]
    for bound, on_date, on_month in bounds:
        if bound is not None:
            bound = bound if isinstance(bound, Column) else F.lit(bound)
            wide = wide.where(on_date(bound))
            if MONTH in wide.columns:
                wide = wide.where(on_month(F.trunc(bound, "month")))
    if types is not None:
        wide = wide.where(F.col("Medicine_Type").isin(list(types)))
    if vendors is not None:
        wide = wide.where(F.col("Vendor_Name").isin(list(vendors)))
    return wide


def last_days(wide: DataFrame, today: Column, days: int = 30) -> DataFrame:
    """The default selection: from ``days`` before today up to today."""
    return filter_fact(wide, F.date_sub(today, days), today)


def total_value(filtered: DataFrame) -> DataFrame:
    """Summed value of all rows; 0 for an empty selection."""
    return filtered.agg(sum_or_0("Total_Value").alias("total_inventory_value"))


def sum_or_0(value: Column | str) -> Column:
    return F.coalesce(F.sum(value), F.lit(0)).cast("bigint")


def issued_on(day: Column) -> Column:
    return sum_or_0(F.when(F.col("Date") == day, F.col("Issued_Qty")))


def issued_today(filtered: DataFrame, today: Column) -> DataFrame:
    """Issued today and yesterday within the selection, in one pass; 0 for days outside it."""
    return (
        filtered.where(F.col("Date").isin(today, F.date_sub(today, 1)))
        .agg(issued_on(today).alias("issued_today"), issued_on(F.date_sub(today, 1)).alias("issued_yesterday"))
        .withColumn("issued_delta", F.col("issued_today") - F.col("issued_yesterday"))
        .withColumn("issued_delta_abs", F.abs("issued_delta"))
    )


def critical_items(filtered: DataFrame) -> DataFrame:
    """Distinct item names with a row whose issued quantity exceeds what remains."""
    return filtered.where(F.col("Issued_Qty") > F.col("Remaining_Qty")).agg(
        F.count_distinct("Medicine_Name").alias("n_critical")
    )


def cards(filtered: DataFrame, today: Column) -> DataFrame:
    """The three headline figures from one scan of the selection.

    Rows are summed per item name first; the distinct count then runs over names.
    """
    yesterday = F.date_sub(today, 1)
    per_name = filtered.groupBy("Medicine_Name").agg(
        F.sum("Total_Value").alias("value"),
        issued_on(today).alias("today"),
        issued_on(yesterday).alias("yesterday"),
        F.coalesce(F.bool_or(F.col("Issued_Qty") > F.col("Remaining_Qty")), F.lit(False)).alias("critical"),
    )
    return per_name.agg(
        sum_or_0("value").alias("total_inventory_value"),
        sum_or_0("today").alias("issued_today"),
        (sum_or_0("today") - sum_or_0("yesterday")).alias("issued_delta"),
        F.count_if(F.col("critical") & F.col("Medicine_Name").isNotNull()).alias("n_critical"),
    )


def top_items_by_stock(filtered: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` items with the largest summed remaining quantity, shown ascending; rows without a name don't count."""
    return (
        filtered.where("Medicine_Name is not null")
        .groupBy("Medicine_Name")
        .agg(F.sum("Remaining_Qty").alias("Remaining_Qty"))
        .orderBy(F.desc("Remaining_Qty"), "Medicine_Name")
        .limit(n)
        .orderBy("Remaining_Qty", F.desc("Medicine_Name"))
    )


def demand_trend(filtered: DataFrame) -> DataFrame:
    """Issued quantity per day; rows without a date don't count."""
    return filtered.where("Date is not null").groupBy("Date").agg(F.sum("Issued_Qty").alias("Issued_Qty")).orderBy("Date")


def usage_by_group(filtered: DataFrame, order: Collection[str] = AGE_GROUPS) -> DataFrame:
    """Issued quantity per customer group with its share, in the given display order.

    Groups outside ``order`` keep their share and come last. The total is taken
    over the already grouped rows. Rows without a group don't count.
    """
    per_group = filtered.where("Age_Group is not null").groupBy("Age_Group").agg(F.sum("Issued_Qty").alias("Issued_Qty"))
    total = per_group.agg(F.sum("Issued_Qty")).scalar()
    rank = F.nullif(F.array_position(F.array(*[F.lit(g) for g in order]), F.col("Age_Group")), F.lit(0))
    return per_group.withColumn(
        "share_pct", round2(ratio(F.col("Issued_Qty").cast("double") * 100.0, total))
    ).orderBy(F.asc_nulls_last(rank), "Age_Group")


def vendor_received(filtered: DataFrame) -> DataFrame:
    """Received quantity per vendor, smallest first; rows without a vendor don't count."""
    return (
        filtered.where("Vendor_Name is not null")
        .groupBy("Vendor_Name")
        .agg(F.sum("Received_Qty").alias("Received_Qty"))
        .orderBy("Received_Qty", "Vendor_Name")
    )


def filter_options(items: DataFrame, vendors: DataFrame) -> DataFrame:
    """Values offered by the type and vendor filters, sorted."""
    types = items.select(F.lit("type").alias("option_kind"), F.col("Medicine_Type").alias("option_value"))
    names = vendors.select(F.lit("vendor").alias("option_kind"), F.col("Vendor_Name").alias("option_value"))
    return types.unionByName(names).distinct().orderBy("option_kind", "option_value")


def calendar_range(end: Column, demand: DataFrame, days: int = 90) -> DataFrame:
    """``days`` consecutive dates up to ``end`` with their attributes and the demand of each, 0 on dates without.

    ``demand`` holds Date and Issued_Qty once a date; dates between come from the range of its own.
    """
    start = F.date_sub(end, days - 1)
    every = demand.agg(F.explode(F.sequence(F.any_value(start), F.any_value(end))).alias("Date"))
    return every.join(demand, "Date", "left").select(
        "Date",
        F.dayofmonth("Date").alias("Day"),
        F.date_format("Date", "MMMM").alias("Month"),
        F.year("Date").alias("Year"),
        F.date_format("Date", "EEEE").alias("Day_of_Week"),
        F.coalesce("Issued_Qty", F.lit(0)).cast("bigint").alias("Issued_Qty"),
    )


def panels(filtered: DataFrame, groups: Collection[str] = AGE_GROUPS) -> DataFrame:
    """The figures of all panels over one selection, as rows (panel, label, value)."""
    return panel_rows(
        total_value(filtered),
        critical_items(filtered),
        top_items_by_stock(filtered),
        demand_trend(filtered),
        usage_by_group(filtered, groups),
        vendor_received(filtered),
    )


def panel_rows(
    total: DataFrame, critical: DataFrame, top: DataFrame, demand: DataFrame, usage: DataFrame, vendors: DataFrame
) -> DataFrame:
    """Each panel's result as rows (panel, label, value)."""

    def rows(df: DataFrame, panel: str, label: Column, value: str) -> DataFrame:
        return df.select(F.lit(panel).alias("panel"), label.cast("string").alias("label"), F.col(value).cast("bigint").alias("value"))

    parts = [
        rows(total, "total_value", F.lit("all"), "total_inventory_value"),
        rows(critical, "critical_items", F.lit("all"), "n_critical"),
        rows(top, "top_items", F.col("Medicine_Name"), "Remaining_Qty"),
        rows(demand, "demand", F.col("Date"), "Issued_Qty"),
        rows(usage, "usage", F.col("Age_Group"), "Issued_Qty"),
        rows(vendors, "vendors", F.col("Vendor_Name"), "Received_Qty"),
    ]
    return reduce(DataFrame.unionByName, parts)
