"""Six KPIs in two families.

``raw_*`` compute from base quantities, ``stored_*`` read the metrics kept in
the fact. They differ on purpose; see each docstring. Sums run per surrogate key
first and names are looked up afterwards, so a dimension join sees one row per
key; row lists carry only keys and the value into the lookup and are cut after
it, since a row without its dimension row doesn't count. Every limited result is
ordered by all its columns, so ties resolve the same way on every run.

Null ratios sort last ascending and first descending.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.constants import BAND_RAW, BAND_STORED, COVERAGE_HIGH, COVERAGE_LOW, CURRENCY_RATE
from shelfline.functions import ratio, round2
from shelfline.plans.warehouse import Star, month_of
from shelfline.schemas import MONTH_ID

NAMES = ["medicine_name", "type_description"]


def latest_fact(star: Star) -> DataFrame:
    """Fact rows of the newest calendar date.

    The date comes from the calendar: if every row of that day was dropped at
    load, the result is empty. Scalar subqueries filter the partition column and
    the date, so only that month's files are opened and most of them skipped.
    """
    newest = star.calendar.agg(F.max_by("date_id_pk", "full_date")).scalar()
    return _months(star.fact, newest).where(F.col("date_id_fk") == newest)


def _months(fact: DataFrame, since: Column) -> DataFrame:
    """Rows from the month of a date id on; a fact that isn't stored by month stays whole."""
    return fact.where(F.col(MONTH_ID) >= month_of(since)) if MONTH_ID in fact.columns else fact


def _with_items(df: DataFrame, star: Star) -> DataFrame:
    items = star.items.select(F.col("medicine_id_pk").alias("medicine_id_fk"), *NAMES, "unit_cost")
    return df.join(items, "medicine_id_fk")


def _with_vendors(df: DataFrame, star: Star) -> DataFrame:
    return df.join(star.vendors.select(F.col("vendor_id_pk").alias("vendor_id_fk"), "vendor_name"), "vendor_id_fk")


def _total(col: str) -> Column:
    return F.sum(F.coalesce(F.col(col), F.lit(0)))


def _rows(fact: DataFrame) -> Column:
    """Fact rows; a fact of sums says how many are behind each of its own."""
    return F.sum("n_rows") if "n_rows" in fact.columns else F.count(F.lit(1))


def _band(days: Column, labels: tuple[str, str, str]) -> Column:
    high, middle, low = labels
    return F.when(days > COVERAGE_HIGH, high).when(days.between(COVERAGE_LOW, COVERAGE_HIGH), middle).otherwise(low)


# --- from base quantities -------------------------------------------------------------------------


def _stock_sums(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(
        _total("opening_qty").alias("opened"), _total("received_qty").alias("received"), _total("issued_qty").alias("issued")
    )


def raw_availability(star: Star, limit: int = 10) -> DataFrame:
    """Lowest share of stock left after issues, per item name and type, newest date."""
    sums = _with_items(_stock_sums(latest_fact(star), "medicine_id_fk"), star)
    supply = F.sum("opened") + F.sum("received")
    share = round2(ratio((supply - F.sum("issued")).cast("double") * 100.0, supply))
    return (
        sums.groupBy(*NAMES)
        .agg(share.alias("stock_availability_pct"))
        .orderBy(F.asc_nulls_last("stock_availability_pct"), *NAMES)
        .limit(limit)
    )


def raw_value(star: Star, rate: int = CURRENCY_RATE) -> DataFrame:
    """Stock quantity and converted value per type, newest date."""
    sums = _with_items(_stock_sums(latest_fact(star), "medicine_id_fk"), star)
    left = F.col("opened") + F.col("received") - F.col("issued")
    worth = left.cast("decimal(20,2)") * F.col("unit_cost")
    return (
        sums.groupBy("type_description")
        .agg(F.sum(left).alias("current_stock_qty"), F.round(F.sum(worth) * rate, 2).alias("total_valuasi_idr"))
        .orderBy(F.desc_nulls_first("total_valuasi_idr"), "type_description")
    )


def _monthly_issued(star: Star) -> DataFrame:
    months = star.calendar.select(F.col("date_id_pk").alias("date_id_fk"), "year", "month", "month_name")
    per_item = (
        star.fact.join(months, "date_id_fk")
        .groupBy("year", "month", "month_name", "medicine_id_fk")
        .agg(_total("issued_qty").alias("issued"))
    )
    return (
        _with_items(per_item, star)
        .groupBy("year", "month", "month_name", "type_description")
        .agg(F.sum("issued").alias("total"))
    )


def raw_monthly_issued(star: Star, limit: int = 20) -> DataFrame:
    """Issued quantity per month and type, earliest months first, largest type first."""
    return (
        _monthly_issued(star)
        .select("year", "month", "month_name", "type_description", F.col("total").alias("total_qty_issued"))
        .orderBy("year", "month", F.desc_nulls_first("total_qty_issued"), "type_description")
        .limit(limit)
    )


def raw_turnover(star: Star, limit: int = 10) -> DataFrame:
    """Highest issued total over mean opening stock, per item name and type, all dates."""
    per_item = star.fact.groupBy("medicine_id_fk").agg(
        _total("issued_qty").alias("issued"), _total("opening_qty").alias("opened"), _rows(star.fact).alias("n")
    )
    mean_open = ratio(F.sum("opened"), F.sum("n"))
    return (
        _with_items(per_item, star)
        .groupBy(*NAMES)
        .agg(
            F.sum("issued").alias("total_issued"),
            round2(mean_open).alias("avg_opening"),
            round2(ratio(F.sum("issued"), mean_open)).alias("turnover_ratio"),
        )
        .orderBy(F.desc_nulls_first("turnover_ratio"), *NAMES)
        .limit(limit)
    )


def raw_coverage(star: Star, limit: int = 15, days: int = 30) -> DataFrame:
    """Lowest days of cover: stock on the newest date over mean issued per fact row since ``days`` before it.

    The window holds ``days + 1`` dates. The band is taken from the unrounded
    value; a null value falls into the last band. One pass over the window's
    partitions gives both the mean and the newest day's stock.
    """
    newest_day = star.calendar.agg(F.max("full_date")).scalar()
    window = star.calendar.where(F.col("full_date") >= F.date_sub(newest_day, days)).select(
        F.col("date_id_pk").alias("date_id_fk"), (F.col("full_date") == newest_day).alias("newest")
    )
    since = window.agg(F.min("date_id_fk")).scalar()
    stock = F.coalesce("opening_qty", F.lit(0)) + F.coalesce("received_qty", F.lit(0)) - F.coalesce("issued_qty", F.lit(0))
    per_item = (
        _months(star.fact, since)
        .join(window, "date_id_fk")
        .groupBy("medicine_id_fk")
        .agg(
            ratio(_total("issued_qty"), F.count(F.lit(1))).alias("avg_issued"),
            F.count_if("newest").alias("n_newest"),
            F.sum(F.when(F.col("newest"), stock)).alias("stock"),
        )
        .where(F.col("n_newest") > 0)
    )
    cover = ratio(F.sum("stock"), F.col("avg_issued"))
    return (
        _with_items(per_item, star)
        .groupBy(*NAMES, "avg_issued")
        .agg(round2(cover).alias("coverage_days"), _band(cover, BAND_RAW).alias("status"))
        .select(*NAMES, "coverage_days", "status")
        .orderBy(F.asc_nulls_last("coverage_days"), *NAMES, "status")
        .limit(limit)
    )


def raw_surplus(star: Star, limit: int = 15) -> DataFrame:
    """Highest share of received stock not issued, per type and vendor; may be negative.

    Vendors without receipts have a null share and come first.
    """
    per_key = star.fact.groupBy("medicine_id_fk", "vendor_id_fk").agg(
        _total("received_qty").alias("received"), _total("issued_qty").alias("issued")
    )
    per_type = (
        _with_items(per_key, star)
        .groupBy("type_description", "vendor_id_fk")
        .agg(F.sum("received").alias("received"), F.sum("issued").alias("issued"))
    )
    received, issued = F.sum("received"), F.sum("issued")
    return (
        _with_vendors(per_type, star)
        .groupBy("type_description", "vendor_name")
        .agg(
            received.alias("total_received"),
            issued.alias("total_issued"),
            round2(ratio((received - issued).cast("double") * 100.0, received)).alias("wastage_ratio_pct"),
        )
        .orderBy(F.desc_nulls_first("wastage_ratio_pct"), "type_description", "vendor_name")
        .limit(limit)
    )


# --- from stored metrics --------------------------------------------------------------------------


def stored_availability(star: Star, limit: int = 10) -> DataFrame:
    """Lowest stored availability among single fact rows of the newest date."""
    return (
        _with_items(latest_fact(star).select("medicine_id_fk", "stock_availability_pct"), star)
        .select(*NAMES, "stock_availability_pct")
        .orderBy(F.asc_nulls_last("stock_availability_pct"), *NAMES)
        .limit(limit)
    )


def stored_value(star: Star, rate: int = CURRENCY_RATE) -> DataFrame:
    """Converted stored value per type, newest date; negative stock counted as 0 at load."""
    per_item = latest_fact(star).groupBy("medicine_id_fk").agg(F.sum("valuasi").alias("worth"))
    return (
        _with_items(per_item, star)
        .groupBy("type_description")
        .agg(F.round(F.sum("worth") * rate, 2).alias("total_valuasi_idr"))
        .orderBy(F.desc_nulls_first("total_valuasi_idr"), "type_description")
    )


def stored_monthly_issued(star: Star, limit: int = 15) -> DataFrame:
    """Issued quantity per month and type; ordered by month, which is not part of the output."""
    return (
        _monthly_issued(star)
        .orderBy("year", "month", F.desc_nulls_first("total"), "type_description")
        .limit(limit)
        .select("year", "month_name", "type_description", F.col("total").alias("total_pengeluaran"))
    )


def stored_turnover(star: Star, limit: int = 10) -> DataFrame:
    """Highest stored turnover among single fact rows of the newest date."""
    return (
        _with_items(latest_fact(star).select("medicine_id_fk", "turnover_ratio"), star)
        .select(*NAMES, "turnover_ratio")
        .orderBy(F.desc_nulls_first("turnover_ratio"), *NAMES)
        .limit(limit)
    )


def stored_coverage(star: Star, limit: int = 15) -> DataFrame:
    """Lowest positive stored coverage on the newest date; the band is taken from the rounded value."""
    days = F.col("stock_coverage_days")
    rows = latest_fact(star).where(days > 0).select("medicine_id_fk", "stock_coverage_days")
    return (
        _with_items(rows, star)
        .select(*NAMES, days, _band(days, BAND_STORED).alias("status"))
        .orderBy(F.asc_nulls_last("stock_coverage_days"), *NAMES)
        .limit(limit)
    )


def stored_surplus(star: Star, limit: int = 15) -> DataFrame:
    """Highest positive stored surplus among single fact rows, all dates."""
    rows = star.fact.where(F.col("wastage_ratio_pct") > 0).select("medicine_id_fk", "vendor_id_fk", "wastage_ratio_pct")
    return (
        _with_vendors(_with_items(rows, star), star)
        .select("type_description", "vendor_name", "wastage_ratio_pct")
        .orderBy(F.desc_nulls_first("wastage_ratio_pct"), "type_description", "vendor_name")
        .limit(limit)
    )
