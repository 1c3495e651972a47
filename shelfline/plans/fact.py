"""The daily inventory fact.

Movements are summed per (date, SKU) before anything else. The as-of join gives
one vendor per (date, SKU), so summing first changes no result, and it means
that the only stage to see raw rows is a map-side combined aggregate. All later
stages hold at most one row per item and date.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline import schemas
from shelfline.functions import money, ratio, round2
from shelfline.operators.asof import asof_carry, asof_rows, latest_receipts
from shelfline.operators.windows import coverage, trailing_mean, turnover, turnover_ratio
from shelfline.schemas import QUANTITIES


def daily_movements(movements: DataFrame, scope: tuple[str, ...] = ()) -> DataFrame:
    """Quantities summed per date and SKU; rows without a date are dropped.

    They are dropped by a count after summing. A filter on the date column would
    be pushed below the projection that parses it, and every date parsed twice.
    ``scope`` adds grouping columns; ``("source_file",)`` confines the item
    measures to one input file each.
    """
    return (
        movements.groupBy(*scope, "mat_sku", "movement_date")
        .agg(*[F.sum(q).alias(q) for q in QUANTITIES], F.count("movement_date").alias("_dated"))
        .where(F.col("_dated") > 0)
        .drop("_dated")
    )


def grouped_fact(daily: DataFrame, supply: DataFrame, scope: tuple[str, ...] = ()) -> DataFrame:
    """Daily rows with the vendor of the latest receipt; rows without one are dropped.

    With a scope a SKU may have many rows on one date, so the vendor is found
    once per (SKU, date) and joined back.
    """
    known, receipts = daily.where(F.col("mat_sku").isNotNull()), latest_receipts(supply)
    if not scope:
        return asof_carry(known, receipts)
    return asof_rows(known, receipts).withColumn("day_number", F.unix_date("movement_date"))


def item_measures(grouped: DataFrame, scope: tuple[str, ...] = (), whole: bool = True) -> DataFrame:
    """Add turnover, 30-day mean usage and coverage. One shuffle and sort by SKU and day serve all of it.

    Rows that aren't the whole history of their items have no turnover; it is 0.
    """
    item = ["mat_sku", *scope]
    return grouped.withColumns(
        {
            "turnover_ratio": turnover(item) if whole else F.lit(0.0),
            "avg_issued_30d": trailing_mean("issued_qty", item, F.col("day_number")),
        }
    ).withColumn("stock_coverage_days", coverage(F.col("closed_qty"), F.col("avg_issued_30d")))


def item_turnover(grouped: DataFrame) -> DataFrame:
    """Turnover of each item as one row per SKU, from partial sums."""
    per_item = grouped.groupBy("mat_sku").agg(
        F.sum("issued_qty").alias("total_issued"), F.avg("opening_qty").alias("avg_opening")
    )
    return per_item.withColumn("turnover_ratio", turnover_ratio(F.col("total_issued"), F.col("avg_opening")))


def rolling_usage(grouped: DataFrame, days: int = 30) -> DataFrame:
    """Daily issued quantity per item with its trailing mean."""
    daily = grouped.groupBy("mat_sku", "movement_date").agg(F.sum("issued_qty").alias("daily_issued"))
    mean = trailing_mean("daily_issued", ["mat_sku"], F.unix_date("movement_date"), days)
    return daily.withColumn("avg_issued_30d", mean)


def row_measures(df: DataFrame) -> DataFrame:
    """Availability, value, spend and surplus of one fact row, from unrounded quantities."""
    opened, received, issued, closed = (F.col(q) for q in QUANTITIES)
    cost = F.col("unit_cost").cast("double")
    zero = F.lit(0.0)
    availability = F.when((opened + received > 0) & (closed > 0), ratio(closed * 100.0, opened + received))
    surplus = F.when(received > issued, ratio((received - issued) * 100.0, received))
    return df.withColumns(
        {
            "stock_availability_pct": F.coalesce(round2(availability), zero),
            "valuasi": F.greatest(zero, closed) * cost,
            "pengeluaran": issued * cost,
            "wastage_ratio_pct": F.coalesce(round2(surplus), zero),
        }
    )


def with_keys(measured: DataFrame, items: DataFrame, calendar: DataFrame, vendors: DataFrame) -> DataFrame:
    """Inner lookups of the surrogate keys and unit cost; rows without a match are dropped.

    No broadcast is forced: the planner broadcasts a dimension whose measured
    size is under its threshold and otherwise joins by sort-merge with skew
    splitting. The item lookup comes first because the rows already sit
    partitioned by SKU.
    """
    return (
        measured.join(
            items.select(
                F.col("medicine_sku").alias("mat_sku"), F.col("medicine_id_pk").alias("medicine_id_fk"), "unit_cost"
            ),
            "mat_sku",
        )
        .join(
            calendar.select(F.col("full_date").alias("movement_date"), F.col("date_id_pk").alias("date_id_fk")),
            "movement_date",
        )
        .join(
            vendors.select(F.col("vendor_account").alias("ven_acc"), F.col("vendor_id_pk").alias("vendor_id_fk")),
            "ven_acc",
        )
    )


def build_fact(
    daily: DataFrame,
    supply: DataFrame,
    items: DataFrame,
    calendar: DataFrame,
    vendors: DataFrame,
    scope: tuple[str, ...] = (),
    keep: tuple[str, ...] = (),
    whole: bool = True,
) -> DataFrame:
    """The fact in its stored types. ``keep`` carries natural-key columns along; ``whole`` as in ``item_measures``."""
    keyed = with_keys(item_measures(grouped_fact(daily, supply, scope), scope, whole), items, calendar, vendors)
    return row_measures(keyed).select(
        *keep, *schemas.FACT_KEYS, *[money(F.col(m)).alias(m) for m in schemas.FACT_MEASURES]
    )
