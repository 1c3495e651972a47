"""The three dimensions, first load and repeated load."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline import schemas
from shelfline.functions import calendar_columns
from shelfline.operators.merge import insert_ignore, upsert
from shelfline.operators.surrogate import assign_ids


def calendar_from_days(days: DataFrame, col: str = "movement_date") -> DataFrame:
    """Calendar row per distinct date of ``days``; missing dates are dropped.

    The key is the date written as yyyymmdd: unique, stable over reloads, and
    ordered like the dates, which keeps fact partitions prunable by range.
    """
    key = (F.year("full_date") * 10000 + F.month("full_date") * 100 + F.dayofmonth("full_date")).cast("bigint")
    return (
        days.groupBy(F.col(col).alias("full_date"))
        .agg(F.count(col).alias("_dated"))
        .where(F.col("_dated") > 0)
        .withColumns({"date_id_pk": key, **calendar_columns(F.col("full_date"))})
        .select(*schemas.DIM_CALENDAR.names)
    )


def load_items(clean: DataFrame, current: DataFrame | None = None) -> DataFrame:
    """Item dimension: new SKUs get ids, known SKUs keep theirs and take the new attributes."""
    if current is None:
        loaded = assign_ids(clean, "medicine_sku", "medicine_id_pk")
    else:
        loaded = upsert(current, clean, "medicine_sku", "medicine_id_pk")
    return loaded.select(*schemas.DIM_ITEM.names)


def load_vendors(clean: DataFrame, current: DataFrame | None = None) -> DataFrame:
    """Vendor dimension, loaded like items."""
    if current is None:
        loaded = assign_ids(clean, "vendor_account", "vendor_id_pk")
    else:
        loaded = upsert(current, clean, "vendor_account", "vendor_id_pk")
    return loaded.select(*schemas.DIM_VENDOR.names)


def load_calendar(days: DataFrame, current: DataFrame | None = None) -> DataFrame:
    """Calendar dimension: dates already present are left alone."""
    loaded = calendar_from_days(days)
    return loaded if current is None else insert_ignore(current, loaded, "full_date")
