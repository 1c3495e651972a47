"""Backward as-of join: for each movement, the vendor of the latest receipt on or before its date.

Two shapes, same result, both free of size assumptions:

* ``asof_carry`` sorts both sides together per key and carries the last value
  forward. One shuffle on the key.
* ``asof_interval`` turns receipts into validity intervals and meets movements
  in one month of one key, where intervals are few.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest_receipts(supply: DataFrame) -> DataFrame:
    """One vendor per (SKU, date): the greatest account wins a same-day tie.

    Receipts without a SKU, date or vendor are dropped, the latter two after
    grouping so that dates are parsed once. Raw rows first collapse to distinct
    triples by a hash aggregate; the maximum of a text, which needs a sort, is
    taken over that small rest.
    """
    distinct = (
        supply.where(F.col("mat_sku").isNotNull())
        .groupBy("mat_sku", "rcvd_date", "ven_acc")
        .agg(F.count("rcvd_date").alias("_dated"))
        .where((F.col("_dated") > 0) & F.col("ven_acc").isNotNull())
    )
    return distinct.groupBy("mat_sku", "rcvd_date").agg(F.max("ven_acc").alias("ven_acc"))


def asof_carry(daily: DataFrame, receipts: DataFrame) -> DataFrame:
    """Add ``ven_acc`` and ``day_number`` to rows of ``daily``; rows without an earlier receipt are dropped.

    Both sides must hold at most one row per (SKU, date), so one key's window
    is bounded by the number of dates, however many raw rows it had.
    The result stays sorted by SKU and ``day_number``, which later windows on
    those columns reuse.
    """
    left = daily.withColumns({"day_number": F.unix_date("movement_date"), "_side": F.lit(1)})
    right = receipts.select(
        "mat_sku", "ven_acc", F.unix_date("rcvd_date").alias("day_number"), F.lit(0).alias("_side")
    )
    so_far = (
        Window.partitionBy("mat_sku")
        .orderBy("day_number", "_side")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        left.unionByName(right, allowMissingColumns=True)
        .withColumn("ven_acc", F.last("ven_acc", ignorenulls=True).over(so_far))
        .where((F.col("_side") == 1) & F.col("ven_acc").isNotNull())
        .select(*daily.columns, "ven_acc", "day_number")
    )


def asof_interval(rows: DataFrame, receipts: DataFrame) -> DataFrame:
    """Row-level as-of join through validity intervals, cut at the ends of months.

    A SKU has at most one interval a date, hence a movement meets at most 31
    pieces and keeps one. The join is on (SKU, month), where adaptive execution
    splits a hot pair. The last interval runs to the last month of movements.
    """
    last = rows.agg(F.max("movement_date")).scalar()
    upto = F.lead("rcvd_date").over(Window.partitionBy("mat_sku").orderBy("rcvd_date"))
    valid = receipts.withColumn("_next", upto)
    end = F.coalesce(F.date_sub("_next", 1), F.greatest(last, F.col("rcvd_date")))
    months = F.sequence(F.trunc("rcvd_date", "month"), F.trunc(end, "month"), F.expr("interval 1 month"))
    pieces = valid.withColumn("_month", F.explode(months))
    within = (F.col("movement_date") >= F.col("rcvd_date")) & (
        F.col("_next").isNull() | (F.col("movement_date") < F.col("_next"))
    )
    left = rows.withColumn("_month", F.trunc("movement_date", "month"))
    return left.join(pieces, ["mat_sku", "_month"]).where(within).select(*rows.columns, "ven_acc")


def asof_rows(rows: DataFrame, receipts: DataFrame) -> DataFrame:
    """Row-level as-of join of any size.

    The vendor is found once per distinct (SKU, date) and joined back on both
    columns, so a SKU with very many rows never sits in one window.
    """
    days = rows.where(F.col("mat_sku").isNotNull()).select("mat_sku", "movement_date").distinct()
    return rows.join(asof_carry(days, receipts), ["mat_sku", "movement_date"]).select(*rows.columns, "ven_acc")
