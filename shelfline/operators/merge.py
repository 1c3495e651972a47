"""Upserts as DataFrame functions: old table + batch -> new table.

Plain Parquet has no row-level merge, so each returns the full next version;
write it to a new path and switch readers to it.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfline.functions import money, ratio, round2
from shelfline.operators.surrogate import assign_ids
from shelfline.operators.windows import coverage, turnover_ratio
from shelfline.schemas import QUANTITIES


def upsert(old: DataFrame, new: DataFrame, key: str, id_col: str, after: Column | None = None) -> DataFrame:
    """Overwrite on conflict: known keys keep their id and take the new attributes.

    ``new`` must hold each key once. One full outer join serves both branches.
    New ids follow the greatest one of ``old``, or ``after`` where ``old`` is
    only a part of a table.
    """
    attributes = [c for c in new.columns if c != key]
    both = (
        old.withColumn("_known", F.lit(True))
        .alias("o")
        .join(new.withColumn("_given", F.lit(True)).alias("n"), key, "full_outer")
        .select(
            F.col(f"o.{id_col}").alias(id_col),
            F.col(key),
            *[F.when(F.col("n._given"), F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c) for c in attributes],
            F.col("o._known").alias("_known"),
        )
    )
    kept = both.where("_known").drop("_known")
    added = both.where("_known is null").drop("_known", id_col)
    return kept.unionByName(assign_ids(added, key, id_col, after=top_id(old, id_col) if after is None else after))


def bucket_of(key: str, buckets: int) -> Column:
    """Bucket of a key, from 0 up; the same one in every load."""
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def changed_rows(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Rows of ``new`` whose key ``old`` doesn't hold, or holds with other attributes."""
    attributes = [c for c in new.columns if c != key]
    had = old.select(key, F.struct(*attributes).alias("_had"))
    same = F.col("_had").eqNullSafe(F.struct(*attributes))
    return new.join(had, key, "left").where(F.col("_had").isNull() | ~same).select(*new.columns)


def insert_ignore(old: DataFrame, new: DataFrame, key: str, id_col: str | None = None) -> DataFrame:
    """Ignore on conflict: known keys stay as they are, new keys are added."""
    added = new.join(old.select(key), key, "left_anti")
    if id_col and id_col not in new.columns:
        added = assign_ids(added, key, id_col, after=top_id(old, id_col))
    return old.unionByName(added.select(*old.columns))


def top_id(old: DataFrame, id_col: str) -> Column:
    return F.coalesce(old.agg(F.max(id_col)).scalar(), F.lit(0))


def accumulate(old: DataFrame, new: DataFrame, keys: list[str], item: str, day: str) -> DataFrame:
    """Add on conflict: two fact versions or batches become one.

    Quantities and money add up. For keys present on both sides availability and
    surplus are recomputed from the added quantities, without the positive-value
    gates of a first load and with 0 for an empty denominator; keys on one side
    keep their stored values. Turnover and coverage are not additive, so they
    are recomputed from the quantities over the whole history of the item.
    """
    additive = [*QUANTITIES, "valuasi", "pengeluaran"]
    summed = (
        old.unionByName(new)
        .groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("_n"),
            *[F.sum(c).cast("decimal(18,2)").alias(c) for c in additive],
            F.max("stock_availability_pct").alias("_availability"),
            F.max("wastage_ratio_pct").alias("_surplus"),
        )
    )
    opened, received, issued, closed = (F.col(c).cast("double") for c in QUANTITIES)
    merged = summed.withColumns(
        {
            "stock_availability_pct": _once("_availability", ratio(closed * 100.0, opened + received)),
            "wastage_ratio_pct": _once("_surplus", ratio((received - issued) * 100.0, received)),
        }
    ).drop("_n", "_availability", "_surplus")
    return with_history(merged, keys, item, day).select(*old.columns)


def _once(stored: str, recomputed: Column) -> Column:
    zero = F.lit(0).cast("decimal(18,2)")
    return F.when(F.col("_n") == 1, F.col(stored)).otherwise(F.coalesce(money(round2(recomputed)), zero))


def with_history(fact: DataFrame, keys: list[str], item: str, day: str, days: int = 30) -> DataFrame:
    """Set turnover and coverage from the stored quantities, over all dates of an item.

    Merged batches may hold several vendors for one item and date, so the mean
    usage divides by dates, not rows: the first row of each date counts as 1.
    All windows share one shuffle and sort by item and date.
    """
    rest = [k for k in keys if k not in (item, day)]
    whole = Window.partitionBy(item)
    recent = Window.partitionBy(item).orderBy("_day").rangeBetween(-(days - 1), Window.currentRow)
    on_day = Window.partitionBy(item, "_day").orderBy(*rest)
    mean_open = ratio(F.sum("opening_qty").over(whole), F.count(F.lit(1)).over(whole))
    mean_usage = ratio(F.sum("issued_qty").over(recent), F.sum("_new_day").over(recent))
    return (
        fact.withColumn("_day", F.unix_date(day))
        .withColumn("_new_day", (F.row_number().over(on_day) == 1).cast("int"))
        .withColumns(
            {
                "turnover_ratio": money(turnover_ratio(F.sum("issued_qty").over(whole), mean_open)),
                "stock_coverage_days": money(coverage(F.col("closed_qty").cast("double"), mean_usage)),
            }
        )
        .drop("_day", "_new_day")
    )
