"""A stored star that takes batches of raw rows: one more file, one more month, a late receipt.

The ledger (``plans/ledger.py``) says which folders are live; a batch writes
only new ones, so a refused or broken-off batch leaves no trace in any result,
and whoever reads while a batch is added sees the star before it. The tables:

* ``moves``: sums per (date, SKU) of each batch, which add up, in date order, so
  that months not asked for are skipped by their files' statistics;
* ``receipts``: vendors per (SKU, date) that a batch brought or changed;
* ``dim_item``, ``dim_vendor``, by hash bucket of the key: a batch rewrites the
  buckets in which a row is new or differs; ``dim_calendar``: dates, added;
* ``item_months``, by month: for each (SKU, month) its number of dates, first
  and last date, and the sums behind turnover. It tells which months a batch
  affects without a look at the history;
* ``fact``, by month, in a folder for each; ``fact_sums``, by month: sums per
  (month, item, vendor); ``fact_checks`` and ``fact_ids``, by month: rule
  violations, and bitmaps of the surrogate ids in use. All four are rewritten
  for affected months only.

A movement affects its SKU's rows of that date and the 29 after it, whose mean
usage changes. A receipt affects its SKU from its date to the next receipt, and
29 dates on. New items and vendors affect all dates of their SKUs. To write a
month again takes the daily sums of that month and of the 29 dates before it.
Turnover depends on an item's whole history, so it is summed from
``item_months`` when the star is read. Stored values keep the unit cost known
when their date was last written.
"""

import datetime as dt
from collections.abc import Callable, Collection, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline import schemas
from shelfline.functions import money, ratio
from shelfline.operators.asof import latest_receipts
from shelfline.operators.merge import bucket_of, changed_rows, top_id, upsert
from shelfline.operators.quality import check_rows, check_unique, report
from shelfline.operators.windows import turnover_ratio
from shelfline.plans import ledger
from shelfline.plans.dims import calendar_from_days, load_items, load_vendors
from shelfline.plans.fact import build_fact
from shelfline.plans.ledger import Layout, Snapshot
from shelfline.plans.warehouse import (
    ENFORCED,
    RefusedLoad,
    by_month,
    check_inputs,
    in_date_order,
    month_of,
    write_daily,
    write_table,
)
from shelfline.schemas import MONTH_ID, QUANTITIES
from shelfline.session import subfolders
from shelfline.sources import RawInputs, clean_items, clean_vendors, type_supply
from shelfline.star import Dims, Star

BUCKET = "bucket"
LAYOUTS = {
    "moves": Layout(),
    "receipts": Layout(),
    "dim_item": Layout(BUCKET, folders=True),
    "dim_vendor": Layout(BUCKET, folders=True),
    "dim_calendar": Layout(),
    "item_months": Layout(MONTH_ID),
    "fact": Layout(MONTH_ID, folders=True),
    "fact_sums": Layout(MONTH_ID),
    "fact_checks": Layout(MONTH_ID),
    "fact_ids": Layout(MONTH_ID),
}
#: Buckets of a dimension; a batch that changes one row rewrites this share of it.
BUCKETS = 16
#: Dates after its own on which a movement has a say.
SPAN = 29


_TEXT, _LONG, _DATE, _DOUBLE, _SUM = T.StringType(), T.LongType(), T.DateType(), T.DoubleType(), T.DecimalType(28, 2)


def _schema(**types: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in types.items()])


_SCHEMAS = {
    "moves": _schema(mat_sku=_TEXT, movement_date=_DATE, **dict.fromkeys(QUANTITIES, _DOUBLE), month_id=T.IntegerType()),
    "receipts": _schema(mat_sku=_TEXT, rcvd_date=_DATE, ven_acc=_TEXT),
    "dim_item": schemas.DIM_ITEM,
    "dim_vendor": schemas.DIM_VENDOR,
    "dim_calendar": schemas.DIM_CALENDAR,
    "item_months": _schema(
        mat_sku=_TEXT, first_day=_DATE, last_day=_DATE, n_dates=_LONG, issued=_DOUBLE, opened=_DOUBLE, n_days=_LONG
    ),
    "fact": schemas.FACT,
    "fact_sums": _schema(
        **dict.fromkeys(schemas.FACT_KEYS, _LONG), **dict.fromkeys(QUANTITIES[:3], _SUM), n_rows=_LONG
    ),
    "fact_checks": _schema(rule=_TEXT, table_name=_TEXT, column_name=_TEXT, violations=_LONG),
    "fact_ids": _schema(column_name=_TEXT, chunk=_LONG, ids=T.BinaryType()),
}

def open_star(spark: SparkSession, path: str) -> Snapshot:
    """The star's live folders just now; later batches don't change what is read through it."""
    return ledger.snapshot(spark, path, LAYOUTS)


def last_batch(spark: SparkSession, path: str) -> int:
    """Id of the newest batch added whole; -1 for none."""
    return open_star(spark, path).batch_id


def _read(spark: SparkSession, snap: Snapshot, table: str, parts: Collection[int | None] | None = None) -> DataFrame:
    return snap.read(spark, table, _SCHEMAS[table], parts)


def _dims(spark: SparkSession, snap: Snapshot) -> Dims:
    items, vendors = (_read(spark, snap, t).drop(BUCKET) for t in ("dim_item", "dim_vendor"))
    return Dims(items, vendors, _read(spark, snap, "dim_calendar"))


def _daily(spark: SparkSession, snap: Snapshot, months: Collection[int]) -> DataFrame:
    """Quantities per (SKU, date) of some months."""
    rows = _read(spark, snap, "moves").where(F.col(MONTH_ID).isin(sorted(months))).drop(MONTH_ID)
    if snap.whole("moves", [None]):
        return rows
    # dealt by SKU, as all that follows is; an item has a row for each date and batch
    return rows.repartition("mat_sku").groupBy("mat_sku", "movement_date").agg(*[F.sum(q).alias(q) for q in QUANTITIES])


def _receipts(spark: SparkSession, snap: Snapshot) -> DataFrame:
    """One vendor per (SKU, date); a later batch may have brought a greater account for the same date."""
    rows = _read(spark, snap, "receipts")
    if snap.whole("receipts", [None]):
        return rows
    return rows.repartition("mat_sku").groupBy("mat_sku", "rcvd_date").agg(F.max("ven_acc").alias("ven_acc"))


def _month(day: Column | str) -> Column:
    return F.year(day) * 100 + F.month(day)


def months_between(first: dt.date, last: dt.date) -> list[int]:
    """Months, as yyyymm, from that of one date to that of another."""
    return [y * 100 + m for y in range(first.year, last.year + 1) for m in range(1, 13) if (first.year, first.month) <= (y, m) <= (last.year, last.month)]


def months_needed(months: Iterable[int]) -> set[int]:
    """The months whose rows have a say in these ones: each and those of the 29 dates before it."""
    out: set[int] = set()
    for month in months:
        first = dt.date(month // 100, month % 100, 1)
        out |= set(months_between(first - dt.timedelta(days=SPAN), first))
    return out


def _together(*actions: Callable[[], object]) -> list:
    """Run independent jobs side by side, as each is too small for all cores; the first failure is raised."""
    with ThreadPoolExecutor(len(actions)) as pool:
        return [done.result() for done in [pool.submit(action) for action in actions]]


def _written_parts(spark: SparkSession, snap: Snapshot, table: str, batch_id: int) -> set[int]:
    """Parts in the folder of a batch."""
    names = subfolders(spark, f"{snap.path}/{table}/batch_id={batch_id}")
    return {int(name.partition("=")[2]) for name in names if name.startswith(f"{LAYOUTS[table].column}=")}


def _of_batch(spark: SparkSession, snap: Snapshot, table: str, batch_id: int) -> DataFrame:
    """What a batch wrote to a table without parts."""
    return _read(spark, snap.without(table, [None]).adding(table, [None], batch_id), table)


# --- dimensions -----------------------------------------------------------------------------------


def _merge_buckets(
    spark: SparkSession, before: Snapshot, table: str, new: DataFrame, key: str, id_col: str, batch_id: int
) -> tuple[set[int], set[int], int]:
    """Write the buckets in which rows are new or differ: those buckets, those of them that hold new keys, and rows."""
    folder = f"{before.path}/{table}/batch_id={batch_id}"
    if before.parts(table):
        old = _read(spark, before, table).drop(BUCKET)
        changed = changed_rows(old, new, key).join(old.select(key, F.lit(True).alias("_known")), key, "left")
        changed = changed.withColumn(BUCKET, bucket_of(key, BUCKETS))
        found = changed.groupBy(BUCKET).agg(F.count_if(F.col("_known").isNull()).alias("n")).collect()  # BUCKETS at most
        if not found:
            return set(), set(), 0
        part = _read(spark, before, table, {r[BUCKET] for r in found}).drop(BUCKET)
        rows = upsert(part, changed.drop("_known", BUCKET), key, id_col, after=top_id(old, id_col))
        fresh = {r[BUCKET] for r in found if r["n"]}
    else:
        rows, fresh = (load_items if table == "dim_item" else load_vendors)(new), None
    rows = rows.select(*_SCHEMAS[table].names).withColumn(BUCKET, bucket_of(key, BUCKETS)).repartition(BUCKET)
    n = write_table(rows, folder, partition_by=BUCKET)
    touched = _written_parts(spark, before, table, batch_id)
    return touched, touched if fresh is None else fresh, n


def _added_keys(spark: SparkSession, before: Snapshot, after: Snapshot, table: str, key: str, buckets: set[int]) -> DataFrame:
    """Keys in these buckets that the star did not hold before."""
    now, old = (_read(spark, s, table, buckets).select(key) for s in (after, before))
    return now.join(old, key, "left_anti")


# --- affected months ------------------------------------------------------------------------------


def _months_in_ranges(ranges: DataFrame, index: DataFrame, months: Collection[int]) -> DataFrame:
    """Months of the index in which a SKU has dates from ``since`` to ``until``, or to the end where that is null.

    Ranges are cut into months first, so that a SKU with many of them doesn't meet each of its months as often.
    """
    lowest, highest = (dt.date(m // 100, m % 100, 1) for m in (min(months), max(months)))
    start = F.greatest(F.trunc("since", "month"), F.lit(lowest))
    end = F.least(F.trunc("until", "month"), F.lit(highest))  # the least of those that aren't null
    pieces = F.when(start <= end, F.sequence(start, end, F.expr("interval 1 month")))
    return (
        ranges.select("mat_sku", "since", "until", F.explode(pieces).alias("_start"))
        .select("mat_sku", "since", "until", _month("_start").alias(MONTH_ID))
        .join(index, ["mat_sku", MONTH_ID])
        .where("last_day >= since and (until is null or first_day <= until)")
        .select(MONTH_ID)
    )


def affected_months(
    spark: SparkSession, before: Snapshot, after: Snapshot, batch_id: int, fresh_items: set[int], fresh_vendors: set[int]
) -> set[int]:
    """Months whose rows a batch may change, from the batch and the index of (SKU, month).

    The index is asked only about months in which the batch has no movements: the others are affected anyway.
    """
    mine = _of_batch(spark, after, "moves", batch_id)
    moved_in = {r[MONTH_ID] for r in mine.select(MONTH_ID).distinct().collect()}  # months
    open_months = before.parts("item_months") - moved_in
    if not open_months:
        return moved_in
    index = _read(spark, before, "item_months", open_months).select("mat_sku", MONTH_ID, "first_day", "last_day")
    moved = mine.groupBy("mat_sku", MONTH_ID).agg(F.max("movement_date").alias("last"))
    until = F.date_add("last", SPAN)
    later = F.sequence(F.trunc(F.add_months("last", 1), "month"), F.trunc(until, "month"), F.expr("interval 1 month"))
    reach = moved.where(F.trunc(until, "month") > F.trunc("last", "month")).select(
        "mat_sku", F.explode(later).alias("_start"), until.alias("until")
    )
    after_moves = (
        reach.select("mat_sku", _month("_start").alias(MONTH_ID), "until")
        .join(index, ["mat_sku", MONTH_ID])
        .where("first_day <= until")
    )
    found = [after_moves.select(MONTH_ID)]
    if batch_id in after.live.get("receipts", {}).get(None, ()):
        new = _of_batch(spark, after, "receipts", batch_id)
        skus = new.select("mat_sku").distinct()
        following = F.lead("rcvd_date").over(Window.partitionBy("mat_sku").orderBy("rcvd_date"))
        ranges = (
            _receipts(spark, after)
            .join(skus, "mat_sku", "left_semi")
            .withColumn("until", F.date_add(following, SPAN))
            .join(new.select("mat_sku", "rcvd_date"), ["mat_sku", "rcvd_date"], "left_semi")
            .select("mat_sku", F.col("rcvd_date").alias("since"), "until")
        )
        found.append(_months_in_ranges(ranges, index, open_months))
    if fresh_items and before.parts("dim_item"):
        items = _added_keys(spark, before, after, "dim_item", "medicine_sku", fresh_items)
        found.append(index.join(items.withColumnRenamed("medicine_sku", "mat_sku"), "mat_sku", "left_semi").select(MONTH_ID))
    if fresh_vendors and before.parts("dim_vendor"):
        vendors = _added_keys(spark, before, after, "dim_vendor", "vendor_account", fresh_vendors)
        skus = _read(spark, after, "receipts").join(vendors.withColumnRenamed("vendor_account", "ven_acc"), "ven_acc", "left_semi")
        found.append(index.join(skus.select("mat_sku"), "mat_sku", "left_semi").select(MONTH_ID))
    months = found[0]
    for more in found[1:]:
        months = months.unionByName(more)
    return moved_in | {r[MONTH_ID] for r in months.distinct().collect()}  # months


# --- what is kept of each month -------------------------------------------------------------------


def _item_months(daily: DataFrame, receipts: DataFrame, months: Collection[int]) -> DataFrame:
    """Dates and turnover sums per (SKU, month); only dates from a SKU's first receipt on have a vendor and count."""
    first = receipts.groupBy("mat_sku").agg(F.min("rcvd_date").alias("_first"))
    supplied = F.col("movement_date") >= F.col("_first")
    return (
        daily.withColumn(MONTH_ID, _month("movement_date"))
        .where(F.col(MONTH_ID).isin(list(months)) & F.col("mat_sku").isNotNull())
        .join(first, "mat_sku", "left")
        .groupBy("mat_sku", MONTH_ID)
        .agg(
            F.min("movement_date").alias("first_day"),
            F.max("movement_date").alias("last_day"),
            F.count(F.lit(1)).alias("n_dates"),
            F.coalesce(F.sum(F.when(supplied, F.col("issued_qty"))), F.lit(0.0)).alias("issued"),
            F.coalesce(F.sum(F.when(supplied, F.col("opening_qty"))), F.lit(0.0)).alias("opened"),
            F.count_if(supplied).alias("n_days"),
        )
    )


def _fact_sums(fact: DataFrame) -> DataFrame:
    """Sums per (month, item, vendor), under the month's first date."""
    return fact.groupBy(MONTH_ID, "medicine_id_fk", "vendor_id_fk").agg(
        F.min("date_id_fk").alias("date_id_fk"),
        *[F.sum(q).cast("decimal(28,2)").alias(q) for q in QUANTITIES[:3]],
        F.count(F.lit(1)).alias("n_rows"),
    )


def _fact_checks(fact: DataFrame) -> DataFrame:
    """Violations of the fact's own rules in each month."""
    rules = schemas.FACT_RULES
    checks = [("not_null", c, F.col(c).isNull()) for c in rules.not_null]
    checks += [("overflow", c, F.abs(F.col(c).cast("double")) >= n) for c, n in rules.max_abs.items()]
    keys = fact.groupBy(MONTH_ID, *rules.key).agg(
        F.count(F.lit(1)).alias("_n"), *[F.count_if(test).alias(f"_{i}") for i, (_, _, test) in enumerate(checks)]
    )
    counted = keys.groupBy(MONTH_ID).agg(
        F.count_if(F.col("_n") > 1).alias("_unique"), *[F.sum(f"_{i}").alias(f"_{i}") for i in range(len(checks))]
    )
    rows = [("unique", "+".join(rules.key), "_unique")] + [(rule, c, f"_{i}") for i, (rule, c, _) in enumerate(checks)]
    listed = [
        F.struct(
            F.lit(rule).alias("rule"),
            F.lit("fact_inventory").alias("table_name"),
            F.lit(column).alias("column_name"),
            F.col(value).cast("long").alias("violations"),
        )
        for rule, column, value in rows
    ]
    return counted.select(MONTH_ID, F.inline(F.array(*listed)))


def _bitmaps(ids: DataFrame, *keys: str) -> DataFrame:
    """Bitmaps of the ids in column id, one for each chunk of some 32,000 of them."""
    return ids.groupBy(*keys, F.bitmap_bucket_number("id").alias("chunk")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("id")).alias("ids")
    )


def _fact_ids(fact: DataFrame) -> DataFrame:
    used = [F.struct(F.lit(c).alias("column_name"), F.col(c).alias("id")) for c in schemas.FACT_KEYS]
    return _bitmaps(fact.select(MONTH_ID, F.inline(F.array(*used))), MONTH_ID, "column_name")


def _orphans(used: DataFrame, dims: Dims) -> DataFrame:
    """Surrogate ids in use that no dimension holds, counted by column.

    Bits that appear only once the used ids join the dimension's are its orphans; no row of the fact is read.
    """
    parents = [
        dims.calendar.select(F.lit("date_id_fk").alias("column_name"), F.col("date_id_pk").alias("id")),
        dims.items.select(F.lit("medicine_id_fk").alias("column_name"), F.col("medicine_id_pk").alias("id")),
        dims.vendors.select(F.lit("vendor_id_fk").alias("column_name"), F.col("vendor_id_pk").alias("id")),
    ]
    known = _bitmaps(report(parents), "column_name").withColumn("_known", F.lit(True))
    both = known.unionByName(used.select("column_name", "chunk", "ids"), allowMissingColumns=True)
    merged = both.groupBy("column_name", "chunk").agg(
        F.bitmap_count(F.bitmap_or_agg("ids")).alias("n_all"),
        F.coalesce(F.sum(F.when(F.col("_known"), F.bitmap_count("ids"))), F.lit(0)).alias("n_known"),
    )
    return merged.groupBy("column_name").agg(F.sum(F.col("n_all") - F.col("n_known")).alias("violations")).select(
        F.lit("reference").alias("rule"), F.lit("fact_inventory").alias("table_name"), "column_name", "violations"
    )


def batch_report(spark: SparkSession, path: str, snap: Snapshot | None = None) -> DataFrame:
    """Every declared rule with its violations, as ``star_report`` gives them, without reading the fact.

    A reference counts ids without a row in the dimension, not the fact rows that hold them.
    """
    snap = snap or open_star(spark, path)
    dims = _dims(spark, snap)
    tables = [
        ("dim_item", dims.items, schemas.ITEM_RULES),
        ("dim_vendor", dims.vendors, schemas.VENDOR_RULES),
        ("dim_calendar", dims.calendar, schemas.CALENDAR_RULES),
    ]
    parts = [check_rows(df, name, rules) for name, df, rules in tables]
    parts += [check_unique(df, name, rules.key) for name, df, rules in tables]
    stored = _read(spark, snap, "fact_checks").groupBy("rule", "table_name", "column_name")
    parts.append(stored.agg(F.sum("violations").alias("violations")))
    return report([*parts, _orphans(_read(spark, snap, "fact_ids"), dims)])


# --- batches --------------------------------------------------------------------------------------


def _refuse_broken(spark: SparkSession, after: Snapshot, months: Collection[int]) -> None:
    """Fail on broken rules in the months just written; the others kept them when they were written."""
    found = report(
        [
            _read(spark, after, "fact_checks", months).drop(MONTH_ID),
            _orphans(_read(spark, after, "fact_ids", months), _dims(spark, after)),
        ]
    )
    broken = [r for r in found.where("violations > 0").collect() if r["rule"] in ENFORCED]  # a row for each rule at most
    if broken:
        raise RefusedLoad("; ".join(sorted({f"{r.rule} {r.column_name}: {r.violations}" for r in broken})))


def _write_batch(spark: SparkSession, raw: RawInputs, before: Snapshot, batch_id: int) -> tuple[Snapshot, dict[str, int]]:
    """Write all folders of a batch; what the star consists of with them, and rows written by table."""
    def receipts() -> int:
        new = latest_receipts(type_supply(raw.supply))
        if before.parts("receipts"):  # only those that change the vendor of their date
            known = _receipts(spark, before).withColumnRenamed("ven_acc", "_had")
            new = new.join(known, ["mat_sku", "rcvd_date"], "left").where("_had is null or ven_acc > _had").drop("_had")
        return write_table(new, here["receipts"])

    here = {table: f"{before.path}/{table}/batch_id={batch_id}" for table in LAYOUTS}
    _, n_moves, n_receipts, items, vendors = _together(
        lambda: check_inputs(raw),
        lambda: write_daily(raw.movements, here["moves"], in_order=True),
        receipts,
        lambda: _merge_buckets(
            spark, before, "dim_item", clean_items(raw.items), "medicine_sku", "medicine_id_pk", batch_id
        ),
        lambda: _merge_buckets(
            spark, before, "dim_vendor", clean_vendors(raw.vendors), "vendor_account", "vendor_id_pk", batch_id
        ),
    )
    after = before.adding("moves", [None], batch_id) if n_moves else before
    if n_receipts:
        after = after.adding("receipts", [None], batch_id)
    after = after.replacing("dim_item", items[0], batch_id).replacing("dim_vendor", vendors[0], batch_id)

    rows = {"moves": n_moves, "receipts": n_receipts, "dim_item": items[2], "dim_vendor": vendors[2], "dim_calendar": 0}

    def calendar() -> int:
        days = calendar_from_days(_of_batch(spark, after, "moves", batch_id))
        known = _read(spark, before, "dim_calendar").select("full_date")
        return write_table(days.join(known, "full_date", "left_anti").coalesce(1), here["dim_calendar"])

    def affected() -> set[int]:
        return affected_months(spark, before, after, batch_id, items[1], vendors[1])

    rows["dim_calendar"], months = _together(calendar, affected)
    if rows["dim_calendar"]:
        after = after.adding("dim_calendar", [None], batch_id)
    if not months:
        return after, rows

    daily = _daily(spark, after, months_needed(months))
    dims, known = _dims(spark, after), _receipts(spark, after)

    def fact() -> int:
        built = build_fact(daily, known, dims.items, dims.calendar, dims.vendors, whole=False)
        return write_table(
            by_month(built.where(month_of(F.col("date_id_fk")).isin(list(months)))), here["fact"], partition_by=MONTH_ID
        )

    def item_months() -> int:
        # the affected months lie wholly within the daily sums, which also hold the 29 dates before them
        # a SKU's first receipt is the same whichever vendor holds a date
        return write_table(_item_months(daily, _read(spark, after, "receipts"), months), here["item_months"])

    rows["fact"], rows["item_months"] = _together(fact, item_months)
    held = _written_parts(spark, after, "fact", batch_id)  # a month may have lost all its rows
    stored = _read(spark, after.without("fact", after.parts("fact")).replacing("fact", held, batch_id), "fact")
    rows["fact_sums"], _, _ = _together(
        lambda: write_table(_fact_sums(stored), here["fact_sums"]),
        lambda: write_table(_fact_checks(stored), here["fact_checks"]),
        lambda: write_table(_fact_ids(stored), here["fact_ids"]),
    )
    for table in ("item_months", "fact_sums", "fact_checks", "fact_ids"):
        after = after.replacing(table, months, batch_id)
    after = after.without("fact", months).replacing("fact", held, batch_id)
    _refuse_broken(spark, after, months)
    return after, rows


def add_batch(spark: SparkSession, raw: RawInputs, path: str, batch_id: int) -> bool:
    """Add a batch to the star under ``path``, the first one making it; False if it was added before.

    Batches are numbered upward from 0, and an id up to the newest one's counts
    as added. Each brings whole master data or what changed, movements not seen
    before, and receipts of which some may be known. Raises RefusedLoad, and
    leaves every result as it was, for unreadable numbers or broken rules.
    """
    before = open_star(spark, path)
    if batch_id <= before.batch_id:
        return False
    try:
        after, rows = _write_batch(spark, raw, before, batch_id)
    except RefusedLoad as refusal:
        ledger.note_refusal(spark, path, batch_id, str(refusal))
        raise
    ledger.commit(spark, after, batch_id, rows)
    return True


def compact(spark: SparkSession, path: str) -> None:
    """Fold what many batches wrote to the tables that have one folder a batch into one each, as a new entry."""
    snap = after = open_star(spark, path)
    folded = -2 - snap.entry  # a name that no batch has
    for table, layout in LAYOUTS.items():
        if layout.folders or len({b for batches in snap.live.get(table, {}).values() for b in batches}) < 2:
            continue
        if table == "moves":
            day = F.col("movement_date")
            rows = in_date_order(_daily(spark, snap, _months(spark, snap)).withColumn(MONTH_ID, _month(day)))
        else:
            rows = _receipts(spark, snap) if table == "receipts" else _read(spark, snap, table)
        write_table(rows, snap.folder(table, folded))
        after = after.without(table, after.parts(table)).replacing(table, snap.parts(table), folded)
    if after is not snap:
        ledger.commit(spark, after, snap.batch_id, {})


def _months(spark: SparkSession, snap: Snapshot) -> set[int]:
    return {r[MONTH_ID] for r in _read(spark, snap, "moves").select(MONTH_ID).distinct().collect()}  # months


def vacuum(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Delete what none of the newest entries of the ledger lists."""
    return ledger.vacuum(spark, path, LAYOUTS, keep)


# --- reading --------------------------------------------------------------------------------------


def _turnover(spark: SparkSession, snap: Snapshot, items: DataFrame) -> DataFrame:
    totals = (
        _read(spark, snap, "item_months")
        .where("n_days > 0")
        .groupBy(F.col("mat_sku").alias("medicine_sku"))
        .agg(F.sum("issued").alias("issued"), F.sum("opened").alias("opened"), F.sum("n_days").alias("n_days"))
    )
    rate = money(turnover_ratio(F.col("issued"), ratio(F.col("opened"), F.col("n_days"))))
    return items.join(totals, "medicine_sku").select(F.col("medicine_id_pk").alias("medicine_id_fk"), rate.alias("turnover_ratio"))


def read_batches(spark: SparkSession, path: str, snap: Snapshot | None = None) -> Star:
    """The star after the newest batch, or as a snapshot of it lists; turnover is summed from the item months."""
    snap = snap or open_star(spark, path)
    if snap.batch_id < 0:
        raise RefusedLoad(f"{path} holds no batch")
    dims = _dims(spark, snap)
    stored = _read(spark, snap, "fact").drop("turnover_ratio")
    fact = stored.join(_turnover(spark, snap, dims.items), "medicine_id_fk").select(*schemas.FACT_STORED.names)
    return Star(dims.items, dims.vendors, dims.calendar, fact)


def read_sums(spark: SparkSession, path: str, snap: Snapshot | None = None) -> Star:
    """The star with sums per (month, item, vendor) in place of its fact: all that the KPIs over whole months need.

    Rewriting a month replaces its sums, so what no longer holds is gone from them.
    """
    snap = snap or open_star(spark, path)
    dims = _dims(spark, snap)
    return Star(dims.items, dims.vendors, dims.calendar, _read(spark, snap, "fact_sums"))
