"""Every query by name, over the test tables.

Queries on a loaded warehouse (KPIs, dashboard panels) share one written star
and one written wide table per session and data version, in the session's
shared folder. The others are single lazy plans from the raw views.
"""

from collections.abc import Callable
from threading import RLock

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline.functions import round2
from shelfline.operators import merge
from shelfline.operators.asof import asof_interval, asof_rows, latest_receipts
from shelfline.plans import dashboard, kpis, rollups
from shelfline.plans.dims import calendar_from_days, load_calendar, load_items, load_vendors
from shelfline.plans.fact import build_fact, daily_movements, grouped_fact, item_measures, item_turnover, rolling_usage
from shelfline.plans.quality import input_report, lookup_report, star_report
from shelfline.plans.ledger import load_ledger
from shelfline.plans.star_batches import add_batch, batch_report, last_batch, open_star, read_batches, read_sums
from shelfline.plans.warehouse import (
    TABLES,
    RefusedLoad,
    deploy_schema,
    load_dims,
    load_star,
    read_dims,
    read_star,
    refresh_tables,
    write_table,
)
from shelfline.schemas import FACT_MEASURES, MOVEMENT_RAW
from shelfline.session import bulk_write, discard, shared_dir
from shelfline.sources import (
    RawInputs,
    clean_items,
    clean_movements,
    clean_supply,
    clean_vendors,
    fixtures,
    read_raw,
    stream_files,
    type_movements,
    type_supply,
)
from shelfline.star import Dims, Star
from shelfline.streaming import incremental

Query = Callable[[SparkSession, str], DataFrame]

#: Selections of the dashboard's filters.
SOME_TYPES = ("ECONOMY", "PROMO", "SMALL")
SOME_VENDORS = tuple(f"Supplier#{n:09d}" for n in range(40))

NATURAL_KEYS = ["movement_date", "mat_sku", "ven_acc"]

#: Rows of a file that a stream takes, about; larger tables make more files.
FILE_ROWS = 2_000_000
STREAM_KEYS = ["l_orderkey", "l_linenumber"]

_lock = RLock()  # one written table may ask for another
_written: set[str] = set()
_opened: dict[str, Dims] = {}
_versions: dict[tuple[str, str], str] = {}
_rollups: dict[str, rollups.Rollups] = {}


def _plain(df: DataFrame) -> DataFrame:
    """Decimals as double, for comparison across engines."""
    return df.select(
        *[
            F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


# --- shared written tables ------------------------------------------------------------------------


def _version(spark: SparkSession, sf_dir: str) -> str:
    """Identifies the input files by path, size and time; lists them once a session, without reading."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _versions:
        names = ("customer", "lineitem", "nation", "orders", "part", "region", "supplier")
        files = spark.read.format("binaryFile").load([f"{sf_dir}/{n}.parquet" for n in names])
        stamp = F.bit_xor(F.xxhash64("path", "modificationTime", "length"))
        _versions[key] = f"{files.agg(F.hex(stamp)).first()[0]}"
    return _versions[key]


def _shared(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/shelfline/{spark.sparkContext.applicationId}"


def _folder(spark: SparkSession, sf_dir: str, name: str) -> str:
    return f"{_shared(spark)}/{_version(spark, sf_dir)}/{name}"


def discard_shared(spark: SparkSession) -> None:
    """Delete every table that this session's queries have written; they are written anew when asked for."""
    with _lock:
        discard(spark, _shared(spark))
        _written.clear()
        _opened.clear()
        _versions.clear()
        _rollups.clear()


def _once(path: str, write: Callable[[], object]) -> str:
    with _lock:
        if path not in _written:
            write()
            _written.add(path)
    return path


def star(spark: SparkSession, sf_dir: str) -> Star:
    """The loaded star; loading and listing its files happen on first use."""
    path = _folder(spark, sf_dir, "star")

    def load() -> None:
        load_star(spark, fixtures.raw_inputs(spark, sf_dir), path)
        _opened[path] = read_star(spark, path)

    _once(path, load)
    return _opened[path]


def dims(spark: SparkSession, sf_dir: str) -> Dims:
    """The written dimensions alone, for queries that build a fact themselves."""
    path = _folder(spark, sf_dir, "dims")

    def load() -> None:
        raw = fixtures.raw_inputs(spark, sf_dir)
        load_dims(spark, raw, type_movements(raw.movements), path)
        _opened[path] = read_dims(spark, path)

    _once(path, load)
    return _opened[path]


def wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The written wide dashboard table, partitioned by month so that date filters read the months they need."""
    path = _folder(spark, sf_dir, "wide")

    def write() -> None:
        rows = fixtures.dashboard_wide(spark, sf_dir, gathered=True).sortWithinPartitions(*rollups.ORDER)
        with bulk_write(spark, fixtures.table(spark, sf_dir, "lineitem").count()):
            rows.write.mode("overwrite").partitionBy(dashboard.MONTH).parquet(path)

    _once(path, write)
    return spark.read.parquet(path)


def wide_today(spark: SparkSession, sf_dir: str) -> Column:
    """Newest date of the wide table, from its own small table of dates."""
    path = _folder(spark, sf_dir, "wide_days")
    _once(path, lambda: wide(spark, sf_dir).select("Date").distinct().write.mode("overwrite").parquet(path))
    return dashboard.newest_date(spark.read.parquet(path))


# --- dimensions -----------------------------------------------------------------------------------


def _items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_items(fixtures.raw_items(spark, sf_dir))


def _vendors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_vendors(fixtures.raw_vendors(spark, sf_dir))


def _movements(spark: SparkSession, sf_dir: str, *keep: str) -> DataFrame:
    return type_movements(fixtures.raw_movements(spark, sf_dir), keep)


def _supply(spark: SparkSession, sf_dir: str) -> DataFrame:
    return type_supply(fixtures.raw_supply(spark, sf_dir))


def dim_item(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(load_items(_items(spark, sf_dir)).drop("medicine_id_pk"))


def dim_vendor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_vendors(_vendors(spark, sf_dir)).drop("vendor_id_pk")


def dim_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_calendar(_movements(spark, sf_dir))


def surrogate_key_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row count, distinct ids and id range of each written dimension."""
    loaded = star(spark, sf_dir)

    def summary(df: DataFrame, name: str, key: str) -> DataFrame:
        return df.agg(
            F.lit(name).alias("table_name"),
            F.count(F.lit(1)).alias("n_rows"),
            F.count_distinct(key).alias("n_ids"),
            F.min(key).alias("min_id"),
            F.max(key).alias("max_id"),
        )

    return (
        summary(loaded.items, "dim_item", "medicine_id_pk")
        .unionByName(summary(loaded.vendors, "dim_vendor", "vendor_id_pk"))
        .unionByName(summary(loaded.calendar, "dim_calendar", "date_id_pk"))
    )


# --- fact and its stages --------------------------------------------------------------------------


def movement_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_movements(fixtures.raw_movements(spark, sf_dir))


def supply_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_supply(fixtures.raw_supply(spark, sf_dir))


def asof_vendor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return asof_rows(_movements(spark, sf_dir), latest_receipts(_supply(spark, sf_dir)))


def asof_vendor_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    return asof_interval(_movements(spark, sf_dir), latest_receipts(_supply(spark, sf_dir)))


def _grouped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grouped_fact(daily_movements(_movements(spark, sf_dir)), _supply(spark, sf_dir))


def fact_grouped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _grouped(spark, sf_dir).drop("day_number")


def fact_turnover(spark: SparkSession, sf_dir: str) -> DataFrame:
    rated = item_turnover(_grouped(spark, sf_dir))
    return rated.select("mat_sku", "total_issued", round2(F.col("avg_opening")).alias("avg_opening"), "turnover_ratio")


def fact_rolling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rolling_usage(_grouped(spark, sf_dir)).withColumn("avg_issued_30d", round2(F.col("avg_issued_30d")))


def coverage_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    measured = item_measures(_grouped(spark, sf_dir))
    return measured.select(*NATURAL_KEYS, "closed_qty", "stock_coverage_days")


def _natural_fact(spark: SparkSession, sf_dir: str, movements: DataFrame, scope: tuple[str, ...] = ()) -> DataFrame:
    """The fact with natural keys: one plan from raw movements and receipts over the written dimensions."""
    known = dims(spark, sf_dir)
    keep = (*scope, *NATURAL_KEYS)
    daily = daily_movements(movements, scope)
    fact = build_fact(daily, _supply(spark, sf_dir), known.items, known.calendar, known.vendors, scope, keep)
    return fact.select(*keep, *FACT_MEASURES)


def fact_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(_natural_fact(spark, sf_dir, _movements(spark, sf_dir)))


def fact_per_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact with item measures confined to each source file."""
    return _plain(_natural_fact(spark, sf_dir, _movements(spark, sf_dir, "source_file"), ("source_file",)))


def _natural(loaded: Star) -> DataFrame:
    """A star's fact, resolved back to natural keys."""
    return _plain(
        loaded.fact.join(
            loaded.calendar.select(F.col("date_id_pk").alias("date_id_fk"), F.col("full_date").alias("movement_date")),
            "date_id_fk",
        )
        .join(
            loaded.items.select(F.col("medicine_id_pk").alias("medicine_id_fk"), F.col("medicine_sku").alias("mat_sku")),
            "medicine_id_fk",
        )
        .join(
            loaded.vendors.select(
                F.col("vendor_id_pk").alias("vendor_id_fk"), F.col("vendor_account").alias("ven_acc")
            ),
            "vendor_id_fk",
        )
        .select(*NATURAL_KEYS, *FACT_MEASURES)
    )


def fact_loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The written fact, resolved back to natural keys."""
    return _natural(star(spark, sf_dir))


# --- merging --------------------------------------------------------------------------------------


def upsert_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load without economy items, then a full load with raised costs: known SKUs keep their id."""
    full = _items(spark, sf_dir)
    before = load_items(full.where(F.col("type_description") != "ECONOMY"))
    raised = full.withColumn("unit_cost", (F.col("unit_cost") + 1).cast("decimal(18,2)"))
    after = load_items(raised, before)
    ids = before.select("medicine_sku", F.col("medicine_id_pk").alias("old_id"))
    return _plain(
        after.join(ids, "medicine_sku", "left")
        .withColumn("kept_id", F.coalesce(F.col("old_id") == F.col("medicine_id_pk"), F.lit(False)))
        .withColumn("clashing_id", F.col("old_id").isNull() & (F.col("medicine_id_pk") <= ids.agg(F.max("old_id")).scalar()))
        .drop("old_id", "medicine_id_pk")
    )


def upsert_ignore(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A calendar of the first half-year with upper-case names, then all dates: known dates stay as they are."""
    everything = calendar_from_days(_movements(spark, sf_dir))
    early = everything.where(F.col("month") <= 6).withColumn("month_name", F.upper("month_name"))
    return merge.insert_ignore(early, everything, "full_date")


def accumulate_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The facts of two batches of movements, added up."""
    rows = _movements(spark, sf_dir, "batch")
    old, new = (_natural_fact(spark, sf_dir, rows.where(F.col("batch") == b)) for b in ("A", "R"))
    return _plain(merge.accumulate(old, new, NATURAL_KEYS, "mat_sku", "movement_date"))


def stream_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Movements ingested file by file by an available-now stream, then the grouped fact from the stored sums."""
    path = _folder(spark, sf_dir, "stream")

    def run() -> None:
        lines = fixtures.table(spark, sf_dir, "lineitem")
        files = max(4, lines.count() // FILE_ROWS)
        lines.repartition(files, *STREAM_KEYS).write.mode("overwrite").parquet(f"{path}/files")
        files = spark.readStream.schema(lines.schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/files")
        incremental.ingest(fixtures.movement_rows(files), f"{path}/daily", f"{path}/checkpoint").awaitTermination()

    _once(path, run)
    return grouped_fact(incremental.read_daily(spark, f"{path}/daily"), _supply(spark, sf_dir)).drop("day_number")


def fact_from_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The loaded fact of a star read from CSV files, the movement files in two column orders."""
    path = _folder(spark, sf_dir, "csv")

    def run() -> None:
        raw = fixtures.raw_inputs(spark, sf_dir)
        moves = raw.movements.select("batch", *MOVEMENT_RAW.names)
        frames = {
            "items": raw.items,
            "vendors": raw.vendors,
            "supply": raw.supply,
            "movements/a": moves.where("batch = 'A'"),
            "movements/r": moves.where("batch = 'R'").select(*reversed(moves.columns)),
        }
        for name, frame in frames.items():
            frame.write.mode("overwrite").csv(f"{path}/{name}", header=True, quote='"', escape='"')
        inputs = read_raw(spark, f"{path}/items", f"{path}/vendors", f"{path}/supply", f"{path}/movements/*")
        load_star(spark, inputs, f"{path}/star")

    _once(path, run)
    return _natural(read_star(spark, f"{path}/star"))


def _batched(spark: SparkSession, sf_dir: str) -> str:
    """Path of a star that took three batches, a base, more movements, and late receipts with the rest, and refused one."""
    path = _folder(spark, sf_dir, "batches")

    def run() -> None:
        raw = fixtures.raw_inputs(spark, sf_dir)
        late = F.crc32("VEN_ACC") % 3 == 0
        first, rest = F.col("batch") == "A", F.col("MAT_SKU") < "M5"
        junk = fixtures.text_movements(spark, sf_dir)
        parts = [
            (raw.movements.where(first), raw.supply.where(~late | F.col("VEN_ACC").isNull())),
            (raw.movements.where(~first & ~rest), raw.supply.limit(0)),
            (junk, raw.supply),
            (raw.movements.where(~first & rest), raw.supply.where(late)),
        ]
        for number, (movements, supply) in enumerate(parts):
            try:
                add_batch(spark, RawInputs(raw.items, raw.vendors, supply, movements), path, number)
            except RefusedLoad:
                if movements is not junk:
                    raise

    return _once(path, run)


def star_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact of a star that took three batches and refused one with unreadable numbers."""
    return _natural(read_batches(spark, _batched(spark, sf_dir)))


def batch_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule violations of that star, from what its batches noted of each month."""
    return batch_report(spark, _batched(spark, sf_dir))


def batch_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that each batch of that star wrote, and the batch that was refused."""
    rows = load_ledger(spark, _batched(spark, sf_dir))
    counted = ("moves", "dim_item", "dim_vendor", "dim_calendar")
    return rows.where(F.col("table_name").isin(*counted) | F.col("table_name").isNull()).drop("reason")


def _sums_kpi(build: Callable[[Star], DataFrame]) -> Query:
    """A KPI of that star from its sums per (month, item, vendor), without the fact."""
    return lambda spark, sf_dir: _plain(build(read_sums(spark, _batched(spark, sf_dir))))


def stream_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact of a star that an available-now stream of CSV files built, a third a batch, one batch sent twice.

    The files have their columns in two orders, and each is read by its own header. A third is one file, or as many
    as its rows need: one task can't write them all, and a batch for each would write the star's history as often.
    """
    path = _folder(spark, sf_dir, "stream_star")

    def run() -> None:
        raw = fixtures.raw_inputs(spark, sf_dir)
        moves = raw.movements.select(*MOVEMENT_RAW.names)
        third = F.pmod(F.xxhash64("MAT_SKU"), F.lit(3))
        files_a_third = max(1, fixtures.table(spark, sf_dir, "lineitem").count() // 3 // FILE_ROWS)
        for number, columns in enumerate((moves.columns, moves.columns[::-1], moves.columns)):
            part = moves.where(third == number).select(*columns).coalesce(files_a_third)
            part.write.mode("overwrite").csv(f"{path}/files/part={number}", header=True, quote='"', escape='"')
        files = stream_files(spark, f"{path}/files/*", files_a_third)
        incremental.ingest_star(files, lambda: raw, f"{path}/star", f"{path}/checkpoint").awaitTermination()
        newest = last_batch(spark, f"{path}/star")
        assert not add_batch(spark, raw, f"{path}/star", newest)  # as a stream does that ended before its own commit

    _once(path, run)
    return _natural(read_batches(spark, f"{path}/star"))


def append_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily sums of two batches appended to one table, which knows no keys, and the rows that each write counted."""
    path = _folder(spark, sf_dir, "appended")

    def run() -> None:
        rows = _movements(spark, sf_dir, "batch")
        for name in ("A", "R"):
            part = daily_movements(rows.where(F.col("batch") == name)).withColumn("batch", F.lit(name))
            n = write_table(part, f"{path}/daily", "append")
            counted = spark.createDataFrame([(name, n)], "batch string, n_written long")
            write_table(counted, f"{path}/loads", "append")

    _once(path, run)
    loads = spark.read.parquet(f"{path}/loads")
    sums = spark.read.parquet(f"{path}/daily").groupBy("batch").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("issued_qty").alias("issued_qty")
    )
    return sums.join(loads, "batch")


def catalog_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the star's tables as the catalog has them, one total through a join in SQL."""
    path, name = _folder(spark, sf_dir, "star"), f"shelfline_{_version(spark, sf_dir).lower()}"
    star(spark, sf_dir)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")
    deploy_schema(spark, path, name, replace=True)
    refresh_tables(spark, name)
    counts = [f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {name}.{t}" for t in TABLES]
    joined = f"""SELECT 'joined' AS table_name, count(*) AS n_rows FROM {name}.fact_inventory f
        JOIN {name}.dim_item i ON f.medicine_id_fk = i.medicine_id_pk
        JOIN {name}.dim_calendar c ON f.date_id_fk = c.date_id_pk AND f.month_id = c.year * 100 + c.month"""
    return spark.sql(" UNION ALL ".join([*counts, joined]))


def item_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items of a star after a batch that raises the cost of one of them: all buckets but one keep their files."""
    path = _folder(spark, sf_dir, "item_buckets")

    def run() -> None:
        raw = fixtures.raw_inputs(spark, sf_dir)
        moves, supply = raw.movements.where(F.col("batch") == "A"), raw.supply.limit(0)
        add_batch(spark, RawInputs(raw.items, raw.vendors, supply, moves.limit(0)), path, 0)
        one = F.col("MED_ID") == raw.items.agg(F.min("MED_ID")).scalar()
        raised = raw.items.where(one).withColumn("COST_UN", F.coalesce("COST_UN", F.lit(0.0)) + 1)
        add_batch(spark, RawInputs(raised, raw.vendors, supply, moves.limit(0)), path, 1)

    _once(path, run)
    rewritten = [batches for batches in open_star(spark, path).live["dim_item"].values() if batches != (0,)]
    if rewritten != [(1,)]:
        raise RuntimeError("a bucket without a change was written again")
    return _plain(read_batches(spark, path).items.drop("medicine_id_pk"))


# --- roll-ups -------------------------------------------------------------------------------------


def dashboard_rollups(spark: SparkSession, sf_dir: str) -> rollups.Rollups:
    """The written roll-ups of the wide table."""
    path = _folder(spark, sf_dir, "rollups")
    _once(path, lambda: _rollups.__setitem__(path, rollups.write_rollups(wide(spark, sf_dir), path)))
    return _rollups[path]


def _chosen(spark: SparkSession, sf_dir: str) -> rollups.Selection:
    today = rollups.newest_date(dashboard_rollups(spark, sf_dir))
    return rollups.Selection(F.date_sub(today, 900), F.date_sub(today, 350), SOME_TYPES, SOME_VENDORS)


def rollup_panels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All panels over one selection of dates, types and vendors, without the wide table."""
    return rollups.panels(dashboard_rollups(spark, sf_dir), _chosen(spark, sf_dir), fixtures.SEGMENTS)


def rollup_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The headline figures of the default selection from the smallest roll-up and merged bitmaps."""
    tables = dashboard_rollups(spark, sf_dir)
    today = rollups.newest_date(tables)
    return rollups.cards(tables, rollups.Selection(F.date_sub(today, 30), today), today)


def rollup_critical_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct critical items of all dates, by merging one bitmap for each date, type and vendor."""
    return rollups.critical_items(dashboard_rollups(spark, sf_dir), rollups.Selection())


def input_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unreadable numbers and missing keys of raw inputs whose numbers are text."""
    raw = fixtures.raw_inputs(spark, sf_dir)
    texts = RawInputs(
        fixtures.text_items(spark, sf_dir), raw.vendors, raw.supply, fixtures.text_movements(spark, sf_dir)
    )
    return input_report(texts)


def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star_report(star(spark, sf_dir))


def lookup_losses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookup_report(_grouped(spark, sf_dir), star(spark, sf_dir))


# --- KPIs and dashboard ---------------------------------------------------------------------------


def _kpi(build: Callable[[Star], DataFrame]) -> Query:
    return lambda spark, sf_dir: _plain(build(star(spark, sf_dir)))


def _panel(build: Callable[[DataFrame], DataFrame]) -> Query:
    """A panel over the whole wide table: an open date range, all types and vendors."""
    return lambda spark, sf_dir: build(dashboard.filter_fact(wide(spark, sf_dir)))


def wide_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.dashboard_wide(spark, sf_dir)


def filtered_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The default selection: the last 30 days, all types and vendors."""
    return dashboard.last_days(wide(spark, sf_dir), wide_today(spark, sf_dir)).drop(dashboard.MONTH)


def filtered_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    today = wide_today(spark, sf_dir)
    return dashboard.cards(dashboard.last_days(wide(spark, sf_dir), today), today)


def dashboard_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.cards(wide(spark, sf_dir), wide_today(spark, sf_dir))


def issued_today_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.issued_today(wide(spark, sf_dir), wide_today(spark, sf_dir))


def _selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A year and a half of dates, some types, some vendors."""
    today = wide_today(spark, sf_dir)
    rows = wide(spark, sf_dir)
    return dashboard.filter_fact(rows, F.date_sub(today, 900), F.date_sub(today, 350), SOME_TYPES, SOME_VENDORS)


def filtered_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _selection(spark, sf_dir).drop(dashboard.MONTH)


def filtered_panels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All panels over one selection of dates, types and vendors."""
    return dashboard.panels(_selection(spark, sf_dir), fixtures.SEGMENTS)


def filter_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.filter_options(fixtures.dashboard_items(spark, sf_dir), fixtures.dashboard_vendors(spark, sf_dir))


def dashboard_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last 90 dates with the quantity issued on each."""
    rows, today = wide(spark, sf_dir), wide_today(spark, sf_dir)
    demand = dashboard.demand_trend(dashboard.filter_fact(rows, F.date_sub(today, 89), today))
    return dashboard.calendar_range(today, demand)


QUERIES: dict[str, Query] = {
    "dim_item": dim_item,
    "dim_vendor": dim_vendor,
    "dim_calendar": dim_calendar,
    "surrogate_key_check": surrogate_key_check,
    "movement_clean": movement_clean,
    "supply_clean": supply_clean,
    "asof_vendor": asof_vendor,
    "asof_vendor_interval": asof_vendor_interval,
    "fact_grouped": fact_grouped,
    "item_turnover": fact_turnover,
    "rolling_usage": fact_rolling,
    "coverage_days": coverage_days,
    "fact_inventory": fact_inventory,
    "fact_per_file": fact_per_file,
    "fact_loaded": fact_loaded,
    "kpi_raw_1": _kpi(kpis.raw_availability),
    "kpi_raw_2": _kpi(kpis.raw_value),
    "kpi_raw_3": _kpi(kpis.raw_monthly_issued),
    "kpi_raw_4": _kpi(kpis.raw_turnover),
    "kpi_raw_5": _kpi(kpis.raw_coverage),
    "kpi_raw_6": _kpi(kpis.raw_surplus),
    "kpi_mat_1": _kpi(kpis.stored_availability),
    "kpi_mat_2": _kpi(kpis.stored_value),
    "kpi_mat_3": _kpi(kpis.stored_monthly_issued),
    "kpi_mat_4": _kpi(kpis.stored_turnover),
    "kpi_mat_5": _kpi(kpis.stored_coverage),
    "kpi_mat_6": _kpi(kpis.stored_surplus),
    "wide_fact": wide_fact,
    "filtered_fact": filtered_fact,
    "filtered_cards": filtered_cards,
    "filtered_selection": filtered_selection,
    "filtered_panels": filtered_panels,
    "dashboard_cards": dashboard_cards,
    "total_value": _panel(dashboard.total_value),
    "issued_today_delta": issued_today_delta,
    "critical_items": _panel(dashboard.critical_items),
    "top_items_by_stock": _panel(dashboard.top_items_by_stock),
    "demand_trend": _panel(dashboard.demand_trend),
    "usage_by_segment": _panel(lambda rows: dashboard.usage_by_group(rows, fixtures.SEGMENTS)),
    "vendor_received": _panel(dashboard.vendor_received),
    "filter_options": filter_options,
    "dashboard_calendar": dashboard_calendar,
    "upsert_overwrite": upsert_overwrite,
    "upsert_ignore": upsert_ignore,
    "accumulate_load": accumulate_load,
    "stream_daily": stream_daily,
    "star_incremental": star_incremental,
    "batch_quality": batch_quality,
    "batch_loads": batch_loads,
    "sums_kpi_raw_3": _sums_kpi(kpis.raw_monthly_issued),
    "sums_kpi_raw_4": _sums_kpi(kpis.raw_turnover),
    "sums_kpi_raw_6": _sums_kpi(kpis.raw_surplus),
    "sums_kpi_mat_3": _sums_kpi(kpis.stored_monthly_issued),
    "stream_star": stream_star,
    "append_load": append_load,
    "catalog_tables": catalog_tables,
    "item_buckets": item_buckets,
    "rollup_panels": rollup_panels,
    "rollup_cards": rollup_cards,
    "rollup_critical_items": rollup_critical_items,
    "fact_from_csv": fact_from_csv,
    "input_report": input_problems,
    "quality_report": quality_report,
    "lookup_losses": lookup_losses,
}
