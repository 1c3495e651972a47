"""Roll-ups of the wide dashboard table, and panels over selections answered from them.

A roll-up keeps the sums of all measures for each combination of some columns;
the finest here are still far smaller than the wide table where items, vendors
and groups repeat within a day. A panel over a selection needs the columns it
shows and those the selection filters by; it reads the smallest roll-up that
has them all, by the row counts noted when they were written.

All sums are written by one job from one exchange of the wide table, in date
order: whole dates lie together, so that each roll-up groups without another.

Distinct critical items are no sum. Their names are numbered, and for each
(date, type, vendor) a bitmap holds the numbers of its critical items; bitmaps
of any selection merge by OR, and the bits of the result are the count. A bitmap
is kept as its words of 64 bits that aren't 0, so that few items take few bytes.
"""

from collections.abc import Collection
from dataclasses import dataclass
from datetime import date

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from shelfline.constants import AGE_GROUPS
from shelfline.operators.surrogate import assign_ids
from shelfline.plans import dashboard
from shelfline.plans.dashboard import MONTH
from shelfline.plans.warehouse import observed, write_table
from shelfline.session import TASK_ROWS, bulk_write

MEASURES = ["Remaining_Qty", "Received_Qty", "Issued_Qty", "Total_Value"]
TYPE, VENDOR, GROUP, NAME = "Medicine_Type", "Vendor_Name", "Age_Group", "Medicine_Name"
#: Columns of each roll-up besides the date.
ROLLUPS = {
    "by_date": (),
    "by_vendor": (VENDOR,),
    "by_group": (GROUP,),
    "by_name": (NAME,),
    "by_type_vendor": (TYPE, VENDOR),
    "by_type_vendor_group": (TYPE, VENDOR, GROUP),
    "by_type_vendor_name": (TYPE, VENDOR, NAME),
}
#: Order of the wide table's rows in which like ones lie together.
ORDER = (MONTH, "Date", TYPE, VENDOR, NAME, GROUP)
CRITICAL = "critical"
#: Folder of the roll-ups, and the column that tells them apart.
SUMS, ROLLUP = "sums", "rollup"
#: Bits in a word of a bitmap.
WORD = 64


@dataclass(frozen=True)
class Rollups:
    """Where the roll-ups lie, and how many rows each has."""

    spark: SparkSession
    path: str
    rows: dict[str, int]

    def read(self, name: str) -> DataFrame:
        if name == CRITICAL:
            return self.spark.read.parquet(f"{self.path}/{CRITICAL}")
        rows = self.spark.read.parquet(f"{self.path}/{SUMS}/{ROLLUP}={name}")
        return rows.select(MONTH, "Date", *ROLLUPS[name], *MEASURES)

    def covering(self, *columns: str) -> str:
        """The smallest roll-up with these columns."""
        able = [n for n, kept in ROLLUPS.items() if set(columns) <= set(kept)]
        if not able:
            raise ValueError(f"no roll-up has {', '.join(columns)}")
        return min(able, key=lambda n: (self.rows[n], n))


def _sums(rows: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    return rows.groupBy(MONTH, "Date", *columns).agg(*[F.sum(m).cast("bigint").alias(m) for m in MEASURES])


def in_date_order(rows: DataFrame, tasks: int | None = None) -> DataFrame:
    """Rows dealt in ranges of dates; a date lies in one task, a month in few."""
    return rows.repartitionByRange(*([tasks] if tasks else []), MONTH, "Date")


def _all_sums(wide: DataFrame, rows: int | None = None) -> DataFrame:
    """The rows of all roll-ups, told apart by ROLLUP; columns that one doesn't have are null.

    Tasks get about as many rows each as they can sum in memory. Adaptive
    execution would merge them by bytes, and like rows take few in a shuffle.
    """
    tasks = 2 + (wide.count() if rows is None else rows) // TASK_ROWS
    # each roll-up starts from the same sums over all columns, hence from the same exchange
    finest = _sums(in_date_order(wide.select(MONTH, "Date", TYPE, VENDOR, GROUP, NAME, *MEASURES), tasks), (TYPE, VENDOR, GROUP, NAME))
    parts = [_sums(finest, columns).withColumn(ROLLUP, F.lit(name)) for name, columns in ROLLUPS.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def critical_bitmaps(wide: DataFrame) -> DataFrame:
    """For each (date, type, vendor) with critical rows, the words of the bitmap of their item names' numbers."""
    short = wide.where((F.col("Issued_Qty") > F.col("Remaining_Qty")) & F.col(NAME).isNotNull())
    numbers = assign_ids(short.select(NAME).distinct(), NAME, "id")
    word = F.floor(F.col("id") / WORD).cast("bigint")
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod("id", F.lit(WORD)).cast("int"))
    numbered = short.select(MONTH, "Date", TYPE, VENDOR, NAME).join(numbers, NAME)
    return (
        in_date_order(numbered.select(MONTH, "Date", TYPE, VENDOR, word.alias("word"), bit.alias("ids")))
        .groupBy(MONTH, "Date", TYPE, VENDOR, "word")
        .agg(F.bit_or("ids").alias("ids"))
    )


def write_rollups(wide: DataFrame, path: str) -> Rollups:
    """Write all roll-ups of a wide table that carries MONTH, partitioned by it."""
    seen, n = Observation(), wide.count()
    counted = _all_sums(wide, n).observe(seen, *[F.count_if(F.col(ROLLUP) == name).alias(name) for name in ROLLUPS])
    with bulk_write(wide.sparkSession, n):
        counted.write.mode("overwrite").partitionBy(ROLLUP, MONTH).parquet(f"{path}/{SUMS}")
        found = observed(seen)
        rows = {name: found.get(name, 0) for name in ROLLUPS}
        rows[CRITICAL] = write_table(critical_bitmaps(wide), f"{path}/{CRITICAL}", partition_by=MONTH)
    return Rollups(wide.sparkSession, path, rows)


@dataclass(frozen=True)
class Selection:
    """Bounds and choices of the dashboard's filters; None leaves one open."""

    start: Column | date | None = None
    end: Column | date | None = None
    types: Collection[str] | None = None
    vendors: Collection[str] | None = None

    def columns(self) -> tuple[str, ...]:
        return tuple(c for c, chosen in ((TYPE, self.types), (VENDOR, self.vendors)) if chosen is not None)

    def of(self, rows: DataFrame) -> DataFrame:
        return dashboard.filter_fact(rows, self.start, self.end, self.types, self.vendors)


def selected(rollups: Rollups, selection: Selection, *shown: str) -> DataFrame:
    """Sums of a selection for a panel that shows these columns, from the smallest roll-up that has what it takes."""
    return selection.of(rollups.read(rollups.covering(*selection.columns(), *shown)))


def critical_items(rollups: Rollups, selection: Selection) -> DataFrame:
    """Distinct critical item names of a selection, by merging bitmaps."""
    merged = (
        selection.of(rollups.read(CRITICAL))
        .groupBy("word")
        .agg(F.bit_count(F.bit_or("ids")).alias("n"))
    )
    return merged.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("n_critical"))


def cards(rollups: Rollups, selection: Selection, today: Column) -> DataFrame:
    """The three headline figures of a selection."""
    figures = selected(rollups, selection).agg(
        dashboard.sum_or_0("Total_Value").alias("total_inventory_value"),
        dashboard.issued_on(today).alias("issued_today"),
        (dashboard.issued_on(today) - dashboard.issued_on(F.date_sub(today, 1))).alias("issued_delta"),
    )
    return figures.withColumn("n_critical", critical_items(rollups, selection).scalar())


def panels(rollups: Rollups, selection: Selection, groups: Collection[str] = AGE_GROUPS) -> DataFrame:
    """The figures of all panels over one selection, as rows (panel, label, value)."""
    plain = selected(rollups, selection)
    return dashboard.panel_rows(
        dashboard.total_value(plain),
        critical_items(rollups, selection),
        dashboard.top_items_by_stock(selected(rollups, selection, NAME)),
        dashboard.demand_trend(plain),
        dashboard.usage_by_group(selected(rollups, selection, GROUP), groups),
        dashboard.vendor_received(selected(rollups, selection, VENDOR)),
    )


def newest_date(rollups: Rollups) -> Column:
    return dashboard.newest_date(rollups.read(rollups.covering()))
