"""Load, write and read the star."""

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline import schemas
from shelfline.operators.quality import problem_counts
from shelfline.plans.dims import load_calendar, load_items, load_vendors
from shelfline.plans.fact import build_fact, daily_movements
from shelfline.plans.quality import input_report, star_report
from shelfline.sources import NUMBERS, RawInputs, clean_items, clean_vendors, parsed_numbers, type_movements, type_supply
from shelfline.star import Dims, Star


class RefusedLoad(Exception):
    """A load whose input or result breaks the rules; nothing of it can be read."""


#: Share of unreadable numbers in a column that a load accepts, counting them as 0.
TOLERANCE = 0.0
#: Rules that a published star keeps; lengths and overflows are only reported.
ENFORCED = ("not_null", "unique", "reference")

TABLES = {
    "dim_item": schemas.DIM_ITEM,
    "dim_vendor": schemas.DIM_VENDOR,
    "dim_calendar": schemas.DIM_CALENDAR,
    "fact_inventory": schemas.FACT_STORED,
}
DIM_TABLES = ("dim_item", "dim_vendor", "dim_calendar")
PUBLISHED = "_published"


def write_table(df: DataFrame, path: str, mode: str = "overwrite", partition_by: str | None = None) -> int:
    """Write Parquet and return the row count, observed during the write itself."""
    seen = Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    writer = counted.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    return observed(seen).get("rows", 0)


def observed(seen: Observation) -> dict[str, int]:
    """Metrics of a finished write; none where Spark knew the input to be empty and left the counting out of the plan."""
    try:
        return seen.get
    except Py4JJavaError:
        return {}


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read a written table under its declared schema."""
    return spark.read.schema(schema).parquet(path)


def write_fact(fact: DataFrame, path: str, mode: str = "overwrite") -> int:
    """Write the fact partitioned by month and sorted by date, so that a date filter skips most of a month's files.

    The rebalance hint gathers each month into few files and, with adaptive
    execution, splits a month that is far larger than the others.
    """
    return write_table(by_month(fact), path, mode, partition_by=schemas.MONTH_ID)


def month_of(date_id: Column) -> Column:
    return F.floor(date_id / 100).cast("int")


def by_month(fact: DataFrame) -> DataFrame:
    """Fact rows gathered for writing by month."""
    rows = fact.select(*schemas.FACT.names, month_of(F.col("date_id_fk")).alias(schemas.MONTH_ID))
    return rows.hint("rebalance", schemas.MONTH_ID).sortWithinPartitions(schemas.MONTH_ID, "date_id_fk")


def read_star(spark: SparkSession, path: str) -> Star:
    """A published star; fails for one whose load didn't end or was refused."""
    try:
        spark.read.parquet(f"{path}/{PUBLISHED}").schema  # noqa: B018  opening it is the check
    except AnalysisException as error:
        raise RefusedLoad(f"{path} holds no published star") from error
    return _open_star(spark, path)


def _open_star(spark: SparkSession, path: str) -> Star:
    return Star(*(read_table(spark, f"{path}/{name}", schema) for name, schema in TABLES.items()))


def publish(spark: SparkSession, path: str) -> None:
    """Make a written star readable if it keeps the enforced rules."""
    broken = star_report(_open_star(spark, path)).where("violations > 0").collect()  # a row for each rule at most
    broken = [r for r in broken if r["rule"] in ENFORCED]
    if broken:
        raise RefusedLoad("; ".join(f"{r.rule} {r.table_name}.{r.column_name}: {r.violations}" for r in broken))
    spark.range(1).write.mode("overwrite").parquet(f"{path}/{PUBLISHED}")


def deploy_schema(spark: SparkSession, path: str, database: str = "default", *, replace: bool = False) -> None:
    """Create the star tables over ``path`` in the catalog where they do not exist yet, or anew with ``replace``.

    Dropping such a table forgets the catalog entry and leaves its files.
    """
    for name, schema in TABLES.items():
        required, defaults = schemas.RULES[name].not_null, schemas.DEFAULTS.get(name, {})
        columns = ", ".join(
            f"{f.name} {f.dataType.simpleString()}"
            + (" NOT NULL" if f.name in required else "")
            + (f" DEFAULT {defaults[f.name]}" if f.name in defaults else "")
            for f in schema.fields
        )
        partitions = f"PARTITIONED BY ({schemas.MONTH_ID})" if name == "fact_inventory" else ""
        if replace:
            spark.sql(f"DROP TABLE IF EXISTS {database}.{name}")
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {database}.{name} ({columns}) USING parquet {partitions}"
            f" LOCATION '{path}/{name}'"
        )


def refresh_tables(spark: SparkSession, database: str = "default") -> None:
    """Make the catalog see newly written files and fact partitions."""
    for name in TABLES:
        spark.catalog.refreshTable(f"{database}.{name}")
    spark.catalog.recoverPartitions(f"{database}.fact_inventory")


def register_views(star: Star, names: dict[str, str] | None = None) -> None:
    """Expose the star to SQL. ``names`` maps a table to the view name a caller's SQL expects."""
    names = names or {}
    frames = zip(TABLES, (star.items, star.vendors, star.calendar, star.fact), strict=True)
    for table, frame in frames:
        frame.createOrReplaceTempView(names.get(table, table))


def read_dims(spark: SparkSession, path: str) -> Dims:
    return Dims(*(read_table(spark, f"{path}/{name}", TABLES[name]) for name in DIM_TABLES))


def load_dims(
    spark: SparkSession, raw: RawInputs, days: DataFrame, path: str, previous: Dims | Star | None = None
) -> dict[str, int]:
    """Write the three dimensions; ``days`` holds every valid movement date.

    With ``previous`` they are merged into that version, keeping its ids.
    """
    loaded = {
        "dim_item": load_items(clean_items(raw.items), previous and previous.items),
        "dim_vendor": load_vendors(clean_vendors(raw.vendors), previous and previous.vendors),
        "dim_calendar": load_calendar(days, previous and previous.calendar),
    }
    return {name: write_table(df, f"{path}/{name}") for name, df in loaded.items()}


def refuse_unreadable(counts: list[tuple[str, str, int, int]], tolerance: float) -> None:
    """Fail if any (table, column, rows, unreadable ones) is over the tolerance."""
    bad = [f"{t}.{c}: {n} of {rows}" for t, c, rows, n in counts if n > tolerance * rows]
    if bad:
        raise RefusedLoad("unreadable numbers in " + "; ".join(bad))


def in_date_order(daily: DataFrame) -> DataFrame:
    """Daily sums dealt and sorted by date, so that readers skip files and row groups of other dates."""
    return daily.repartitionByRange("movement_date").sortWithinPartitions("movement_date")


def write_daily(movements: DataFrame, path: str, tolerance: float = TOLERANCE, in_order: bool = False) -> int:
    """Write the daily sums of raw movements; unreadable numbers are counted in the same pass.

    With ``in_order`` they have their month and lie in date order.

    Each number is parsed into a column of its own, from which both its value and its count are taken.
    """
    seen, parsed = Observation(), parsed_numbers(movements, "movements")
    unreadable = {(c, "unreadable"): F.col(c).isNull() for c in NUMBERS["movements"]}
    watched = parsed.observe(seen, *problem_counts(unreadable))
    daily = daily_movements(type_movements(watched))
    if in_order:
        day = F.col("movement_date")
        daily = in_date_order(daily).withColumn(schemas.MONTH_ID, F.year(day) * 100 + F.month(day))
    rows = write_table(daily, path)
    found = observed(seen)
    refuse_unreadable(
        [("movements", col, found.get("_rows", 0), found.get(f"_{i}", 0)) for i, (col, _) in enumerate(unreadable)], tolerance
    )
    return rows


def check_inputs(raw: RawInputs, tolerance: float = TOLERANCE) -> None:
    """Fail on too many unreadable numbers in the master data."""
    found = input_report(raw, ("items", "vendors", "supply")).where("problem = 'unreadable'").collect()
    refuse_unreadable([(r.table_name, r.column_name, r.n_rows, r.n_bad) for r in found], tolerance)


def load_star(
    spark: SparkSession, raw: RawInputs, path: str, previous: Star | None = None, tolerance: float = TOLERANCE
) -> dict[str, int]:
    """Full load into ``path``, which must be new; returns rows written per table.

    Movements are read once: their daily sums are written first, and calendar
    and fact both start from that table. It also cuts the lineage, so a lost
    executor never forces a second pass over the raw files. The fact is always
    rebuilt; the dimensions continue ``previous``. Raises RefusedLoad, and
    leaves nothing readable, for unreadable numbers beyond the tolerance or a
    result that breaks an enforced rule.
    """
    check_inputs(raw, tolerance)
    staged = f"{path}/_daily_movements"
    rows = {"daily_movements": write_daily(raw.movements, staged, tolerance)}
    daily = spark.read.parquet(staged)
    rows |= load_dims(spark, raw, daily, path, previous)
    dims = read_dims(spark, path)
    fact = build_fact(daily, type_supply(raw.supply), dims.items, dims.calendar, dims.vendors)
    rows["fact_inventory"] = write_fact(fact, f"{path}/fact_inventory")
    publish(spark, path)
    return rows
