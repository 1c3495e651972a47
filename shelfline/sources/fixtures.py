"""Raw inputs and dashboard records as views over the TPC-H-like test tables.

Every row of ``part``, ``supplier`` and ``lineitem`` is used: returned lines
(flags A and R) are stock movements, the others are receipts. Ship dates move
by a fixed number of days and span seven years. Chosen discount and tax values stand for the defects of real exports: missing dates,
dates with a time part, missing quantities and vendors. Line number 7 is
equipment that the item master does not list; line number 6 came from a vendor
the vendor master does not list.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.plans.dashboard import wide_fact
from shelfline.sources.raw import RawInputs

#: From ship dates to stock dates: 24 years.
DAYS_ON = 8766

SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _text(prefix: str, key: str) -> Column:
    return F.concat(F.lit(prefix), F.col(key).cast("string"))


def _day_text() -> Column:
    moved = F.date_add(F.col("l_shipdate").cast("date"), DAYS_ON).cast("string")
    no_tax, full_tax = F.col("l_tax") == 0.0, F.col("l_tax") == 0.08
    return (
        F.when(no_tax & (F.col("l_discount") == 0.05), None)
        .when(full_tax & (F.col("l_discount") == 0.05), "2")
        .when(full_tax & (F.col("l_discount") == 0.06), F.concat(moved, F.lit(" 00:00:00")))
        .otherwise(moved)
    )


def _sku() -> Column:
    return F.when(F.col("l_linenumber") == 7, _text("E", "l_partkey")).otherwise(_text("M", "l_partkey"))


def _opened() -> Column:
    return F.col("l_quantity") * F.col("l_linenumber")


def _received() -> Column:
    units = F.round(F.col("l_tax") * 100) * F.col("l_linenumber") * 2
    return F.when(F.col("l_returnflag") == "R", units).otherwise(0.0)


def _issued() -> Column:
    return F.col("l_linenumber") * F.when(F.col("l_linestatus") == "F", 7.0).otherwise(1.0)


def raw_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        _text("M", "p_partkey").alias("MED_ID"),
        F.col("p_name").alias("MED_NAME"),
        F.col("p_type").alias("TYPE_DES"),
        F.col("p_brand").alias("STRG_DES"),
        F.when(F.col("p_size") != 50, F.col("p_retailprice")).alias("COST_UN"),
        F.when(F.col("p_size") != 1, F.col("p_size")).alias("EXP_MON"),
    )


def raw_vendors(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation").withColumnRenamed("n_nationkey", "s_nationkey")
    region = table(spark, sf_dir, "region").withColumnRenamed("r_regionkey", "n_regionkey")
    return (
        table(spark, sf_dir, "supplier")
        .join(nation, "s_nationkey")
        .join(region, "n_regionkey")
        .select(
            _text("V", "s_suppkey").alias("VEN_ACC"),
            F.col("s_name").alias("VEN_NAME"),
            F.col("r_name").alias("VEN_TYPE"),
            F.col("n_name").alias("CTRY_NAME"),
            F.when(F.col("s_acctbal") < 0, "Inactive").otherwise("Active").alias("VSTAT_DES"),
        )
    )


def raw_supply(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = F.when(F.col("l_linenumber") == 6, _text("X", "l_suppkey")).otherwise(_text("V", "l_suppkey"))
    nameless = (F.col("l_discount") == 0.1) & (F.col("l_tax") == 0.08)
    return (
        table(spark, sf_dir, "lineitem")
        .where(F.col("l_returnflag") == "N")
        .select(
            _sku().alias("MAT_SKU"),
            _day_text().alias("RCVD_DATE"),
            F.when(~nameless, listed).alias("VEN_ACC"),
        )
    )


def movement_rows(lines: DataFrame) -> DataFrame:
    """Raw movements from lineitem rows; works on a batch or a streaming frame."""
    return lines.where(F.col("l_returnflag").isin("A", "R")).select(
        F.concat(F.lit("movements_"), "l_linestatus", F.lit(".csv")).alias("source_file"),
        F.col("l_returnflag").alias("batch"),
        _sku().alias("MAT_SKU"),
        _day_text().alias("INGTN_TS"),
        F.when(F.col("l_discount") != 0.0, _opened()).alias("OPEN_QTY"),
        _received().alias("RCVD_QTY"),
        _issued().alias("ISSD_QTY"),
        F.when(F.col("l_discount") != 0.1, _opened() + _received() - _issued()).alias("CLSD_QTY"),
    )


def raw_movements(spark: SparkSession, sf_dir: str) -> DataFrame:
    return movement_rows(table(spark, sf_dir, "lineitem"))


def text_movements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Movements with their numbers as text, some unreadable, and some without a SKU."""
    lines = table(spark, sf_dir, "lineitem").where(F.col("l_returnflag").isin("A", "R"))
    junk = (F.col("l_tax") == 0.01) & (F.col("l_discount") == 0.01)
    texts = {"OPEN_QTY": "abc", "RCVD_QTY": "NaN", "ISSD_QTY": "1,234.50", "CLSD_QTY": " "}
    plain = {"OPEN_QTY": _opened(), "RCVD_QTY": _received(), "ISSD_QTY": _issued(), "CLSD_QTY": _opened()}
    return lines.select(
        F.when(F.col("l_tax") != 0.07, _sku()).alias("MAT_SKU"),
        _day_text().alias("INGTN_TS"),
        *[F.when(junk, text).otherwise(plain[c].cast("string")).alias(c) for c, text in texts.items()],
    )


def text_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The item master as text; shelf lives are written with a fraction, some of them not zero."""
    months = F.concat(F.col("p_size").cast("string"), F.when(F.col("p_size") == 7, ".5").otherwise(".0"))
    return raw_items(spark, sf_dir).drop("EXP_MON", "COST_UN").join(
        table(spark, sf_dir, "part").select(
            _text("M", "p_partkey").alias("MED_ID"),
            F.when(F.col("p_size") == 9, "n/a").otherwise(F.col("p_retailprice").cast("string")).alias("COST_UN"),
            months.alias("EXP_MON"),
        ),
        "MED_ID",
    )


def raw_inputs(spark: SparkSession, sf_dir: str) -> RawInputs:
    return RawInputs(
        items=raw_items(spark, sf_dir),
        vendors=raw_vendors(spark, sf_dir),
        supply=raw_supply(spark, sf_dir),
        movements=raw_movements(spark, sf_dir),
    )


def dashboard_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("Medicine_ID"),
        F.col("p_name").alias("Medicine_Name"),
        F.col("p_type").alias("Medicine_Type"),
    )


def dashboard_vendors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("Vendor_ID"), F.col("s_name").alias("Vendor_Name")
    )


def dashboard_wide(spark: SparkSession, sf_dir: str, gathered: bool = False) -> DataFrame:
    """Wide dashboard records: every lineitem, its order's customer as patient, its supplier's nation as staff."""
    visits = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("Patient_ID")
    )
    home = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("Vendor_ID"), F.col("s_nationkey").alias("Staff_ID")
    )
    fact = table(spark, sf_dir, "lineitem").select(
        F.col("l_shipdate").cast("date").alias("Date"),
        F.col("l_partkey").alias("Medicine_ID"),
        F.col("l_suppkey").alias("Vendor_ID"),
        "l_orderkey",
        _opened().cast("bigint").alias("Opening_Qty"),
        _received().cast("bigint").alias("Received_Qty"),
        _issued().cast("bigint").alias("Issued_Qty"),
        F.floor(F.col("l_extendedprice") / F.col("l_quantity")).alias("Unit_Cost"),
    )
    staff = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("Staff_ID"), F.col("n_name").alias("Staff_Name")
    )
    patients = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("Patient_ID"), F.col("c_mktsegment").alias("Age_Group")
    )
    items, vendors = dashboard_items(spark, sf_dir), dashboard_vendors(spark, sf_dir)
    return wide_fact(fact, items, staff, vendors, patients, {"Patient_ID": visits, "Staff_ID": home}, gathered)
