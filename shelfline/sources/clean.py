"""Projection, typing and row rules for the raw inputs."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline.functions import money, number, parse_day, quantity, whole
from shelfline.operators.dedupe import keep_one


def _typed(raw: DataFrame, name: str) -> tuple[Column, T.DataType]:
    return F.col(name), raw.schema[name].dataType


def clean_items(raw: DataFrame) -> DataFrame:
    """Item master: one row per SKU, cost and shelf life defaulting to 0. Rows without a SKU are dropped."""
    typed = raw.select(
        F.col("MED_ID").cast("string").alias("medicine_sku"),
        F.col("MED_NAME").cast("string").alias("medicine_name"),
        F.col("TYPE_DES").cast("string").alias("type_description"),
        F.col("STRG_DES").cast("string").alias("storage_type"),
        money(quantity(*_typed(raw, "COST_UN"))).alias("unit_cost"),
        F.coalesce(whole(*_typed(raw, "EXP_MON")), F.lit(0)).alias("expiration_months"),
    )
    return keep_one(typed.where("medicine_sku is not null"), ["medicine_sku"])


def clean_vendors(raw: DataFrame) -> DataFrame:
    """Vendor master: one row per account. Rows without an account are dropped."""
    typed = raw.select(
        F.col("VEN_ACC").cast("string").alias("vendor_account"),
        F.col("VEN_NAME").cast("string").alias("vendor_name"),
        F.col("VEN_TYPE").cast("string").alias("vendor_type"),
        F.col("CTRY_NAME").cast("string").alias("country_name"),
        F.col("VSTAT_DES").cast("string").alias("vendor_status"),
    )
    return keep_one(typed.where("vendor_account is not null"), ["vendor_account"])


def type_supply(raw: DataFrame) -> DataFrame:
    """Receipts with parsed dates; unreadable ones are null."""
    return raw.select(
        F.col("MAT_SKU").cast("string").alias("mat_sku"),
        parse_day(F.col("RCVD_DATE")).alias("rcvd_date"),
        F.col("VEN_ACC").cast("string").alias("ven_acc"),
    )


def clean_supply(raw: DataFrame) -> DataFrame:
    """Receipts with a SKU, a readable date and a vendor; other rows are dropped."""
    return type_supply(raw).na.drop("any")


def type_movements(raw: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Movements with parsed dates, unreadable ones null; missing quantities count as 0.

    ``keep`` names extra raw columns to carry, such as ``source_file``.
    """
    return raw.select(
        *keep,
        F.col("MAT_SKU").cast("string").alias("mat_sku"),
        parse_day(F.col("INGTN_TS")).alias("movement_date"),
        quantity(*_typed(raw, "OPEN_QTY")).alias("opening_qty"),
        quantity(*_typed(raw, "RCVD_QTY")).alias("received_qty"),
        quantity(*_typed(raw, "ISSD_QTY")).alias("issued_qty"),
        quantity(*_typed(raw, "CLSD_QTY")).alias("closed_qty"),
    )


def clean_movements(raw: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Movements with a readable date; other rows are dropped."""
    return type_movements(raw, keep).na.drop(subset=["movement_date"])


#: Raw columns that hold numbers, whole numbers and keys, by table.
NUMBERS = {"items": ["COST_UN"], "movements": ["OPEN_QTY", "RCVD_QTY", "ISSD_QTY", "CLSD_QTY"]}
WHOLE_NUMBERS = {"items": ["EXP_MON"]}
KEYS = {"items": ["MED_ID"], "vendors": ["VEN_ACC"], "supply": ["MAT_SKU"], "movements": ["MAT_SKU"]}


def input_problems(raw: DataFrame, table: str) -> dict[tuple[str, str], Column]:
    """Test of each (column, problem) of a raw table: unreadable numbers and missing keys."""
    tests = {(c, "unreadable"): number(*_typed(raw, c)).isNull() for c in NUMBERS.get(table, [])}
    tests |= {(c, "unreadable"): whole(*_typed(raw, c)).isNull() for c in WHOLE_NUMBERS.get(table, [])}
    return tests | {(c, "missing_key"): F.col(c).isNull() for c in KEYS[table]}


def parsed_numbers(raw: DataFrame, table: str) -> DataFrame:
    """The raw table with its numbers as doubles, unreadable ones null, so that each is parsed once for all later uses."""
    return raw.withColumns({c: number(*_typed(raw, c)) for c in NUMBERS[table]})
