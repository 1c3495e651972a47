"""Column contracts: raw CSV inputs, dimensions and fact."""

from dataclasses import dataclass

from pyspark.sql import types as T

# Raw inputs are read as text, so codes such as "007" keep their zeros.


def _text(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def _struct(**types: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in types.items()])


_TEXT, _INT, _LONG, _DATE, _MONEY = T.StringType(), T.IntegerType(), T.LongType(), T.DateType(), T.DecimalType(18, 2)


ITEM_RAW = _text("MED_ID", "MED_NAME", "TYPE_DES", "STRG_DES", "COST_UN", "EXP_MON")
VENDOR_RAW = _text("VEN_ACC", "VEN_NAME", "VEN_TYPE", "CTRY_NAME", "VSTAT_DES")
SUPPLY_RAW = _text("MAT_SKU", "RCVD_DATE", "VEN_ACC")
MOVEMENT_RAW = _text("MAT_SKU", "INGTN_TS", "OPEN_QTY", "RCVD_QTY", "ISSD_QTY", "CLSD_QTY")

DIM_ITEM = _struct(
    medicine_id_pk=_LONG,
    medicine_sku=_TEXT,
    medicine_name=_TEXT,
    type_description=_TEXT,
    storage_type=_TEXT,
    unit_cost=_MONEY,
    expiration_months=_INT,
)
DIM_VENDOR = _struct(
    vendor_id_pk=_LONG,
    vendor_account=_TEXT,
    vendor_name=_TEXT,
    vendor_type=_TEXT,
    country_name=_TEXT,
    vendor_status=_TEXT,
)
DIM_CALENDAR = _struct(
    date_id_pk=_LONG,
    full_date=_DATE,
    year=_INT,
    quarter=_INT,
    month=_INT,
    month_name=_TEXT,
    day=_INT,
    day_of_week=_TEXT,
)
# Percentages are wider than the usual (5,2): values above 999.99 are kept and reported
# by the quality checks instead of failing the load.
FACT = _struct(
    date_id_fk=_LONG,
    medicine_id_fk=_LONG,
    vendor_id_fk=_LONG,
    opening_qty=_MONEY,
    received_qty=_MONEY,
    issued_qty=_MONEY,
    closed_qty=_MONEY,
    stock_availability_pct=_MONEY,
    valuasi=_MONEY,
    pengeluaran=_MONEY,
    wastage_ratio_pct=_MONEY,
    turnover_ratio=_MONEY,
    stock_coverage_days=_MONEY,
)
#: The written fact is partitioned by month, yyyymm, and sorted by date within.
MONTH_ID = "month_id"
FACT_STORED = T.StructType([*FACT.fields, T.StructField(MONTH_ID, _INT)])

QUANTITIES = ["opening_qty", "received_qty", "issued_qty", "closed_qty"]
FACT_KEYS = ["date_id_fk", "medicine_id_fk", "vendor_id_fk"]
FACT_MEASURES = [f.name for f in FACT.fields if f.name not in FACT_KEYS]


@dataclass(frozen=True)
class Rules:
    """Constraints of one table, checked after a load."""

    key: tuple[str, ...]
    not_null: tuple[str, ...]
    max_length: dict[str, int]
    max_abs: dict[str, float]


#: Columns that a row may leave out, and the value it then has.
DEFAULTS = {
    "dim_item": {"unit_cost": "0.00", "expiration_months": "0"},
    "fact_inventory": {m: "0.00" for m in FACT_MEASURES},
}

ITEM_RULES = Rules(
    key=("medicine_sku",),
    not_null=("medicine_sku", "medicine_name", "unit_cost"),
    max_length={"medicine_sku": 20, "medicine_name": 100, "type_description": 100, "storage_type": 100},
    max_abs={"unit_cost": 1e16},
)
VENDOR_RULES = Rules(
    key=("vendor_account",),
    not_null=("vendor_account", "vendor_name"),
    max_length={
        "vendor_account": 20,
        "vendor_name": 100,
        "vendor_type": 50,
        "country_name": 50,
        "vendor_status": 50,
    },
    max_abs={},
)
CALENDAR_RULES = Rules(
    key=("full_date",),
    not_null=("full_date", "year", "quarter", "month", "day"),
    max_length={"month_name": 20, "day_of_week": 20},
    max_abs={},
)
FACT_RULES = Rules(
    key=tuple(FACT_KEYS),
    not_null=tuple(f.name for f in FACT.fields),
    max_length={},
    max_abs={m: 1e3 if m.endswith("_pct") else 1e16 for m in FACT_MEASURES},
)
RULES = {
    "dim_item": ITEM_RULES,
    "dim_vendor": VENDOR_RULES,
    "dim_calendar": CALENDAR_RULES,
    "fact_inventory": FACT_RULES,
}
