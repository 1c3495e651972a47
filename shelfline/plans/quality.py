"""Quality reports for raw inputs, for a star and for the rows about to be keyed."""

from pyspark.sql import DataFrame

from shelfline import schemas
from shelfline.operators.quality import check_keys, check_references, check_rows, check_unique, count_problems, report
from shelfline.sources import RawInputs, input_problems
from shelfline.star import Star


def input_report(raw: RawInputs, tables: tuple[str, ...] = ("items", "vendors", "supply", "movements")) -> DataFrame:
    """Rows (table_name, column_name, problem, n_rows, n_bad) of the raw inputs, one pass over each table."""
    frames = {name: getattr(raw, name) for name in tables}
    return report([count_problems(frame, name, input_problems(frame, name)) for name, frame in frames.items()])


def star_report(star: Star) -> DataFrame:
    """Every declared rule of the star with its number of violations; two passes over the fact."""
    tables = [
        ("dim_item", star.items, schemas.ITEM_RULES),
        ("dim_vendor", star.vendors, schemas.VENDOR_RULES),
        ("dim_calendar", star.calendar, schemas.CALENDAR_RULES),
        ("fact_inventory", star.fact, schemas.FACT_RULES),
    ]
    parts = [check_rows(df, name, rules) for name, df, rules in tables]
    parts += [check_unique(df, name, rules.key) for name, df, rules in tables[:3]]
    parents = {
        "date_id_fk": (star.calendar, "date_id_pk"),
        "medicine_id_fk": (star.items, "medicine_id_pk"),
        "vendor_id_fk": (star.vendors, "vendor_id_pk"),
    }
    return report([*parts, *check_keys(star.fact, "fact_inventory", schemas.FACT_RULES.key, parents)])


def lookup_report(grouped: DataFrame, star: Star) -> DataFrame:
    """Grouped rows that the key lookups are going to drop, per reason."""
    parents = {
        "movement_date": (star.calendar, "full_date"),
        "mat_sku": (star.items, "medicine_sku"),
        "ven_acc": (star.vendors, "vendor_account"),
    }
    return check_references(grouped, "grouped", parents)
