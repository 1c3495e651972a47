"""Numeric rules shared by every query.

Metrics are computed in double and rounded once, at the end, through a
decimal: rounding a double directly depends on its binary form.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY = "decimal(18,2)"
_EXACT = "decimal(28,8)"


def number(col: Column, kind: T.DataType | None = None) -> Column:
    """Text or number to double; missing is 0, unreadable is null. NaN and infinities count as unreadable.

    ``kind`` is the column's type. Numbers are tested as they are; only text, or
    a column of unknown type, is trimmed and parsed.
    """
    if isinstance(kind, T.IntegralType | T.DecimalType):
        return F.coalesce(col.cast("double"), F.lit(0.0))
    if isinstance(kind, T.FractionalType):
        return _finite(F.coalesce(col.cast("double"), F.lit(0.0)))
    text = F.trim(col.cast("string"))
    return F.when(text.isNull() | (text == ""), 0.0).otherwise(_finite(text.try_cast("double")))


def _finite(value: Column) -> Column:
    # NaN counts as greater than any number
    return F.when(F.abs(value) < float("inf"), value)


def quantity(col: Column, kind: T.DataType | None = None) -> Column:
    """As ``number``, unreadable counting as 0 as well; ``input_report`` counts those and a load refuses too many."""
    return F.coalesce(number(col, kind), F.lit(0.0))


def whole(col: Column, kind: T.DataType | None = None) -> Column:
    """Text or number to int, also when written with a zero fraction; missing is 0, anything else null."""
    value = number(col, kind)
    return F.when(value == F.floor(value), value.try_cast("int"))


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division in double; null where the denominator is 0 or null."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def round2(col: Column) -> Column:
    """Round half up to two places, as double. NaN becomes null."""
    return F.round(col.try_cast(_EXACT), 2).cast("double")


def money(col: Column) -> Column:
    """Stored form of a measure: decimal(18,2), half up."""
    return F.round(col.try_cast(_EXACT), 2).try_cast(MONEY)
