"""Per-item window measures. Frames hold one row per item and date (and scope)."""

from pyspark.sql import Column, Window
from pyspark.sql import functions as F

from shelfline.functions import ratio, round2


def turnover(by: list[str]) -> Column:
    """Issued total over mean opening stock of the item; 0 where the mean is not positive."""
    item = Window.partitionBy(*by)
    mean_open = F.avg("opening_qty").over(item)
    return turnover_ratio(F.sum("issued_qty").over(item), mean_open)


def turnover_ratio(issued: Column, mean_open: Column) -> Column:
    value = F.when(mean_open > 0, ratio(issued, mean_open))
    return F.coalesce(round2(F.nanvl(value, F.lit(0.0))), F.lit(0.0))


def trailing_mean(value: str, by: list[str], day: Column, days: int = 30) -> Column:
    """Mean over the rows of the last ``days`` dates, the current date included."""
    frame = Window.partitionBy(*by).orderBy(day).rangeBetween(-(days - 1), Window.currentRow)
    return F.avg(value).over(frame)


def coverage(closed: Column, mean_issued: Column) -> Column:
    """Days the closing stock lasts; 0 unless stock and usage are both positive."""
    value = F.when((mean_issued > 0) & (closed > 0), ratio(closed, mean_issued))
    return F.coalesce(round2(value), F.lit(0.0))
