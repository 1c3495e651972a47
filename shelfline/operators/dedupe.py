"""Keep one row per key, the same one on every run."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def keep_one(df: DataFrame, key: list[str]) -> DataFrame:
    """The smallest row per key, comparing the other columns left to right, nulls first.

    An aggregate rather than ``row_number``: copies of a key collapse before
    the shuffle, so one key with very many copies costs no more than another.
    Equal rows go first, by a hash aggregate; the minimum of a struct needs a
    sort and sees the rest.
    """
    rest = [c for c in df.columns if c not in key]
    return (
        df.distinct()
        .groupBy(*key)
        .agg(F.min(F.struct(*rest)).alias("_row"))
        .select(*[F.col(c) if c in key else F.col(f"_row.{c}").alias(c) for c in df.columns])
    )
