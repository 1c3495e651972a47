"""Constraint checks: Spark enforces no keys, so a load is checked instead."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.schemas import Rules


def check_rows(df: DataFrame, table: str, rules: Rules) -> DataFrame:
    """Null, length and range checks of one table in a single pass: (rule, table, column, violations)."""
    checks = [("not_null", c, F.col(c).isNull()) for c in rules.not_null]
    checks += [("max_length", c, F.length(c) > n) for c, n in rules.max_length.items()]
    checks += [("overflow", c, F.abs(F.col(c).cast("double")) >= n) for c, n in rules.max_abs.items()]
    counted = df.agg(*[F.count_if(test).alias(f"_{i}") for i, (_, _, test) in enumerate(checks)])
    return _long(counted, [(kind, table, col, f"_{i}") for i, (kind, col, _) in enumerate(checks)])


def check_unique(df: DataFrame, table: str, key: tuple[str, ...]) -> DataFrame:
    """Keys that occur more than once."""
    counted = df.groupBy(*key).agg(F.count(F.lit(1)).alias("_n")).agg(F.count_if(F.col("_n") > 1).alias("_0"))
    return _long(counted, [("unique", table, "+".join(key), "_0")])


def check_reference(df: DataFrame, table: str, col: str, parent: DataFrame, parent_col: str) -> DataFrame:
    """Rows whose reference has no parent.

    Counts rows per distinct reference before the anti-join, so a reference
    shared by very many rows crosses the join once.
    """
    counted = (
        df.groupBy(F.col(col).alias("_ref"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .join(parent.select(F.col(parent_col).alias("_ref")), "_ref", "left_anti")
        .agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("_0"))
    )
    return _long(counted, [("reference", table, col, "_0")])


def check_references(df: DataFrame, table: str, parents: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """``check_reference`` of several columns, from one pass over the rows: each is counted by column and reference as text."""
    refs = [F.struct(F.lit(col).alias("_col"), F.col(col).cast("string").alias("_ref")) for col in parents]
    known = [p.select(F.lit(col).alias("_col"), F.col(pk).cast("string").alias("_ref")) for col, (p, pk) in parents.items()]
    orphans = (
        df.select(F.inline(F.array(*refs)))
        .groupBy("_col", "_ref")
        .agg(F.count(F.lit(1)).alias("_n"))
        .join(report(known), ["_col", "_ref"], "left_anti")
    )
    sums = [F.sum(F.when(F.col("_col") == col, F.col("_n"))) for col in parents]
    counted = orphans.agg(*[F.coalesce(s, F.lit(0)).alias(f"_{i}") for i, s in enumerate(sums)])
    return _long(counted, [("reference", table, col, f"_{i}") for i, col in enumerate(parents)])


def check_keys(
    df: DataFrame, table: str, key: tuple[str, ...], parents: dict[str, tuple[DataFrame, str]]
) -> list[DataFrame]:
    """Uniqueness of a key and the references in its columns, all from one grouping by the whole key.

    Each part plans the same grouping, which is then computed once and reused.
    """
    keys = df.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"))
    parts = [_long(keys.agg(F.count_if(F.col("_n") > 1).alias("_0")), [("unique", table, "+".join(key), "_0")])]
    for col, (parent, parent_col) in parents.items():
        counted = (
            keys.groupBy(F.col(col).alias("_ref"))
            .agg(F.sum("_n").alias("_n"))
            .join(parent.select(F.col(parent_col).alias("_ref")), "_ref", "left_anti")
            .agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("_0"))
        )
        parts.append(_long(counted, [("reference", table, col, "_0")]))
    return parts


def problem_counts(tests: dict[tuple[str, str], Column]) -> list[Column]:
    """Aggregates: rows in all, and rows with each problem."""
    return [F.count(F.lit(1)).alias("_rows"), *[F.count_if(t).alias(f"_{i}") for i, t in enumerate(tests.values())]]


def count_problems(df: DataFrame, table: str, tests: dict[tuple[str, str], Column]) -> DataFrame:
    """Rows with each problem in one pass: (table_name, column_name, problem, n_rows, n_bad)."""
    rows = [
        F.struct(
            F.lit(table).alias("table_name"),
            F.lit(col).alias("column_name"),
            F.lit(problem).alias("problem"),
            F.col("_rows").alias("n_rows"),
            F.col(f"_{i}").alias("n_bad"),
        )
        for i, (col, problem) in enumerate(tests)
    ]
    return df.agg(*problem_counts(tests)).select(F.inline(F.array(*rows)))


def _long(counted: DataFrame, names: list[tuple[str, str, str, str]]) -> DataFrame:
    rows = [
        F.struct(
            F.lit(kind).alias("rule"),
            F.lit(table).alias("table_name"),
            F.lit(col).alias("column_name"),
            F.col(alias).cast("bigint").alias("violations"),
        )
        for kind, table, col, alias in names
    ]
    return counted.select(F.inline(F.array(*rows)))


def report(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)
