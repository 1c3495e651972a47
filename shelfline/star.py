"""The star as frames."""

from dataclasses import dataclass

from pyspark.sql import DataFrame


@dataclass(frozen=True)
class Dims:
    items: DataFrame
    vendors: DataFrame
    calendar: DataFrame


@dataclass(frozen=True)
class Star(Dims):
    fact: DataFrame
