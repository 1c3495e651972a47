"""Queries whose work must spread over more tasks as their tables grow."""

import datetime as dt
import random

import pytest

from shelfline import registry
from shelfline.plans.quality import lookup_report
from shelfline.star import Star

LINES = (
    "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double,"
    " l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp"
)


@pytest.fixture(scope="module")
def small(spark, tmp_path_factory):
    """Tables of a few hundred rows, the line items in some files."""
    rnd, path = random.Random(5), str(tmp_path_factory.mktemp("tables"))
    start = dt.datetime(1995, 1, 1)
    lines = [
        (n, n % 9, n % 4, 1 + n % 7, float(rnd.randrange(1, 50)), 10.0, rnd.randrange(11) / 100, rnd.randrange(9) / 100,
         rnd.choice("ARN"), rnd.choice("FO"), start + dt.timedelta(rnd.randrange(40)))
        for n in range(600)
    ]
    tables = {
        "lineitem": spark.createDataFrame(lines, LINES).repartition(6, "l_orderkey"),
        "part": spark.createDataFrame([(n, f"p{n}", "ECONOMY", "b", 3, 2.5) for n in range(9)],
                                      "p_partkey long, p_name string, p_type string, p_brand string, p_size int, p_retailprice double"),
        "supplier": spark.createDataFrame([(n, f"s{n}", 0, 1.0) for n in range(4)], "s_suppkey long, s_name string, s_nationkey int, s_acctbal double"),
        "nation": spark.createDataFrame([(0, "n", 0)], "n_nationkey int, n_name string, n_regionkey int"),
        "region": spark.createDataFrame([(0, "r")], "r_regionkey int, r_name string"),
        "orders": spark.createDataFrame([(0, 0)], "o_orderkey long, o_custkey long"),
        "customer": spark.createDataFrame([(0, "BUILDING")], "c_custkey long, c_mktsegment string"),
    }
    for name, table in tables.items():
        table.write.parquet(f"{path}/{name}.parquet")
    return path


def rows(df):
    return sorted(df.collect(), key=str)


def test_streams_get_more_files_from_larger_tables(spark, small, monkeypatch):
    daily, star = rows(registry.fact_grouped(spark, small)), rows(registry.fact_loaded(spark, small))
    assert daily and star
    monkeypatch.setattr(registry, "FILE_ROWS", 75)
    assert rows(registry.stream_daily(spark, small)) == daily
    files = spark.read.parquet(f"{registry._folder(spark, small, 'stream')}/files").inputFiles()
    assert len(files) == 600 // 75
    assert rows(registry.stream_star(spark, small)) == star
    path = registry._folder(spark, small, "stream_star")
    parts = [spark.read.csv(f"{path}/files/part={n}").inputFiles() for n in range(3)]
    assert all(len(part) == 600 // 3 // 75 for part in parts)
    assert registry.last_batch(spark, f"{path}/star") == 2


def test_lookup_report_goes_over_the_rows_once(spark):
    day = dt.date(2025, 1, 1)
    grouped = spark.createDataFrame([("1", day, "V1"), ("1", None, "V9"), ("2", day, None), (None, day, "V9")], "mat_sku string, movement_date date, ven_acc string")
    dims = [spark.createDataFrame([row], schema) for row, schema in (
        (("1",), "medicine_sku string"), (("V1",), "vendor_account string"), ((day,), "full_date date"))]
    found = lookup_report(grouped.repartition(3, "mat_sku"), Star(*dims, None))
    assert [tuple(r) for r in found.collect()] == [
        ("reference", "grouped", "movement_date", 1), ("reference", "grouped", "mat_sku", 2), ("reference", "grouped", "ven_acc", 3),
    ]
    plan = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("hashpartitioning(mat_sku") + plan.count("REPARTITION_BY_NUM") <= 2 and "ReusedExchange" not in plan
