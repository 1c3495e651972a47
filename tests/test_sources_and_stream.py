import datetime as dt
import gzip

import pytest
from pyspark.sql import functions as F

from shelfline.plans.warehouse import RefusedLoad, load_star, publish, read_star, write_fact, write_table
from shelfline.sources import clean_movements, clean_supply, read_raw, stream_files
from shelfline.streaming import incremental

MOVE_HEADER = "ID,MAT_SKU,INGTN_TS,OPEN_QTY,RCVD_QTY,ISSD_QTY,CLSD_QTY\n"


@pytest.fixture
def files(tmp_path):
    (tmp_path / "items.csv").write_text(
        'MED_ID,MED_NAME,GEN,TYPE_DES,STRG_DES,EXP_MON,COST_UN\n007,"Syrup ""mild"", 5 ml",g,T1,cold,,2.50\n8,Pill,g,T2,,12,\n'
    )
    (tmp_path / "vendors.csv").write_text("VEN_ACC,VEN_NAME,VEN_TYPE,CTRY_NAME,VSTAT_DES\nV1,One,Local,X,Active\n")
    (tmp_path / "supply.csv").write_text(
        "MAT_SKU,QTY,RCVD_DATE,VEN_ACC\n007,1,2025-01-01,V1\n007,1,2,V1\n8,1,2025-01-01,\n,1,2025-01-01,V1\n"
    )
    folder = tmp_path / "moves"
    folder.mkdir()
    (folder / "m1.csv").write_text(MOVE_HEADER + "1,007,2025-01-02,10,,2,8\n2,007,2,10,,2,8\n3,8,2025-01-03,1,1,1,1\n")
    (folder / "m2.csv").write_text(MOVE_HEADER + "4,007,2025-01-02,5,1,1,5\n5,007,2025-01-03 10:00:00,5,1,1,5\n")
    return tmp_path


def open_all(spark, files):
    return read_raw(spark, f"{files}/items.csv", f"{files}/vendors.csv", f"{files}/supply.csv", f"{files}/moves")


def test_columns_are_chosen_by_name_and_stay_text(spark, files):
    raw = open_all(spark, files)
    first = raw.items.orderBy("MED_ID").first()
    assert (first.MED_ID, first.MED_NAME, first.EXP_MON, first.COST_UN) == ("007", 'Syrup "mild", 5 ml', None, "2.50")
    files_seen = {r.source_file for r in raw.movements.collect()}
    assert len(files_seen) == 2 and all(f.endswith(("/moves/m1.csv", "/moves/m2.csv")) for f in files_seen)


def test_bad_rows_are_dropped_or_defaulted(spark, files):
    raw = open_all(spark, files)
    assert [tuple(r) for r in clean_supply(raw.supply).collect()] == [("007", dt.date(2025, 1, 1), "V1")]
    moves = clean_movements(raw.movements).collect()
    assert len(moves) == 3 and all(m.received_qty is not None for m in moves)


@pytest.mark.parametrize("missing", ["nowhere.csv", "empty"])
def test_missing_input_fails_fast(spark, files, missing):
    (files / "empty").mkdir()
    with pytest.raises(FileNotFoundError):
        read_raw(spark, f"{files}/items.csv", f"{files}/vendors.csv", f"{files}/supply.csv", f"{files}/{missing}")


def test_reordered_file_is_read_by_name(spark, files):
    other = files / "moves" / "other"
    other.mkdir()
    (other / "m1.csv").write_text("CLSD_QTY,EXTRA,INGTN_TS,MAT_SKU,OPEN_QTY,RCVD_QTY,ISSD_QTY\n9,x,2025-01-02,007,8,7,6\n")
    raw = read_raw(spark, f"{files}/items.csv", f"{files}/vendors.csv", f"{files}/supply.csv", f"{files}/moves/{{*.csv,other}}")
    rows = clean_movements(raw.movements, ("source_file",)).where("opening_qty = 8").collect()
    assert [(r.mat_sku, r.received_qty, r.issued_qty, r.closed_qty) for r in rows] == [("007", 7.0, 6.0, 9.0)]
    assert raw.movements.select("source_file").distinct().count() == 3  # one name in two folders is two files


def test_file_without_the_columns_fails(spark, files):
    (files / "moves" / "m3.csv").write_text("A,B\n1,2\n")
    with pytest.raises(ValueError, match="no header"):
        open_all(spark, files)


def test_headers_are_read_once_whatever_their_spelling(spark, files):
    (files / "moves" / "m3.csv").write_text('"ID","MAT_SKU","INGTN_TS","OPEN_QTY","RCVD_QTY","ISSD_QTY","CLSD_QTY"\n9,8,2025-01-09,1,1,1,1\n')
    (files / "moves" / "m4.csv").write_text("")
    (files / "moves" / "m5.csv").write_bytes("\ufeffMAT_SKU,ID,ID,,INGTN_TS,OPEN_QTY,RCVD_QTY,ISSD_QTY,CLSD_QTY\n8,a,b,c,2025-01-10,1,1,1,1\n".encode())
    with gzip.open(files / "moves" / "m6.csv.gz", "wt") as f:
        f.write("CLSD_QTY,MAT_SKU,INGTN_TS,OPEN_QTY,RCVD_QTY,ISSD_QTY\n5,8,2025-01-11,1,2,3\n")
    rows = open_all(spark, files).movements
    assert rows.count() == 8
    got = {r.INGTN_TS: (r.MAT_SKU, r.CLSD_QTY) for r in rows.where("MAT_SKU = '8'").collect()}
    assert got["2025-01-09"] == got["2025-01-10"] == ("8", "1") and got["2025-01-11"] == ("8", "5")


def test_a_second_header_in_a_file_refuses_the_load(spark, files, tmp_path):
    text = (files / "moves" / "m2.csv").read_text()
    (files / "moves" / "m2.csv").write_text(text + text)
    with pytest.raises(RefusedLoad, match="OPEN_QTY: 1 of 8"):
        load_star(spark, open_all(spark, files), f"{tmp_path}/v")


def test_a_load_reads_each_movement_file_once(spark, files):
    plan = open_all(spark, files).movements._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan csv") == 1 and "FileScan text" not in plan


def test_load_from_files_and_reload(spark, files, tmp_path):
    rows = load_star(spark, open_all(spark, files), f"{tmp_path}/v1")
    assert rows == {"daily_movements": 2, "dim_item": 2, "dim_vendor": 1, "dim_calendar": 2, "fact_inventory": 1}
    first = read_star(spark, f"{tmp_path}/v1")
    fact = first.fact.first()
    assert (float(fact.opening_qty), float(fact.valuasi), fact.date_id_fk) == (15.0, 32.5, 20250102)

    (files / "items.csv").write_text("MED_ID,MED_NAME,TYPE_DES,STRG_DES,EXP_MON,COST_UN\n007,Renamed,T1,cold,,3\n9,New,T3,,1,1\n")
    load_star(spark, open_all(spark, files), f"{tmp_path}/v2", previous=first)
    before = {r.medicine_sku: r.medicine_id_pk for r in first.items.collect()}
    after = {r.medicine_sku: (r.medicine_id_pk, r.medicine_name) for r in read_star(spark, f"{tmp_path}/v2").items.collect()}
    assert after["007"] == (before["007"], "Renamed") and after["8"] == (before["8"], "Pill")
    assert after["9"] == (3, "New")


def test_stream_equals_batch_and_replay_counts_once(spark, files, tmp_path):
    out = f"{tmp_path}/daily"
    incremental.ingest_files(stream_files(spark, f"{files}/moves"), out, f"{tmp_path}/ck").awaitTermination()
    raw = open_all(spark, files)
    expected = sorted(incremental.daily_movements(clean_movements(raw.movements)).collect())
    assert sorted(incremental.read_daily(spark, out).collect()) == expected
    batches = sorted(r.batch_id for r in spark.read.parquet(out).select("batch_id").distinct().collect())
    assert batches == [0, 1]

    incremental.write_batch(raw.movements.where("source_file like '%/m1.csv'"), 0, out)
    incremental.write_batch(raw.movements.where("source_file like '%/m2.csv'"), 1, out)
    assert sorted(incremental.read_daily(spark, out).collect()) == expected

    incremental.compact(spark, out, f"{tmp_path}/compact")
    assert sorted(incremental.read_daily(spark, f"{tmp_path}/compact").collect()) == expected


def test_replay_after_compaction_counts_once(spark, files, tmp_path):
    raw, out, target = open_all(spark, files), f"{tmp_path}/daily", f"{tmp_path}/folded"
    parts = [raw.movements.where(f"source_file like '%/m{n}.csv'") for n in (1, 2)]
    for number, part in enumerate(parts):
        incremental.write_batch(part, number, out)
    incremental.compact(spark, out, target)
    expected = sorted(incremental.read_daily(spark, out).collect())
    incremental.write_batch(parts[1], 1, target)  # written before, not committed, replayed
    assert sorted(incremental.read_daily(spark, target).collect()) == expected
    incremental.write_batch(parts[0], 2, target)
    incremental.compact(spark, target, f"{tmp_path}/again")
    incremental.write_batch(parts[0], 2, f"{tmp_path}/again")
    twice = {r.mat_sku: r.opening_qty for r in incremental.read_daily(spark, f"{tmp_path}/again").collect()}
    assert incremental.folded_upto(spark, f"{tmp_path}/again") == 2 and twice["007"] == 25.0


@pytest.mark.parametrize("value", ["abc", "NaN", "1 234", "Infinity"])
def test_unreadable_numbers_refuse_a_load(spark, files, tmp_path, value):
    (files / "moves" / "m3.csv").write_text(MOVE_HEADER + f'7,007,2025-01-02,{value},1,1,1\n8,007,2025-01-02,"1,234.50",1,1,1\n')
    with pytest.raises(RefusedLoad, match="OPEN_QTY: 2 of 7"):
        load_star(spark, open_all(spark, files), f"{tmp_path}/v")
    with pytest.raises(RefusedLoad):
        read_star(spark, f"{tmp_path}/v")
    load_star(spark, open_all(spark, files), f"{tmp_path}/w", tolerance=0.5)
    assert float(read_star(spark, f"{tmp_path}/w").fact.first().opening_qty) == 15.0


def test_null_keys_do_not_multiply_on_reloads(spark, files, tmp_path):
    with (files / "items.csv").open("a") as f:
        f.write(",Nameless,g,T1,cold,12.0,1\n9,Nine,g,T1,cold,12.0,1\n")
    with (files / "vendors.csv").open("a") as f:
        f.write(",Nobody,Local,X,Active\n")
    previous, sizes = None, []
    for number in range(3):
        load_star(spark, open_all(spark, files), f"{tmp_path}/v{number}", previous)
        previous = read_star(spark, f"{tmp_path}/v{number}")
        sizes.append((previous.items.count(), previous.vendors.count()))
    assert sizes == [(3, 1)] * 3
    assert previous.items.where("medicine_sku = '9'").first().expiration_months == 12


def test_broken_star_stays_unreadable(spark, files, tmp_path):
    load_star(spark, open_all(spark, files), f"{tmp_path}/v")
    good = read_star(spark, f"{tmp_path}/v")
    for name, fact in {"twice": good.fact.unionByName(good.fact), "orphan": good.fact.withColumn("vendor_id_fk", F.lit(99).cast("long"))}.items():
        path = f"{tmp_path}/{name}"
        for table, frame in (("dim_item", good.items), ("dim_vendor", good.vendors), ("dim_calendar", good.calendar)):
            write_table(frame, f"{path}/{table}")
        write_fact(fact, f"{path}/fact_inventory")
        with pytest.raises(RefusedLoad):
            publish(spark, path)
        with pytest.raises(RefusedLoad):
            read_star(spark, path)


def test_stream_resumes_with_new_files_only(spark, files, tmp_path):
    out, checkpoint = f"{tmp_path}/daily", f"{tmp_path}/ck"
    incremental.ingest_files(stream_files(spark, f"{files}/moves"), out, checkpoint).awaitTermination()
    # a later file may have its columns in another order
    (files / "moves" / "m9.csv").write_text("MAT_SKU,INGTN_TS,CLSD_QTY,ISSD_QTY,RCVD_QTY,OPEN_QTY\n007,2025-01-02,100,0,0,100\n")
    incremental.ingest_files(stream_files(spark, f"{files}/moves"), out, checkpoint).awaitTermination()
    got = {(r.mat_sku, r.movement_date): r.opening_qty for r in incremental.read_daily(spark, out).collect()}
    assert got[("007", dt.date(2025, 1, 2))] == 115.0
