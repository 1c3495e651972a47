"""A star that takes batches: what a refused, broken-off, repeated or late one leaves, and who sees what when."""

import datetime as dt
import random
import threading

import pytest
from pyspark.sql import functions as F

from shelfline.plans import kpis, ledger, star_batches
from shelfline.plans.quality import star_report
from shelfline.plans.star_batches import add_batch, batch_report, compact, open_star, read_batches, read_sums, vacuum
from shelfline.plans.warehouse import RefusedLoad, load_star, read_star
from shelfline.session import subfolders
from shelfline.sources import RawInputs, stream_files
from shelfline.streaming import incremental

MOVES = "MAT_SKU string, INGTN_TS string, OPEN_QTY string, RCVD_QTY string, ISSD_QTY string, CLSD_QTY string"
SUPPLY = "MAT_SKU string, RCVD_DATE string, VEN_ACC string"
ITEMS = "MED_ID string, MED_NAME string, TYPE_DES string, STRG_DES string, COST_UN string, EXP_MON string"
VENDORS = "VEN_ACC string, VEN_NAME string, VEN_TYPE string, CTRY_NAME string, VSTAT_DES string"


@pytest.fixture
def make(spark):
    def frames(moves=(), supply=(), items=("007", "8"), vendors=("V1", "V2")):
        return RawInputs(
            spark.createDataFrame([(i, f"n{i}", "t", "s", "2.5", "1") for i in items], ITEMS),
            spark.createDataFrame([(v, v, "t", "c", "s") for v in vendors], VENDORS),
            spark.createDataFrame(list(supply), SUPPLY),
            spark.createDataFrame([(s, d, "10", "0", q, "8") for s, d, q in moves], MOVES),
        )

    return frames


def united(*batches):
    first = batches[0]
    moves, supply = first.movements, first.supply
    for b in batches[1:]:
        moves, supply = moves.unionByName(b.movements), supply.unionByName(b.supply)
    items, vendors = (
        [getattr(b, name) for b in batches] for name in ("items", "vendors")
    )
    for more in items[1:]:
        items[0] = items[0].unionByName(more).distinct()
    for more in vendors[1:]:
        vendors[0] = vendors[0].unionByName(more).distinct()
    return RawInputs(items[0], vendors[0], supply, moves)


def natural(star):
    rows = (
        star.fact.join(star.items.select(F.col("medicine_id_pk").alias("medicine_id_fk"), "medicine_sku"), "medicine_id_fk")
        .join(star.vendors.select(F.col("vendor_id_pk").alias("vendor_id_fk"), "vendor_account"), "vendor_id_fk")
        .drop("medicine_id_fk", "vendor_id_fk")
    )
    return sorted(tuple(r[c] for c in sorted(rows.columns)) for r in rows.collect())


def same_as_full(spark, path, tmp_path, *batches):
    load_star(spark, united(*batches), f"{tmp_path}/full")
    full, got = read_star(spark, f"{tmp_path}/full"), read_batches(spark, path)
    assert natural(got) == natural(full)
    assert sorted(r.full_date for r in got.calendar.collect()) == sorted(r.full_date for r in full.calendar.collect())
    return full


FIRST = [("007", "2025-01-05", "2"), ("007", "2025-01-20", "4"), ("007", "2025-03-10", "1"), ("8", "2025-03-11", "1")]
RECEIPTS = [("007", "2025-01-01", "V1"), ("8", "2025-03-01", "V1")]


def test_batches_rewrite_affected_months_only(spark, make, tmp_path):
    path = f"{tmp_path}/star"
    batches = [
        make(FIRST, [*RECEIPTS, ("007", "2025-02-01", "V1")]),
        make([("007", "2025-03-12", "3")]),
        make((), [("007", "2025-01-15", "V2"), ("007", "2025-01-25", "V1")]),
    ]

    def written(batch_id):
        return {int(n.partition("=")[2]) for n in subfolders(spark, f"{path}/fact/batch_id={batch_id}")}

    assert all(add_batch(spark, b, path, n) for n, b in enumerate(batches))
    assert [written(n) for n in range(3)] == [{202501, 202503}, {202503}, {202501}]
    assert not add_batch(spark, batches[1], path, 1) and not add_batch(spark, batches[1], path, 2)
    same_as_full(spark, path, tmp_path, *batches)


def test_a_refused_batch_counts_nowhere(spark, make, tmp_path):
    path = f"{tmp_path}/star"
    good, more = make(FIRST, RECEIPTS), make([("007", "2025-03-12", "3")])
    add_batch(spark, good, path, 0)
    before = natural(read_batches(spark, path))
    with pytest.raises(RefusedLoad, match="ISSD_QTY"):
        add_batch(spark, make([("007", "2025-03-13", "9"), ("007", "2025-03-14", "junk")], [("007", "2025-03-01", "V2")]), path, 1)
    assert natural(read_batches(spark, path)) == before and star_batches.last_batch(spark, path) == 0
    add_batch(spark, more, path, 2)
    same_as_full(spark, path, tmp_path, good, more)
    loads = {(r.batch_id, r.table_name): (r.n_rows, r.outcome) for r in ledger.load_ledger(spark, path).collect()}
    assert loads[1, None] == (None, "refused") and loads[0, "moves"] == (4, "added") and loads[2, "moves"] == (1, "added")


def test_a_refused_first_batch_leaves_no_star(spark, make, tmp_path):
    path = f"{tmp_path}/star"
    with pytest.raises(RefusedLoad):
        add_batch(spark, make([("007", "2025-03-14", "junk")], RECEIPTS), path, 0)
    with pytest.raises(RefusedLoad, match="no batch"):
        read_batches(spark, path)
    add_batch(spark, make(FIRST, RECEIPTS), path, 0)
    same_as_full(spark, path, tmp_path, make(FIRST, RECEIPTS))


def test_a_batch_broken_off_anywhere_counts_nowhere(spark, make, tmp_path, monkeypatch):
    path = f"{tmp_path}/star"
    first, second = make(FIRST, RECEIPTS), make([("007", "2025-03-12", "3")], [("007", "2025-03-11", "V2")], items=("007", "8", "9"))
    add_batch(spark, first, path, 0)
    before = natural(read_batches(spark, path))
    for step in ("_refuse_broken", "_item_months", "affected_months"):
        with monkeypatch.context() as patch:
            patch.setattr(star_batches, step, lambda *a, **b: (_ for _ in ()).throw(KeyboardInterrupt()))
            with pytest.raises(KeyboardInterrupt):
                add_batch(spark, second, path, 1)
        assert natural(read_batches(spark, path)) == before
    with monkeypatch.context() as patch:
        patch.setattr(ledger, "move", lambda *a: False)
        with pytest.raises(ledger.BrokenLedger):
            add_batch(spark, second, path, 1)
    assert natural(read_batches(spark, path)) == before
    add_batch(spark, second, path, 1)
    same_as_full(spark, path, tmp_path, first, second)


def test_readers_see_one_batch_throughout(spark, make, tmp_path, monkeypatch):
    path = f"{tmp_path}/star"
    first, second = make(FIRST, RECEIPTS), make([("007", "2025-01-06", "3")], [("007", "2025-01-02", "V2")], vendors=("V1", "V2", "V3"))
    add_batch(spark, first, path, 0)
    held, before = read_batches(spark, path), natural(read_batches(spark, path))
    reached, go, seen = threading.Event(), threading.Event(), []
    commit = ledger.commit

    def slow(*args):
        reached.set()
        assert go.wait(120)
        return commit(*args)

    monkeypatch.setattr(ledger, "commit", slow)
    writer = threading.Thread(target=lambda: seen.append(add_batch(spark, second, path, 1)))
    writer.start()
    assert reached.wait(120)
    assert natural(read_batches(spark, path)) == before  # all is written, nothing committed
    go.set()
    writer.join()
    assert seen == [True] and natural(held) == before != natural(read_batches(spark, path))
    same_as_full(spark, path, tmp_path, first, second)


def test_random_batches_equal_a_full_load(spark, make, tmp_path):
    rnd, path = random.Random(5), f"{tmp_path}/star"
    days = [str(dt.date(2024, 11, 1) + dt.timedelta(k)) for k in range(170)]
    batches = []
    for n in range(4):
        skus, vendors = ["a", "b", "c", "d"][: n + 2], ["V1", "V2", "V3"][: n + 1]
        moves = [(rnd.choice("abcd"), rnd.choice(days), str(rnd.randrange(5))) for _ in range(40)]
        supply = [(rnd.choice("abcd"), rnd.choice(days), rnd.choice(["V1", "V2", "V3", "V9"])) for _ in range(6)]
        batches.append(make(moves, supply, skus, vendors))
        add_batch(spark, batches[-1], path, n)
    full = same_as_full(spark, path, tmp_path, *batches)
    sums = read_sums(spark, path)
    for kpi in (kpis.raw_monthly_issued, kpis.raw_turnover, kpis.raw_surplus, kpis.stored_monthly_issued):
        assert kpi(sums).collect() == kpi(full).collect()
    wanted = {tuple(r) for r in star_report(full).collect()}
    assert {tuple(r) for r in batch_report(spark, path).collect()} == wanted

    compact(spark, path)
    assert open_star(spark, path).whole("moves", open_star(spark, path).parts("moves"))
    same_as_full(spark, path, tmp_path / "again", *batches)
    held = natural(read_batches(spark, path))
    assert vacuum(spark, path, keep=1) and not vacuum(spark, path, keep=1)
    assert natural(read_batches(spark, path)) == held
    assert not add_batch(spark, batches[0], path, 3)
    late = make([("a", days[60], "2")], [("b", days[0], "V2")], ["a", "b", "c", "d"], ["V1", "V2", "V3"])
    add_batch(spark, late, path, 4)
    same_as_full(spark, path, tmp_path / "late", *batches, late)


def test_orphans_show_in_the_bitmaps(spark, make, tmp_path):
    path = f"{tmp_path}/star"
    add_batch(spark, make(FIRST, RECEIPTS), path, 0)
    dims = star_batches._dims(spark, open_star(spark, path))
    fact = read_batches(spark, path).fact
    broken = fact.withColumn("vendor_id_fk", F.lit(70_000).cast("long")).unionByName(fact)
    found = {r.column_name: r.violations for r in star_batches._orphans(star_batches._fact_ids(broken), dims).collect()}
    assert found == {"date_id_fk": 0, "medicine_id_fk": 0, "vendor_id_fk": 1}
    doubled = star_batches._fact_checks(fact.unionByName(fact)).where("rule = 'unique'").agg(F.sum("violations")).first()[0]
    assert doubled == fact.count()


def test_a_stream_of_files_adds_batches_once(spark, make, tmp_path):
    folder, path, checkpoint = tmp_path / "moves", f"{tmp_path}/star", f"{tmp_path}/ck"
    folder.mkdir()
    (folder / "1.csv").write_text("MAT_SKU,INGTN_TS,OPEN_QTY,RCVD_QTY,ISSD_QTY,CLSD_QTY\n007,2025-01-05,10,0,2,8\n")
    (folder / "2.csv").write_text("CLSD_QTY,MAT_SKU,INGTN_TS,OPEN_QTY,RCVD_QTY,ISSD_QTY\n8,007,2025-01-20,10,0,4\n")
    master = make((), RECEIPTS)

    def run():
        incremental.ingest_star(stream_files(spark, str(folder)), lambda: master, path, checkpoint).awaitTermination()

    run()
    assert star_batches.last_batch(spark, path) == 1
    (folder / "3.csv").write_text("MAT_SKU,INGTN_TS,OPEN_QTY,RCVD_QTY,ISSD_QTY,CLSD_QTY\n007,2025-03-10,x,0,1,8\n")
    with pytest.raises(Exception, match="unreadable"):
        run()
    assert star_batches.last_batch(spark, path) == 1
    (folder / "3.csv").write_text("MAT_SKU,INGTN_TS,OPEN_QTY,RCVD_QTY,ISSD_QTY,CLSD_QTY\n007,2025-03-10,10,0,1,8\n")
    run()
    commits = sorted((tmp_path / "ck" / "commits").glob("[0-9]*"))
    commits[-1].unlink()  # as after a crash between the star's commit and the stream's
    for crc in (tmp_path / "ck" / "commits").glob(f".{commits[-1].name}.crc"):
        crc.unlink()
    run()
    same_as_full(spark, path, tmp_path, make(FIRST[:3], RECEIPTS))


def test_untouched_buckets_keep_their_files_and_ids(spark, make, tmp_path):
    path = f"{tmp_path}/star"
    many = [f"i{k}" for k in range(200)]
    add_batch(spark, make((), (), many), path, 0)
    ids = {r.medicine_sku: r.medicine_id_pk for r in star_batches._dims(spark, open_star(spark, path)).items.collect()}
    changed = make((), (), ["i5", "new"])
    changed = RawInputs(changed.items.withColumn("COST_UN", F.lit("9")), changed.vendors, changed.supply, changed.movements)
    add_batch(spark, changed, path, 1)
    live = open_star(spark, path).live["dim_item"]
    assert 1 <= sum(b == (1,) for b in live.values()) <= 2 and sum(b == (0,) for b in live.values()) >= 14
    after = {r.medicine_sku: (r.medicine_id_pk, float(r.unit_cost)) for r in star_batches._dims(spark, open_star(spark, path)).items.collect()}
    assert all(after[s][0] == n for s, n in ids.items()) and after["i5"][1] == 9.0 and after["i6"][1] == 2.5
    assert after["new"][0] == 201
    assert open_star(spark, path).live["dim_vendor"].keys() and all(b == (0,) for b in open_star(spark, path).live["dim_vendor"].values())


def test_the_index_is_asked_only_about_months_without_movements(spark, make, tmp_path, monkeypatch):
    path, asked, read = f"{tmp_path}/star", [], star_batches._read
    first = make(FIRST, RECEIPTS)
    everywhere = make([("8", "2025-01-31", "1"), ("8", "2025-03-02", "1")], [("007", "2025-01-02", "V2")])
    march = make([("007", "2025-03-20", "1")], [("007", "2025-01-18", "V1")])
    add_batch(spark, first, path, 0)

    def watched(session, snap, table, parts=None):
        if table == "item_months":
            asked.append(parts)
        return read(session, snap, table, parts)

    monkeypatch.setattr(star_batches, "_read", watched)
    add_batch(spark, everywhere, path, 1)
    assert asked == []
    add_batch(spark, march, path, 2)
    assert asked == [{202501}]
    monkeypatch.undo()
    assert open_star(spark, path).live["item_months"] == {202501: (2,), 202503: (2,)}
    same_as_full(spark, path, tmp_path, first, everywhere, march)


def test_many_receipts_of_a_sku_meet_a_month_once_each(spark):
    rnd = random.Random(7)
    day = lambda: dt.date(2023, 11, 1) + dt.timedelta(rnd.randrange(800))
    ends = [None, dt.date(9999, 12, 31)]
    ranges, index = [("a", dt.date(1, 1, 1), dt.date(2024, 1, 3)), ("a", dt.date(9999, 1, 1), None)], []
    for _ in range(40):
        since = day()
        ranges.append((rnd.choice("abc"), since, rnd.choice([*ends, *[since + dt.timedelta(rnd.randrange(70))] * 6])))
    months = [m for m in star_batches.months_between(dt.date(2024, 1, 1), dt.date(2025, 6, 1)) if rnd.random() < 0.7]
    for sku, month in ((s, m) for s in "abcd" for m in months if rnd.random() < 0.6):
        days = sorted(dt.date(month // 100, month % 100, rnd.randrange(1, 29)) for _ in range(2))
        index.append((sku, month, *days))
    left = spark.createDataFrame(ranges, "mat_sku string, since date, until date")
    right = spark.createDataFrame(index, "mat_sku string, month_id int, first_day date, last_day date")
    found = star_batches._months_in_ranges(left, right, months)
    wanted = [i[1] for r in ranges for i in index if r[0] == i[0] and i[3] >= r[1] and (r[2] is None or i[2] <= r[2])]
    assert sorted(r[0] for r in found.collect()) == sorted(wanted)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    join = next(line for line in plan.splitlines() if "Join Inner" in line)
    assert "mat_sku" in join and "month_id" in join


def test_months_before_an_affected_one():
    assert star_batches.months_needed([202503]) == {202501, 202502, 202503}
    assert star_batches.months_needed([202403]) == {202402, 202403}
    assert star_batches.months_needed([202501, 202512]) == {202412, 202501, 202511, 202512}


def test_history_is_dealt_by_sku_once(spark, make, tmp_path):
    """One vendor per (SKU, date) needs no exchange in one batch; over several, the as-of join reuses its exchange."""
    from shelfline.operators.asof import asof_carry

    path = str(tmp_path / "star")
    add_batch(spark, make([("007", "2025-01-05", "2")], [("007", "2025-01-01", "V1")]), path, 0)
    assert "Exchange" not in star_batches._receipts(spark, open_star(spark, path))._jdf.queryExecution().executedPlan().toString()
    add_batch(spark, make([("8", "2025-01-05", "2")], [("007", "2025-01-01", "V2")]), path, 1)
    snap = open_star(spark, path)
    known = star_batches._receipts(spark, snap)
    assert [tuple(r)[0::2] for r in known.collect()] == [("007", "V2")]
    joined = asof_carry(star_batches._daily(spark, snap, [202501]), known)
    assert joined._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 2
