"""The corpus pipeline against brute force, and queries against their SQL."""

import sys
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from shelfline.llm import base, decontaminate, exact_dedup, importance, language, licenses, pieces, quality, queries, simhash

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from compare import connect, differences  # noqa: E402
from test_dedup_operators import brute_components, brute_print, fold  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_equals_its_sql(spark, name):
    assert differences(queries.QUERIES[name](spark, SF_DIR), connect(SF_DIR), queries.ORACLE[name]) is None


def test_every_query_has_its_contract_columns(spark):
    contract = {
        "op2": "doc_id held_out score predicted",
        "op3": "doc_id keep_id group_size kept text_sha256",
        "op4": "doc_id n_words n_removed kept_sha256",
        "op6": "doc_id fingerprint component_id",
        "op7": "conv_id n_turns turns_sha256 loss_chars loss_sha256 formatted_chars",
        "op8": "doc_id held_out lang_pred score",
        "op9": "doc_id n_words n_base first_word last_word base_labels labels score",
        "op10": "page_id url text n_chars",
        "op11": "vec_id code error label_error codebooks_sha256",
        "op12": "doc_id n_email n_ip n_card n_phone base_sha256 spans",
        "op13": "doc_id n_features weight score rank",
    }
    for name, query in queries.QUERIES.items():
        number = name.split("_")[0]
        if number in contract:
            assert set(contract[number].split()) <= set(query(spark, SF_DIR).columns)


def test_pipeline_equals_brute_force(spark):
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{SF_DIR}/documents.parquet'").fetchall()
    items = [fold(t).split() for (t,) in duckdb.sql(f"SELECT text FROM '{SF_DIR}/benchmark.parquet'").fetchall()]
    docs, labels = (spark.read.parquet(f"{SF_DIR}/{n}.parquet") for n in ("documents", "labels"))
    good = {r.doc_id for r in quality.score_documents(docs, labels).where("predicted = 1").collect()}
    best = {}
    for d, t in rows:
        if d in good:
            best[fold(t)] = max(d, best.get(fold(t), d))
    left = sorted((d, t) for d, t in rows if d in good and best[fold(t)] == d)
    classes = brute_components([brute_print(t, 4) for _, t in left], 4)
    left = [row for k, row in enumerate(left) if classes[k] == k]
    known = {}
    for words in items:
        known.setdefault(tuple(words[:8]), []).append(words)

    def holds(text):
        words = fold(text).split()
        return any(
            words[k : k + len(item)] == item for k in range(len(words)) for item in known.get(tuple(words[k : k + 8]), [])
        )

    want = {d: t for d, t in left if not holds(t)}
    result = corpus_pipeline.run(spark, SF_DIR)
    got = {r.doc_id: r.text for r in pieces.decode_documents(result).collect()}
    assert got == want and 0 < len(got) < len(rows)


def test_stages_keep_the_columns_of_documents(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF_DIR).columns == docs.columns
        assert stage(spark, docs.limit(0), SF_DIR).count() == 0


def test_stages_decide_on_rows_whatever_their_ids(spark):
    def left(stage, rows):
        docs = spark.createDataFrame(rows, "doc_id long, text string, kept string").repartition(3)
        return sorted((r.doc_id if r.doc_id is not None else -1, r.text or "") for r in stage(docs).collect())

    rows = [(1, "a", "x"), (1, "b", "x"), (2, "b", "x"), (None, "c", "x"), (None, "d", "x"), (3, "D", "x"), (4, "E", "x"), (4, "e", "x")]
    got = left(exact_dedup.drop_copies, rows)
    assert [r for r in got if r[0] != 4] == [(-1, "c"), (1, "a"), (2, "b"), (3, "D")] and len(got) == 5

    words = [f"word{k} and{k} more{k}" for k in range(400)]
    long = " ".join(words[:200])
    other = " ".join(words[200:])
    rows = [(1, long, "x"), (1, other, "x"), (2, long + " end", "x"), (2, "quite another text than these", "x"), (0, other + " end", "x")]
    rows += [(None, "one more that has no id at all", "x"), (None, long + " more", "x")]
    want = [(-1, rows[5][1]), (0, rows[4][1]), (1, long), (2, rows[3][1])]
    assert left(simhash.keep_firsts, rows) == sorted(want)
    assert len(left(simhash.keep_firsts, [(None, long, "x"), (None, long + " end", "x")])) == 1

    items = spark.createDataFrame([(1, words[0] + " " + words[1] + " " + words[2])], "item_id long, text string")
    rows = [(None, "see " + words[0] + " " + words[1] + " " + words[2], "x"), (None, other, "x"), (None, None, "x"), (5, other, "x"), (5, long, "x")]
    assert left(lambda docs: decontaminate.drop_leaks(docs, items), rows) == sorted([(-1, other), (-1, ""), (5, other)])


def test_one_bad_row_takes_no_other_of_its_id(spark, monkeypatch):
    class Model:
        def score(self, rows):
            return (rows[:, quality.MEASURES.index("digit")] == 0).astype(float)

    monkeypatch.setattr(quality, "learn", lambda table, labels: Model())
    docs = spark.createDataFrame([(None, "bad 1"), (None, "good"), (1, "good"), (1, "bad 22"), (2, None)], "doc_id long, text string")
    assert [r.text for r in quality.keep_good(docs, None).collect()] == ["good", "good", None]


def test_filtering_keeps_what_scoring_keeps(spark):
    docs, labels = (spark.read.parquet(f"{SF_DIR.replace('0.001', '0.01')}/{n}.parquet") for n in ("documents", "labels"))
    kept = quality.keep_good(docs, labels)
    good = quality.score_documents(docs, labels).where("predicted = 1").select("doc_id")
    assert kept.columns == docs.columns and kept.select("doc_id").exceptAll(good).count() == 0 == good.exceptAll(kept.select("doc_id")).count()


def test_filters_move_no_text(spark):
    docs, labels, items = (spark.read.parquet(f"{SF_DIR}/{n}.parquet") for n in ("documents", "labels", "benchmark"))
    for kept in (quality.keep_good(docs, labels), decontaminate.drop_leaks(docs, items)):
        assert "Exchange" not in kept._jdf.queryExecution().executedPlan().toString()


def test_rows_are_told_apart_by_their_place(spark, tmp_path):
    frame = spark.range(1000).select((F.col("id") % 3).alias("doc_id"), F.lit("same").alias("text"))
    frame.repartition(7).write.parquet(str(tmp_path / "docs"))
    stored = spark.read.parquet(str(tmp_path / "docs"))
    for docs in (stored, stored.unionAll(stored), frame):
        rows = base.with_row(docs)
        assert rows.select(base.ROW).distinct().count() == docs.count()
        some = base.written(rows.where("doc_id = 1").select(base.ROW), "some")
        assert base.keep_rows(rows, some, "left_anti").where("doc_id = 1").count() == 0
        assert base.keep_rows(rows, some).where("doc_id = 1").count() == docs.where("doc_id = 1").count()


def test_a_run_leaves_its_result_only(spark):
    before = len(base._tables)
    result = corpus_pipeline.run(spark, SF_DIR)
    assert len(base._tables) == before + 1 and result.count() > 0
    base.discard_written(spark, before)
    assert len(base._tables) == before


def test_very_long_texts(spark):
    """One text of some megabytes beside short ones: as many rows as came in, and what stands at its end is found."""
    item = "which river floods the old vineyards below the northern mountain each spring when snow melts early"
    long = "some plain words that go on and on\n" * 80_000
    rows = [(1, long + item + " mit license"), (2, "short text of a few plain words"), (3, "x" * 2_000_000), (4, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("lang", F.when(F.col("doc_id") == 2, "en"))
    labels = spark.createDataFrame([(2, 1, 0), (1, 0, 0)], "doc_id long, quality int, toxic int")
    items = spark.createDataFrame([(7, item)], "item_id long, text string")
    assert [(r.doc_id, r.item_id) for r in decontaminate.find_leaks(docs, items).collect()] == [(1, 7)]
    assert sorted(r.doc_id for r in decontaminate.drop_leaks(docs, items).collect()) == [2, 3, 4]
    assert sorted(r.doc_id for r in quality.score_documents(docs, labels).collect()) == [1, 2, 3, 4]
    assert quality.keep_good(docs, labels).count() <= 4
    found = {r.doc_id: r for r in licenses.scan_licenses(docs).collect()}
    assert found[1].base_labels == "mit" and found[1].last_word == found[1].n_words - 2 and found[3].n_words == 1
    assert {r.doc_id for r in language.learn_and_identify(docs).collect()} == {1, 2, 3, 4}
    assert {r.doc_id: r.n_features for r in importance.resample(docs, items.select("text")).collect()}[3] == 1
    assert {r.doc_id: r.n_pieces > 0 for r in pieces.checked_documents(docs).collect()} == {1: True, 2: True, 3: True, 4: False}


def test_pipeline_says_whether_its_pieces_read_back(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "a text"), (None, None), (2, "  \u2581x")], "doc_id long, text string")
    rows = corpus_pipeline.encoded_documents(spark, docs, SF_DIR).collect()
    assert [r.lossless for r in rows] == [True] * 3 and all(r.n_pieces == len(r.ids) for r in rows)
    decode = pieces.decode_documents
    monkeypatch.setattr(pieces, "decode_documents", lambda *a: decode(*a).withColumn("text", F.upper("text")))
    assert sorted(r.lossless for r in corpus_pipeline.encoded_documents(spark, docs, SF_DIR).collect()) == [False, False, True]
