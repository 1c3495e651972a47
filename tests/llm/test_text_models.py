"""Quality, language, decontamination and pieces."""

import random

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F

from shelfline.llm import decontaminate, language, pieces, quality

DOCS = "doc_id long, text string"
ITEMS = "item_id long, text string"


# --- quality --------------------------------------------------------------------------------------


def sentence(rnd, n):
    return " ".join(rnd.choice(["tion", "the", "ing", "stan", "er", "of"]) + rnd.choice(["", "ra", "lo", "mi"]) for _ in range(n)).capitalize() + "."


@pytest.fixture(scope="module")
def graded():
    rnd = random.Random(2)
    rows, labels = [], []
    for k in range(900):
        good = rnd.random() < 0.7
        n = rnd.randrange(20, 80)
        bad = [" ".join(["SPAM!!"] * n), " ".join(w + "###" for w in sentence(rnd, n).split()), "x " * n]
        rows.append((k, sentence(rnd, n) if good else rnd.choice(bad), good))
        if rnd.random() < 0.4:
            labels.append((k, int(good), 0))
    return rows, labels


def test_quality_on_held_out_rows(spark, graded):
    rows, labels = graded
    docs = spark.createDataFrame([r[:2] for r in rows] + [(5000, None), (5001, "")], DOCS).withColumn("positive", F.lit(True))
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in quality.score_documents(docs, marks).collect()}
    assert len(got) == 902 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())
    held = [(got[k].predicted, good) for k, _, good in rows if got[k].held_out]
    assert 200 < len(held) < 400 and np.mean([p == g for p, g in held]) > 0.97
    assert got[5000].score == got[5001].score


def test_negative_labels_teach_nothing(spark, graded):
    rows, labels = graded
    docs = spark.createDataFrame([r[:2] for r in rows], DOCS)
    schema = "doc_id long, quality int, toxic int"
    drop = [x for x in labels if x[1]]
    unseen = docs.join(spark.createDataFrame([x for x in labels if not x[1]], schema), "doc_id", "left_anti")
    one = {r.doc_id: r.score for r in quality.score_documents(docs, spark.createDataFrame(labels, schema)).collect()}
    two = {r.doc_id: r.score for r in quality.score_documents(unseen, spark.createDataFrame(drop, schema)).collect()}
    assert max(abs(one[k] - two[k]) for k in two) < 1e-9


def some_moments(rng, n_p=60, n_u=90, size=12):
    """Rows of a few positives and unlabelled, separable enough for the unbiased risk to go below 0, and their moments."""
    x_p, x_u = (np.hstack([rng.normal(m, 1, (n, size - 1)), np.ones((n, 1))]) for m, n in ((0.4, n_p), (0.0, n_u)))
    return x_p, x_u, quality.Moments.of(x_p.T @ x_p, x_u.T @ x_u)


def test_risks_from_moments_equal_those_over_rows():
    rng = np.random.default_rng(1)
    x_p, x_u, moments = some_moments(rng)
    for prior in (0.2, 0.7):
        w = rng.normal(size=12)
        positive = prior * ((x_p @ w - 1) ** 2).mean() / 4
        negative = ((x_u @ w + 1) ** 2).mean() / 4 - prior * ((x_p @ w + 1) ** 2).mean() / 4
        assert np.isclose(moments.positive_risk(w, prior), positive) and np.isclose(moments.negative_risk(w, prior), negative)


@pytest.mark.parametrize("prior", [0.3, 0.6, 0.9])
def test_the_fit_is_the_least_non_negative_risk(monkeypatch, prior):
    monkeypatch.setattr(quality, "SIZE", 11)
    rng = np.random.default_rng(7)
    x_p, x_u, moments = some_moments(rng)
    ridge = (quality.RIDGE + quality.RIDGE_ROWS / moments.n) * np.eye(12)
    ridge[-1, -1] = 1e-9

    def risk(w):
        positive = prior * ((x_p @ w - 1) ** 2).mean() / 4
        negative = ((x_u @ w + 1) ** 2).mean() / 4 - prior * ((x_p @ w + 1) ** 2).mean() / 4
        return positive + max(0.0, negative) + w @ ridge @ w / 4, negative

    w = moments.fit(prior)
    least, negative = risk(w)
    assert negative >= -1e-9
    for size in (1e-3, 1e-2, 0.1, 1.0):  # the risk is convex, so no better place near means none anywhere
        assert all(risk(w + size * rng.normal(size=12))[0] >= least - 1e-9 for _ in range(500))
    slow, pace = np.zeros(12), 0.02  # plain descent over rows, from afar
    for _ in range(20_000):
        value, below = risk(slow)
        slope = prior * x_p.T @ (x_p @ slow - 1) / len(x_p) / 2 + ridge @ slow / 2
        if below > 0:
            slope = slope + x_u.T @ (x_u @ slow + 1) / len(x_u) / 2 - prior * x_p.T @ (x_p @ slow + 1) / len(x_p) / 2
        slow = slow - pace * slope
        pace = max(pace * 0.9997, 1e-4)
    assert risk(slow)[0] >= least - 1e-9 and risk(slow)[0] < least + 5e-3


def test_learnt_risk_is_not_negative(spark, monkeypatch):
    fits = []
    fit = quality.Moments.fit
    monkeypatch.setattr(quality.Moments, "fit", lambda m, prior: fits.append((m, fit(m, prior), prior)) or fits[-1][1])
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{n}.parquet") for n in ("documents", "labels"))
    got = quality.score_documents(docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert all(m.negative_risk(w, prior) > -1e-9 for m, w, prior in fits)
    assert sum(r.predicted == r.quality for r in got) > 0.97 * len(got)


def test_prior_is_near_the_truth(graded):
    rows, _ = graded
    rng = np.random.default_rng(0)
    good, mixed = rng.normal(1, 1, 20_000), np.concatenate([rng.normal(1, 1, 14_000), rng.normal(-4, 0.5, 6_000)])
    edges = np.linspace(-6, 5, 200)
    tails = [np.array([(x >= e).sum() for e in edges], float) for x in (good, mixed)]
    assert abs(quality.class_prior(*tails) - 0.7) < 0.03


@pytest.mark.parametrize("labels", [[], [(0, 0, 0)], [(None, 1, 0)]])
def test_nothing_to_learn_scores_half(spark, labels):
    docs = spark.createDataFrame([(0, "a"), (None, "b"), (0, "a")], DOCS)
    got = quality.score_documents(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    assert [r.score for r in got] == [0.5] * 3
    none = spark.createDataFrame([], DOCS)
    assert quality.score_documents(none, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).count() == 0


def test_a_corpus_with_labels_throughout_is_learnt(spark, graded):
    docs = spark.createDataFrame([r[:2] for r in graded[0]], DOCS)
    marks = spark.createDataFrame([(r[0], int(r[2]), 0) for r in graded[0]], "doc_id long, quality int, toxic int")
    truth = {r[0]: r[2] for r in graded[0]}
    got = [r for r in quality.score_documents(docs, marks).collect() if r.held_out]
    assert sum(r.predicted == truth[r.doc_id] for r in got) > 0.9 * len(got)


# --- language -------------------------------------------------------------------------------------


def test_language_of_held_out_rows(spark):
    rnd = random.Random(3)
    parts = {"aa": ["th", "ing", "er", "the"], "bb": ["sch", "ung", "ü", "der"], "cc": ["ción", "que", "ñ", "los"]}
    rows = []
    for k in range(240):
        lang = rnd.choice(list(parts))
        words = ["".join(rnd.choices(parts[lang], k=rnd.randrange(1, 4))) for _ in range(rnd.randrange(5, 60))]
        rows.append((k, " ".join(words), lang))
    extra = [(900, None, "aa"), (901, "", None), (902, "12 !? 34", "bb"), (903, "THE ING", None), (0, rows[0][1], rows[0][2]), (None, "der ung", "bb")]
    docs = spark.createDataFrame(rows + extra, "doc_id long, text string, lang string").withColumn("held_out", F.lit(9))
    got = {r.doc_id: r for r in language.learn_and_identify(docs).collect()}
    assert all(got[k].lang_pred == lang for k, _, lang in rows)
    assert [got[k].lang_pred for k in (900, 901, 902, 903)] == ["und", "und", "und", "aa"]
    assert all(0 <= r.score <= 1 for r in got.values())


def test_language_distance_equals_brute_force():
    ranked = [("x", 5, 0), ("x", 6, 1), ("y", 6, 0), ("y", 7, 1)]
    profiles = language.Profiles(ranked, 2)
    points = np.array([0, 97, 97, 98, 0], np.int64)
    grams, counts = np.unique(language.grams_of(points), return_counts=True)
    assert counts.sum() == 3 + 4 + 3
    assert profiles.predict(points) == ("x", 0.0)


def test_language_without_training(spark):
    docs = spark.createDataFrame([(1, "abc", None)], "doc_id long, text string, lang string")
    assert language.learn_and_identify(docs).first().lang_pred == "und"
    assert language.learn_and_identify(docs.limit(0)).count() == 0


# --- decontamination ------------------------------------------------------------------------------


def brute_align(a, b):
    table = np.zeros((len(a) + 1, len(b) + 1), int)
    for i, x in enumerate(a, 1):
        for j, y in enumerate(b, 1):
            table[i, j] = max(0, table[i - 1, j - 1] + (2 if x == y else -1), table[i - 1, j] - 1, table[i, j - 1] - 1)
    return table.max()


def test_smith_waterman_equals_the_recurrence():
    rng = np.random.default_rng(8)
    items, texts = rng.integers(2, 7, (200, 11)).astype(np.uint64), rng.integers(2, 7, (200, 23)).astype(np.uint64)
    items[:50, 7:], texts[:50, 15:] = 0, 1
    scores, begins, ends = decontaminate.smith_waterman(items, texts)
    for k in range(200):
        a, b = items[k][items[k] != 0], texts[k][texts[k] != 1]
        assert scores[k] == brute_align(a.tolist(), b.tolist())
        if scores[k]:
            assert brute_align(a.tolist(), texts[k][begins[k] : ends[k]].tolist()) == scores[k]


@pytest.mark.parametrize("block_words", [decontaminate.BLOCK_WORDS, 40])
def test_leaks_are_found_and_clean_texts_left(spark, block_words):
    rnd = random.Random(11)
    vocabulary = [f"w{k}é" for k in range(400)] + ["the", "of", "and"] * 40
    items = [(k, " ".join(rnd.choices(vocabulary, k=rnd.randrange(14, 50))) + ".") for k in range(20)]
    items += [(50, "Ab Cd"), (51, ""), (52, None), (53, items[0][1])]
    rows, want = [], set()
    for d in range(120):
        words = rnd.choices(vocabulary, k=rnd.randrange(0, 150))
        if d % 3 == 0:
            i, text = items[d % 20]
            copy = text.upper().replace("É", "é").split() if d % 2 else text.split()
            if d % 9 == 0:  # edited: some words replaced, lost and put in
                for _ in range(len(copy) // 9):
                    copy[rnd.randrange(len(copy))] = "changed"
                del copy[rnd.randrange(len(copy))]
                copy.insert(rnd.randrange(len(copy)), "more")
            at = rnd.randrange(len(words) + 1)
            words[at:at] = copy
            want.add((d, i))
        rows.append((d, " ".join(words)))
    want |= {(d, 53) for d, i in want if i == 0}
    rows += [(500, None), (501, "x ab, cd y"), (502, rows[0][1]), (502, rows[0][1])]
    want |= {(502, i) for d, i in want if d == 0}
    docs = spark.createDataFrame(rows, DOCS).withColumn("item_id", F.lit("clash"))
    got = decontaminate.find_leaks(docs, spark.createDataFrame(items, ITEMS), block_words=block_words).collect()
    assert {(r.doc_id, r.item_id) for r in got} == want
    assert all(0.5 <= r.similarity <= 1 and r.doc_end > r.doc_start for r in got)
    weak = decontaminate.find_leaks(docs, spark.createDataFrame(items, ITEMS), block_words=block_words, weak=True).collect()
    exact = next(r for r in weak if r.doc_id == 501)  # two words say too little, and are given on request
    assert (exact.doc_start, exact.doc_end, exact.similarity, exact.convincing) == (1, 3, 1.0, False)
    assert {(r.doc_id, r.item_id) for r in weak if r.convincing} == want


def test_edited_copies_are_found_beside_exact_ones(spark):
    rnd = random.Random(3)
    vocabulary = [f"w{k}" for k in range(3000)]
    items = [(k, " ".join(rnd.choices(vocabulary, k=n))) for k, n in enumerate([30, 31, 33, 40, 12, 7])]
    rows, want = [], set()
    for i, text in items:
        for step, edit in ((0, ""), (5, "new"), (4, "new"), (3, "new"), (3, "gone"), (1, "more")):
            words = []
            for k, word in enumerate(text.split()):
                if step and k % step == step - 1:
                    words += {"new": ["xx"], "gone": [], "more": [word, "xx"]}[edit]
                else:
                    words.append(word)
            around = [rnd.choices(vocabulary, k=60) for _ in range(2)]
            rows.append((len(rows), " ".join([*around[0], *words, *around[1]])))
            score = brute_align(text.split(), rows[-1][1].split())
            # half of a perfect score, worth eight matches at least or all words of a shorter item
            if score >= max(len(text.split()), 2 * min(len(text.split()), 8)):
                want.add((len(rows) - 1, i, score))
    assert len(want) >= 24
    for docs in (rows, rows[1:]):
        got = decontaminate.find_leaks(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)).collect()
        assert {(r.doc_id, r.item_id, r.score) for r in got} == {w for w in want if w[0] >= docs[0][0]}


PROSE = [
    ("What is the capital of Peru?", "She asked me what is the best way to get there before the night falls."),
    ("Is it true that the earth is flat?", "It is true that the sky is blue, and that is all there is to it."),
    ("yes", "Yes, he said, and yes again, and then yes once more."),
    ("the answer is", "This is a sentence about the answer is what she thought of."),
    ("Which of the following is a mammal that lives in the sea?", "Which of the following words is the one that she wrote in the book?"),
]


def test_natural_short_questions_leave_clean_texts_alone(spark):
    rnd = random.Random(4)
    common = "the of and to in is was for that with on as by from this not are but had which one all were it she he be at".split()
    rest = [f"{a}{b}{c}" for a in ("ba", "ko", "ri", "mu") for b in ("ten", "lor", "sim", "var") for c in ("a", "is", "on", "ed", "y")]
    filler = [(100 + k, " ".join(rnd.choice(common if rnd.random() < 0.6 else rest) for _ in range(300))) for k in range(60)]
    clean = [(k, text) for k, (_, text) in enumerate(PROSE)]
    question = "Which river of the old kingdom of Karvaly floods the vineyards below Mount Tessen each spring"
    copy = question.lower().replace("old", "ancient").replace("each spring", "in every single spring")
    docs = spark.createDataFrame([*filler, *clean, (50, f"and so {copy} it says"), (51, filler[0][1] + " " + question)], DOCS)
    items = spark.createDataFrame([(k, q) for k, (q, _) in enumerate(PROSE)] + [(9, question)], ITEMS)
    assert {(r.doc_id, r.item_id) for r in decontaminate.find_leaks(docs, items).collect()} == {(50, 9), (51, 9)}
    weak = decontaminate.find_leaks(docs, items, weak=True).collect()
    assert {(r.doc_id, r.item_id) for r in weak if r.convincing} == {(50, 9), (51, 9)}
    assert (2, 2) in {(r.doc_id, r.item_id) for r in weak if not r.convincing}  # "yes", as it stands
    left = {r.doc_id for r in decontaminate.drop_leaks(docs, items).collect()}
    assert left == {k for k, _ in filler + clean}
    assert {r.doc_id for r in decontaminate.drop_leaks(docs, items, block_words=20).collect()} == left


def test_no_items_no_leaks(spark):
    docs, none = spark.createDataFrame([(1, "a b c d")], DOCS), spark.createDataFrame([], ITEMS)
    assert decontaminate.find_leaks(docs, none).count() == 0
    assert decontaminate.drop_leaks(docs, none).count() == 1
    assert decontaminate.find_leaks(docs.limit(0), spark.createDataFrame([(1, "a b c d")], ITEMS)).count() == 0


# --- pieces ---------------------------------------------------------------------------------------

ODD = ["", "  a  b", " ", "▁x ▁▁", "日本語🙂", "\n\n\t x", "a" * 300, "hello" * 20, "éñ", "x\u0000y", " " * 40 + "z", "a b", "The cat sat. " * 30]


@pytest.fixture(scope="module")
def vocabulary(spark):
    return pieces.read_model(spark)


def encoded(encoder, texts):
    ids, edges = encoder.encode(pa.array(texts), list(range(len(texts))))
    return [ids[a:b].tolist() for a, b in zip(edges[:-1], edges[1:], strict=True)]


def test_without_dropout_the_pieces_are_the_librarys(vocabulary):
    library = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    got = encoded(pieces.Encoder(vocabulary, 0.0), ODD)
    for text, ids in zip(ODD, got, strict=True):
        if text and "▁" not in text:
            assert ids == library.encode(text)


@pytest.mark.parametrize("rate", [0.0, 0.1, 0.5, 1.0])
def test_decoding_loses_nothing(vocabulary, rate):
    for text, ids in zip(ODD, encoded(pieces.Encoder(vocabulary, rate, seed=3), ODD), strict=True):
        assert pieces.decode(vocabulary, ids).decode() == text


def test_many_at_a_time_equals_one_at_a_time(vocabulary):
    rng = np.random.default_rng(5)
    letters = [vocabulary.characters[c] for c in "aehinorst▁"] + [vocabulary.size + 0x4E00]
    rows = rng.choice(letters, (300, 12))
    for k, n in enumerate(rng.integers(1, 13, 300)):
        rows[k, n:] = -1
    keys = rng.integers(0, 1 << 63, 300).astype(np.uint64)
    for rate in (0.0, 0.3):
        many = pieces.cut_many(vocabulary, rows, keys, rate)
        for row, cut, key in zip(rows, many, keys.tolist(), strict=True):
            assert cut[cut >= 0].tolist() == pieces.cut_one(vocabulary, row[row >= 0].tolist(), key, rate)


def test_seeds_vary_and_repeat(vocabulary):
    text = ["international understanding of segmentation " * 20]
    one, same, other = (encoded(pieces.Encoder(vocabulary, 0.2, seed), text)[0] for seed in (1, 1, 2))
    assert one == same != other
    plain = encoded(pieces.Encoder(vocabulary, 0.0), text)[0]
    assert len(one) > len(plain)
    words = {tuple(encoded(pieces.Encoder(vocabulary, 0.2, 1), [" understanding" * 40])[0][k : k + 3]) for k in range(0, 60, 3)}
    assert len(words) > 1


def test_every_occurrence_of_a_word_is_cut_by_its_own_coins(vocabulary):
    texts = [" understanding" * 3000, " of a the" * 400, " understanding" * 50, "x" + "anders" * 9 + " the of" * 30]
    encoder = pieces.Encoder(vocabulary, 0.1, 1)
    got = encoded(encoder, texts)
    cuts = [tuple(vocabulary.bytes_of[i] for i in ids) for ids in got]
    words, word = {}, []
    for piece in cuts[0]:
        if piece.startswith(b" ") and word:
            words[tuple(word)] = words.get(tuple(word), 0) + 1
            word = []
        word.append(piece)
    assert len(words) > 20
    plain = tuple(vocabulary.bytes_of[i] for i in encoded(pieces.Encoder(vocabulary, 0.0), [" understanding"])[0])[1:]
    assert 0.05 < words.get((b" " + plain[0].lstrip(), *plain[1:]), 0) / 3000 < 0.9
    # the plain cut, where it is taken, is the cut that the occurrence's own coins give
    shared, encoder.skipping = encoder, lambda unit, keys, n_units, made: np.ones(len(unit), bool)
    assert encoded(shared, texts) == got
    # equal ids or none: different texts have coins of their own
    ids, edges = pieces.Encoder(vocabulary, 0.1, 1).encode(pa.array([" understanding" * 40 + " a", " understanding" * 40 + " b"]), [None, None])
    assert ids[: edges[1] - 1].tolist() != ids[edges[1] : -1].tolist()


def test_documents_round_trip(spark):
    rows = [(k, t) for k, t in enumerate(ODD)] + [(None, "x"), (99, None), (1, ODD[1])]
    docs = spark.createDataFrame(rows, DOCS).withColumns({"ids": F.lit(1), "n_pieces": F.lit("x")})
    got = pieces.decode_documents(pieces.encode_documents(docs)).collect()
    assert sorted((str(r.doc_id), r.text) for r in got) == sorted((str(d), t or "") for d, t in rows)
    assert all(r.n_pieces == len(r.ids) for r in got)
    assert pieces.encode_documents(docs.limit(0)).count() == 0
