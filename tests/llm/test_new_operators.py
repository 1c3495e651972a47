"""Vector codes, personal data and importance resampling against brute force."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfline.llm import importance, personal, vector_codes

# --- vector codes ---------------------------------------------------------------------------------

VECTORS = "vec_id long, embedding array<double>, label int"


def slow_codes(rows, parts, entries, rounds):
    """The same codes by plain integers."""
    whole = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    whole.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not whole:
        return {}
    length = len(whole[0][1])
    kept = [(i, [math.floor(4096 * x) if abs(x) < 1e15 else int(x) * 4096 for x in v], lab) for i, v, lab in whole if len(v) == length]
    width = -(-length // parts)
    cut = [[(v + [0] * (parts * width - length))[p * width : (p + 1) * width] for p in range(parts)] for _, v, _ in kept]
    books = [[list(c[p]) for c in cut[:entries]] for p in range(parts)]

    def near(part, book):
        found = [sum((a - b) ** 2 for a, b in zip(part, e, strict=True)) for e in book]
        return min(range(len(book)), key=lambda k: (found[k], k)), min(found)

    for _ in range(rounds):
        for p in range(parts):
            mine = [near(c[p], books[p])[0] for c in cut]
            for e in range(len(books[p])):
                of = [c[p] for c, m in zip(cut, mine, strict=True) if m == e]
                if of:
                    books[p][e] = [sum(x) // len(of) for x in zip(*of, strict=True)]
    out, per_label = [], Counter()
    for (i, _, lab), c in zip(kept, cut, strict=True):
        found = [near(c[p], books[p]) for p in range(parts)]
        error = min(sum(d for _, d in found), 2**63 - 1)
        per_label[lab] += error
        out.append((i, "".join(f"{k:02x}" for k, _ in found), error, lab))
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return Counter((i, code, error, min(per_label[lab], 2**63 - 1), digest) for i, code, error, lab in out)


def codes(spark, rows, **how):
    table = spark.createDataFrame(rows, VECTORS).withColumns({"code": F.lit("x"), "of": F.lit(1), "error": F.lit(2.5)})
    return Counter(tuple(r) for r in vector_codes.compress(table, **how).collect())


@pytest.mark.parametrize("size", [1.0, 3e4, 1e9, 1e14, 1e30])
def test_codes_equal_plain_integers_at_any_magnitude(spark, size):
    rnd = random.Random(3)
    rows = [(k, [rnd.gauss(0, size) for _ in range(8)], rnd.choice([0, 1, None])) for k in range(60)]
    assert codes(spark, rows, parts=4, entries=5, rounds=3) == slow_codes(rows, 4, 5, 3)


def test_codes_of_odd_rows(spark):
    rows = [
        (5, [0.1, 0.2, 0.3], 1), (1, None, 1), (2, [0.1, None, 0.3], 1), (3, [float("nan"), 0.0, 0.0], 2), (4, [float("inf"), 0.0, 0.0], 2),
        (6, [0.1, 0.2, 0.3], None), (6, [0.1, 0.2, 0.3], None), (None, [-0.5, 0.25, 0.0], 3), (7, [1.0, 2.0], 3), (8, [], 3), (9, [-0.1, -0.2, 0.0], 1),
    ]
    got = codes(spark, rows, parts=2, entries=3, rounds=2)
    assert got == slow_codes(rows, 2, 3, 2) and sum(got.values()) == 5


def test_no_vectors_no_codes(spark):
    assert not codes(spark, [])
    assert not codes(spark, [(1, None, 1)])


def test_limbs_and_products_are_exact():
    rng = np.random.default_rng(4)
    for top in (2**10, 2**21, 2**45, 2**61):
        a, b = rng.integers(-top, top, (7, 5)), rng.integers(-top, top, (3, 5))
        parts = vector_codes.limbs(a)
        assert np.array_equal(sum(p.astype(np.int64).astype(object) * 2 ** (20 * k) for k, p in enumerate(parts)), a.astype(object))
        assert np.array_equal(vector_codes.products(a, b).astype(object), a.astype(object) @ b.astype(object).T)


def test_the_first_of_equally_near_entries_counts():
    code, distance = vector_codes.nearest(np.array([[0, 0], [5, 5]]), np.array([[1, 0], [0, 1], [1, 0], [5, 5], [5, 5]]))
    assert code.tolist() == [0, 3] and distance.tolist() == [1, 0]


# --- personal data --------------------------------------------------------------------------------


def naive_base(text):
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m.group().split(".")):
            out.append((m.start(), 2, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub(r"[^0-9]", "", m.group())
        total = sum(int(d) if k % 2 == 0 else sum(divmod(2 * int(d), 10)) for k, d in enumerate(reversed(digits)))
        if 14 <= len(digits) <= 19 and total % 10 == 0:
            out.append((m.start(), 3, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub(r"[^0-9]", "", m.group())) <= 15:
            out.append((m.start(), 4, m.end()))
    return sorted(out)


def odd_text(rnd):
    value = [
        "a@b.c", "a@b.c@d.e", "@x.y", "a@", "x@y", "a.b+c@d-e.f..g", "1.2.3.4", "1.2.3.4.5.6.7.8", "256.1.1.1", "0001.2.3.255", "1.2.3",
        "4539 1488 0343 6467", "4539148803436467", "4539-1488-0343-6468", "45391488034364671234567", "+1 (017) 555-7713", "+1..2", "+12345 67890 ",
        "++49 30 1234567", "é", "🙂", "\n", "  ", "-", "+", ".", "7", "@",
    ]
    return "".join(rnd.choice(value) + rnd.choice(["", " ", "x"]) for _ in range(rnd.randrange(12)))


def test_base_spans_equal_the_patterns():
    rnd = random.Random(8)
    for _ in range(4000):
        text = odd_text(rnd)
        assert personal.base_spans(text) == naive_base(text), text


def test_long_runs_take_linear_time():
    text = "a" * 300_000 + " " + "1" * 300_000 + " " + "1." * 100_000 + "@" * 100_000 + "1 " * 100_000 + "+1 " * 50_000
    assert personal.base_spans(text) == personal.base_spans(text)
    personal.mentions_of(text, [])


def test_messages_give_exact_marginals_on_trees():
    rng = np.random.default_rng(5)
    field = personal.Field(np.zeros((1, 5)), np.array([0.5, 2.0, 1.0]))
    edges = [(0, 1, 0), (1, 2, 1), (1, 3, 2), (3, 4, 1)]
    theta = rng.normal(size=(5, 5))
    weight = np.zeros((5, 5))
    for y in itertools.product(range(5), repeat=5):
        w = math.exp(sum(theta[k, v] for k, v in enumerate(y)) + sum(field.ties[s] * (y[a] == y[b]) for a, b, s in edges))
        for k, v in enumerate(y):
            weight[k, v] += w
    assert np.allclose(field.beliefs(theta, edges), weight / weight.sum(axis=1, keepdims=True), atol=1e-4)


LONE = "they wrote 017 555 7713 there"
CASES = [
    ("+1 (017) 555-7713 or, if that is busy for a long while as it so often is in the evening, 1 017 555 7713 works", ["phone", "phone"]),
    ("write to anna.x (at) mail.example.com please", ["email"]),
    ("anna@example.com then again anna [at] example [dot] com", ["email", "email"]),
    ("host 10.20.30.40 and much later 10[.]20[.]30[.]40", ["ip", "ip"]),
    ("card 4539 1488 0343 6467 again as 4539.1488.0343.6467", ["card", "card"]),
    ("order number 2390409500648961 total", []),
    ("on 2024-05-17 we met at home.Then we left", []),
    ("isbn 978-3-16-148410-0", []),
    ("", []),
]


@pytest.mark.parametrize(("text", "kinds"), CASES)
def test_the_field_adds_what_repeats_or_resembles(text, kinds):
    spans = personal.learnt().spans(text, personal.base_spans(text))
    assert [personal.KINDS[k - 1] for _, k, _ in spans] == kinds
    assert set(personal.base_spans(text)) <= set(spans)


def test_a_distant_repeat_decides_the_label():
    number, far = "6125550143", " and so on" * 400
    alone = f"it said {number} there"
    field = personal.learnt()
    assert field.spans(alone, []) == []
    both = f"phone +1 (612) 555-0143{far} it said 1{number} there"
    spans = field.spans(both, personal.base_spans(both))
    assert [k for _, k, _ in spans] == [personal.PHONE] * 2


def test_held_out_examples():
    found = wanted = right = 0
    for text, truth in personal.examples(300, seed=99):
        got = personal.learnt().spans(text, personal.base_spans(text))
        found, wanted = found + len(got), wanted + len(truth)
        right += sum(any(k == kind and s < e2 and s2 < e for s2, kind, e2 in truth) for s, k, e in got)
    assert right / found > 0.97 and right / wanted > 0.95


def test_personal_rows(spark):
    rnd = random.Random(9)
    rows = [(k, odd_text(rnd)) for k in range(200)] + [(1, None), (None, "a@b.c"), (None, "a@b.c"), (7, ""), (8, "x " * 200_000 + "a@b.c")]
    table = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"spans": F.lit(1), "n_ip": F.lit("x")})
    want = Counter()
    for d, text in rows:
        base = naive_base(text or "")
        joined = ",".join(f"{personal.KINDS[k - 1]}:{s}:{e}" for s, k, e in base)
        counts = [sum(k == kind for _, k, _ in base) for kind in (1, 2, 3, 4)]
        want[(d, *counts, hashlib.sha256(joined.encode()).hexdigest())] += 1
    got = personal.find_personal(table).collect()
    assert Counter(tuple(r)[:6] for r in got) == want
    assert personal.find_personal(table.limit(0)).count() == 0


# --- importance resampling ------------------------------------------------------------------------


def features(text, longest):
    words = re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").encode().translate(personal_lower()))
    return words, [b" ".join(words[k : k + n]) for n in range(1, longest + 1) for k in range(len(words) - n + 1)]


def personal_lower():
    return bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def slow_resample(docs, target, longest, buckets, percent, least):
    count = [Counter(zlib.crc32(f) % buckets for t in texts for f in features(t, longest)[1]) for texts in ([t for _, t in docs], target)]
    s, t = count
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (big_s + buckets) / ((s[b] + 1) * (big_t + buckets)))) for b in range(buckets)]
    rows = []
    for place, (d, text) in enumerate(docs):
        words, found = features(text, longest)
        weight = sum(gain[zlib.crc32(f) % buckets] for f in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"2024:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))
        rows.append((d, len(found), weight, score, len(words), place))
    fit = sorted((r for r in rows if r[4] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[5]))
    rank = {r[5]: k + 1 for k, r in enumerate(fit[: percent * len(fit) // 100])}
    return Counter((*r[:4], rank.get(r[5])) for r in rows)


def some_docs(n=400):
    rnd = random.Random(6)
    lines = [" ".join(rnd.choice(["alpha", "Beta", "gámma", "d4", "x" * 90, "e-f", "42"]) for _ in range(rnd.randrange(7))) for _ in range(30)]
    docs = [(k, "\n".join(rnd.choice(lines) for _ in range(rnd.randrange(9)))) for k in range(n)]
    return docs + [(7, None), (None, "alpha beta " * 20), (None, "alpha beta " * 20), (9, ""), (9, "\n\n"), (11, "long " * 50_000)]


@pytest.mark.parametrize(("longest", "percent", "least"), [(1, 10, 20), (2, 50, 3), (3, 100, 0), (1, 0, 0)])
def test_resampling_equals_brute_force(spark, longest, percent, least):
    docs, target = some_docs(), ["Alpha gámma 42", None, "", "beta\nbeta alpha"]
    table = spark.createDataFrame(docs, "doc_id long, text string").coalesce(1).withColumns({"row": F.lit("x"), "weight": F.lit(1)})
    wanted = spark.createDataFrame([(t,) for t in target], "text string")
    got = importance.resample(table, wanted, longest, 97, percent=percent, least_words=least)
    assert Counter(tuple(r) for r in got.collect()) == slow_resample(docs, target, longest, 97, percent, least)


def test_resampling_nothing(spark):
    docs, target = (spark.createDataFrame([], s) for s in ("doc_id long, text string", "text string"))
    assert importance.resample(docs, target).count() == 0


def test_crc_of_words_equals_zlib():
    words = [b"", b"a", b"abc" * 21, b"q" * 64, b"r" * 65, b"s" * 1000, "é".encode()]
    data = np.frombuffer(b"".join(words), np.uint8)
    ends = np.cumsum([len(w) for w in words])
    got = importance.crc_on(np.zeros(len(words), np.uint32), data, ends - [len(w) for w in words], ends)
    assert got.tolist() == [zlib.crc32(w) for w in words]
    again = importance.crc_on(got, data, ends - [len(w) for w in words], ends)
    assert again.tolist() == [zlib.crc32(w + w) for w in words]


def test_ranks_across_partitions(spark):
    rows = spark.range(5000).select(
        F.col("id").alias("doc_id"), F.col("id").alias("row"), F.lit(30).cast("long").alias("n_words"), F.pmod(F.col("id") * 7919, F.lit(501)).alias("score")
    )
    got = importance.ranked(rows.repartition(13), 40, 20).where("rank is not null").collect()
    want = sorted(range(5000), key=lambda k: (-(k * 7919 % 501), k))[:2000]
    assert [r.doc_id for r in sorted(got, key=lambda r: r.rank)] == want
