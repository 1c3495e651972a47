"""Exact, substring and near duplicates against brute force."""

import hashlib
import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from shelfline.llm import exact_dedup, simhash, substring_dedup

LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
DOCS = "doc_id long, text string"


def fold(text):
    return (text or "").encode().translate(LOWER)


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(5)
    long = " ".join(f"w{rnd.randrange(500)}" for _ in range(3000))
    texts = ["same", "SAME", "sÉme", "séme", "", None, long, long.upper(), long + "x", "a b", "a  b"] * 2
    return [(k, t) for k, t in enumerate(texts)] + [(3, "séme"), (3, "séme"), (None, "same"), (None, "other")]


@pytest.mark.parametrize("digest_bytes", [16, 1])
def test_exact_groups(spark, rows, digest_bytes):
    docs = spark.createDataFrame(rows, DOCS).withColumns({"row": F.lit("x"), "keep_id": F.lit(1.5), "recipe": F.lit(0)})
    got = exact_dedup.exact_groups(docs, digest_bytes).collect()
    groups = {}
    for doc_id, text in rows:
        groups.setdefault(fold(text), []).append(doc_id)
    want = sorted(
        (str(d), str(max((x for x in groups[fold(t)] if x is not None), default=None)), len(groups[fold(t)]), hashlib.sha256(fold(t)).hexdigest())
        for d, t in rows
    )
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.text_sha256) for r in got) == want
    assert sum(r.kept for r in got) == len(groups)
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_drop_copies_keeps_columns_and_one_of_each(spark, rows):
    docs = spark.createDataFrame(rows, DOCS).withColumn("lang", F.lit("en"))
    kept = exact_dedup.drop_copies(docs.where("doc_id is not null"))
    assert kept.columns == ["doc_id", "text", "lang"]
    texts = [fold(r.text) for r in kept.collect()]
    assert len(texts) == len(set(texts)) == len({fold(t) for d, t in rows if d is not None})


def test_empty_tables(spark):
    none = spark.createDataFrame([], DOCS)
    assert exact_dedup.exact_groups(none).count() == 0
    assert substring_dedup.remove_repeats(none).count() == 0
    assert simhash.near_groups(none).count() == 0


def brute_repeats(rows, window):
    """What is left of each document, by the rule itself."""
    docs = sorted({(-1 << 63 if d is None else d, (t or "").encode()) for d, t in rows})
    seen, gone = {}, {}
    for d, text in docs:
        words = text.split()
        drop = set()
        for k in range(len(words) - window + 1):
            key = tuple(words[k : k + window])
            if key in seen:
                drop.update(range(k, k + window))
            seen.setdefault(key, (d, k))
        kept = [w for k, w in enumerate(words) if k not in drop]
        gone[d, text] = (len(words), len(words) - len(kept), b" ".join(kept).decode())
    return sorted((str(d), *gone[-1 << 63 if d is None else d, (t or "").encode()]) for d, t in rows)


@pytest.mark.parametrize("window", [2, 5, 20])
def test_substring_repeats(spark, window, monkeypatch):
    monkeypatch.setattr(substring_dedup, "BUCKET_BYTES", 3000)
    monkeypatch.setattr(substring_dedup, "GROUP_BYTES", 2000)
    rnd = random.Random(window)
    common = [f"c{k}" for k in range(45)]
    rows = []
    for d in range(60):
        words = [f"u{rnd.randrange(10**6)}" for _ in range(rnd.randrange(90))]
        for _ in range(rnd.randrange(3)):
            a = rnd.randrange(30)
            words[rnd.randrange(len(words) + 1) : 0] = common[a : a + rnd.randrange(5, 40)]
        rows.append((d, " ".join(words)))
    rows += [(100, rows[3][1]), (101, "x " * 70), (102, None), (103, ""), (100, rows[3][1]), (None, rows[3][1]), (104, "a b " * 41)]
    docs = spark.createDataFrame(rows, DOCS).withColumns({"part": F.lit(1), "ref": F.lit("r")})
    got = substring_dedup.remove_repeats(docs, window).collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_text) for r in got) == brute_repeats(rows, window)
    assert all(r.kept_sha256 == hashlib.sha256(r.kept_text.encode()).hexdigest() for r in got)


def brute_print(text, size):
    words = fold(text).split()
    shingles = [b" ".join(words[k : k + size]) for k in range(max(1, len(words) - size + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, most):
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(prints)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= most:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return [find(x) for x in range(len(prints))]


def test_near_groups(spark):
    rnd = random.Random(9)
    rows = []
    for _ in range(40):
        words = [f"w{rnd.randrange(3000)}" for _ in range(rnd.choice([0, 2, 3, 4, 5, 80, 300]))]
        for _ in range(rnd.randrange(1, 4)):
            rows.append((len(rows), " ".join(words)))
            if words and rnd.random() < 0.7:
                words[rnd.randrange(len(words))] = "changed"
    rows += [(900, None), (901, " "), (0, rows[0][1])]
    prints = [brute_print(t, 4) for _, t in rows]
    classes = brute_components(prints, 4)
    least = {c: min(d for (d, _), x in zip(rows, classes, strict=True) if x == c) for c in set(classes)}
    want = sorted((d, f"{p:016x}", least[c]) for (d, _), p, c in zip(rows, prints, classes, strict=True))
    docs = spark.createDataFrame(rows, DOCS).withColumn("fp", F.lit("clash"))
    assert sorted(tuple(r) for r in simhash.near_groups(docs).collect()) == want
    kept = sorted(r.doc_id for r in simhash.keep_firsts(docs).select("doc_id").distinct().collect())
    assert kept == sorted(least.values())


def test_every_pair_within_four_bits_shares_a_key():
    rng = np.random.default_rng(3)
    for bits in range(5):
        for _ in range(200):
            one = rng.integers(0, 1 << 63, dtype=np.uint64)
            other = one
            for bit in rng.choice(64, bits, replace=False):
                other ^= np.uint64(1 << int(bit))
            at, keys = simhash.combined_keys(np.array([one, other], np.uint64))
            assert set(keys[at == 0]) & set(keys[at == 1])


def test_one_error_in_each_segment_shares_a_key():
    rng = np.random.default_rng(4)
    for _ in range(300):
        one = rng.integers(0, 1 << 63, dtype=np.uint64)
        other = one ^ np.uint64(sum(1 << (16 * s + int(rng.integers(16))) for s in range(4)))
        at, keys = simhash.combined_keys(np.array([one, other], np.uint64))
        assert set(keys[at == 0]) & set(keys[at == 1])


@pytest.mark.parametrize("limit", [1 << 16, 10])
def test_links_connect_dense_groups_in_blocks(spark, limit):
    rng = np.random.default_rng(6)
    center = int(rng.integers(1 << 62))
    prints = {center}
    while len(prints) < 150:  # a crowd around one fingerprint, as of many near copies
        prints.add(center ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(1, 6), replace=False)) & (2**63 - 1))
    prints |= {int(x) for x in rng.integers(0, 1 << 62, 100)}
    prints = sorted(prints)
    found = simhash.links(spark.createDataFrame([(p,) for p in prints], "fp long"), 4, limit).collect()
    assert all((r.u ^ r.v).bit_count() <= 64 for r in found)
    root = {p: p for p in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for r in found:
        a, b = find(r.u), find(r.v)
        root[max(a, b)] = min(a, b)
    classes = brute_components(prints, 4)
    assert [find(p) for p in prints] == [prints[c] for c in classes]
