"""Words, rolling hashes, packed integers, chunks, components."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from shelfline.llm import base, exact_dedup
from shelfline.llm.components import components

TEXTS = ["", "one two  three", None, "\n\t x", "é à\x0bb", "a" * 70, " ", "tail "]


@pytest.mark.parametrize(("table", "pattern"), [(base.NOT_SPACE, rb"[^\x20\x09-\x0D]+"), (base.ALNUM, rb"[0-9A-Za-z\x80-\xff]+")])
def test_words_equal_the_pattern(table, pattern):
    data, offsets = base.utf8(pa.array(TEXTS))
    starts, ends, first = base.split_words(data, offsets, table)
    raw = data.tobytes()
    for k, text in enumerate(TEXTS):
        got = [raw[a:b] for a, b in zip(starts[first[k] : first[k + 1]], ends[first[k] : first[k + 1]], strict=True)]
        assert got == re.findall(pattern, (text or "").encode())


def test_blocks_keep_rows_and_order():
    batch = pa.RecordBatch.from_arrays([pa.array(["x" * n for n in (5, 100, 1, 0, 30)])], ["text"])
    parts = list(base.blocks([batch], limit=32))
    assert [v for p in parts for v in p.column("text").to_pylist()] == batch.column("text").to_pylist()
    assert len(parts) == 3


def test_windows_stay_within_a_text_and_equal_ones_hash_alike():
    rng = np.random.default_rng(1)
    words = rng.integers(0, 3, 60).astype(np.uint64)
    first = np.array([0, 2, 2, 30, 60])
    at, h = base.Rolling(3).windows(words, first, 4)
    assert at.tolist() == [*range(2, 27), *range(30, 57)]
    seen = {}
    for place, value in zip(at.tolist(), h.tolist(), strict=True):
        assert seen.setdefault(tuple(words[place : place + 4].tolist()), value) == value
    assert len(set(seen.values())) == len(seen)


def test_pack_round_trip():
    for values in ([], [0], [-5, 7, 2**62, -(2**62)], list(range(1000))):
        assert base.unpack(base.pack(np.array(values, np.int64))).tolist() == values


def test_chunks_follow_content_not_place():
    rng = np.random.default_rng(2)
    body = rng.integers(97, 123, 30_000).astype(np.uint8)
    other = np.concatenate([rng.integers(97, 123, 777).astype(np.uint8), body])

    def cuts(data):
        return exact_dedup.cut_points(data, 0, len(data), exact_dedup.rolling_marks(data))

    one, two = cuts(body), [c - 777 for c in cuts(other)]
    assert len(set(one) & set(two)) > 0.8 * len(one)
    assert one[-1] == len(body) and max(np.diff([0, *one])) <= exact_dedup.MOST


def test_components_equal_union_find(spark):
    rnd = random.Random(4)
    edges = [(rnd.randrange(60), rnd.randrange(60)) for _ in range(45)] + [(k, k + 1) for k in range(100, 140)] + [(200, k) for k in range(201, 230)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    want = {(x, find(x)) for x in parent if find(x) != x}
    got = components(spark.createDataFrame(edges, "u long, v long")).collect()
    assert {(r.u, r.v) for r in got} == want and len(got) == len(want)


def test_no_edges_no_components(spark):
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0
