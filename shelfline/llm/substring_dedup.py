"""Exact substring duplicates by fixed-block anchors.

Wanted is each word covered by a window of WINDOW words that also starts
earlier. Every window holds a whole block of BLOCK words that begins at a
multiple of BLOCK in its document, since 2 * BLOCK - 1 <= WINDOW. So:

1. Index and probe. Each document gives its non-overlapping blocks as anchors
   and every rolling window of BLOCK words as a probe. Their hashes meet in
   buckets; a place is hit if its hash occurs twice and once as an anchor. A
   block of texts sends a hash it holds several times once, and packs what it
   sends: some five bytes a word. Places that a block itself knows to be hit are
   only passed on to their documents, by whatever bucket, so that of a passage
   which very many documents share its own bucket gets one place a block.
2. Extend. A window of WINDOW words can have a second occurrence only if the
   anchors within it are hit. Such windows, 128 bits each, meet in buckets; all
   but the earliest are repeats, and consecutive ones are the maximal repeats.
   Again a group settles what it can, sends each window once, and passes on what
   it knows to be repeats.
3. Remove. Each document meets its repeated windows and drops the words.

Buckets and document groups have fixed expected sizes, so their number grows
with the input and their memory does not. Steps are written to the shared
folder. A 31-bit hash that agrees by chance in step 1 only adds windows for step
2 to refuse. Step 2 compares windows by 128 bits over 64-bit hashes of words, and
not word by word: with a billion different words two of them share a hash by a
chance of 3 %, and then matter only where all other 19 words agree as well.

Null and empty texts have no words. Rows that repeat a doc_id with the same text
are one document; with another text they are documents of their own, in the
order of a hash. A null doc_id comes first.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm.base import NOT_SPACE, Rolling, blocks, pack, scan, ship, split_words, unpack, utf8, written

WINDOW, BLOCK = 20, 10
#: Text bytes behind a bucket (about 1.3 million words) and behind a group of documents.
BUCKET_BYTES, GROUP_BYTES = 8 << 20, 3 << 20

_WORDS, _PROBES, _WIDE, _WIDE_TOO = Rolling(21), Rolling(22), Rolling(23), Rolling(24)
_NULL_ID = np.iinfo(np.int64).min


class Texts:
    """Words of a batch of documents: doc_id, ref (identity by id and text), text."""

    def __init__(self, table: pa.RecordBatch | pa.Table) -> None:
        column = table.column("text")
        self.data, offsets = utf8(column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column)
        self.starts, self.ends, self.first = split_words(self.data, offsets, NOT_SPACE)
        self.words = _WORDS.of_words(self.data, self.starts, self.ends)
        self.ref = np.asarray(table.column("ref").to_numpy(), np.int64)
        self.doc_id = np.array([_NULL_ID if i is None else i for i in table.column("doc_id").to_pylist()], np.int64)

    def place(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Document and place within it of words."""
        doc = np.searchsorted(self.first, at, "right") - 1
        return doc, at - self.first[doc]


def _groups(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order that brings equal keys together (the last key sorts first), and where each run of them begins."""
    order = np.lexsort(keys)
    new = np.zeros(len(order), bool)
    new[:1] = True
    for key in keys:
        row = key[order]
        new[1:] |= row[1:] != row[:-1]
    return order, np.flatnonzero(new)


def _split(part: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Rows of each part, in their order."""
    order = np.argsort(part, kind="stable")
    edges = np.flatnonzero(np.diff(part[order], prepend=-1, append=-1))
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        yield int(part[order[a]]), order[a:b]


def _table(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.Table:
    return pa.table({n: pa.array([r[k] for r in rows], kinds[k]) for k, n in enumerate(names)})


# --- step 1 ---------------------------------------------------------------------------------------

# With a part, refs and places are known to be hits and pass on to that group of documents.
_PROBED = "bucket int, part int, keys binary, refs binary, places binary"
_HITS = "part int, refs binary, places binary"


def _probe(block: int, buckets: int, parts: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, limit=2 << 20):
            texts = Texts(batch)
            at, h = _PROBES.windows(texts.words, texts.first, block)
            doc, place = texts.place(at)
            ref = texts.ref[doc]
            anchor = place % block == 0
            order, begin = _groups(h)
            size = np.diff(begin, append=len(order))
            anchored = np.logical_or.reduceat(anchor[order], begin) if len(begin) else np.zeros(0, bool)
            known = np.repeat((size > 1) & anchored, size)  # hit within this batch already
            hit = np.zeros(len(at), bool)
            hit[order] = known
            send = ~hit
            send[order[begin]] = True
            anchor[order[begin]] |= anchored & (size > 1)
            key = (h & np.uint64(0x7FFFFFFF)) << np.uint64(1) | anchor.astype(np.uint64)
            bucket = ((h >> np.uint64(32)) % np.uint64(buckets)).astype(np.int32)
            rows = []
            sent = np.flatnonzero(send)
            for b, some in _split(bucket[sent]):
                some = sent[some]
                rows.append((b, None, key[some].astype("<u4").tobytes(), pack(ref[some]), pack(place[some])))
            index = np.flatnonzero(hit)
            for part, own in _split(np.mod(ref[index], parts)):
                own = index[own]
                own = own[np.lexsort((place[own], ref[own]))]
                rows.append((part % buckets, part, b"", pack(ref[own]), pack(place[own])))
            names = ["bucket", "part", "keys", "refs", "places"]
            yield from _table(rows, names, [pa.int32(), pa.int32(), *[pa.binary()] * 3]).to_batches()

    return work


def _join(table: pa.Table, name: str) -> np.ndarray:
    parts = [unpack(x.as_py()) for x in table.column(name)]
    return np.concatenate(parts) if parts else np.zeros(0, np.int64)


def _passing(table: pa.Table, names: list[str]) -> tuple[pa.Table, pa.Table]:
    """Rows of a bucket that pass on to a group of documents, and those that meet here."""
    meets = pc.is_null(table.column("part"))
    return table.filter(pc.invert(meets)).select(names), table.filter(meets)


def _meet(parts: int):
    """Hits of a bucket, by the group of documents they go to; those that blocks found themselves pass through."""

    def work(table: pa.Table) -> pa.Table:
        pa.default_memory_pool().release_unused()
        known, table = _passing(table, ["part", "refs", "places"])
        if not table.num_rows:
            return known
        key = np.concatenate([np.frombuffer(x.as_py(), "<u4") for x in table.column("keys")])
        ref, place = _join(table, "refs"), _join(table, "places")
        order, begin = _groups(key >> np.uint32(1))
        size = np.diff(begin, append=len(order))
        anchored = np.logical_or.reduceat((key[order] & np.uint32(1)).astype(bool), begin)
        some = order[np.repeat((size > 1) & anchored, size)]
        ref, place = ref[some], place[some]
        rows = []
        for part, own in _split(np.mod(ref, parts)):
            own = own[np.lexsort((place[own], ref[own]))]
            rows.append((part, pack(ref[own]), pack(place[own])))
        return pa.concat_tables([known, _table(rows, ["part", "refs", "places"], [pa.int32(), pa.binary(), pa.binary()])])

    return work


# --- step 2 ---------------------------------------------------------------------------------------

_WINDOWS = "bucket int, part int, keys binary, ids binary, refs binary, places binary"
_GONE = "part int, ids binary, refs binary, places binary"


def _words_at(texts: Texts, ref: np.ndarray, place: np.ndarray, ids: np.ndarray | None = None) -> np.ndarray:
    """Batch word numbers of places in documents named by ref (and id), for all rows that the document stands in."""
    order = np.argsort(texts.ref, kind="stable")
    sorted_ref = texts.ref[order]
    low, high = np.searchsorted(sorted_ref, ref), np.searchsorted(sorted_ref, ref, "right")
    n = high - low
    which = np.repeat(np.arange(len(ref)), n)
    doc = order[np.repeat(low, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
    at = texts.first[doc] + place[which]
    fit = at < texts.first[doc + 1]
    if ids is not None:
        fit &= texts.doc_id[doc] == ids[which]
    return at[fit]


def _earlier(ids: np.ndarray, refs: np.ndarray, places: np.ndarray, *keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which rows are the first of their key, and which repeat a key at a later place; repeated rows are neither."""
    order = np.lexsort((places, refs, ids, *keys))
    new = np.zeros(len(order), bool)
    new[:1] = True
    for key in keys:
        row = key[order]
        new[1:] |= row[1:] != row[:-1]
    first = order[np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))] if len(order) else order
    same = (ids[order] == ids[first]) & (refs[order] == refs[first]) & (places[order] == places[first])
    firsts, repeats = np.zeros(len(order), bool), np.zeros(len(order), bool)
    firsts[order[new]] = True
    repeats[order[~same]] = True
    return firsts, repeats


def _extend(window: int, block: int, buckets: int, parts: int):
    def work(docs: pa.Table, hits: pa.Table) -> pa.Table:
        pa.default_memory_pool().release_unused()
        names = ["bucket", "part", "keys", "ids", "refs", "places"]
        kinds = [pa.int32(), pa.int32(), *[pa.binary()] * 4]
        if not docs.num_rows or not hits.num_rows:
            return _table([], names, kinds)
        texts = Texts(docs)
        hit = np.zeros(len(texts.words) + window + block, bool)
        hit[_words_at(texts, _join(hits, "refs"), _join(hits, "places"))] = True
        at, low = _WIDE.windows(texts.words, texts.first, window)
        doc, place = texts.place(at)
        anchor = at + (-place) % block
        maybe = hit[anchor]
        step = anchor + block
        while (inside := step + block <= at + window).any():  # each anchor within the window
            maybe &= hit[np.where(inside, step, anchor)]
            step = step + block
        at, low, doc, place = at[maybe], low[maybe], doc[maybe], place[maybe]
        high = _WIDE_TOO.ranges(texts.words, at, at + window) if len(at) else low
        ids, refs = texts.doc_id[doc], texts.ref[doc]
        firsts, repeats = _earlier(ids, refs, place, high, low)
        bucket = (low % np.uint64(buckets)).astype(np.int32)
        gone = np.flatnonzero(repeats)
        sent = np.flatnonzero(firsts)
        rows = []
        for b, some in _split(bucket[sent]):
            some = sent[some]
            keys = low[some].astype("<u8").tobytes() + high[some].astype("<u8").tobytes()
            rows.append((b, None, keys, *(pack(x[some]) for x in (ids, refs, place))))
        for part, own in _split(np.mod(refs[gone], parts)):
            own = gone[own]
            own = own[np.lexsort((place[own], refs[own], ids[own]))]
            rows.append((part % buckets, part, b"", *(pack(x[own]) for x in (ids, refs, place))))
        return _table(rows, names, kinds)

    return work


def _first_wins(parts: int):
    """Repeated windows of a bucket, by the group of documents they go to; those known before pass through."""

    def work(table: pa.Table) -> pa.Table:
        known, table = _passing(table, ["part", "ids", "refs", "places"])
        if not table.num_rows:
            return known
        both = [np.frombuffer(x.as_py(), "<u8").reshape(2, -1) for x in table.column("keys")]
        low, high = np.concatenate(both, axis=1)
        ids, refs, places = (_join(table, n) for n in ("ids", "refs", "places"))
        _, repeats = _earlier(ids, refs, places, high, low)
        ids, refs, places = ids[repeats], refs[repeats], places[repeats]
        rows = []
        for part, own in _split(np.mod(refs, parts)):
            own = own[np.lexsort((places[own], refs[own], ids[own]))]
            rows.append((part, pack(ids[own]), pack(refs[own]), pack(places[own])))
        return pa.concat_tables([known, _table(rows, ["part", "ids", "refs", "places"], [pa.int32(), *[pa.binary()] * 3])])

    return work


# --- step 3 ---------------------------------------------------------------------------------------

_RESULT = "doc_id long, n_words long, n_removed long, kept_text string, kept_sha256 string"


def _remove(window: int, texts_too: bool):
    def work(docs: pa.Table, gone: pa.Table) -> pa.Table:
        names = [c.split()[0] for c in _RESULT.split(", ")]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
        if not docs.num_rows:
            return _table([], names, kinds)
        texts = Texts(docs)
        cover = np.zeros(len(texts.words) + 1, np.int64)
        if gone.num_rows:
            at = _words_at(texts, _join(gone, "refs"), _join(gone, "places"), _join(gone, "ids"))
            np.add.at(cover, at, 1)
            np.add.at(cover, np.minimum(at + window, len(texts.words)), -1)
        kept = np.cumsum(cover)[:-1] == 0
        raw, rows = texts.data.tobytes(), []
        starts, ends = texts.starts.tolist(), texts.ends.tolist()
        ids = docs.column("doc_id").to_pylist()
        for k in range(docs.num_rows):
            a, b = int(texts.first[k]), int(texts.first[k + 1])
            text = b" ".join([raw[starts[i] : ends[i]] for i in (np.flatnonzero(kept[a:b]) + a).tolist()])
            removed = b - a - int(kept[a:b].sum())
            rows.append((ids[k], b - a, removed, text.decode() if texts_too else None, hashlib.sha256(text).hexdigest()))
        return _table(rows, names, kinds)

    return work


def remove_repeats(docs: DataFrame, window: int = WINDOW, texts_too: bool = True) -> DataFrame:
    """One row for each row of docs (doc_id, text): doc_id, n_words, n_removed, kept_text, kept_sha256.

    kept_text is the words not covered by an earlier-started window of ``window`` words, joined by one space; null
    unless ``texts_too``.
    """
    if window < 2:
        raise ValueError("a window has two words or more")
    spark, block = docs.sparkSession, (window + 1) // 2
    ship(spark)
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64(F.col("doc_id").cast("long"), F.col("text")).alias("ref"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets, parts = 1 + size // BUCKET_BYTES, 1 + size // GROUP_BYTES
    probed = scan(rows, _probe(block, buckets, parts), _PROBED)
    hits = written(probed.groupBy("bucket").applyInArrow(_meet(parts), _HITS), "hits")
    grouped = rows.withColumn("part", F.pmod("ref", F.lit(parts)).cast("int"))
    windows = grouped.groupBy("part").cogroup(hits.groupBy("part")).applyInArrow(_extend(window, block, buckets, parts), _WINDOWS)
    gone = written(windows.groupBy("bucket").applyInArrow(_first_wins(parts), _GONE), "gone")
    return grouped.groupBy("part").cogroup(gone.groupBy("part")).applyInArrow(_remove(window, texts_too), _RESULT)
