"""Benchmark decontamination: word pair seeds, counted, then Smith-Waterman alignment.

1. A pair is two words of an item with at most one word between them. Count how
   often each pair occurs over all documents. Only these counts, two for each
   word of the benchmark, are gathered.
2. An alignment of n item words that scores 2 * similarity * n or more holds at
   least need = ceil(similarity * n) - 1 pairs, each at a word of its own: with
   m matches it can pay 2 * (m - similarity * n) for edits, and only a pair of
   neighbouring matches with two edits between them, at that price, is no pair
   of step 1. So of an item's words, all but the need - ask whose pairs are the
   commonest are seeds, and an alignment holds at least ask of these, however
   its edits lie and whatever other documents hold.
3. Where ask seeds of an item stand within the span of an alignment, the words
   around are aligned with the item by Smith-Waterman over words; the score as
   a share of a perfect one is the similarity, which edits and paraphrase lower
   but do not end.
4. An alignment counts if it can't well be chance. Its score must be worth
   LEAST_WORDS matches, or all words of a shorter item; and its matched words
   must be rare enough: with each word's share of the corpus as its chance, a
   corpus of this size holds such a run of words less than once in 1 / CHANCE
   times; items of fewer words need as much more evidence, since words of a
   common phrase aren't independent. Hence "yes", or "what is the", is no leak wherever it stands. Matches
   that fail this are given only on request.

All work on documents is one scan for each step; no document moves, and
``drop_leaks`` decides within the scan. The benchmark is taken in blocks of at most BLOCK_WORDS words, hence what tasks
receive has a fixed bound whatever its size.

Words are runs of digits, letters and characters beyond ASCII, in lower case.
Null and empty texts and items match nothing; equal items are found each under
its own item_id; repeated documents each give a row.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm.base import ALNUM, LOWER, Rolling, blocks, keep_where, mix, scan, split_words, utf8, written

#: An item of fewer words is found only as it stands.
SEED = 3
#: Least number of seeds asked for, where an alignment must hold so many.
ASK = 4
MATCH, MISMATCH, GAP = 2, -1, -1
#: Least share of an item's perfect score, least matches that the score is worth, and how likely chance may be.
SIMILARITY, LEAST_WORDS, CHANCE = 0.5, 8, 1e-3
#: Words of test items worked on in one scan: about 100 MB in each task.
BLOCK_WORDS = 1 << 20

#: Words of a document that an alignment spans at most, as a multiple of the item's: each match pays for two edits.
SPAN = 3
#: Document words in one batch of alignments.
CELLS = 1 << 18

_WORDS = Rolling(11)
_MATCHES = "doc_id long, item_id long, similarity double, score long, doc_start long, doc_end long"
_WEAK = ", evidence double, convincing boolean"


def fold(data: np.ndarray) -> np.ndarray:
    """Lower-cases A-Z and, in two bytes, the capitals from À to Þ."""
    data = np.frombuffer(data.tobytes().translate(LOWER), np.uint8).copy()
    capital = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)) + 1
    data[capital] += 0x20
    return data


def word_ids(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each word, and the first word of each text."""
    data, offsets = utf8(column)
    data = fold(data)
    starts, ends, first = split_words(data, offsets, ALNUM)
    return _WORDS.of_words(data, starts, ends), first


def word_pairs(words: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each pair of words of one text with at most one between them begins, and its hash."""
    end = np.repeat(first[1:], np.diff(first))
    at, out = [], []
    for step in (1, 2):
        begin = np.flatnonzero(np.arange(len(words)) + step < end)
        at.append(begin)
        out.append(mix(words[begin] * np.uint64(0x9E3779B97F4A7C15) + words[begin + step]))
    return np.concatenate(at), np.concatenate(out)


class Table:
    """Sorted hashes; a look in a few bits of each says that most others are absent."""

    def __init__(self, keys: np.ndarray) -> None:
        self.keys = keys
        self.shift = np.uint64(64 - min(24, max(10, int(16 * len(keys)).bit_length())))
        self.some = np.zeros(1 << (64 - int(self.shift)), bool)
        self.some[(keys >> self.shift).astype(np.int64)] = True

    def among(self, hashes: np.ndarray) -> np.ndarray:
        """Places of those hashes that are in the table."""
        at = np.flatnonzero(self.some[(hashes >> self.shift).astype(np.int64)])
        place = np.minimum(np.searchsorted(self.keys, hashes[at]), len(self.keys) - 1)
        return at[self.keys[place] == hashes[at]] if len(self.keys) else at[:0]


class Items:
    """A block of test items: words, pairs and, once chosen, seeds."""

    def __init__(self, ids: list[int], texts: list[str], similarity: float = SIMILARITY) -> None:
        self.ids = np.array(ids, np.int64)
        self.words, self.first = word_ids(pa.array(texts, pa.string()))
        self.size = np.diff(self.first)
        short = self.size < SEED
        at, pairs = word_pairs(self.words, self.first)
        item = np.searchsorted(self.first, at, "right") - 1
        long = ~short[item]
        # an item of fewer words is found as it stands; see _align
        self.pairs, self.pair_item, self.pair_at = pairs[long], item[long], at[long]
        self.known = np.unique(self.pairs)
        self.need = np.maximum(1, np.ceil(similarity * self.size - 1e-9).astype(np.int64) - 1)
        self.ask = np.maximum(np.minimum(self.need, ASK), -(-self.need // 2))
        self.least = MATCH * np.minimum(self.size, np.maximum(np.ceil(similarity * self.size - 1e-9), LEAST_WORDS).astype(np.int64))
        self.vocabulary = np.unique(self.words)
        self.short = [(int(i), tuple(self.words[self.first[i] : self.first[i + 1]])) for i in np.flatnonzero(short & (self.size > 0))]

    @property
    def n_counts(self) -> int:
        """Counts of pairs, of words, and of all words of the corpus."""
        return len(self.known) + len(self.vocabulary) + 1

    def choose(self, counts: np.ndarray) -> None:
        """Seeds: the pairs of all words of an item but its need - ask commonest. counts: as n_counts says."""
        total = max(1, int(counts[-1]))
        of_words = np.maximum(1, counts[len(self.known) : -1])
        self.surprise = dict(zip(self.vocabulary.tolist(), np.log(total / of_words).tolist(), strict=True))
        self.enough = np.log(total / CHANCE) * LEAST_WORDS / np.clip(self.size, 1, LEAST_WORDS)
        counts = counts[: len(self.known)]
        common = np.zeros(len(self.words), np.int64)
        np.add.at(common, self.pair_at, counts[np.searchsorted(self.known, self.pairs)])
        item = np.repeat(np.arange(len(self.size)), self.size)
        order = np.lexsort((-common, item))
        seed = np.ones(len(self.words), bool)
        seed[order[np.arange(len(order)) - self.first[item[order]] < (self.need - self.ask)[item[order]]]] = False
        chosen = np.flatnonzero(seed[self.pair_at])
        chosen = chosen[np.argsort(self.pairs[chosen], kind="stable")]
        self.seeds, self.seed_item = self.pairs[chosen], self.pair_item[chosen]
        self.seed_at = self.pair_at[chosen] - self.first[self.seed_item]

    def evidence(self, item: int, words: np.ndarray) -> float:
        """How much the words that an item shares with these say against chance: the sum of their -log shares."""
        shared = Counter(self.words[self.first[item] : self.first[item + 1]].tolist()) & Counter(words.tolist())
        return sum(n * self.surprise[w] for w, n in shared.items())


def smith_waterman(items: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best local score of each row of items with the same row of texts, and the range of text words it spans.

    Rows are word ids; 0 in items and 1 in texts fill up and match nothing.
    The row-wise recurrence runs over all pairs at once; gaps along the text
    come from a running maximum, since each further word costs the same.
    """
    n, width = texts.shape
    slope = GAP * np.arange(width)
    row, start = np.zeros((n, width), np.int64), np.tile(np.arange(width), (n, 1))
    best, best_from, best_to = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
    lanes = np.arange(n)
    for k in range(items.shape[1]):
        word = items[:, k : k + 1]
        step = np.where((texts == word) & (word != 0), MATCH, MISMATCH)
        diagonal = step.copy()
        diagonal[:, 1:] += row[:, :-1]
        origin = np.tile(np.arange(width), (n, 1))
        origin[:, 1:] = np.where(row[:, :-1] > 0, start[:, :-1], origin[:, 1:])
        up = row + GAP
        new = np.maximum(diagonal, up)
        origin = np.where(up > diagonal, start, origin)
        new = np.maximum(new, 0)
        level = new - slope  # a gap of d words costs -GAP * d, so levels compare across a row
        peak = np.maximum.accumulate(level, axis=1)
        at = np.maximum.accumulate(np.where(level == peak, np.arange(width), 0), axis=1)
        row = peak + slope
        start = np.take_along_axis(origin, at, axis=1)
        top = row.argmax(axis=1)
        score = row[lanes, top]
        better = score > best
        best[better], best_from[better], best_to[better] = score[better], start[lanes, top][better], top[better] + 1
    return best, best_from, best_to


def _count(items: Items):
    """Of each partition, how often each pair and each word of the items occurs, and how many words there are."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, tables = np.zeros(items.n_counts, np.int64), (Table(items.known), Table(items.vocabulary))
        edge = len(items.known)
        for batch in blocks(batches):
            words, first = word_ids(batch.column("text"))
            _, pairs = word_pairs(words, first)
            for keys, hashes, table, part in (
                (items.known, pairs, tables[0], total[:edge]),
                (items.vocabulary, words, tables[1], total[edge:-1]),
            ):
                part += np.bincount(np.searchsorted(keys, hashes[table.among(hashes)]), minlength=len(keys))
            total[-1] += len(words)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(total[some])], ["gram", "n"])

    return work


def _candidates(items: Items, table: Table, words: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, item and the document word where the item would begin, for each seed with enough others around.

    A document word counts once for an item, whichever of its pairs are seeds. An alignment that scores as much as
    it has item words or more spans at most twice as many words of the document, one that scores less (a lower
    similarity) at most three times as many.
    """
    at, pairs = word_pairs(words, first)
    hit = table.among(pairs)
    low, high = (np.searchsorted(items.seeds, pairs[hit], side) for side in ("left", "right"))
    n = high - low
    seed = np.repeat(low, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    place, item = np.repeat(at[hit], n), items.seed_item[seed]
    order = np.lexsort((place, item, np.searchsorted(first, place, "right") - 1))
    place, item, begin = place[order], item[order], (place - items.seed_at[seed])[order]
    doc = np.searchsorted(first, place, "right") - 1
    new = np.ones(len(place), bool)
    new[1:] = (place[1:] != place[:-1]) | (item[1:] != item[:-1])
    once = np.flatnonzero(new)
    # the ask-th place from each one on, within the same document and item and the span of an alignment
    last = np.arange(len(once)) + items.ask[item[once]] - 1
    to = once[np.minimum(last, len(once) - 1)] if len(once) else once
    enough = (last < len(once)) & (doc[to] == doc[once]) & (item[to] == item[once])
    enough &= place[to] - place[once] < SPAN * items.size[item[once]]
    edge = np.zeros(len(once) + 1, np.int64)
    np.add.at(edge, np.flatnonzero(enough), 1)
    np.add.at(edge, last[enough] + 1, -1)
    good = (np.cumsum(edge)[:-1] > 0)[np.cumsum(new) - 1]
    return doc[good], item[good], begin[good]


def _windows(items: Items, first: np.ndarray, doc: np.ndarray, item: np.ndarray, begin: np.ndarray) -> list[tuple[int, int, int, int]]:
    """Document, item and range of document words that hold every alignment around a seed.

    Ranges that meet are joined, and long ones are cut into such that overlap by the span of an alignment.
    """
    order = np.lexsort((begin, item, doc))
    ranges: list[tuple[int, int, int, int]] = []
    for d, i, b in zip(doc[order].tolist(), item[order].tolist(), begin[order].tolist(), strict=True):
        span = SPAN * int(items.size[i])
        low, high = max(int(first[d]), b - span), min(int(first[d + 1]), b + int(items.size[i]) + span)
        if ranges and ranges[-1][:2] == (d, i) and low <= ranges[-1][3]:
            ranges[-1] = (d, i, ranges[-1][2], max(high, ranges[-1][3]))
        else:
            ranges.append((d, i, low, high))
    out = []
    for d, i, low, high in ranges:
        span = SPAN * int(items.size[i])
        while high - low > 4 * span:
            out.append((d, i, low, low + 3 * span))
            low += 2 * span
        out.append((d, i, low, high))
    return out


def _aligned(items: Items, table: Table, texts: pa.Array) -> dict[tuple[int, int], tuple[int, int, int, float]]:
    """Score, range of words and evidence of the best alignment of each (text, item) that scores enough."""
    words, first = word_ids(texts)
    windows = _windows(items, first, *_candidates(items, table, words, first))
    found: dict[tuple[int, int], tuple[int, int, int]] = {}
    windows.sort(key=lambda w: (items.size[w[1]], w[3] - w[2]))
    start = 0
    while start < len(windows):
        widest = max(h - lo for _, _, lo, h in windows[start : start + 256])
        part = windows[start : start + max(1, min(256, CELLS // max(1, widest)))]
        start += len(part)
        deep, wide = max(int(items.size[i]) for _, i, _, _ in part), max(h - lo for _, _, lo, h in part)
        left, right = np.zeros((len(part), deep), np.uint64), np.ones((len(part), wide), np.uint64)
        for k, (_, i, low, high) in enumerate(part):
            left[k, : items.size[i]] = items.words[items.first[i] : items.first[i + 1]]
            right[k, : high - low] = words[low:high]
        scores, begins, ends = smith_waterman(left, right)
        for (d, i, low, _), score, a, b in zip(part, scores.tolist(), begins.tolist(), ends.tolist(), strict=True):
            if score >= items.least[i]:
                span = (score, low + a - int(first[d]), low + b - int(first[d]))
                found[d, i] = max(found.get((d, i), span), span, key=lambda x: (x[0], -x[1]))
    for i, short in items.short:  # items of fewer words than a seed: their words as they stand
        same = np.ones(max(0, len(words) - len(short) + 1), bool)
        for k, word in enumerate(short):
            same &= words[k : len(words) - len(short) + 1 + k] == word
        for place in np.flatnonzero(same).tolist():
            d = int(np.searchsorted(first, place, "right")) - 1
            if place + len(short) <= first[d + 1]:
                span = (MATCH * len(short), place - int(first[d]), place - int(first[d]) + len(short))
                found.setdefault((d, i), span)
    return {(d, i): (*span, items.evidence(i, words[first[d] + span[1] : first[d] + span[2]])) for (d, i), span in found.items()}


def _align(items: Items, weak: bool = False):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Table(items.seeds)
        for batch in blocks(batches):
            ids = batch.column("doc_id").to_pylist()
            rows = [
                (ids[d], int(items.ids[i]), score / (MATCH * int(items.size[i])), score, a, b, evidence, bool(evidence >= items.enough[i]))
                for (d, i), (score, a, b, evidence) in sorted(_aligned(items, table, batch.column("text")).items())
                if weak or evidence >= items.enough[i]
            ]
            names = ["doc_id", "item_id", "similarity", "score", "doc_start", "doc_end", "evidence", "convincing"]
            kinds = [pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.bool_()]
            n = len(names) if weak else 6
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kinds[k]) for k in range(n)], names[:n])

    return work


def _blocks_of_items(docs: DataFrame, benchmark: DataFrame, similarity: float, block_words: int) -> Iterator[Items]:
    """The benchmark in blocks, each with its seeds and the words' shares, counted over all documents."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce("text", F.lit("")).alias("text"))
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-total // (4 * block_words)))
    for part in range(parts):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part).collect()  # at most about block_words
        block = Items([r["item_id"] if r["item_id"] is not None else -1 for r in rows], [r["text"] for r in rows], similarity)
        counts = np.zeros(block.n_counts, np.int64)
        if len(block.words):
            sums = scan(docs.select("text"), _count(block), "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
            for r in sums.collect():  # one for each pair and word of this block
                counts[r["gram"]] = r["n"]
        block.choose(counts)
        yield block


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, block_words: int = BLOCK_WORDS, weak: bool = False
) -> DataFrame:
    """Rows (doc_id, item_id, similarity, score, doc_start, doc_end): the best alignment of each item found in a document.

    docs: doc_id, text; benchmark: item_id, text. doc_start and doc_end count the document's words from 0.
    With weak, alignments that may be chance are given too, and the columns evidence and convincing tell them apart.
    """
    schema = _MATCHES + (_WEAK if weak else "")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    out = docs.sparkSession.createDataFrame([], schema)
    for block in _blocks_of_items(docs, benchmark, similarity, block_words):
        out = out.unionByName(scan(docs, _align(block, weak), schema))
    return out


def drop_leaks(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The rows of docs in which no test item was convincingly found; for each block of items, one scan that drops rows."""

    def clean(items: Items):
        table: list[Table] = []  # made in the task, once

        def test(batch: pa.RecordBatch) -> np.ndarray:
            if not table:
                table.append(Table(items.seeds))
            out = np.ones(batch.num_rows, bool)
            for (d, i), found in _aligned(items, table[0], batch.column("text")).items():
                out[d] &= found[3] < items.enough[i]
            return out

        return test

    left = docs
    for k, block in enumerate(_blocks_of_items(docs, benchmark, similarity, block_words)):
        left = keep_where(written(left, "clean") if k else left, clean(block))  # one Python process a task at a time
    return left
