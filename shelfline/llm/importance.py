"""Importance resampling of documents towards a target distribution, by hashed word features.

Features are all runs of 1 to LONGEST_RUN consecutive words, joined by a space;
each falls into the bucket of its CRC-32. A bucket's gain is the logarithm of
its share in the target over its share in the corpus, both with one added count
a bucket; a document's weight is the mean gain of its features. Gumbel noise,
keyed by doc_id, on top of the weight makes the highest scores a draw without
replacement.

Corpus counts by segment deduplication: newlines part words, so texts are cut
into lines; Spark counts equal lines, each different line's features are counted
once and multiplied by its occurrences, and runs that cross lines are added
from the documents. A hot line collapses in the partial count of each task.

Ranks: a two-step histogram of the whole-number scores gives the lowest score
drawn; only rows from there up are dealt by score and sorted, and each
partition's ranks start after the sizes of those before it. No row but sizes and
histograms (a few thousand numbers) reaches the driver.

Null texts and texts without words have no features and weight 0, and are
scored like others, but drawn only where least_words is 0. Null ids are hashed
as empty text and lose ties; of rows that repeat an id, which then share their
noise, the one read first wins ties. An empty table gives an empty result; an
empty target or corpus only its added counts.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm.base import ALNUM, LOWER, blocks, scan, split_words, utf8, written

LONGEST_RUN, BUCKETS, SEED, PERCENT, LEAST_WORDS = 1, 10_000, 2024, 10, 20
#: Words longer than this are hashed one by one.
_LONG = 64
#: Scores of one bar in the first histogram.
_BAR = 1000

_ALL = np.uint32(0xFFFFFFFF)


def _crc_table() -> np.ndarray:
    value = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        value = np.where(value & 1, (value >> 1) ^ np.uint32(0xEDB88320), value >> 1).astype(np.uint32)
    return value


_TABLE = _crc_table()


def crc_on(crc: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Each CRC-32 carried on over data[start:end], all words a byte at a time."""
    out, length = crc ^ _ALL, ends - starts
    order = np.argsort(-np.minimum(length, _LONG + 1), kind="stable")
    short = order[int(np.searchsorted(-length[order], -_LONG)) :]
    active = np.searchsorted(-length[short], -np.arange(1, _LONG + 1), "right")  # words of at least so many bytes
    state, at = out[short], starts[short]
    for k, n in enumerate(active.tolist()):
        if not n:
            break
        state[:n] = _TABLE[(state[:n] ^ data[at[:n] + k]) & np.uint32(255)] ^ (state[:n] >> np.uint32(8))
    out[short] = state
    out ^= _ALL
    for k in order[: len(order) - len(short)].tolist():
        out[k] = zlib.crc32(data[starts[k] : ends[k]], int(crc[k]))
    return out


def runs(data: np.ndarray, offsets: np.ndarray, longest: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For each length of run: the text, first byte and last byte of each run, and its CRC-32. data: lower-cased texts."""
    starts, ends, first = split_words(data, offsets, ALNUM)
    if not len(starts):
        return
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    space = np.frombuffer(b" ", np.uint8)
    head = np.arange(len(starts))
    crc = crc_on(np.zeros(len(starts), np.uint32), data, starts, ends)
    for n in range(longest):
        if n:  # runs that can grow by a word of the same text
            more = head + n < len(starts)
            more[more] = text[head[more]] == text[head[more] + n]
            head, crc = head[more], crc[more]
            zero = np.zeros(len(head), np.int64)
            crc = crc_on(crc_on(crc, space, zero, zero + 1), data, starts[head + n], ends[head + n])
        yield text[head], starts[head], ends[head + n], crc


def _lower(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = utf8(column)
    return np.frombuffer(data.tobytes().translate(LOWER), np.uint8), offsets


def _counts(rows: DataFrame, add, buckets: int) -> np.ndarray:
    """Sum over all batches of add(batch), an array of this size; added up by Spark."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in blocks(batches):
            total += add(batch)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at])], ["at", "value"])

    out = np.zeros(buckets, np.int64)
    for r in scan(rows, work, "at long, value long").groupBy("at").agg(F.sum("value").alias("value")).collect():  # buckets
        out[r["at"]] = r["value"]
    return out


def bucket_counts(texts: DataFrame, longest: int = LONGEST_RUN, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all texts (text) fall into each bucket, by segment deduplication."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    lines = texts.select(F.explode(F.split(text, "\n")).alias("text")).where("text != ''")
    lines = lines.groupBy("text").agg(F.count(F.lit(1)).alias("times"))

    def of_lines(batch: pa.RecordBatch) -> np.ndarray:
        times = np.asarray(batch.column("times"), np.int64)
        total = np.zeros(buckets, np.int64)
        for line, _, _, crc in runs(*_lower(batch.column("text")), longest):
            np.add.at(total, (crc % np.uint32(buckets)).astype(np.int64), times[line])
        return total

    def across(batch: pa.RecordBatch) -> np.ndarray:
        data, offsets = _lower(batch.column("text"))
        breaks = np.zeros(len(data) + 1, np.int64)
        np.cumsum(data == 10, out=breaks[1:])
        total = np.zeros(buckets, np.int64)
        for _, start, end, crc in runs(data, offsets, longest):
            crossing = breaks[end] > breaks[start]
            total += np.bincount((crc[crossing] % np.uint32(buckets)).astype(np.int64), minlength=buckets)
        return total

    found = _counts(lines, of_lines, buckets)
    return found + _counts(texts.select("text"), across, buckets) if longest > 1 else found


def gains(target: np.ndarray, corpus: np.ndarray) -> np.ndarray:
    """Whole-number log-ratio of each bucket's share in the target to that in the corpus, in thousandths."""
    buckets, all_target, all_corpus = len(target), float(target.sum()), float(corpus.sum())
    return np.array(
        [
            math.floor(1000 * math.log((t + 1.0) * (all_corpus + buckets) / ((s + 1.0) * (all_target + buckets))))
            for t, s in zip(target.tolist(), corpus.tolist(), strict=True)
        ],
        np.int64,
    )


def noise(doc_id: int | None, seed: int) -> int:
    """Gumbel noise of a document, in thousandths, keyed by the seed and its id."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(docs: DataFrame, gain: np.ndarray, longest: int = LONGEST_RUN, seed: int = SEED) -> DataFrame:
    """doc_id, row, n_words, n_features, weight and score of every row of docs (doc_id, text)."""
    buckets = np.uint32(len(gain))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches):
            n = batch.num_rows
            words, features, total = (np.zeros(n, np.int64) for _ in range(3))
            for k, (text, _, _, crc) in enumerate(runs(*_lower(batch.column("text")), longest)):
                count = np.bincount(text, minlength=n)
                words += 0 if k else count
                features += count
                np.add.at(total, text, gain[(crc % buckets).astype(np.int64)])
            weight = np.where(features > 0, total // np.maximum(features, 1), 0)
            score = weight + np.array([noise(d, seed) for d in batch.column("doc_id").to_pylist()], np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("row"), *map(pa.array, (words, features, weight, score))],
                ["doc_id", "row", "n_words", "n_features", "weight", "score"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.monotonically_increasing_id().alias("row"))
    return scan(rows, work, "doc_id long, row long, n_words long, n_features long, weight long, score long")


def _counted_down(rows: DataFrame, value, wanted: int) -> tuple[int, int]:
    """The greatest value such that rows of it or more are at least as many as wanted, and how many are above it."""
    above = 0
    for v, n in sorted(rows.groupBy(value.alias("v")).agg(F.count(F.lit(1)).alias("n")).collect(), reverse=True):
        if above + n >= wanted:
            return v, above
        above += n
    raise ValueError(f"fewer rows than {wanted}")


def ranked(rows: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS) -> DataFrame:
    """The scored rows, which must be a written table, with the rank of each one drawn; null for others."""
    fit = rows.where(F.col("n_words") >= least_words)
    drawn = percent * fit.count() // 100
    if not drawn:
        return rows.withColumn("rank", F.lit(None).cast("long"))
    bar = F.floor(F.col("score") / _BAR).cast("long")  # some dozen, as gains and noise are logarithms
    at_bar, above = _counted_down(fit, bar, drawn)
    least, _ = _counted_down(fit.where(bar == at_bar), F.col("score"), drawn - above)
    chosen = (F.col("n_words") >= least_words) & (F.col("score") >= least)
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("row")]
    place = F.monotonically_increasing_id()  # partition, then place in it
    dealt = rows.where(chosen).repartitionByRange(*order).sortWithinPartitions(*order)
    dealt = written(dealt.withColumn("_place", place), "drawn").withColumn("_part", F.shiftright("_place", 33))
    sizes = dealt.groupBy("_part").agg(F.count(F.lit(1)).alias("n")).orderBy("_part").collect()  # one for each partition
    before = np.cumsum([0, *(r.n for r in sizes)]).tolist()
    starts = rows.sparkSession.createDataFrame(
        [(r._part, b) for r, b in zip(sizes, before, strict=False)], "_part long, _before long"
    )
    number = F.col("_before") + F.col("_place").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    top = dealt.join(F.broadcast(starts), "_part").withColumn("rank", F.when(number <= drawn, number))
    rest = rows.where(~chosen).withColumn("rank", F.lit(None).cast("long"))
    return rest.unionByName(top.select(rest.columns))


def resample(
    docs: DataFrame,
    target: DataFrame,
    longest: int = LONGEST_RUN,
    buckets: int = BUCKETS,
    seed: int = SEED,
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
) -> DataFrame:
    """doc_id, n_features, weight, score and rank (null: not drawn) of every row of docs (doc_id, text); target: text."""
    gain = gains(bucket_counts(target, longest, buckets), bucket_counts(docs, longest, buckets))
    rows = written(scored(docs, gain, longest, seed), "scores")
    return ranked(rows, percent, least_words).select("doc_id", "n_features", "weight", "score", "rank")
