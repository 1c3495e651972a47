"""Quality classifier by positive-unlabelled learning with a non-negative risk.

Trusted positives are training documents labelled 1; unlabelled web text is
every training document without a label. Labelled negatives are never used.
With the squared loss the risk is a quadratic form of first and second moments
of the features, so one pass over all documents gives the risk over all of
them, exactly, whatever their number; only the moments (about 220 by 220
numbers) reach the driver. The non-negative risk is the greatest, over shares
from 0 to 1, of the positive part plus that share of the negative part. For each
share it is a convex quadratic form, so its minimum is found by solving for the
share at which the negative part is 0, or is that of the whole share where the
unbiased risk's minimum has no negative part below 0.

Model: a sum of one piecewise linear curve for each of a dozen measures of the
text, and weights for the shares of words and of pairs of neighbouring words
that hash to each of some buckets. Class prior: the least ratio, over thresholds, of unlabelled to positive
documents that score above the threshold, from histograms over all documents.

Null and empty texts have all measures 0 and a score like any other. With no
positives or no unlabelled rows nothing can be learned and each score is 0.5.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.llm.base import NOT_SPACE, Rolling, blocks, keep_where, mix, scan, split_words, utf8, written

MEASURES = (
    "upper", "digit", "mark", "symbol", "bar", "beyond_ascii", "line_ends", "word_length", "distinct_words",
    "repeated_next", "marked_words", "upper_words", "log_words", "longest_word",
)
#: Corners of each measure's curve; measures lie between 0 and 1.
KNOTS = np.array([0.0, 0.01, 0.03, 0.06, 0.1, 0.17, 0.25, 0.4, 0.6, 0.8, 1.0])
SIZE = len(MEASURES) * len(KNOTS)
#: Buckets of words, and of pairs of neighbouring words; numbers that stand for a text.
WORD_BUCKETS, PAIR_BUCKETS = 32, 32
HASHED = WORD_BUCKETS + PAIR_BUCKETS
WIDTH = len(MEASURES) + HASHED
#: All features: curves, hashed shares, and a constant one, which is last.
FEATURES = SIZE + HASHED + 1
#: Ridge on the curves' heights, in all and as so many rows; thresholds of the prior's histograms.
RIDGE, RIDGE_ROWS, BINS = 1e-3, 4.0, 200
#: The ridge of hashed shares, as a multiple: what they say must show in many more rows.
HASHED_RIDGE = 10.0

_WORDS = Rolling(7)
_CLASS = np.zeros((8, 256), bool)
for _b in range(256):
    _c = chr(_b)
    _CLASS[0, _b] = 65 <= _b <= 90
    _CLASS[1, _b] = 48 <= _b <= 57
    _CLASS[2, _b] = _c in ".,;:'\"-()"
    _CLASS[3, _b] = 33 <= _b <= 126 and not _c.isalnum() and _c not in ".,;:'\"-()|"
    _CLASS[4, _b] = _c == "|"
    _CLASS[5, _b] = _b >= 128
    _CLASS[6, _b] = _c == "\n"
    _CLASS[7, _b] = 65 <= _b <= 90 or 97 <= _b <= 122


def _per_text(values: np.ndarray, edges: np.ndarray) -> np.ndarray:
    total = np.zeros(len(values) + 1)
    np.cumsum(values, out=total[1:])
    return total[edges[1:]] - total[edges[:-1]]


def measure(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row for each text: its measures, each from 0 to 1, and the root of each bucket's share of words and pairs."""
    n = len(offsets) - 1
    out = np.zeros((n, WIDTH), np.float32)
    if not len(data):
        return out
    starts, ends, first = split_words(data, offsets, NOT_SPACE)
    size, words = np.maximum(np.diff(offsets), 1), np.diff(first)
    some, length = np.maximum(words, 1), ends - starts
    counts = [_per_text(row[data], offsets) for row in _CLASS]
    out[:, 0] = counts[0] / np.maximum(counts[7], 1)
    for at, kind in ((1, 1), (2, 2), (3, 3), (4, 4), (5, 5), (6, 6)):
        out[:, at] = np.minimum(1, counts[kind] / size * (1 if kind in (1, 5) else 3))
    out[:, 7] = np.minimum(1, _per_text(length, first) / some / 20)
    hashes = _WORDS.of_words(data, starts, ends)
    text = np.repeat(np.arange(n), words)
    order = np.lexsort((hashes, text))
    h, t = hashes[order], text[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (t[1:] != t[:-1])
    distinct = np.bincount(t[new], minlength=n)
    # against what a text of this length would have at a common rate of new words
    out[:, 8] = np.minimum(1, distinct / np.maximum(1, some**0.85))
    again = np.zeros(len(hashes), bool)
    again[1:] = (hashes[1:] == hashes[:-1]) & (text[1:] == text[:-1])
    out[:, 9] = _per_text(again, first) / some
    last = data[ends - 1] if len(ends) else np.zeros(0, np.uint8)
    out[:, 10] = _per_text(_CLASS[3][last] | _CLASS[4][last], first) / some
    head = np.minimum(starts + 1, len(data) - 1)
    out[:, 11] = _per_text(_CLASS[0][data[starts]] & _CLASS[0][data[head]], first) / some
    out[:, 12] = np.minimum(1, np.log1p(words) / 12)
    longest = np.zeros(n)
    if len(length):
        np.maximum.at(longest, text, length)
    out[:, 13] = np.minimum(1, longest / 60)
    at = len(MEASURES)
    together = np.flatnonzero(text[1:] == text[:-1])
    pairs = mix(hashes[together] * np.uint64(0x9E3779B97F4A7C15) + hashes[together + 1])
    for of, grams, buckets in ((text, hashes, WORD_BUCKETS), (text[together], pairs, PAIR_BUCKETS)):
        bucket = (grams % np.uint64(buckets)).astype(np.int64)
        counts = np.bincount(of * buckets + bucket, minlength=n * buckets).reshape(n, buckets)
        out[:, at : at + buckets] = np.sqrt(counts / np.maximum(1, counts.sum(axis=1, keepdims=True)))
        at += buckets
    return out


def curve(numbers: np.ndarray) -> np.ndarray:
    """Features of a text's numbers: each measure as its weights on the corners beside it, the hashed shares, a constant."""
    n, measures = len(numbers), numbers[:, : len(MEASURES)]
    out = np.zeros((n, FEATURES))
    out[:, SIZE:-1] = numbers[:, len(MEASURES) :]
    left = np.clip(np.searchsorted(KNOTS, measures, "right") - 1, 0, len(KNOTS) - 2)
    share = (measures - KNOTS[left]) / (KNOTS[left + 1] - KNOTS[left])
    column = np.arange(len(MEASURES)) * len(KNOTS) + left
    rows = np.arange(n)[:, None]
    out[rows, column] = 1 - share
    out[rows, column + 1] = share
    out[:, -1] = 1
    return out


def measured(docs: DataFrame) -> DataFrame:
    """doc_id and the measures of every whole text, as 4-byte numbers end to end."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches):
            rows = measure(*utf8(batch.column("text")))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([r.tobytes() for r in rows], pa.binary())], ["doc_id", "measures"]
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return scan(rows, work, "doc_id long, measures binary")


def _matrix(column: pa.Array) -> np.ndarray:
    return utf8(column)[0].view(np.float32).reshape(-1, WIDTH).astype(float)


def _sums(rows: DataFrame, statistic, size: int) -> np.ndarray:
    """Sums over all rows of statistic(measures), an array of this size, for each kind from 0 to 3; added up by Spark."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((4, size))
        for batch in batches:
            kind = np.asarray(batch.column("kind"), np.int64)
            measures = _matrix(batch.column("measures"))
            for k in np.unique(kind).tolist():
                total[k] += statistic(measures[kind == k])
        at = np.flatnonzero(total.ravel())
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total.ravel()[at])], ["at", "value"])

    parts = scan(rows.select("kind", "measures"), work, "at long, value double")
    out = np.zeros(4 * size)
    for r in parts.groupBy("at").agg(F.sum("value").alias("value")).collect():  # fixed size: moments or bins
        out[r["at"]] = r["value"]
    return out.reshape(4, size)


@dataclass(frozen=True)
class Model:
    heights: np.ndarray
    prior: float

    def margin(self, measures: np.ndarray) -> np.ndarray:
        return curve(measures) @ self.heights

    def score(self, measures: np.ndarray) -> np.ndarray:
        """With the squared loss the best margin is 2 p - 1 for a probability p."""
        return np.clip((1 + self.margin(measures)) / 2, 0, 1)


@dataclass(frozen=True)
class Moments:
    """Means over positives and unlabelled, and second moments of both."""

    mean_p: np.ndarray
    mean_u: np.ndarray
    second_p: np.ndarray
    second_u: np.ndarray
    #: Rows behind the smaller of both.
    n: float

    @staticmethod
    def of(sums_p: np.ndarray, sums_u: np.ndarray) -> Moments:
        """From sums of outer products; the last feature is constant, hence its product counts rows."""
        p, u = (x / max(x[-1, -1], 1) for x in (sums_p, sums_u))
        return Moments(p[-1], u[-1], p, u, min(sums_p[-1, -1], sums_u[-1, -1]))

    def negative_risk(self, w: np.ndarray, prior: float) -> float:
        """Risk of taking negatives for positives, from unlabelled less positives."""
        mean = self.mean_u - prior * self.mean_p
        second = self.second_u - prior * self.second_p
        return float((1 - prior) + 2 * w @ mean + w @ second @ w) / 4

    def positive_risk(self, w: np.ndarray, prior: float) -> float:
        return float(prior - 2 * prior * w @ self.mean_p + prior * w @ self.second_p @ w) / 4

    def fit(self, prior: float) -> np.ndarray:
        """The minimum of the non-negative risk with a ridge: the positive part plus what is above 0 of the negative part."""
        ridge = (RIDGE + RIDGE_ROWS / self.n) * np.eye(len(self.mean_p))
        ridge[SIZE:-1] *= HASHED_RIDGE
        ridge[-1, -1] = 1e-9

        def least(share: float) -> np.ndarray:
            """Where the positive part plus this share of the negative part is least; convex for shares from 0 to 1."""
            form = (1 - share) * prior * self.second_p + share * self.second_u + ridge
            return np.linalg.solve(form, prior * self.mean_p - share * (self.mean_u - prior * self.mean_p))

        w = least(1.0)
        if self.negative_risk(w, prior) >= 0:
            return w
        low, high = 0.0, 1.0  # the negative part at the minimum falls as its share grows
        for _ in range(50):
            middle = (low + high) / 2
            if self.negative_risk(least(middle), prior) >= 0:
                low = middle
            else:
                high = middle
        return least(low)


def class_prior(above_p: np.ndarray, above_u: np.ndarray) -> float:
    """Least ratio of unlabelled to positive shares above a threshold, with a margin for small counts."""
    n_p, n_u = above_p[0], above_u[0]
    slack = np.sqrt(np.log(20) / 2)
    share_p, share_u = above_p / n_p, above_u / n_u
    enough = share_p > 0.02
    bound = (share_u + slack / np.sqrt(n_u) + slack / np.sqrt(n_p) * share_p) / np.maximum(share_p, 1e-9)
    best = np.argmin(np.where(enough, bound, np.inf))
    return float(np.clip(share_u[best] / max(share_p[best], 1e-9), 0.02, 0.98))


def fit(rows: DataFrame) -> Model | None:
    """rows: kind, measures; all training documents. kind is 2 for positives, 0 for unlabelled, plus 0 or 1 for the half.

    The prior is estimated across halves: positives score higher under a function fitted to themselves, which would
    make unlabelled ones look rarer than they are.
    """
    size = FEATURES
    upper = np.triu_indices(size)

    def moments(measures: np.ndarray) -> np.ndarray:
        x = curve(measures)
        return (x.T @ x)[upper]

    sums = np.zeros((4, size, size))
    for kind, flat in enumerate(_sums(rows, moments, len(upper[0]))):
        sums[kind][upper] = flat
        sums[kind] += np.triu(sums[kind], 1).T
    whole = Moments.of(sums[2] + sums[3], sums[0] + sums[1])
    if not whole.n:
        return None
    # what tells positives from unlabelled orders documents, and their order is all the prior needs
    halves = [m.fit(0.5) if (m := Moments.of(sums[2 + h], sums[h])).n else whole.fit(0.5) for h in (0, 1)]

    def counts(measures: np.ndarray) -> np.ndarray:
        x = curve(measures)
        out = []
        for w in halves:
            bins = np.clip(((x @ w + 2) / 4 * BINS).astype(int), 0, BINS - 1)
            out.append(np.bincount(bins, minlength=BINS))
        return np.concatenate(out).astype(float)

    found = _sums(rows, counts, 2 * BINS).reshape(4, 2, BINS)
    # each half is counted under the other's order
    positive, unlabelled = found[2, 1] + found[3, 0], found[0, 1] + found[1, 0]
    prior = class_prior(*(np.cumsum(x[::-1])[::-1] for x in (positive, unlabelled)))
    return Model(whole.fit(prior), prior)


def _held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))


def learn(table: DataFrame, labels: DataFrame) -> Model | None:
    """The model for a written table of measured documents; None where there is nothing to learn from."""
    marks = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
        .where("doc_id is not null and quality is not null")
        .groupBy("doc_id")
        .agg(F.max("quality").alias("quality"))
    )
    training = table.where(~_held_out()).join(marks, "doc_id", "left")
    half = F.pmod(F.xxhash64("doc_id"), F.lit(2))
    positives = training.where("quality = 1").select((half + 2).alias("kind"), "measures")
    model = fit(positives.unionByName(training.where("quality is null").select(half.alias("kind"), "measures")))
    if model is None:  # no row without a label, or none with a positive one
        model = fit(positives.unionByName(training.where("quality is not null").select(half.alias("kind"), "measures")))
    return model


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted for every row of docs (doc_id, text).

    labels: doc_id, quality (1: positive). Rows whose crc32 of the id leaves remainder 1 by 3 are held out.
    Where every training row has a label, their texts without their labels are the unlabelled ones.
    """
    table = written(measured(docs), "measures")
    model = learn(table, labels)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = _matrix(batch.column("measures"))
            score = model.score(rows) if model else np.full(batch.num_rows, 0.5)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(score, pa.float64()), pa.array((score >= 0.5).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"],
            )

    return scan(table.withColumn("held_out", _held_out()), work, "doc_id long, held_out boolean, score double, predicted int")


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of docs not predicted 0; once the model is learnt, one scan that scores each row and passes it on."""
    model = learn(written(measured(docs), "measures"), labels)

    def good(batch: pa.RecordBatch) -> np.ndarray:
        return model.score(measure(*utf8(batch.column("text"))).astype(float)) >= 0.5

    return keep_where(docs, good) if model else docs
