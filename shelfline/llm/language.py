"""Language identification by rank-order profiles.

A language's profile is the PROFILE most frequent character n-grams (one to
three characters, within words and over their edges) of all its training
documents, in order of frequency. A document's own n-grams, ranked likewise,
are compared with each profile: every n-gram adds how far its rank is out of
place, or the most possible where the profile lacks it. The least distance
names the language; the score is 1 less that distance as a share of the most
possible.

Null texts and texts without a letter are "und" with score 0, and so is every
text where no language was learnt. Equal distances go to the first name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfline.llm.base import blocks, scan

PROFILE = 400
UNKNOWN = "und"

_LETTER: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """Which code points are letters."""
    if not _LETTER:
        _LETTER.append(np.array([chr(c).isalpha() for c in range(0x110000)]))
    return _LETTER[0]


def characters(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Lower-case code points of all texts with a 0 around each, 0 for all but letters, and where each text begins."""
    lower = [(t or "").lower() for t in texts]
    sizes = np.array([len(t) + 1 for t in lower], np.int64)
    raw = ("\0" + "\0".join(lower) + "\0").encode("utf-32-le", "surrogatepass")
    points = np.frombuffer(raw, np.uint32).astype(np.int64)
    return np.where(_letters()[points], points, 0), np.concatenate([[0], np.cumsum(sizes)])


def grams_of(points: np.ndarray) -> np.ndarray:
    """All n-grams of a text's code points, which begin and end with 0, each as one number."""
    a, b = points[:-1], points[1:]
    one = points[points > 0] | np.int64(1) << 62
    two = ((a << 21) | b | np.int64(1) << 61 | np.int64(1) << 62)[(a > 0) | (b > 0)]
    middle = b[:-1]
    # 20 bits for each of three characters: letters beyond that are none in use
    three = ((a[:-1] & 0xFFFFF) << 40 | (middle & 0xFFFFF) << 20 | (b[1:] & 0xFFFFF))[middle > 0]
    return np.concatenate([one, two, three])


#: N-grams that a task counts before it hands on what it has.
MOST_HELD = 1 << 20


def _add(grams: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    values, where = np.unique(grams, return_inverse=True)
    return values, np.bincount(where, counts, len(values)).astype(np.int64)


def count_grams(rows: DataFrame) -> DataFrame:
    """lang, gram and n over all rows (text, lang), counted within each task before Spark adds up."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        for batch in blocks(batches, limit=4 << 20):
            points, first = characters(batch.column("text").to_pylist())
            langs = np.array(batch.column("lang").to_pylist())
            for lang in np.unique(langs).tolist():
                grams = [grams_of(points[first[k] : first[k + 1] + 1]) for k in np.flatnonzero(langs == lang)]
                values, counts = np.unique(np.concatenate(grams), return_counts=True)
                if lang in total:
                    values, counts = np.concatenate([total[lang][0], values]), np.concatenate([total[lang][1], counts])
                    values, counts = _add(values, counts)
                total[lang] = values, counts
            if sum(len(values) for values, _ in total.values()) > MOST_HELD:
                yield from counted(total)
                total = {}
        yield from counted(total)

    def counted(total: dict[str, tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        for lang, (values, counts) in total.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(values)), pa.array(values), pa.array(counts)], ["lang", "gram", "n"]
            )

    parts = scan(rows.select("text", F.col("lang").cast("string").alias("lang")), work, "lang string, gram long, n long")
    return parts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


class Profiles:
    """Rank of each known n-gram in each language; the profile's size where it is missing."""

    def __init__(self, ranked: list[tuple[str, int, int]], size: int) -> None:
        self.langs = sorted({lang for lang, _, _ in ranked})
        self.size = size
        self.grams = np.unique(np.array([gram for _, gram, _ in ranked], np.int64))
        self.rank = np.full((len(self.grams), len(self.langs)), size, np.int64)
        for lang, gram, rank in ranked:
            self.rank[np.searchsorted(self.grams, gram), self.langs.index(lang)] = rank

    def predict(self, points: np.ndarray) -> tuple[str, float]:
        """points: code points of one text between zeros."""
        grams, counts = np.unique(grams_of(points), return_counts=True)
        if not len(grams) or not self.langs:
            return UNKNOWN, 0.0
        if len(grams) > self.size:
            least = np.partition(counts, len(counts) - self.size)[len(counts) - self.size]
            some = np.flatnonzero(counts >= least)
            top = grams[some[np.argsort(-counts[some], kind="stable")[: self.size]]]
        else:
            top = grams[np.argsort(-counts, kind="stable")]
        at = np.minimum(np.searchsorted(self.grams, top), len(self.grams) - 1)
        known = self.grams[at] == top
        ranks = self.rank[at[known]]
        apart = np.where(ranks < self.size, np.abs(ranks - np.flatnonzero(known)[:, None]), self.size).sum(axis=0)
        apart += self.size * int((~known).sum())
        best = int(apart.argmin())
        return self.langs[best], 1 - float(apart[best]) / (self.size * len(top))


def learn(rows: DataFrame, size: int = PROFILE) -> Profiles:
    """Profiles from rows (text, lang), all of them; rows without a language don't count."""
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    counted = count_grams(rows.where("lang is not null and text is not null"))
    ranked = counted.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= size)
    return Profiles([(r["lang"], r["gram"], r["rank"] - 1) for r in ranked.collect()], size)  # size for each language


def identify(docs: DataFrame, profiles: Profiles) -> DataFrame:
    """doc_id, held_out, lang_pred and score for every row of docs (doc_id, text, held_out)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches):
            points, first = characters(batch.column("text").to_pylist())
            found = [profiles.predict(points[a : b + 1]) for a, b in zip(first[:-1], first[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("held_out"),
                    pa.array([f[0] for f in found], pa.string()),
                    pa.array([f[1] for f in found], pa.float64()),
                ],
                ["doc_id", "held_out", "lang_pred", "score"],
            )

    return scan(docs.select("doc_id", "held_out", "text"), work, "doc_id long, held_out boolean, lang_pred string, score double")


def learn_and_identify(docs: DataFrame, size: int = PROFILE) -> DataFrame:
    """Learns from rows of docs (doc_id, text, lang) that aren't held out, and names the language of every row.

    Held out are those whose crc32 of the id leaves remainder 2 by 4.
    """
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang", held_out.alias("held_out"))
    return identify(rows, learn(rows.where(~F.col("held_out")), size))
