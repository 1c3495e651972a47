"""Compression of vectors to codes by product quantisation in exact integers.

Each component x becomes the integer floor(scale * x); vectors are cut into
equal consecutive parts, and every part position has a codebook of integer
entries that rounds of assignment and averaging improve. All of it is exact:
the same rows give the same codes on any machine, in any order and dealing.

Exactness comes from limbs. An integer is a sum of limbs of LIMB_BITS bits, the
highest one signed. Products of two limbs, summed over a part, stay under 2^53,
so a float64 BLAS product of two limb matrices has no rounding; the products of
all pairs of limbs are shifted and added as int64, or as Python's integers where
an int64 could overflow. The nearest entry is the first one of least distance.

Each round is one scan of the vectors. A task sends at most one row for each
(part, entry, component, limb), and Spark adds these up; only the codebooks
reach the driver.

Rows whose vector is null or holds a null or non-finite component are dropped,
as are rows whose vector isn't as long as that of the first seed. Where the
length isn't a multiple of the parts, zeros fill up the last one. Seeds are the
kept rows of smallest id; null ids come last and equal ids by their vectors. With
fewer kept rows than entries the codebooks are shorter; an empty table has empty
codebooks and gives an empty result. A distance beyond a long counts as the
largest long. Equal vectors have equal codes. Null labels form one group.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm.base import scan, written

SCALE_BITS = 12  # components are multiplied by 4096
PARTS, ENTRIES, ROUNDS = 8, 16, 6
#: Two limbs multiply to at most 2^40, and 2^13 of these add up under 2^53.
LIMB_BITS, MOST_WIDTH = 20, 1 << 13
#: Vectors worked on at once.
BLOCK_ROWS = 4096
LONGEST = 2**63 - 1

_LIMB = 1 << LIMB_BITS


def integers(values: np.ndarray) -> np.ndarray:
    """floor(4096 * x) of finite doubles: int64 where all fit well, else Python's integers."""
    if not values.size or np.abs(values).max() < 2.0**34:
        return np.floor(values * float(1 << SCALE_BITS)).astype(np.int64)
    # a double from 2^52 upward is an integer itself
    exact = [int(x) << SCALE_BITS if abs(x) >= 2.0**52 else int(np.floor(x * float(1 << SCALE_BITS))) for x in values.ravel().tolist()]
    return np.array(exact, object).reshape(values.shape)


def limbs(values: np.ndarray) -> list[np.ndarray]:
    """Float64 arrays l with values = sum of l[i] * 2^(LIMB_BITS * i); all but the last within 0 and 2^LIMB_BITS."""
    out = []
    while values.size and max(int(values.max()), -int(values.min())) >= _LIMB:
        out.append((values & (_LIMB - 1)).astype(np.float64))
        values = values >> LIMB_BITS
    return [*out, values.astype(np.float64)]


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b.T of integer matrices, exactly: int64, or Python's integers where the result may not fit."""
    width = a.shape[1]
    if width > MOST_WIDTH:
        raise ValueError(f"a part has {width} components; {MOST_WIDTH} are allowed")
    left, right = limbs(a), limbs(b)
    # shifted products may each reach 2^(40 + shift) times the width, and some of them are added
    top = 2 * LIMB_BITS + LIMB_BITS * (len(left) + len(right) - 2) + max(1, width).bit_length() + len(left) * len(right)
    kind = np.int64 if top < 62 else object
    total = np.zeros((len(a), len(b)), kind)
    for (i, x), (j, y) in product(enumerate(left), enumerate(right)):
        part = (x @ y.T).astype(np.int64).astype(kind)
        total += part << (LIMB_BITS * (i + j)) if kind is np.int64 else part * (1 << (LIMB_BITS * (i + j)))
    return total


def nearest(vectors: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the first nearest entry of each vector, and the squared distance, exactly."""
    dots = products(vectors, entries)
    if max(_magnitude(vectors), _magnitude(entries)) ** 2 * 4 * max(1, vectors.shape[1]) >= 2**62:
        vectors, entries, dots = (x.astype(object) for x in (vectors, entries, dots))
    distance = (vectors * vectors).sum(axis=1)[:, None] - 2 * dots + (entries * entries).sum(axis=1)[None, :]
    best = np.argmin(distance, axis=1)
    return best, distance[np.arange(len(vectors)), best]


def _magnitude(values: np.ndarray) -> int:
    return max(int(values.max()), -int(values.min())) if values.size else 0


def _rows(column: pa.Array, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Which of some vectors have this length, and the components of these."""
    offsets = np.asarray(column.offsets, np.int64)
    keep = np.diff(offsets) == length
    values = np.asarray(column.values)
    at = offsets[:-1][keep][:, None] + np.arange(length)
    return keep, values[at].reshape(int(keep.sum()), length)


def _padded(values: np.ndarray, parts: int) -> np.ndarray:
    more = -values.shape[1] % parts
    return np.pad(values, ((0, 0), (0, more))) if more else values


def kept_vectors(vectors: DataFrame, column: str) -> DataFrame:
    """vec_id, label and vector of rows whose vector is whole."""
    vector = F.col(column).cast("array<double>")
    label = F.col("label").cast("string") if "label" in vectors.columns else F.lit(None).cast("string")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), label.alias("label"), vector.alias("vector"))
    return rows.where(F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))


def seeds(kept: DataFrame, entries: int) -> np.ndarray | None:
    """The vectors of smallest id that set the length and start the codebooks; None for an empty table."""
    order = [F.col("vec_id").asc_nulls_last(), "vector"]
    first = kept.orderBy(*order).limit(1).collect()
    if not first:
        return None
    length = len(first[0].vector)
    rows = kept.where(F.size("vector") == length).orderBy(*order).limit(entries).collect()  # as many as entries
    return np.array([r.vector for r in rows], float).reshape(len(rows), length)


def _blocks(batches: Iterator[pa.RecordBatch], length: int, parts: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for start in range(0, batch.num_rows, BLOCK_ROWS):
            part = batch.slice(start, BLOCK_ROWS)
            keep, values = _rows(part.column("vector"), length)
            if keep.any():
                yield part.filter(pa.array(keep)), _padded(integers(values), parts)


def part_sums(kept: DataFrame, length: int, books: list[np.ndarray]) -> dict[tuple[int, int], tuple[int, list[int]]]:
    """Of each (part, entry) that is nearest to some: how many, and the sum of each component."""
    parts = len(books)
    width = books[0].shape[1]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[int, int], np.ndarray] = {}  # as large as the codebooks
        for _, rows in _blocks(batches, length, parts):
            ones = np.ones((len(rows), 1), np.int64)
            for p, entries in enumerate(books):
                part = rows[:, p * width : (p + 1) * width]
                code, _ = nearest(part, entries)
                for e in np.unique(code).tolist():
                    mine = code == e
                    sums = np.concatenate([ones[mine], part[mine]], axis=1)
                    # BLOCK_ROWS integers under 2^46 add up within an int64; larger ones are Python's
                    sums = sums.sum(axis=0) if sums.dtype != object else sum(sums[1:], sums[0])
                    total[p, e] = total.get((p, e), 0) + sums.astype(object)
        out = []
        for (p, e), sums in total.items():
            for i, value in enumerate(sums.tolist()):
                k = 0
                while not -_LIMB <= value < _LIMB:
                    out.append((p, e, i, k, value & (_LIMB - 1)))
                    value >>= LIMB_BITS
                    k += 1
                out.append((p, e, i, k, value))
        columns = [pa.array([r[c] for r in out], pa.int64()) for c in range(5)]
        yield pa.RecordBatch.from_arrays(columns, ["part", "entry", "place", "limb", "value"])

    sums = scan(kept.select("vector"), work, "part long, entry long, place long, limb long, value long")
    found: dict[tuple[int, int], list[int]] = {}
    for r in sums.groupBy("part", "entry", "place", "limb").agg(F.sum("value").alias("value")).collect():  # as large as the codebooks
        found.setdefault((r.part, r.entry), [0] * (width + 1))[r.place] += r.value << (LIMB_BITS * r.limb)
    return {key: (values[0], values[1:]) for key, values in found.items()}


def _integer_array(rows: list[list[int]]) -> np.ndarray:
    most = max((abs(x) for row in rows for x in row), default=0)
    return np.array(rows, np.int64 if most < 2**62 else object)


def learn(kept: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[int, list[np.ndarray]]:
    """Length of the vectors, and the codebook of each part after all rounds; (0, []) for an empty table."""
    start = seeds(kept, entries)
    if start is None:
        return 0, []
    length = start.shape[1]
    rows = _padded(integers(start), parts)
    width = rows.shape[1] // parts
    books = [rows[:, p * width : (p + 1) * width] for p in range(parts)]
    if not width:
        return length, books
    for _ in range(rounds):
        found = part_sums(kept, length, books)
        books = [
            _integer_array([
                [s // found[p, e][0] for s in found[p, e][1]] if (p, e) in found else [int(x) for x in entry]
                for e, entry in enumerate(book)
            ])
            for p, book in enumerate(books)
        ]
    return length, books


def codebooks_digest(books: list[np.ndarray]) -> str:
    return hashlib.sha256(",".join(str(int(x)) for book in books for x in book.ravel()).encode()).hexdigest()


def encode(kept: DataFrame, length: int, books: list[np.ndarray]) -> DataFrame:
    """vec_id, label, code and error of every kept row."""
    parts, width = len(books), books[0].shape[1] if books else 0

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, rows in _blocks(batches, length, parts):
            codes, error = np.zeros((len(rows), parts), np.int64), np.zeros(len(rows), object)
            for p, entries in enumerate(books) if width else ():
                codes[:, p], distance = nearest(rows[:, p * width : (p + 1) * width], entries)
                error = error + distance.astype(object)
            texts = ["".join(f"{c:02x}" for c in row) for row in codes.tolist()]
            errors = [min(int(e), LONGEST) for e in error.tolist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), pa.array(texts, pa.string()), pa.array(errors, pa.int64())],
                ["vec_id", "label", "code", "error"],
            )

    return scan(kept, work, "vec_id long, label string, code string, error long")


def compress(vectors: DataFrame, column: str = "embedding", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """vec_id, code, error, label_error and codebooks_sha256 of every kept row of vectors (vec_id, label, column)."""
    kept = kept_vectors(vectors, column)
    length, books = learn(kept, parts, entries, rounds)
    coded = written(encode(kept, length, books), "codes")
    # written, so that its size is known: broadcast while small, else both sides are dealt for the join and hot labels split
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(LONGEST).cast("decimal(38,0)"))
    sums = written(coded.groupBy(F.col("label").alias("of")).agg(total.cast("long").alias("label_error")), "label_errors")
    return coded.join(sums, F.col("label").eqNullSafe(F.col("of"))).select(
        "vec_id", "code", "error", "label_error", F.lit(codebooks_digest(books)).alias("codebooks_sha256")
    )
