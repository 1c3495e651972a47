"""Exact duplicates by content-defined chunk recipes.

Each normalised text is cut into chunks where a rolling hash of the last bytes
says so, hence equal texts are cut alike. A chunk's identifier is its digest,
verified by moving each different chunk once: a digest that stands for two
different chunks gets one identifier for each. A text's recipe is its ordered
list of identifiers; texts are equal when their recipes are. Only recipes, some
16 bytes a kilobyte, are grouped and joined; long texts never move as a whole.

Null texts count as empty; an empty text has the empty recipe. Repeated rows
are told apart by a number given in the one scan whose result is written, so
one row of each group stays.
A null doc_id is smaller than any other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfline.llm.base import LOWER, ROW, blocks, keep_rows, mix, scan, utf8, with_row, written

#: Bytes that decide on a cut, least chunk, and one cut in so many bytes.
WINDOW, LEAST, EVERY = 32, 256, 1024
#: A chunk never exceeds this, whatever the text.
MOST = 1 << 16
DIGEST_BYTES = 16

_GEAR = (mix(np.arange(1, 257, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32)


def cut_points(data: np.ndarray, start: int, end: int, marks: np.ndarray) -> list[int]:
    """Ends of the chunks of data[start:end]; marks are places where the rolling hash allows a cut."""
    ends, at = [], start
    for mark in marks[np.searchsorted(marks, start + LEAST) : np.searchsorted(marks, end)].tolist():
        while mark - at > MOST:
            at += MOST
            ends.append(at)
        if mark - at >= LEAST:
            ends.append(mark)
            at = mark
    while end - at > MOST:
        at += MOST
        ends.append(at)
    if end > at:
        ends.append(end)
    return ends


def rolling_marks(data: np.ndarray) -> np.ndarray:
    """Places before which the last WINDOW bytes hash to a cut; a place depends on these bytes alone."""
    h = _GEAR[data]
    span = 1
    while span < WINDOW:  # doubles the window: h(2k) at i is h(k) at i and, shifted, h(k) at i - k
        later = h[span:] + (h[:-span] << np.uint32(span))
        h = np.concatenate([h[:span], later])
        span *= 2
    return np.flatnonzero((h >> np.uint32(8)) % np.uint32(EVERY) == 0) + 1


def _chunks(batch: pa.RecordBatch) -> Iterator[list[bytes]]:
    data, offsets = utf8(batch.column("text"))
    raw = data.tobytes().translate(LOWER)
    data = np.frombuffer(raw, np.uint8)
    marks = rolling_marks(data) if len(data) else np.zeros(0, np.int64)
    for start, end in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        edges = [start, *cut_points(data, start, end, marks)]
        yield [raw[a:b] for a, b in zip(edges[:-1], edges[1:], strict=True)]


def _digest(chunk: bytes, size: int) -> bytes:
    return hashlib.blake2b(chunk, digest_size=size).digest()


def _kind(docs: DataFrame) -> str:
    return docs.schema["row"].dataType.simpleString()


def recipes(docs: DataFrame, digest_bytes: int = DIGEST_BYTES) -> DataFrame:
    """doc_id, row, text_sha256 and the digests of each text's chunks, end to end."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches):
            shas, lists = [], []
            for chunks in _chunks(batch):
                whole = hashlib.sha256()
                for chunk in chunks:
                    whole.update(chunk)
                shas.append(whole.hexdigest())
                lists.append(b"".join(_digest(c, digest_bytes) for c in chunks))
            columns = [batch.column("doc_id"), batch.column("row"), pa.array(shas, pa.string()), pa.array(lists, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "row", "text_sha256", "recipe"])

    return scan(docs, work, f"doc_id long, row {_kind(docs)}, text_sha256 string, recipe binary")


def chunk_rows(docs: DataFrame, digest_bytes: int = DIGEST_BYTES, place: bool = False) -> DataFrame:
    """Digest and bytes of each chunk: once a batch, or with its place in every text."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, limit=8 << 20):
            if place:
                rows = [(k, at, chunk) for k, chunks in enumerate(_chunks(batch)) for at, chunk in enumerate(chunks)]
            else:
                rows = [(None, None, chunk) for chunk in {c for chunks in _chunks(batch) for c in chunks}]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row").take(pa.array([r[0] for r in rows], pa.int64())),
                    pa.array([r[1] for r in rows], pa.int64()),
                    pa.array([_digest(r[2], digest_bytes) for r in rows], pa.binary()),
                    pa.array([r[2] for r in rows], pa.binary()),
                ],
                ["row", "place", "digest", "chunk"],
            )

    return scan(docs, work, f"row {_kind(docs)}, place long, digest binary, chunk binary")


def ambiguous(docs: DataFrame, digest_bytes: int = DIGEST_BYTES) -> DataFrame:
    """Digests that stand for several different chunks; with 16 bytes there are none."""
    different = chunk_rows(docs, digest_bytes).groupBy("digest", "chunk").agg(F.count(F.lit(1)).alias("n"))
    return different.groupBy("digest").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("digest")


def refined(docs: DataFrame, lists: DataFrame, digests: DataFrame, digest_bytes: int) -> DataFrame:
    """The recipes with the chunks behind ambiguous digests numbered, so that their identifiers differ."""
    rows = chunk_rows(docs, digest_bytes, place=True).join(digests, "digest", "left_semi")
    numbers = Window.partitionBy("digest").orderBy("chunk")
    variants = rows.select("digest", "chunk").distinct().withColumn("variant", F.row_number().over(numbers))
    numbered = (
        rows.join(written(variants, "variants"), ["digest", "chunk"])
        .groupBy("row")
        .agg(F.to_json(F.sort_array(F.collect_list(F.struct("place", "variant")))).alias("variants"))
    )
    exact = F.concat("recipe", F.encode(F.coalesce("variants", F.lit("")), "UTF-8"))
    return lists.join(numbered, "row", "left").select("doc_id", "row", "text_sha256", exact.alias("recipe"))


def exact_groups(docs: DataFrame, digest_bytes: int = DIGEST_BYTES) -> DataFrame:
    """One row per row of docs (doc_id, text): doc_id, row, keep_id, group_size, kept, text_sha256.

    The row with the largest doc_id of each group of equal texts (A-Z lower-cased) stays. row tells rows apart: docs'
    own ROW where it has one, otherwise a number.
    """
    row = F.col(ROW) if ROW in docs.columns else F.monotonically_increasing_id()
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", row.alias("row"))
    lists = written(recipes(docs, digest_bytes), "recipes")
    clashes = written(ambiguous(docs, digest_bytes), "clashes")
    if not clashes.isEmpty():
        lists = written(refined(docs, lists, clashes, digest_bytes), "recipes")
    best = F.max(F.struct("doc_id", "row"))
    groups = lists.groupBy("recipe").agg(best.alias("best"), F.count(F.lit(1)).alias("group_size"))
    groups = written(groups, "groups")  # so that both sides of the join are dealt for it, and hot recipes split
    return lists.join(groups, "recipe").select(
        "doc_id",
        "row",
        F.col("best.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("best.row")).alias("kept"),
        "text_sha256",
    )


def drop_copies(docs: DataFrame) -> DataFrame:
    """The rows of docs that stay, with all their columns: one of each group, even of rows that repeat doc_id and text.

    Decisions are rows without texts; only the join that applies them moves a text, once.
    """
    docs = with_row(docs)
    gone = exact_groups(docs).where(~F.col("kept")).select(F.col("row").alias(ROW))
    return keep_rows(docs, gone, "left_anti")
