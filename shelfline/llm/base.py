"""Helpers of the text operators: Arrow columns as byte arrays, words, rolling hashes, written tables.

Conventions shared by all operators of this package: a null text counts as
empty; only the named columns of an input are read, so further columns, with
whatever names, do no harm; an empty table gives an empty result of the same
schema.
"""

from __future__ import annotations

import ctypes
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import shelfline
from shelfline.session import discard, shared_dir

#: Lower-cases A-Z and leaves every other byte.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))

#: Bytes of a word between ASCII white space.
NOT_SPACE = np.array([b not in b" \t\n\v\f\r" for b in range(256)])

#: Bytes of a word of digits, letters and anything beyond ASCII.
ALNUM = np.array([48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 or b >= 128 for b in range(256)])

#: Text bytes worked on at once inside a task; a longer text is worked on alone.
BLOCK_BYTES = 1 << 20


# --- written tables -------------------------------------------------------------------------------


#: Spark's own setting that ends a query's shuffle files with the query.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


#: Folders that ``written`` has made and nobody has discarded, oldest first.
_tables: list[str] = []


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows as written to the shared folder: computed once, safe from lost executors, with no lineage.

    The shuffle files behind them go as soon as the write has ended, since nothing reads them again. The table stays
    until ``discard_written``, as a result that isn't computed yet may read it.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/shelfline/{spark.sparkContext.applicationId}/llm/{name}-{uuid.uuid4().hex}"
    _tables.append(path)
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def written_so_far() -> int:
    """A mark for ``discard_written``."""
    return len(_tables)


def discard_written(spark: SparkSession, since: int = 0, but_last: bool = False) -> None:
    """Delete the tables written since that mark, all or but the last one; what is lazily read from them is lost."""
    upto = len(_tables) - but_last
    for path in _tables[since:upto]:
        discard(spark, path)
    del _tables[since:upto]


_shipped: set[str] = set()

#: Rows of an Arrow batch between Spark and Python, where the session keeps Spark's default of 10,000. Whole texts are
#: far longer than the rows that default is meant for, and both sides hold some batches at once.
BATCH_ROWS = 500
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def ship(spark: SparkSession) -> None:
    """Sends this package's code to the executors, once for each application, and sets the size of Arrow batches."""
    if spark.conf.get(_BATCH) == "10000":
        spark.conf.set(_BATCH, str(BATCH_ROWS))
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        package = Path(shelfline.__file__).resolve().parent
        archive = shutil.make_archive(f"{tempfile.mkdtemp()}/shelfline", "zip", package.parent, package.name)
        spark.sparkContext.addPyFile(archive)
        _shipped.add(app)


def scan(df: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """Rows that ``work`` makes of each partition's Arrow batches.

    Spark goes on using a task's Python process, so what a task has freed goes back to the machine at its end.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from work(batches)
        finally:
            release_memory()

    ship(df.sparkSession)
    return df.mapInArrow(task, schema)


def release_memory() -> None:
    """Gives unused memory of Arrow and of the C library back to the machine."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library, which has no such call
        return


def keep_where(docs: DataFrame, test: Callable[[pa.RecordBatch], np.ndarray]) -> DataFrame:
    """The rows of docs (text, ...) for which test, given blocks of rows, is true, decided within one scan."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches):
            yield batch.filter(pa.array(test(batch)))

    return scan(docs, work, docs.schema)


def text_mark() -> Column:
    """A digest of the column text, which orders rows of one doc_id."""
    return F.unhex(F.sha2(F.coalesce(F.col("text").cast("string"), F.lit("")), 256))


#: Column that tells rows apart, as ids may be null or repeat.
ROW = "_row_of_docs"


def with_row(docs: DataFrame) -> DataFrame:
    """docs and, as ROW, the file and the place in it of each row, the same ones however often the rows are read.

    Docs that aren't read from Parquet files just as they stand are written first.
    """
    if docs._jdf.queryExecution().analyzed().nodeName() != "LogicalRelation" or "_metadata" in docs.columns:
        docs = written(docs, "docs")
    file = docs.metadataColumn("_metadata")
    return docs.withColumn(ROW, F.struct(F.xxhash64(file["file_path"]).alias("file"), file["row_index"].alias("place")))


def keep_rows(docs: DataFrame, rows: DataFrame, how: str = "left_semi") -> DataFrame:
    """The rows of docs that are (left_anti: are not) among rows, both with ROW, and without it.

    Texts move once and aren't sorted: the hint has Spark build each partition's table from the narrow rows.
    """
    narrow = rows.select(F.col(f"{ROW}.file").alias("_file"), F.col(f"{ROW}.place").alias("_place")).hint("shuffle_hash")
    same = (F.col(f"{ROW}.file") == F.col("_file")) & (F.col(f"{ROW}.place") == F.col("_place"))
    return docs.join(narrow, same, how).drop(ROW)


# --- texts as bytes -------------------------------------------------------------------------------


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts end to end as bytes, and where each begins (one entry more than texts)."""
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    column = column.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    if offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def blocks(batches: Iterable[pa.RecordBatch], column: str = "text", limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``limit`` text bytes."""
    for batch in batches:
        _, offsets = utf8(batch.column(column))
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
            yield batch.slice(at, to - at)
            at = to


def each_bytes(column: pa.Array) -> Iterator[bytes]:
    for value in column.cast(pa.large_binary()):
        yield value.as_py() or b""


def split_words(data: np.ndarray, offsets: np.ndarray, word_byte: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte range of every word, and the first word of each text (one entry more than texts)."""
    inside = word_byte[data]
    before, after = np.zeros(len(data), bool), np.zeros(len(data), bool)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    filled = offsets[1:] > offsets[:-1]
    before[offsets[:-1][filled]] = False
    after[offsets[1:][filled] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    return starts, np.flatnonzero(inside & ~after) + 1, np.searchsorted(starts, offsets)


# --- hashes ---------------------------------------------------------------------------------------


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose every output bit depends on every input bit."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class Rolling:
    """Polynomial hashes modulo 2^64 of ranges of a sequence, from one running sum."""

    def __init__(self, seed: int) -> None:
        with np.errstate(over="ignore"):
            self.byte = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(2 * seed + 1))
            self.base = mix(np.array([seed + 1000], np.uint64))[0] | np.uint64(5)
            inverse = self.base
            for _ in range(6):  # Newton's iteration doubles the right bits each time
                inverse = inverse * (np.uint64(2) - self.base * inverse)
        self.inverse = inverse
        self.powers = self.inverses = np.ones(1, np.uint64)

    def _reach(self, n: int) -> None:
        if len(self.powers) < n:
            n = max(n, 1 << 20)
            for name, base in (("powers", self.base), ("inverses", self.inverse)):
                steps = np.full(n, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))

    def ranges(self, values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hash of values[start:end] for each range; equal ranges have equal hashes wherever they stand."""
        self._reach(len(values) + 1)
        total = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * self.powers[: len(values)], out=total[1:])
        return mix((total[ends] - total[starts]) * self.inverses[starts])

    def of_words(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return self.ranges(self.byte[data], starts, ends)

    def windows(self, words: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Where each window of ``size`` words of one text begins, and its hash."""
        begin = np.ones(len(words) + 1, bool)
        begin[max(0, len(words) - size + 1) :] = False
        for k in range(1, size):  # none may reach over the end of a text
            at = first[1:] - k
            begin[at[at >= first[:-1]]] = False
        at = np.flatnonzero(begin)
        return at, self.ranges(words, at, at + size)


# --- packed integers ------------------------------------------------------------------------------

_ZSTD = pa.Codec("zstd", compression_level=1)


def pack(values: np.ndarray) -> bytes:
    """Integers as compressed differences; small where neighbours are alike."""
    raw = np.diff(values.astype(np.int64), prepend=np.int64(0)).astype("<i8")
    planes = np.ascontiguousarray(raw.view(np.uint8).reshape(-1, 8).T)
    return len(values).to_bytes(8, "little") + _ZSTD.compress(planes.tobytes(), asbytes=True)


def unpack(data: bytes) -> np.ndarray:
    n = int.from_bytes(data[:8], "little")
    planes = np.frombuffer(_ZSTD.decompress(data[8:], decompressed_size=8 * n, asbytes=True), np.uint8)
    return np.cumsum(np.ascontiguousarray(planes.reshape(8, n).T).view("<i8").ravel())
