"""CSV readers: every column as text, chosen by header name."""

import csv
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline import schemas

# Doubled quotes inside quoted fields, as spreadsheet exports write them.
CSV_OPTIONS = {"header": True, "quote": '"', "escape": '"'}


@dataclass(frozen=True)
class RawInputs:
    """The four raw frames a load starts from. Movements carry ``source_file``."""

    items: DataFrame
    vendors: DataFrame
    supply: DataFrame
    movements: DataFrame


#: Headers read at the same time.
READERS = 32


def _files(spark: SparkSession, paths: Sequence[str]) -> list[str]:
    """Files with anything in them under these paths, from Spark's own listing; none of their content is read.

    Raises FileNotFoundError for a missing path or a folder without files,
    before any load starts.
    """
    try:
        listed = spark.read.format("binaryFile").load(list(paths)).select("path", "length").collect()  # as Spark's planner has them
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise FileNotFoundError(f"missing input: {', '.join(paths)}") from error
        raise
    if not listed:
        raise FileNotFoundError(f"no files in {', '.join(paths)}")
    return sorted(row["path"] for row in listed if row["length"])


def first_line(spark: SparkSession, file: str) -> str:
    """The first line of a file, compressed or not; the file system reads no further than its first block."""
    jvm, hadoop = spark._jvm, spark._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(file)
    stream = path.getFileSystem(hadoop).open(path)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(hadoop).getCodec(path)
        text = jvm.java.io.InputStreamReader(stream if codec is None else codec.createInputStream(stream), "UTF-8")
        return jvm.java.io.BufferedReader(text).readLine() or ""
    finally:
        stream.close()


def header_groups(spark: SparkSession, files: Sequence[str], wanted: T.StructType) -> dict[tuple[str, ...], list[str]]:
    """Files by the columns that their first lines name.

    Raises ValueError for a file whose first line doesn't name every wanted column.
    """

    def columns(file: str) -> tuple[str, ...]:
        return tuple(c.strip().lstrip("\ufeff").strip('"') for c in next(csv.reader([first_line(spark, file)]), []))

    groups: dict[tuple[str, ...], list[str]] = {}
    with ThreadPoolExecutor(READERS) as pool:
        for file, names in zip(files, pool.map(columns, files), strict=True):
            if not set(wanted.names) <= set(names):
                raise ValueError(f"{file} has no header with {', '.join(wanted.names)}")
            groups.setdefault(names, []).append(file)
    return groups


def read_csv(spark: SparkSession, path: str | Sequence[str], wanted: T.StructType, *, multi_line: bool = False) -> DataFrame:
    """The wanted columns of CSV files that may hold more, in whatever order each file has them.

    Spark matches CSV columns by position, so files are read in groups of one
    header, each with its own explicit schema, and the groups united by name.
    Headers come from one line of each file; the rest of a file is read once,
    by whatever uses the result. All columns are text, so "007" keeps its zeros.
    ``source_file`` is the full path. ``multi_line`` allows line breaks inside
    quotes but makes files unsplittable. Empty files are passed over.
    """
    paths = [path] if isinstance(path, str) else list(path)
    parts = [
        spark.read.csv(files, schema=_text_schema(columns), multiLine=multi_line, **CSV_OPTIONS).select(
            *wanted.names, F.col("_metadata.file_path").alias("source_file")
        )
        for columns, files in header_groups(spark, _files(spark, paths), wanted).items()
    ]
    if not parts:
        raise ValueError(f"{', '.join(paths)}: no header with {', '.join(wanted.names)}")
    return reduce(DataFrame.unionByName, parts)


def _text_schema(columns: Sequence[str]) -> T.StructType:
    """Columns as text; one that isn't wanted may be nameless or share a name, and is then named by its place."""
    seen: set[str] = set()
    names = []
    for place, name in enumerate(columns):
        names.append(name if name and name.lower() not in seen else f"_column_{place}")
        seen.add(name.lower())
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


def read_raw(spark: SparkSession, items: str, vendors: str, supply: str, movements: str) -> RawInputs:
    """Open the four CSV inputs; each path may be a file, folder or glob."""
    return RawInputs(
        items=read_csv(spark, items, schemas.ITEM_RAW),
        vendors=read_csv(spark, vendors, schemas.VENDOR_RAW),
        supply=read_csv(spark, supply, schemas.SUPPLY_RAW),
        movements=read_csv(spark, movements, schemas.MOVEMENT_RAW),
    )


def stream_files(spark: SparkSession, folder: str, files_per_batch: int = 1) -> DataFrame:
    """Names of the files of a folder as a stream, some in each micro-batch; none of their content is read."""
    return (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length long, content binary")
        .option("maxFilesPerTrigger", files_per_batch)
        .load(folder)
        .where("length > 0")
        .select("path")
    )


def files_of(batch: DataFrame) -> list[str]:
    """The files of a micro-batch of ``stream_files``, as many as it was told to take."""
    return sorted(row["path"] for row in batch.collect())
