"""File-by-file ingest of movements into running base quantities.

Each micro-batch writes only its own daily sums, into a folder named after the
batch id. A replayed batch overwrites its folder, so nothing counts twice, and
the cost of a batch depends on the batch, not on the history. Reading sums the
folders; turnover, coverage and the other measures are then built globally,
which per-file processing cannot do.
"""

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shelfline.plans.fact import daily_movements
from shelfline.plans.star_batches import add_batch
from shelfline.schemas import MOVEMENT_RAW, QUANTITIES
from shelfline.session import subfolders
from shelfline.sources import RawInputs, files_of, read_csv, type_movements

#: One row, the highest folded batch id; readers of Parquet folders pass over names with an underscore.
FOLDED = "_folded"


def folded_upto(spark: SparkSession, path: str) -> int:
    """Highest batch id that compaction folded into this folder; -1 for none."""
    return spark.read.parquet(f"{path}/{FOLDED}").first()["batch_id"] if FOLDED in subfolders(spark, path) else -1


def write_batch(raw_batch: DataFrame, batch_id: int, path: str) -> None:
    """Store the daily sums of one batch under its id; a batch already folded is not stored again."""
    if batch_id > folded_upto(raw_batch.sparkSession, path):
        daily = daily_movements(type_movements(raw_batch))
        daily.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def ingest(raw: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Start ingesting all files available now from a streaming frame of raw movements."""
    return _each(raw, checkpoint, lambda batch, batch_id: write_batch(batch, batch_id, path))


def _each(stream: DataFrame, checkpoint: str, work: Callable[[DataFrame, int], None]) -> StreamingQuery:
    return (
        stream.writeStream.foreachBatch(work)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def ingest_files(files: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """The same from a stream of file names (``stream_files``): CSV files of any column order, each read once."""

    def work(batch: DataFrame, batch_id: int) -> None:
        if names := files_of(batch):
            write_batch(read_csv(batch.sparkSession, names, MOVEMENT_RAW), batch_id, path)

    return _each(files, checkpoint, work)


def ingest_star(files: DataFrame, master: Callable[[], RawInputs], path: str, checkpoint: str) -> StreamingQuery:
    """Add the movement files of each micro-batch to the stored star under ``path``, which readers see batch by batch.

    ``master`` gives the items, vendors and receipts known at the time; its
    movements are not used. The stream's batch id names the star's batch, so
    that one which was committed to the star but not to the stream's
    checkpoint, and is sent again, counts once. A refused batch ends the stream,
    which goes on with it when started again.
    """

    def work(batch: DataFrame, batch_id: int) -> None:
        if names := files_of(batch):
            moves = read_csv(batch.sparkSession, names, MOVEMENT_RAW)
            add_batch(batch.sparkSession, replace(master(), movements=moves), path, batch_id)

    return _each(files, checkpoint, work)


def read_daily(spark: SparkSession, path: str) -> DataFrame:
    """Daily sums over all batches so far."""
    return (
        spark.read.parquet(path)
        .groupBy("mat_sku", "movement_date")
        .agg(*[F.sum(q).alias(q) for q in QUANTITIES])
    )


def compact(spark: SparkSession, path: str, target: str) -> None:
    """Rewrite all batches as one folder at a new path, which remembers the highest id it holds.

    A stream that goes on at ``target`` may replay a batch that was written but
    not committed before; its id tells that it is there already.
    """
    newest = spark.read.parquet(path).agg(F.max("batch_id").cast("long").alias("batch_id"))
    upto = newest.select(F.greatest("batch_id", F.lit(folded_upto(spark, path))).alias("batch_id"))
    read_daily(spark, path).write.mode("overwrite").parquet(f"{target}/batch_id=-1")
    upto.write.mode("overwrite").parquet(f"{target}/{FOLDED}")
