"""Which written folders make up a star: the ledger that readers and writers go by.

A batch writes into folders of its own, ``table/batch_id=N``, and changes no
other. Large tables have a folder within for each part, ``column=part``; of
small ones, one folder holds the rows of all the batch's parts, and those that a
later batch has replaced are passed over by a filter on the part. What is live is listed by the newest entry of the ledger, a
small table of its own folder ``_ledger/entry=K``. Moving an entry into place
commits a batch: before, every reader sees the star as it was, and after it the
new one, with all tables of the same batch. Folders that no entry lists, left
by a refused or broken-off batch, are never read; a retry overwrites them.

One writer works at a time. The file system must move a folder in one step, as
HDFS and local ones do.
"""

import uuid
from collections.abc import Collection
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline.session import discard, move, subfolders

_LIVE = "table_name string, part int, batch_id int"
_LOADS = "batch_id int, table_name string, n_rows long, outcome string, reason string"
#: An entry: the live parts of tables, and rows written by table, which alone have an outcome.
_ENTRY = f"{_LIVE}, n_rows long, outcome string"


class BrokenLedger(Exception):
    """An entry can't be committed, as another writer has committed one meanwhile."""


@dataclass(frozen=True)
class Layout:
    """How a table is kept: the column of its parts, None for a table without, and whether a part has its own folder."""

    column: str | None = None
    folders: bool = False


@dataclass(frozen=True)
class Snapshot:
    """The live folders of all tables after some batch. A table without parts has the part None."""

    path: str
    entry: int = -1
    batch_id: int = -1
    layouts: dict[str, Layout] = field(default_factory=dict)
    #: For each table and part, the batches whose folders hold it.
    live: dict[str, dict[int | None, tuple[int, ...]]] = field(default_factory=dict)

    def folder(self, table: str, batch_id: int, part: int | None = None) -> str:
        layout = self.layouts[table]
        return f"{self.path}/{table}/batch_id={batch_id}" + (f"/{layout.column}={part}" if layout.folders else "")

    def parts(self, table: str) -> set[int | None]:
        return set(self.live.get(table, {}))

    def whole(self, table: str, parts: Collection[int | None]) -> bool:
        """Whether each of these parts lies in one folder."""
        return all(len(self.live.get(table, {}).get(p, ())) <= 1 for p in parts)

    def read(
        self, spark: SparkSession, table: str, schema: T.StructType, parts: Collection[int | None] | None = None
    ) -> DataFrame:
        """Rows of a table, all or those of some parts; the column of the parts comes last."""
        layout, held = self.layouts[table], self.live.get(table, {})
        named = [layout.column] if layout.column else []
        full = T.StructType([f for f in schema.fields if f.name not in named] + [T.StructField(c, T.IntegerType()) for c in named])
        wanted = {p: batches for p, batches in held.items() if parts is None or p in parts}
        if not wanted:
            return spark.createDataFrame([], full)
        if layout.folders or not named:
            found = [self.folder(table, b, p) for p, batches in wanted.items() for b in batches]
            stored = T.StructType([f for f in full.fields if f.name not in named])
            reader = spark.read.schema(stored).option("basePath", f"{self.path}/{table}")
            return reader.parquet(*found).select(*full.names)
        by_batch: dict[int, list[int | None]] = {}
        for part, batches in wanted.items():
            for batch in batches:
                by_batch.setdefault(batch, []).append(part)
        frames = [
            spark.read.schema(full).parquet(self.folder(table, batch)).where(F.col(layout.column).isin(some))
            for batch, some in by_batch.items()
        ]
        return reduce(DataFrame.unionByName, frames)

    def _with(self, table: str, parts: Collection[int | None], batch_id: int, *, add: bool) -> "Snapshot":
        held = dict(self.live.get(table, {}))
        for part in parts:
            held[part] = (*(held.get(part, ()) if add else ()), batch_id)
        return replace(self, live=self.live | {table: held})

    def adding(self, table: str, parts: Collection[int | None], batch_id: int) -> "Snapshot":
        """These parts also hold what the batch wrote."""
        return self._with(table, parts, batch_id, add=True)

    def replacing(self, table: str, parts: Collection[int | None], batch_id: int) -> "Snapshot":
        """These parts hold what the batch wrote and nothing else."""
        return self._with(table, parts, batch_id, add=False)

    def without(self, table: str, parts: Collection[int | None]) -> "Snapshot":
        return replace(self, live=self.live | {table: {p: b for p, b in self.live.get(table, {}).items() if p not in parts}})


def _entries(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(name.partition("=")[2]) for name in subfolders(spark, f"{path}/_ledger") if name.startswith("entry="))


def snapshot(spark: SparkSession, path: str, layouts: dict[str, Layout], entry: int | None = None) -> Snapshot:
    """What the newest entry, or the given one, lists; nothing for a path without a ledger."""
    entries = _entries(spark, path)
    if not entries:
        return Snapshot(path, layouts=layouts)
    entry = entries[-1] if entry is None else entry
    live: dict[str, dict[int | None, tuple[int, ...]]] = {}
    newest = -1
    listed = spark.read.schema(_ENTRY).parquet(f"{path}/_ledger/entry={entry}").where("outcome is null")
    for row in listed.collect():  # parts of tables
        if row.table_name is None:
            newest = row.batch_id
        else:
            held = live.setdefault(row.table_name, {})
            held[row.part] = tuple(sorted((*held.get(row.part, ()), row.batch_id)))
    return Snapshot(path, entry, newest, layouts, live)


def commit(spark: SparkSession, after: Snapshot, batch_id: int, rows: dict[str, int]) -> Snapshot:
    """Make a snapshot the newest one; rows: how many rows the batch wrote to each table."""
    entry = after.entry + 1
    pending, target = f"{after.path}/_pending/{uuid.uuid4().hex}", f"{after.path}/_ledger/entry={entry}"
    listed: list[tuple] = [(None, None, batch_id, None, None)]
    listed += [(t, p, b, None, None) for t, parts in after.live.items() for p, batches in parts.items() for b in batches]
    listed += [(table, None, batch_id, n, "added") for table, n in rows.items()]
    spark.createDataFrame(listed, _ENTRY).coalesce(1).write.parquet(pending)
    if entry in _entries(spark, after.path) or not move(spark, pending, target):
        raise BrokenLedger(f"{target} is there already")
    return replace(after, entry=entry, batch_id=batch_id)


def note_refusal(spark: SparkSession, path: str, batch_id: int, reason: str) -> None:
    """Remember that a batch was refused; readers of the star don't look here."""
    row = spark.createDataFrame([(batch_id, None, None, "refused", reason)], _LOADS)
    row.coalesce(1).write.mode("overwrite").parquet(f"{path}/_refused/batch_id={batch_id}")


def load_ledger(spark: SparkSession, path: str) -> DataFrame:
    """Rows (batch_id, table_name, n_rows, outcome, reason): what each batch wrote, and why others were refused.

    A batch that was refused and later added under the same id shows as added only.
    """
    added = [f"{path}/_ledger/entry={n}" for n in _entries(spark, path)]
    refused = [f"{path}/_refused/{name}" for name in subfolders(spark, f"{path}/_refused")]
    done = spark.read.schema(_ENTRY).parquet(*added) if added else spark.createDataFrame([], _ENTRY)
    done = done.where("outcome is not null").select(
        "batch_id", "table_name", "n_rows", "outcome", F.lit(None).cast("string").alias("reason")
    )
    not_done = spark.read.schema(_LOADS).parquet(*refused) if refused else spark.createDataFrame([], _LOADS)
    return done.unionByName(not_done.join(done.select("batch_id").distinct(), "batch_id", "left_anti"))


def vacuum(spark: SparkSession, path: str, layouts: dict[str, Layout], keep: int = 2) -> list[str]:
    """Delete folders that none of the newest entries lists, and older entries; returns the folders deleted.

    Readers of the kept entries go on undisturbed. Not to be run beside a writer, whose folders aren't listed yet.
    """
    entries = _entries(spark, path)[-keep:]
    kept = {
        snap.folder(table, batch, part)
        for snap in (snapshot(spark, path, layouts, entry) for entry in entries)
        for table, parts in snap.live.items()
        for part, batches in parts.items()
        for batch in batches
    }
    gone = [f"{path}/_ledger/entry={n}" for n in _entries(spark, path)[:-keep]]
    for table, layout in layouts.items():
        for name in subfolders(spark, f"{path}/{table}"):
            here = f"{path}/{table}/{name}"
            found = [f"{here}/{sub}" for sub in subfolders(spark, here)] if layout.folders else [here]
            gone += [f for f in found if f not in kept]
    for folder in gone:
        discard(spark, folder)
    return gone
