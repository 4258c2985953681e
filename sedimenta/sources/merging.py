"""Merging the load folders of append tables into fewer and larger ones.

Every load leaves a folder in each month it has rows of. Those that all targets have taken over
are packed, in the order of their loads, into bins of a set size; the rows of a bin become one
folder under the bin's highest load number, which is not above what the targets have
taken, so no increment sees them again. The merged rows are written beside the table, counted
against the old ones, and take their place by a noted change: a merge that fails before leaves
the old folders, one that breaks off after is finished by whoever opens the warehouse next.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sedimenta.schemas import Table
from sedimenta.sources.files import Folder, data_folders
from sedimenta.sources.intents import Delete, Replace, carry_out
from sedimenta.sources.storage import Store

TARGET_BYTES = 256 << 20
#: Folders that a bin below the target size must have before it is worth merging.
LEAST = 8
#: Folders merged by one job.
AT_ONCE = 512


@dataclass(frozen=True)
class Bin:
    folders: tuple[Folder, ...]

    @property
    def top(self) -> Folder:
        return self.folders[-1]


def _load_of(folder: Folder) -> int:
    return int(folder.steps[-1].partition("=")[2])


def bins_of(folders: list[Folder], taken: int, target: int, least: int) -> list[Bin]:
    """Folders to merge, by month: neighbours in the order of loads, up to the target size.
    A folder of half that size or more stays as it is."""
    bins: list[Bin] = []
    by_month: dict[tuple[str, ...], list[Folder]] = {}
    for folder in folders:
        if _load_of(folder) <= taken and folder.size < target / 2:
            by_month.setdefault(folder.steps[:-1], []).append(folder)
    for month in sorted(by_month):
        waiting: list[Folder] = []
        for folder in [*sorted(by_month[month], key=_load_of), None]:
            full = sum(f.size for f in waiting) + (folder.size if folder else 0) > target
            if folder is None or full:
                if len(waiting) >= (2 if full else least):
                    bins.append(Bin(tuple(waiting)))
                waiting = []
            if folder is not None:
                waiting.append(folder)
    return bins


def _batches(bins: list[Bin]) -> list[list[Bin]]:
    batches: list[list[Bin]] = [[]]
    for one in bins:
        if batches[-1] and sum(len(b.folders) for b in batches[-1]) + len(one.folders) > AT_ONCE:
            batches.append([])
        batches[-1].append(one)
    return [batch for batch in batches if batch]


def merge_folders(
    store: Store, table: Table, taken: int, target: int = TARGET_BYTES, least: int = LEAST
) -> list[dict]:
    """Merge what can be merged; one entry per job: folders, bins, rows and the highest load."""
    levels = [c for c, _ in table.partition_by]
    if not levels or levels[-1] != "load_id":
        raise ValueError(f"{table.full_name} is not laid out by load")
    folders = data_folders(store.spark, store.location(table), len(levels))
    return [_merge(store, table, some) for some in _batches(bins_of(folders, taken, target, least))]


def _read(store: Store, table: Table, paths: list[str]) -> DataFrame:
    schema = store.read(table).schema
    reader = store.spark.read.schema(schema).option("basePath", store.location(table))
    return reader.parquet(*paths)


def _merge(store: Store, table: Table, bins: list[Bin]) -> dict:
    spark, mark = store.spark, uuid.uuid4().hex[:10]
    levels = [c for c, _ in table.partition_by]
    beside, aside = f"{store.root}/_merge-{mark}", f"{store.root}/_merged-{mark}"
    old = _read(store, table, [f.path for one in bins for f in one.folders])
    # the load number of every old folder's bin
    above = [
        (*[step.partition("=")[2] for step in f.steps[:-1]], _load_of(f), _load_of(one.top))
        for one in bins
        for f in one.folders
    ]
    ddl = ", ".join([*[f"{c} string" for c in levels[:-1]], "load_id bigint", "_top bigint"])
    tops = spark.createDataFrame(above, ddl).withColumns(
        {c: F.col(c).cast(t) for c, t in table.partition_by[:-1]}
    )
    rows = old.join(tops, levels).withColumn("load_id", F.col("_top")).drop("_top")
    gathered = rows.hint("rebalance", *levels)
    if table.sort_by:
        gathered = gathered.sortWithinPartitions(*levels, *table.sort_by)
    gathered.write.partitionBy(*levels).parquet(beside)
    n_old = old.count()
    n_new = spark.read.schema(old.schema).parquet(beside).count()
    if n_old != n_new:
        raise ArithmeticError(f"{table.full_name}: {n_old} rows became {n_new} when merged")
    tails = [(one.top.path, "/".join(one.top.steps)) for one in bins]
    replaced = [Replace(path, f"{beside}/{tail}", f"{aside}/{tail}") for path, tail in tails]
    gone = [f for one in bins for f in one.folders[:-1]]
    deleted = [Delete(f.path) for f in gone] + [Delete(beside), Delete(aside)]
    carry_out(spark, store.root, f"merge-{mark}", [*replaced, *deleted])
    store.forget_partitions(table, [f.steps for f in gone])
    return {
        "table_name": table.full_name,
        "load_id": max(_load_of(one.top) for one in bins),
        "folders": sum(len(one.folders) for one in bins),
        "bins": len(bins),
        "rows": n_new,
    }
