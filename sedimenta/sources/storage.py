"""Stored tables: create, list, drop, write by name, stage and publish."""

from __future__ import annotations

import hashlib
from contextlib import contextmanager
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from sedimenta.schemas import TABLES, Table
from sedimenta.session import shared_folder
from sedimenta.sources.files import delete_path, hadoop_path, list_names, make_folder, path_exists
from sedimenta.sources.intents import Delete, Replace, carry_out

_OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"


@contextmanager
def _overwriting(spark: SparkSession, mode: str):
    before = spark.conf.get(_OVERWRITE_MODE)
    spark.conf.set(_OVERWRITE_MODE, mode)
    try:
        yield
    finally:
        spark.conf.set(_OVERWRITE_MODE, before)


@dataclass(frozen=True)
class Load:
    """One load of one step. `opened` is the time at which its input was fixed, which
    tells its scratch files from those of an earlier warehouse at the same root."""

    load_id: int
    opened: str = ""


@dataclass(frozen=True)
class Store:
    """The tables of one warehouse under one root folder.

    `prefix` goes before the database names, so that several warehouses can
    share a catalog.
    """

    spark: SparkSession
    root: str
    prefix: str = ""

    def database(self, layer: str) -> str:
        return f"{self.prefix}{layer}"

    def name(self, table: Table) -> str:
        return f"{self.database(table.layer)}.{table.name}"

    def location(self, table: Table) -> str:
        return f"{self.root}/{table.layer}/{table.name}"

    def create_tables(self, tables: Iterable[Table] = TABLES) -> None:
        """Create what is absent. Files already under the root are taken over, so
        a new session without a shared catalog sees the stored rows again."""
        for table in tables:
            layer = self.database(table.layer)
            folder = f"{self.root}/{table.layer}"
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer} LOCATION '{folder}'")
            if self.exists(table):
                continue
            columns = ", ".join(f"{c} {dtype}" for c, dtype in table.all_columns)
            parts = ", ".join(c for c, _ in table.partition_by)
            self.spark.sql(
                f"CREATE TABLE {self.name(table)} ({columns}) USING parquet"
                + (f" PARTITIONED BY ({parts})" if parts else "")
                + f" LOCATION '{self.location(table)}'"
            )
            if parts and path_exists(self.spark, self.location(table)):
                self.spark.sql(f"ALTER TABLE {self.name(table)} RECOVER PARTITIONS")

    def exists(self, table: Table) -> bool:
        return self.spark.catalog.tableExists(self.name(table))

    def has_files(self, table: Table) -> bool:
        """Whether anything has been written; hidden names do not count."""
        names = list_names(self.spark, self.location(table))
        return any(not name.startswith(("_", ".")) for name in names)

    def list_tables(self, layer: str) -> list[str]:
        return sorted(t.name for t in self.spark.catalog.listTables(self.database(layer)))

    def drop_tables(self, tables: Iterable[Table], delete_files: bool = False) -> None:
        for table in tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.name(table)}")
            if delete_files:
                delete_path(self.spark, self.location(table))

    def replace_with(self, other: Store, name: str, tables: Iterable[Table] = TABLES) -> None:
        """Put the other store's tables in the place of this one's.

        Folders are moved, old ones aside first; these are deleted last. The moves are noted
        before the first one, so that a break in between is finished by the next opening.
        """
        tables = list(tables)
        aside = f"{other.root}-before"
        for table in tables:
            for store in (self, other):
                self.spark.sql(f"DROP TABLE IF EXISTS {store.name(table)}")
        steps = [
            Replace(self.location(t), other.location(t), f"{aside}/{t.layer}/{t.name}")
            for t in tables
        ]
        carry_out(self.spark, self.root, name, [*steps, Delete(aside), Delete(other.root)])
        self.create_tables(tables)
        for table in tables:
            self.spark.catalog.refreshTable(self.name(table))
        for layer in {table.layer for table in tables}:
            self.spark.sql(f"DROP DATABASE IF EXISTS {other.database(layer)}")

    def recover(self, tables: Iterable[Table] = TABLES) -> None:
        """Make the catalog agree with the folders."""
        for table in tables:
            if table.partition_by:
                make_folder(self.spark, self.location(table))
                self.spark.sql(f"MSCK REPAIR TABLE {self.name(table)} SYNC PARTITIONS")
            self.spark.catalog.refreshTable(self.name(table))

    def forget_partitions(self, table: Table, partitions: Iterable[tuple[str, ...]]) -> None:
        """Drop partitions, given by their folder names, from the catalog."""
        for steps in partitions:
            spec = ", ".join("{}='{}'".format(*step.split("=", 1)) for step in steps)
            self.spark.sql(f"ALTER TABLE {self.name(table)} DROP IF EXISTS PARTITION ({spec})")
        self.spark.catalog.refreshTable(self.name(table))

    def read(self, table: Table) -> DataFrame:
        return self.spark.table(self.name(table))

    def count(self, table: Table) -> int:
        return self.read(table).count()

    def _insert(self, table: Table, rows: DataFrame, verb: str, mode: str = "static") -> None:
        columns = ", ".join(c for c, _ in table.all_columns)
        session = rows.sparkSession
        with _overwriting(session, mode):
            session.sql(
                f"INSERT {verb} {self.name(table)} BY NAME SELECT {columns} FROM {{rows}}",
                rows=rows,
            )

    def append(self, table: Table, rows: DataFrame) -> None:
        self._insert(table, rows, "INTO")

    def overwrite(self, table: Table, rows: DataFrame) -> None:
        self._insert(table, rows, "OVERWRITE")

    def overwrite_partitions(self, table: Table, rows: DataFrame) -> None:
        """Replace only the partitions that occur in the rows."""
        self._insert(table, rows, "OVERWRITE", "dynamic")

    def write_load(
        self,
        table: Table,
        rows: DataFrame,
        load_id: int,
        many_months: bool = False,
        **measures: Column,
    ) -> dict:
        """Append as the rows of one load; returns what was observed while writing.

        The load is a partition. What a failed attempt under its number has left,
        in whatever months, is removed first. `many_months` (a backfill) first
        gathers each month's rows; REBALANCE splits a month that is larger than a
        good file.
        """
        self.clear_load(table, load_id)
        placed = rows.withColumn("load_id", F.lit(load_id).cast("bigint"))
        if many_months and "p_month" in dict(table.partition_by):
            placed = placed.hint("rebalance", "p_month")
        observed, placed = observe(placed, **measures)
        if table.sort_by:
            levels = [c for c, _ in table.partition_by]
            placed = placed.sortWithinPartitions(*levels, *table.sort_by)
        self.overwrite_partitions(table, placed)
        return observed.get

    def clear_load(self, table: Table, load_id: int) -> None:
        """Remove all folders of a load that was not committed."""
        levels = [c for c, _ in table.partition_by]
        pattern = "/".join(f"load_id={load_id}" if c == "load_id" else f"{c}=*" for c in levels)
        files, folders = hadoop_path(self.spark, f"{self.location(table)}/{pattern}")
        left = [status.getPath() for status in files.globStatus(folders) or ()]
        for folder in left:
            files.delete(folder, True)
        if left:
            steps = [tuple(folder.toString().split("/")[-len(levels) :]) for folder in left]
            self.forget_partitions(table, steps)

    def stage(
        self, name: str, rows: DataFrame, load: Load, **measures: Column
    ) -> tuple[DataFrame, dict]:
        """Write rows once to the shared scratch folder and read them from there;
        also returns what was observed while writing.

        The written copy cuts the lineage, so a target can be overwritten from
        it. A complete copy left by a failed attempt of the same load is used as
        it is, because that attempt may have left the target half replaced.
        """
        path = f"{self._staging(load)}/{name}"
        staged = self.spark.read.schema(rows.schema)
        if path_exists(self.spark, f"{path}/_SUCCESS"):
            copy = staged.parquet(path)
            seen, watched = observe(copy, **measures)
            watched.write.format("noop").mode("overwrite").save()
            return copy, seen.get
        seen, watched = observe(rows, **measures)
        watched.write.mode("overwrite").parquet(path)
        return staged.parquet(path), seen.get

    def unstage(self, load: Load) -> None:
        delete_path(self.spark, self._staging(load))

    def _staging(self, load: Load) -> str:
        owner = hashlib.md5(f"{self.root} {load.opened}".encode()).hexdigest()[:16]
        return f"{shared_folder(self.spark)}/sedimenta/staging-{owner}/{load.load_id}"


def observe(df: DataFrame, **measures: Column) -> tuple[Observation, DataFrame]:
    """Counts rows, and the given aggregates, while the DataFrame is written."""
    seen = Observation()
    row_count = F.count(F.lit(1)).alias("row_count")
    return seen, df.observe(seen, row_count, *[c.alias(n) for n, c in measures.items()])
