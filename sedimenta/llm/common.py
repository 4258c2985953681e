"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import json
import os
import tempfile
import time
import zipfile

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimenta.session import fresh_folder

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
#: What separates words: the ASCII white space, as a class for Java's and DuckDB's patterns.
SPACE = r"[\x20\x09-\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, purpose: str, compression: str | None = None) -> DataFrame:
    """Written to the shared folder and read back: lineage ends here, and a lost
    executor costs no more than the steps that follow."""
    spark = df.sparkSession
    path = fresh_folder(spark, purpose)
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def literal_rows(spark: SparkSession, rows: list[dict], ddl: str) -> DataFrame:
    """A small table of the driver as one literal of the plan."""
    array = F.from_json(F.lit(json.dumps(rows)), f"array<struct<{ddl}>>")
    return spark.range(1).select(F.explode(array).alias("row")).select("row.*")


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Gives the Python workers of this application the package, wherever they run."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(prefix="package-"), "sedimenta.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(package)))
    context.addPyFile(archive)  # Spark copies it to every executor
    _shipped.add(context.applicationId)


#: Seconds after which a worker process lets go of tables that no batch has asked for.
IDLE_SECONDS = 10
_last_use: dict[int, tuple[float, dict]] = {}


def in_use(tables: dict | None = None) -> None:
    """Notes that a batch uses what its operator remembers in this worker process, and empties
    what batches of other operators have left there: workers outlive the operators."""
    now = time.monotonic()
    if tables is not None:
        _last_use[id(tables)] = now, tables
    idle = [
        key
        for key, (last, others) in _last_use.items()
        if others is not tables and now - last > IDLE_SECONDS
    ]
    for key in idle:
        _last_use.pop(key)[1].clear()
    if idle:
        give_back()


def give_back() -> None:
    """Returns to the system what this process has freed. Of the 900 MB of a worker that has coded
    texts, more than 300 stay with the allocators of Arrow and of C when the tables are emptied."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim is not None:
        trim(0)


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, all other characters as they are."""
    return F.translate(text, UPPER, LOWER)


def words_of(text: Column) -> Column:
    """The words of a text; none of a null or blank text."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")
