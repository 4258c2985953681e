"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(
    app: str = "sedimenta", cores: int | None = None, start_partitions: int = 8192, **conf: str
) -> SparkSession:
    """A session with the settings the library is tuned for.

    On a cluster, leave `cores` unset. Shuffles then start with
    `start_partitions`, which adaptive execution merges to the advisory size; it
    can merge but not split, so choose shuffled bytes / 256 MB for the largest
    increment (8,192 serve 2 TB).
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # The JVM does not compile methods above 8,000 bytes of code; wide
        # projections are faster in several short ones.
        "spark.sql.codegen.hugeMethodLimit": "8000",
        "spark.ui.enabled": "false",
    }
    builder = SparkSession.builder.appName(app)
    if cores is None:
        settings["spark.sql.shuffle.partitions"] = str(start_partitions)
    else:
        builder = builder.master(f"local[{cores}]")
        settings["spark.sql.shuffle.partitions"] = str(cores)
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach: spark.checkpoint.dir.

    A machine-local folder is used only in local mode with the setting absent.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = os.path.join(tempfile.gettempdir(), "sedimenta-checkpoints")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Written once to the shared folder and read from there: several steps can use the
    rows without computing them again, and a lost executor costs only the steps after."""
    spark = df.sparkSession
    path = fresh_folder(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh_folder(spark: SparkSession, purpose: str) -> str:
    return f"{shared_folder(spark)}/sedimenta/{purpose}-{uuid.uuid4().hex}"
