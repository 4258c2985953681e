"""The newest row of each key.

Both forms cut every task's rows to one per key before the shuffle, so a key
that holds a third of all rows does not make a hot task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest_rows(df: DataFrame, keys: Sequence[str], newest_first: Sequence[str]) -> DataFrame:
    """Whole rows: row_number() = 1, which Spark plans as a group limit on both
    sides of the exchange. Give enough order columns to leave no tie."""
    order = [F.col(c).desc_nulls_last() for c in newest_first]
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")


def latest_values(
    df: DataFrame, keys: Sequence[str], values: Sequence[str], newest_first: Sequence[str]
) -> DataFrame:
    """A few columns of the newest row: an argmax aggregate, combined map-side."""
    newest = F.max_by(F.struct(*values), F.struct(*newest_first))
    return df.groupBy(*keys).agg(newest.alias("_newest")).select(*keys, "_newest.*")
