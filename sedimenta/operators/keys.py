"""Dense surrogate keys without a one-task window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sedimenta.session import stored


def dense_ids(
    rows: DataFrame,
    keys: Sequence[str],
    id_column: str,
    after: int | Column = 0,
    digits: int = 3,
    ties: Sequence[str] = (),
) -> DataFrame:
    """Number rows after+1, after+2, ... in the order of md5(keys).

    The keys must be unique, together with `ties`, and non-NULL. The leading digest digits split the
    rows into 16**digits even ranges whatever the keys look like; each range is
    numbered on its own and shifted by the sizes of the ranges before it. The
    numbering depends on the keys alone, so a lost executor's rows get the same
    numbers when they are computed again. The rows are stored once in the shared
    folder; their ranges are counted from the one narrow column of that copy.
    """
    spelled = [F.col(k).cast("string") for k in keys]
    text = spelled[0] if len(spelled) == 1 else F.concat_ws("\u0001", *spelled)
    ranged = rows.withColumn("_digest", F.md5(text)).withColumn(
        "_range", F.substring("_digest", 1, digits)
    )
    ranged = stored(ranged, "ranges")
    within = Window.partitionBy("_range").orderBy("_digest", *keys, *ties)
    numbered = ranged.withColumn("_position", F.row_number().over(within).cast("bigint"))

    # At most 16**digits rows: small enough for one window and for a broadcast.
    sizes = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select(
        "_range", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_shift")
    )
    start = F.lit(after) if isinstance(after, int) else after
    return (
        numbered.join(F.broadcast(shifts), "_range")
        .withColumn(id_column, (start + F.col("_shift") + F.col("_position")).cast("bigint"))
        .drop("_range", "_digest", "_position", "_shift")
    )


def highest(df: DataFrame, id_column: str) -> Column:
    """The largest id in use, 0 for an empty table, as a scalar subquery."""
    return df.agg(F.coalesce(F.max(id_column), F.lit(0)).cast("bigint").alias("top")).scalar()


def day_key(owner: str, day: str) -> Column:
    """owner id followed by yyyymmdd: unique per (owner, day) without any lookup."""
    date = F.col(day)
    digits = F.year(date) * 10000 + F.month(date) * 100 + F.dayofmonth(date)
    return (F.col(owner) * F.lit(100_000_000) + digits).cast("bigint")
