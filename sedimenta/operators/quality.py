"""Constraint checks and profiles over whole tables."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sedimenta.schemas import Table


def unique_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row. Counts map-side, so a hot key is cheap.
    As in SQL, a key with a NULL part violates nothing."""
    whole = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    counted = df.where(whole).groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))
    return counted.where("copies > 1")


def orphan_rows(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Rows whose non-NULL reference is missing from the parent.

    The distinct references are checked, not the rows: a reference that a third
    of all rows share travels once. The rows are then matched with the few
    missing references.
    """
    used = child.where(F.col(column).isNotNull()).select(column).distinct()
    known = parent.select(F.col(parent_column).alias(column)).distinct()
    missing = used.join(known, column, "left_anti")
    return child.join(missing, column, "left_semi").select(*child.columns)


def missing_required(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with a NULL in a required column, named in `missing_columns`."""
    names = F.concat_ws(",", *[F.when(F.col(c).isNull(), F.lit(c)) for c in columns])
    return df.withColumn("missing_columns", names).where(F.col("missing_columns") != "")


def too_large(column: str, dtype: str) -> Column:
    """A text too long, or a DOUBLE that rounds to more than the type holds. Plain
    comparisons: on wide tables, checked casts make code too long to be compiled."""
    text = re.fullmatch(r"varchar\((\d+)\)", dtype)
    if text:
        return F.length(column) > int(text.group(1))
    if dtype == "bigint":
        return F.abs(column) >= float(2**63)
    precision, scale = map(int, re.fullmatch(r"decimal\((\d+),(\d+)\)", dtype).groups())
    limit = Decimal(10) ** (precision - scale) - Decimal(5) / Decimal(10) ** (scale + 1)
    return F.abs(column) >= float(limit)


def _overflows(column: str, dtype: str) -> Column:
    text = re.fullmatch(r"varchar\((\d+)\)", dtype)
    if text:
        return F.length(column) > int(text.group(1))
    return F.col(column).isNotNull() & F.col(column).try_cast(dtype).isNull()


def overflowing(types: Mapping[str, str]) -> Column:
    """Comma-separated names of the columns that do not fit, '' when all do."""
    return F.concat_ws(
        ",", *[F.when(_overflows(c, dtype), F.lit(c)) for c, dtype in types.items()]
    )


def overflow_rows(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Rows that do not fit the declared types, named in `overflow_columns`."""
    return df.withColumn("overflow_columns", overflowing(types)).where(
        F.col("overflow_columns") != ""
    )


def profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Row count, NULL count and rate, lowest and highest value per numeric column.

    One pass over the table, whatever the number of columns; the single result
    row is then turned into one row per column.
    """
    measured = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.count(F.lit(1)).alias("row_count"),
            F.count_if(F.col(c).isNull()).alias("null_count"),
            F.min(c).cast("double").alias("min_value"),
            F.max(c).cast("double").alias("max_value"),
        )
        for c in columns
    ]
    one = df.agg(F.array(*measured).alias("columns"))
    rate = F.when(F.col("row_count") > 0, F.col("null_count") / F.col("row_count"))
    return one.select(F.inline("columns")).withColumn("null_rate", F.round(rate, 6))


def profile_measures(columns: Sequence[str]) -> dict[str, Column]:
    """The aggregates of a profile, to be observed while a table is written: with row_count,
    NULLs, lowest and highest value of every column, and a sketch of its distinct values."""
    measures = {}
    for k, c in enumerate(columns):
        measures[f"nulls_{k}"] = F.count_if(F.col(c).isNull())
        measures[f"low_{k}"] = F.min(c).cast("double")
        measures[f"high_{k}"] = F.max(c).cast("double")
        measures[f"sketch_{k}"] = F.hll_sketch_agg(F.col(c).cast("string"), F.lit(SKETCH_BITS))
    return measures


#: log2 of a sketch's buckets: estimates are within 3 standard errors of 1.04 / sqrt(2^12), 4.9 %.
SKETCH_BITS = 12


def profile_rows(seen: Mapping[str, object], columns: Sequence[str]) -> list[dict]:
    """What profile_measures() has observed, one row per column."""
    total = seen["row_count"]
    return [
        {
            "column_name": c,
            "row_count": total,
            "null_count": seen[f"nulls_{k}"],
            "null_rate": round(seen[f"nulls_{k}"] / total, 6) if total else None,
            "min_value": seen[f"low_{k}"],
            "max_value": seen[f"high_{k}"],
            "distinct_sketch": seen[f"sketch_{k}"] if total else None,
        }
        for k, c in enumerate(columns)
    ]


def merged_profiles(profiles: DataFrame) -> DataFrame:
    """The profile of a whole table from those of its loads, without reading the table."""
    merged = profiles.groupBy("table_name", "column_name").agg(
        F.sum("row_count").alias("row_count"),
        F.sum("null_count").alias("null_count"),
        F.min("min_value").alias("min_value"),
        F.max("max_value").alias("max_value"),
        F.hll_sketch_estimate(F.hll_union_agg("distinct_sketch", F.lit(True))).alias(
            "distinct_estimate"
        ),
    )
    rate = F.when(F.col("row_count") > 0, F.col("null_count") / F.col("row_count"))
    return merged.withColumn("null_rate", F.round(rate, 6))


def check_table(df: DataFrame, table: Table, parents: Mapping[str, DataFrame]) -> DataFrame:
    """Violations per declared constraint: (table_name, constraint_name, violations)."""

    def counted(rows: DataFrame, name: str) -> DataFrame:
        return rows.agg(F.count(F.lit(1)).alias("violations")).select(
            F.lit(table.full_name).alias("table_name"),
            F.lit(name).alias("constraint_name"),
            "violations",
        )

    checks = [
        counted(unique_violations(df, keys), f"unique({', '.join(keys)})")
        for keys in table.unique
    ]
    if table.required:
        # One pass for all of them.
        missing = [
            F.struct(
                F.lit(table.full_name).alias("table_name"),
                F.lit(f"not null({c})").alias("constraint_name"),
                F.count_if(F.col(c).isNull()).alias("violations"),
            )
            for c in table.required
        ]
        checks.append(df.agg(F.array(*missing).alias("found")).select(F.inline("found")))
    checks += [
        counted(
            orphan_rows(df, r.column, parents[r.table], r.table_column),
            f"references({r.column})",
        )
        for r in table.references
    ]
    return reduce(DataFrame.unionByName, checks)
