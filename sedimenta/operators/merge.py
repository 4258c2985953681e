"""Keyed writes as DataFrames: upsert, insert-if-absent, change counts, NOT IN."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sedimenta.operators.keys import dense_ids, highest

INSERTED, UPDATED, KEPT = "I", "U", "K"


def differs(new: Column, old: Column, null_safe: bool = True) -> Column:
    """IS DISTINCT FROM, or the plain != that is never true against NULL."""
    return ~new.eqNullSafe(old) if null_safe else F.coalesce(new != old, F.lit(False))


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update: Sequence[str],
    insert_only: Sequence[str] = (),
    null_safe: bool = True,
    keep_old_for_null: bool = False,
    whole: bool = True,
) -> DataFrame:
    """The target after `source` is merged in, each row tagged `_op` I, U or K.

    `source` holds one row per key. `update` columns take the new value on a
    conflict where any of them differs; with `keep_old_for_null` a NULL never
    replaces or counts as a difference. `insert_only` columns keep the value of
    the first insert. Other target columns are NULL for inserted rows. With
    `whole=False` only the rows whose key is in the source come out, which spares
    a large target that seldom changes.
    Both sides are unique per key, so the join has no hot key.
    """

    def new(c: str) -> Column:
        return F.col(f"s.{c}")

    def old(c: str) -> Column:
        return F.col(f"t.{c}")

    def changed(c: str) -> Column:
        test = differs(new(c), old(c), null_safe)
        return new(c).isNotNull() & test if keep_old_for_null else test

    taken = source.select(*keys, *update, *insert_only, F.lit(True).alias("_in_source"))
    held = target.withColumn("_in_target", F.lit(True))
    how = "full_outer" if whole else "right_outer"
    joined = held.alias("t").join(taken.alias("s"), list(keys), how)

    is_new = F.col("_in_target").isNull()
    any_change = reduce(lambda a, b: a | b, [changed(c) for c in update], F.lit(False))
    op = (
        F.when(is_new, INSERTED)
        .when(F.col("_in_source").isNotNull() & any_change, UPDATED)
        .otherwise(KEPT)
    )

    def merged(c: str) -> Column:
        if c in keys:
            return F.col(c)
        if c in update:
            replacing = F.coalesce(new(c), old(c)) if keep_old_for_null else new(c)
            return F.when(op == KEPT, old(c)).otherwise(replacing).alias(c)
        if c in insert_only:
            return F.when(is_new, new(c)).otherwise(old(c)).alias(c)
        return old(c)

    return joined.select(*[merged(c) for c in target.columns], op.alias("_op"))


def number_inserts(
    merged: DataFrame, id_column: str, keys: Sequence[str], start: Column
) -> DataFrame:
    """Surrogate keys for the inserted rows, after `start`."""
    fresh = merged.where(F.col("_op") == INSERTED).drop(id_column)
    rest = merged.where(F.col("_op") != INSERTED)
    return rest.unionByName(dense_ids(fresh, keys, id_column, after=start))


def upsert_with_ids(
    target: DataFrame, source: DataFrame, keys: Sequence[str], id_column: str, **options
) -> DataFrame:
    merged = upsert(target, source, keys, **options)
    return number_inserts(merged, id_column, keys, highest(target, id_column))


def apply_changes(target: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The target with the changed rows in place of its own."""
    columns = target.columns
    kept = target.join(changes.select(*keys), list(keys), "left_anti").select(*columns)
    return kept.unionByName(changes.select(*columns))


def touched_rows(merged: DataFrame) -> DataFrame:
    """Only what the merge wrote; unchanged conflicts are not returned."""
    return merged.where(F.col("_op").isin(INSERTED, UPDATED))


def op_measures() -> dict[str, Column]:
    return {
        "inserted": F.count_if(F.col("_op") == INSERTED),
        "updated": F.count_if(F.col("_op") == UPDATED),
    }


def op_counts(merged: DataFrame) -> DataFrame:
    return merged.agg(*[c.alias(name) for name, c in op_measures().items()])


def insert_if_absent(
    target: DataFrame, source: DataFrame, key: str, id_column: str
) -> DataFrame:
    """New distinct keys with their ids; existing rows are never touched."""
    missing = absent_keys(target, source, key)
    return dense_ids(missing, [key], id_column, after=highest(target, id_column))


def absent_keys(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """The distinct keys of the source that the target does not have."""
    keys = source.select(key).where(F.col(key).isNotNull()).distinct()
    return keys.join(target.select(key), key, "left_anti")


def not_in(df: DataFrame, column: str, listing: DataFrame, listed: str) -> DataFrame:
    """SQL `column NOT IN (SELECT listed ...)` with its NULL rules, by a hash anti
    join that shuffles; Spark's own NOT IN has to broadcast the whole list.

    A NULL in the list leaves no row; a NULL column passes an empty list only.
    """
    facts = listing.agg(
        F.struct(
            F.count(F.lit(1)).alias("size"),
            F.count_if(F.col(listed).isNull()).alias("nulls"),
        ).alias("facts")
    ).scalar()
    members = listing.select(F.col(listed).alias("_member")).distinct()
    absent = df.join(members, F.col(column) == F.col("_member"), "left_anti")
    passes = (facts["size"] == 0) | ((facts["nulls"] == 0) & F.col(column).isNotNull())
    return absent.where(passes)
