"""Hard negatives by pruned search for large inner products.

    entries    x = floor(256 * c) of every vector; a score is the integer product with the anchor
    classes    of the rows of one label and one x only the first few ids can ever be among the
               first few of an anchor; the others go before anything is compared
    blocks     rows are ordered by length, longest first, and dealt into blocks; anchors are dealt
               into groups; each pair of a block and a group is one unit of work
    buckets    inside a block, rows of like length form a bucket with one sorted list of
               coordinates of the unit vectors for every dimension
    pruning    a threshold on the score is a threshold on the angle: it bounds, for each of an
               anchor's largest coordinates, the values a partner can have there. The ranges
               are looked up in the sorted lists and intersected; a bucket whose longest row
               falls short is skipped whole
    exactness  the scores of all candidates that are left are computed and compared

The search runs twice: for the positives, whose threshold is the weakest of the best found so
far, and for the negatives of every positive, whose scores lie between a share of the positive's
and the positive's own. Both keep the first few per unit and merge them at the end.

Defined results: rows with a null label or an unusable vector (see whitening.with_entries and
of_one_length) take no part. Rows that agree in id, label and x count as one; anchors too. Rows
with the anchor's own id are not its others. A null id is no anchor and comes last among equal
scores. An anchor without another row of its label, or a positive without a row in its range,
gives no rows; positives of negative score have an empty range. An empty table gives no rows.
Vectors whose scores could pass 2^53 are refused.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sedimenta.llm import whitening
from sedimenta.llm.common import ship_package, stored

#: Rows of a block, anchors of a group, rows of a bucket, and how much shorter than its first
#: a row of a bucket may be.
BLOCK_ROWS = 16_384
GROUP_ANCHORS = 16_384
BUCKET_ROWS = 2_048
LIKE_LENGTH = 0.9
#: Coordinates of an anchor whose ranges are looked up.
FOCUS = 5
#: Anchors scored against a bucket at a time.
AT_ONCE = 512
#: What rounding may do to a cosine.
SLACK = 1e-9
LARGEST_SCORE = 2**53


# ---- one block of rows --------------------------------------------------------


class Bucket:
    """Rows of like length, with a sorted list of values and rows for every dimension."""

    def __init__(self, unit: np.ndarray, longest: float, start: int):
        self.start, self.longest, self.n = start, longest, len(unit)
        self.order = unit.argsort(axis=0, kind="stable").astype(np.int32)
        self.values = np.take_along_axis(unit, self.order, axis=0)

    def candidates(self, low: np.ndarray, high: np.ndarray, focus: np.ndarray) -> np.ndarray:
        """Rows whose value in each dimension of focus lies in its range."""
        times = np.zeros(self.n, np.int16)
        for f, lo, hi in zip(focus, low, high):
            listed = self.values[:, f]
            times[self.order[listed.searchsorted(lo) : listed.searchsorted(hi, "right"), f]] += 1
        return np.flatnonzero(times == len(focus))


def feasible(
    coordinates: np.ndarray, cosine: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Between which values a unit vector's coordinate lies if its cosine with a unit vector of
    the given coordinate is at least the given one."""
    own, wide = np.arccos(np.clip(coordinates, -1, 1)), np.arccos(np.clip(cosine, -1, 1))
    low = np.where(own + wide >= np.pi, -1.0, np.cos(own + wide))
    high = np.where(own <= wide, 1.0, np.cos(own - wide))
    return low - SLACK, high + SLACK


class Block:
    """Rows as columns of arrays, longest first, cut into buckets."""

    def __init__(self, x: np.ndarray, ids: np.ndarray, labels: np.ndarray):
        lengths = np.sqrt((x.astype(float) ** 2).sum(axis=1))
        self.order = np.lexsort((ids, -lengths))
        self.x, self.ids = x[self.order].astype(float), ids[self.order]
        self.labels, lengths = labels[self.order], lengths[self.order]
        unit = self.x / np.where(lengths == 0, 1, lengths)[:, None]
        self.longest = lengths[0] if len(x) else 0.0
        self.buckets, start = [], 0
        while start < len(x):
            like = int((-lengths).searchsorted(-LIKE_LENGTH * lengths[start], "right"))
            end = min(start + BUCKET_ROWS, max(like, start + 1))
            self.buckets.append(Bucket(unit[start:end], lengths[start], start))
            start = end


@dataclass
class Wanted:
    """Anchors and what is looked for: for each, some ranges of scores, and the first `keep`
    rows in each. A range that is not used has low > high."""

    x: np.ndarray
    ids: np.ndarray
    labels: np.ndarray
    low: np.ndarray  # anchors by ranges
    high: np.ndarray
    same_label: bool
    keep: int

    def __post_init__(self):
        self.x = self.x.astype(float)
        self.lengths = np.sqrt((self.x**2).sum(axis=1))
        self.unit = self.x / np.where(self.lengths == 0, 1, self.lengths)[:, None]
        n, k = min(FOCUS, self.x.shape[1]), self.x.shape[1]
        self.focus = np.argsort(-np.abs(self.unit), axis=1, kind="stable")[:, : n if k else 0]
        self.bound = np.where(self.low > self.high, np.inf, self.low)
        self.best: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}

    def offer(self, anchor: int, k: int, scores: np.ndarray, rows: np.ndarray, ids: np.ndarray):
        """Takes the first of what was kept and of new rows; highest score, then smallest id."""
        if (anchor, k) in self.best:
            before = self.best[anchor, k]
            scores, rows = np.append(before[0], scores), np.append(before[1], rows)
        first = np.lexsort((ids[rows], -scores))[: self.keep]
        self.best[anchor, k] = scores[first], rows[first]
        if len(first) == self.keep:
            self.bound[anchor, k] = max(self.bound[anchor, k], scores[first[-1]])


def search(block: Block, wanted: Wanted) -> int:
    """Fills wanted.best with rows of the block; returns how many scores it computed."""
    if len(block.ids) and wanted.lengths.max(initial=0.0) * block.longest >= LARGEST_SCORE:
        raise ValueError(f"scores of {LARGEST_SCORE} or more are not supported")
    verified = 0
    for bucket in block.buckets:
        least = wanted.bound.min(axis=1)  # of the ranges of an anchor
        reach = wanted.lengths * bucket.longest
        active = np.flatnonzero(least <= reach * (1 + SLACK))
        # without a positive threshold, or where no range cuts its list, all rows are candidates
        cosine = np.full(len(active), -1.0)
        bounded = (least[active] > 0) & (reach[active] > 0)
        cosine[bounded] = (least[active] / np.where(reach[active] > 0, reach[active], 1))[bounded]
        focus = wanted.focus[active]
        low, high = feasible(np.take_along_axis(wanted.unit[active], focus, axis=1), cosine[:, None])
        cuts = (low > bucket.values[0][focus]) | (high < bucket.values[-1][focus])
        cuts &= bounded[:, None]
        pruned = cuts.any(axis=1)
        rows = np.arange(bucket.start, bucket.start + bucket.n)
        whole = active[~pruned]
        for start in range(0, len(whole), AT_ONCE):
            some = whole[start : start + AT_ONCE]
            verified += _verify(block, wanted, some, rows)
        for k in np.flatnonzero(pruned):
            used = cuts[k]
            found = bucket.candidates(low[k][used], high[k][used], focus[k][used])
            if len(found):
                verified += _verify(block, wanted, active[k : k + 1], found + bucket.start)
    return verified


def _verify(block: Block, wanted: Wanted, anchors: np.ndarray, rows: np.ndarray) -> int:
    scores = wanted.x[anchors] @ block.x[rows].T  # whole numbers below 2^53: exact
    same = wanted.labels[anchors, None] == block.labels[rows]
    fits = (same if wanted.same_label else ~same) & (wanted.ids[anchors, None] != block.ids[rows])
    for k in range(wanted.low.shape[1]):
        inside = fits & (scores >= wanted.bound[anchors, k, None]) & (
            scores <= wanted.high[anchors, k, None]
        )
        if len(rows) > wanted.keep:  # what is below the last of the first few cannot matter
            kept = np.where(inside, scores, -np.inf)
            last = np.partition(kept, len(rows) - wanted.keep, axis=1)[:, -wanted.keep, None]
            inside &= scores >= last
        at, column = np.nonzero(inside)
        edges = np.flatnonzero(np.diff(at, prepend=-1, append=-1))
        for start, end in zip(edges, edges[1:]):
            hits = column[start:end]
            wanted.offer(anchors[at[start]], k, scores[at[start], hits], rows[hits], block.ids)
    return scores.size


# ---- all blocks and groups ----------------------------------------------------


_LAST_ID = np.iinfo(np.int64).max


def _ids(column: pa.ChunkedArray) -> np.ndarray:
    """Ids as sort keys; null comes last."""
    return column.fill_null(_LAST_ID).to_numpy()


def _grid(rows: DataFrame, anchors: DataFrame, same_label: bool, keep: int) -> DataFrame:
    """anchor_no, range_no, row_id, score: the first rows of every block for every range."""
    groups = anchors.agg(F.max("group")).first()[0] or 0
    blocks = rows.agg(F.max("block")).first()[0] or 0

    def work(block_rows: pa.Table, group_anchors: pa.Table) -> pa.Table:
        schema = pa.schema(
            [("anchor_no", pa.int64()), ("range_no", pa.int32()), ("row_id", pa.int64()), ("score", pa.int64())]
        )
        if not block_rows.num_rows or not group_anchors.num_rows:
            return schema.empty_table()
        n = block_rows.num_rows
        both = pa.concat_arrays(
            [*block_rows["label"].chunks, *group_anchors["label"].chunks]
        ).dictionary_encode()
        codes = both.indices.to_numpy()
        block = Block(whitening.matrix(block_rows["x"]), _ids(block_rows["vec_id"]), codes[:n])
        low, high = whitening.matrix(group_anchors["low"]), whitening.matrix(group_anchors["high"])
        ids = _ids(group_anchors["vec_id"])
        x = whitening.matrix(group_anchors["x"])
        wanted = Wanted(x, ids, codes[n:], low, high, same_label, keep)
        search(block, wanted)
        found = sorted(wanted.best)
        lengths = [len(wanted.best[key][1]) for key in found]
        if not found:
            return schema.empty_table()
        at = np.repeat([a for a, _ in found], lengths)
        rows_found = block.order[np.concatenate([wanted.best[key][1] for key in found])]
        return pa.table(
            {
                "anchor_no": group_anchors["anchor_no"].combine_chunks().take(pa.array(at)),
                "range_no": pa.array(np.repeat([k for _, k in found], lengths), pa.int32()),
                "row_id": block_rows["vec_id"].combine_chunks().take(pa.array(rows_found)),
                "score": np.concatenate([wanted.best[key][0] for key in found]).astype(np.int64),
            },
            schema,
        )

    left = rows.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups))))
    right = anchors.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks))))
    pairs = left.groupBy("block", "group").cogroup(right.groupBy("block", "group"))
    return pairs.applyInArrow(work, "anchor_no bigint, range_no int, row_id bigint, score bigint")


def _first(found: DataFrame, keep: int, keys: list[str]) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_last("row_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= keep)


def _dealt(df: DataFrame, size: int, number: str, *order: Column) -> DataFrame:
    """Stored, with a number from 0 for parts of about `size` rows in the given order."""
    parts = max(1, -(-df.count() // size))
    return stored(
        df.repartitionByRange(parts, *order).withColumn(number, F.spark_partition_id()), number
    )


def mine(
    df: DataFrame,
    is_anchor: Column,
    vector: str = "embedding",
    label: str = "label",
    positives: int = 5,
    negatives: int = 5,
    share: tuple[int, int] = (4, 5),
) -> DataFrame:
    """Rows anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    The positives of an anchor are its first other rows of the same label; the negatives of
    each are the first rows of other labels whose score is at least share[0] / share[1] of the
    positive's and at most the positive's.
    """
    ship_package(df.sparkSession)
    usable = df.where(F.col(label).isNotNull()).select(
        "vec_id", F.col(label).cast("string").alias("label"), vector, is_anchor.alias("is_anchor")
    )
    entries = whitening.of_one_length(whitening.with_entries(usable, vector))
    narrow = stored(entries.select("vec_id", "label", "x", "is_anchor"), "vectors")
    length = F.aggregate("x", F.lit(0.0), lambda s, c: s + c.cast("double") * c)
    # rows of one label and x tie with every anchor; its own id may be among them
    alike = Window.partitionBy("label", "x").orderBy(F.asc_nulls_last("vec_id"))
    classes = (
        narrow.select("vec_id", "label", "x", F.dense_rank().over(alike).alias("place"))
        .where(F.col("place") <= max(positives + 1, negatives))
        .dropDuplicates(["label", "x", "vec_id"])
        .drop("place")
    )
    rows = _dealt(
        stored(classes.withColumn("length", length), "classes"),
        BLOCK_ROWS, "block", F.desc("length"), F.col("vec_id"),
    ).drop("length")
    anchors = _dealt(
        stored(narrow.where("is_anchor").select("vec_id", "label", "x").distinct(), "anchors"),
        GROUP_ANCHORS, "group", F.col("vec_id"),
    )
    numbered = stored(anchors.withColumn("anchor_no", F.monotonically_increasing_id()), "numbered")

    every = {"low": F.array(F.lit(float("-inf"))), "high": F.array(F.lit(float("inf")))}
    near = _grid(rows, numbered.withColumns(every), True, positives)
    found = stored(_first(near, positives, ["anchor_no"]), "positives").select(
        "anchor_no",
        (F.col("rank") - 1).alias("range_no"),
        F.col("row_id").alias("positive_id"),
        F.col("score").alias("positive_score"),
    )
    # one range for each positive, in their order; those that are not there are empty
    scores = found.groupBy("anchor_no").agg(
        F.map_from_entries(F.collect_list(F.struct("range_no", "positive_score"))).alias("scores")
    )
    at = [F.try_element_at("scores", F.lit(k)) for k in range(positives)]
    # the least whole score that is not below the share
    up = [s * share[0] + (share[1] - 1) for s in at]
    least = [(s - F.pmod(s, F.lit(share[1]))) / share[1] for s in up]
    ranges = {
        "low": F.array(*[F.coalesce(s, F.lit(1.0)) for s in least]),
        "high": F.array(*[F.coalesce(s.cast("double"), F.lit(0.0)) for s in at]),
    }
    asked = stored(numbered.join(scores, "anchor_no").withColumns(ranges).drop("scores"), "ranges")
    far = _first(_grid(rows, asked, False, negatives), negatives, ["anchor_no", "range_no"])
    return (
        far.join(found, ["anchor_no", "range_no"])
        .join(numbered.select("anchor_no", F.col("vec_id").alias("anchor_id")), "anchor_no")
        .select(
            "anchor_id",
            "positive_id",
            "rank",
            F.col("row_id").alias("negative_id"),
            "positive_score",
            F.col("score").alias("negative_score"),
        )
    )
