"""Quality classifier: a Gaussian kernel over document statistics, in random Fourier features.

Statistics of a text are standardised and mapped to cosines of random projections, whose
inner products approximate a Gaussian kernel. Every partition sums its share of the normal
equations; the sums are added up by row of the matrix, and the driver solves one system of
FEATURES unknowns. The ridge scores become probabilities by isotonic regression over BINS
bins of scores, so nothing that grows with the data reaches the driver. All labelled rows
are used.

Defined results: a null, empty or blank text has zero statistics and is scored like any other;
labels other than 0 and 1, null ones included, are left out. With no labelled rows every score is
0.5. A result column replaces an input column
of its name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sedimenta.llm.common import in_use, ship_package
from sedimenta.llm.stats import DOCUMENT_STATS, document_stats

FEATURES = 256
BINS = 400
RIDGE = 1e-3
WIDTH = 4.0  # of the kernel, in standard deviations
SEED = 20240607
ORDER = 0.01  # share of the ridge score in a score, so that equal probabilities keep their order
_LOW, _HIGH = -0.5, 1.5  # ridge scores are held within


@dataclass(frozen=True)
class Model:
    mean: np.ndarray
    scale: np.ndarray
    ridge: np.ndarray
    knots: np.ndarray  # rising ridge scores, one per bin
    heights: np.ndarray  # their probabilities, never falling

    def raw(self, stats: np.ndarray) -> np.ndarray:
        """Ridge scores of rows of statistics."""
        return np.clip(fourier(stats, self.mean, self.scale) @ self.ridge, _LOW, _HIGH)

    def score(self, stats: np.ndarray) -> np.ndarray:
        if not len(self.knots):
            return np.full(len(stats), 0.5)
        raw = self.raw(stats)
        rising = (raw - _LOW) / (_HIGH - _LOW)
        return (1 - ORDER) * np.interp(raw, self.knots, self.heights) + ORDER * rising


def projections() -> tuple[np.ndarray, np.ndarray]:
    """The same random directions and phases in every process."""
    random = np.random.RandomState(SEED)
    directions = random.normal(0, 1 / WIDTH, (DOCUMENT_STATS, FEATURES))
    return directions, random.uniform(0, 2 * np.pi, FEATURES)


def fourier(stats: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Rows of FEATURES cosines and a constant."""
    directions, phases = projections()
    x = np.clip((stats - mean) / scale, -5, 5)
    z = np.sqrt(2 / FEATURES) * np.cos(x @ directions + phases)
    return np.hstack([z, np.ones((len(x), 1))])


def with_stats(df: DataFrame, text: str = "text", into: str = "stats") -> DataFrame:
    """Adds the statistics of every whole text."""
    ship_package(df.sparkSession)

    @F.arrow_udf("array<double>")
    def stats(texts: pa.Array) -> pa.Array:
        in_use()
        rows = [document_stats((value.as_py() or "").encode()) for value in texts]
        return pa.array(rows, pa.list_(pa.float64()))

    return df.withColumn(into, stats(F.col(text)))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(-1, DOCUMENT_STATS)


def isotonic(counts: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """The share of ones of each bin after adjacent bins are pooled until it never falls."""
    blocks: list[list[float]] = []  # ones, rows, bins
    for n, k in zip(counts, ones):
        blocks.append([k, n, 1])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last)]
    return np.concatenate([np.full(int(bins), k / n) for k, n, bins in blocks])


def fit(labelled: DataFrame, label: str = "quality") -> Model:
    """Fits on all rows with statistics in `stats` and a label of 0 or 1."""
    ship_package(labelled.sparkSession)
    rows = labelled.where(F.col(label).isin(0, 1)).select(
        "stats", F.col(label).cast("double").alias("label")
    )
    columns = [F.col("stats")[k] for k in range(DOCUMENT_STATS)]
    moments = rows.agg(
        F.count(F.lit(1)), *[F.avg(c) for c in columns], *[F.stddev_pop(c) for c in columns]
    ).first()
    none = np.zeros(0)
    if not moments[0]:
        zeros = np.zeros(DOCUMENT_STATS)
        return Model(zeros, zeros + 1, np.zeros(FEATURES + 1), none, none)
    mean = np.array(moments[1 : DOCUMENT_STATS + 1], dtype=float)
    scale = np.array(moments[DOCUMENT_STATS + 1 :], dtype=float)
    scale[scale < 1e-9] = 1.0

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((FEATURES + 1, FEATURES + 2))
        for batch in batches:
            if batch.num_rows:
                z = fourier(_matrix(batch.column(0)), mean, scale)
                y = batch.column(1).to_numpy(zero_copy_only=False)
                total += z.T @ np.hstack([z, y[:, None]])
        if total.any():
            index = pa.array(range(len(total)), pa.int32())
            yield pa.RecordBatch.from_arrays([index, pa.array(list(total))], ["i", "row"])

    def added(table: pa.Table) -> pa.Table:
        rows = np.stack([np.asarray(r.as_py()) for r in table.column("row")])
        first = table.column("i")[0].as_py()
        return pa.table({"i": pa.array([first], pa.int32()), "row": [rows.sum(axis=0)]})

    schema = "i int, row array<double>"
    partial = rows.mapInArrow(sums, schema)
    summed = partial.groupBy("i").applyInArrow(added, schema).collect()
    system = np.zeros((FEATURES + 1, FEATURES + 2))
    for r in summed:
        system[r.i] = r.row
    left, right = system[:, :-1] / moments[0], system[:, -1] / moments[0]
    ridge = np.linalg.solve(left + RIDGE * np.eye(len(left)), right)
    model = Model(mean, scale, ridge, none, none)

    @F.arrow_udf("double")
    def raw(stats: pa.Array) -> pa.Array:
        return pa.array(model.raw(_matrix(stats)), pa.float64())

    at = F.col("raw")
    bins = (
        rows.withColumn("raw", raw("stats"))
        .groupBy(F.floor((at - _LOW) / (_HIGH - _LOW) * BINS).alias("bin"))
        .agg(F.avg("raw").alias("at"), F.count(F.lit(1)).alias("n"), F.sum("label").alias("ones"))
        .orderBy("bin")
        .collect()
    )
    at, n, ones = (np.array([b[c] for b in bins], float) for c in ("at", "n", "ones"))
    return Model(mean, scale, ridge, at, isotonic(n, ones))


def score(df: DataFrame, model: Model, stats: str = "stats", into: str = "score") -> DataFrame:
    """Adds the probability of label 1 to rows with statistics."""
    ship_package(df.sparkSession)

    @F.arrow_udf("double")
    def scored(rows: pa.Array) -> pa.Array:
        return pa.array(model.score(_matrix(rows)), pa.float64())

    return df.withColumn(into, scored(F.col(stats)))
