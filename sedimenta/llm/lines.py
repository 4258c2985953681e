"""Quality rules: lines labelled content or boilerplate by a conditional random field.

A linear-chain CRF reads the lines of a text that hold a word, in order. Its weights are
fitted by maximum likelihood on labelled documents: lines of good documents count as
content; which lines of a bad document are boilerplate is not known, only that some are, and
the field finds out by itself. Viterbi decoding gives the likeliest label
sequence of every whole text; the share of its words in content lines decides whether the
text is retained. Two base rules reject before that: fewer than 50 words, or more than half
of the words inside repeated 3-word windows.

Fitting takes a bounded sample, on the driver: the SAMPLE distinct texts per label with the
lowest text hash among those of at most SAMPLE_LINES lines and SAMPLE_BYTES bytes; copies
of a text count once. Labelling
covers every line of every text, one text at a time within a batch.

Defined results: a null, empty or blank text has no words, so the base rule rejects it. Without
labelled documents of both kinds every line is content. Repeated rows are judged alike.
The result is one struct column, which replaces an input column of its name.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sedimenta.llm.common import in_use, ship_package, stored
from sedimenta.llm.stats import LINE_FEATURES, base_counts, line_features, word_lines

SAMPLE = 600
SAMPLE_LINES = 400
SAMPLE_BYTES = 50_000
LEAST_WORDS = 50
LEAST_CONTENT = 0.5
_STEPS, _RATE, _DECAY = 150, 0.15, 1e-3
CONTENT = 1

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
RESULT = (
    "struct<n_words: bigint, word_chars: bigint, n_symbols: bigint, n_dup_lines: bigint,"
    " n_repeat_words: bigint, labels: array<tinyint>, content_words: bigint>"
)


@dataclass(frozen=True)
class Chain:
    """Weights of the field: of a line's features by label, and of neighbouring labels."""

    lines: np.ndarray  # features x 2
    steps: np.ndarray  # 2 x 2, from and to

    def viterbi(self, features: np.ndarray) -> list[int]:
        """The likeliest label sequence; content where two are equally likely."""
        (a, b), (c, d) = self.steps.tolist()
        scores = (features @ self.lines).tolist()
        bad, good = scores[0]
        back = []
        for e_bad, e_good in scores[1:]:
            to_bad = (bad + a, 0) if bad + a > good + c else (good + c, 1)
            to_good = (bad + b, 0) if bad + b > good + d else (good + d, 1)
            bad, good = to_bad[0] + e_bad, to_good[0] + e_good
            back.append((to_bad[1], to_good[1]))
        labels = [0 if bad > good else 1]
        for origin in reversed(back):
            labels.append(origin[labels[-1]])
        return labels[::-1]


def features_of(data: bytes) -> tuple[np.ndarray, list[bytes]]:
    lines = word_lines(data)
    seen: set[bytes] = set()
    rows = []
    for line in lines:
        rows.append(line_features(line, line in seen))
        seen.add(line)
    return np.array(rows, dtype=np.float64).reshape(-1, LINE_FEATURES), lines


def fit_chain(sequences: list[np.ndarray], labels: list[int]) -> Chain:
    """Maximum likelihood by gradient steps over all sequences at once; both labels weigh alike.

    All lines of a good document are content. Of a bad one only so much is known that not all are,
    so its target is the field's own expectation given that.
    """
    weights, steps = np.zeros((LINE_FEATURES, 2)), np.zeros((2, 2))
    if len(set(labels)) < 2:
        return Chain(weights, steps)
    longest = max(map(len, sequences))
    x = np.zeros((len(sequences), longest, LINE_FEATURES))
    mask = np.zeros((len(sequences), longest, 1))
    for k, rows in enumerate(sequences):
        x[k, : len(rows)], mask[k, : len(rows)] = rows, 1
    y = np.array(labels)
    share = np.bincount(y, minlength=2) / len(y)
    weight = (0.5 / share[y] / len(y))[:, None, None]
    bad = y == 0
    pairs = mask[:, 1:, 0] * mask[:, :-1, 0]
    sizes = mask.sum(1)[:, 0]
    per_line = weight / sizes[:, None, None]  # documents weigh alike, however long
    moment = [np.zeros_like(weights), np.zeros_like(steps)]
    spread = [np.zeros_like(weights), np.zeros_like(steps)]
    for step in range(1, _STEPS + 1):
        emit = x @ weights
        forward, backward = np.zeros_like(emit), np.zeros_like(emit)
        forward[:, 0] = emit[:, 0]
        for t in range(1, longest):
            arrive = np.logaddexp.reduce(forward[:, t - 1, :, None] + steps, axis=1) + emit[:, t]
            forward[:, t] = np.where(mask[:, t] > 0, arrive, forward[:, t - 1])
        total = np.logaddexp.reduce(forward[:, -1], axis=1)[:, None]
        for t in range(longest - 2, -1, -1):
            leave = np.logaddexp.reduce(steps + (emit + backward)[:, t + 1, None, :], axis=2)
            backward[:, t] = np.where(mask[:, t + 1] > 0, leave, 0)
        marginal = np.exp(forward + backward - total[:, None]) * mask
        joint = np.exp(
            forward[:, :-1, :, None]
            + steps
            + (emit + backward)[:, 1:, None, :]
            - total[:, None, None]
        ) * (pairs[:, :, None, None])
        # the share of sequences with a line of boilerplate, and expectations among these
        all_content = (emit[:, :, CONTENT] * mask[:, :, 0]).sum(1) + pairs.sum(1) * steps[1, 1]
        mixed = np.maximum(-np.expm1(np.minimum(all_content - total[:, 0], 0)), 1e-9)
        given = np.where(bad, 1 / mixed, 0)[:, None]
        gold, gold_joint = np.zeros_like(marginal), joint * given[:, :, None, None]
        gold[:, :, 0] = np.minimum(marginal[:, :, 0] * given, mask[:, :, 0])
        gold[:, :, CONTENT] = mask[:, :, 0] - gold[:, :, 0]
        gold_joint[:, :, 1, 1] = 0
        gold_joint[:, :, 1, 1] = np.maximum(pairs - gold_joint.sum((2, 3)), 0)
        gradients = [
            np.einsum("ntf,ntl->fl", x, (gold - marginal) * per_line) - _DECAY * weights,
            np.einsum("ntab,n->ab", gold_joint - joint, per_line[:, 0, 0]) - _DECAY * steps,
        ]
        for k, (value, gradient) in enumerate(zip((weights, steps), gradients)):
            moment[k] = 0.9 * moment[k] + 0.1 * gradient
            spread[k] = 0.999 * spread[k] + 0.001 * gradient**2
            scaled = moment[k] / (1 - 0.9**step)
            value += _RATE * scaled / (np.sqrt(spread[k] / (1 - 0.999**step)) + 1e-9)
    return Chain(weights, steps)


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> Chain:
    """Fits the field on the bounded sample of labelled documents described above.

    labels has the columns doc_id and quality. Ids and text hashes meet them, no texts: the
    texts of the sample are picked by their hashes in a scan of their own.
    """
    n_lines = F.size(F.split(F.col(text), "\n"))
    usable = (F.octet_length(text) <= SAMPLE_BYTES) & (n_lines <= SAMPLE_LINES)
    hashed = docs.where(usable).select(
        F.col(doc_id).alias("_id"), F.xxhash64(text).alias("_hash"), F.col(text).alias("_text")
    )
    known = labels.select(F.col("doc_id").alias("_of"), F.col("quality").alias("label"))
    met = hashed.select("_id", "_hash").join(known, F.col("_id") == F.col("_of"))
    hashes = stored(met.select("label", "_hash").distinct(), "label-hashes")
    chosen = []
    for value in (0, 1):
        lowest = hashes.where(F.col("label") == value).orderBy("_hash").limit(SAMPLE).collect()
        chosen.append({r["_hash"] for r in lowest})
    texts = hashed.where(F.col("_hash").isin(sorted(chosen[0] | chosen[1]))).select("_hash", "_text")
    sample, taken = [], set()
    for r in texts.distinct().orderBy("_hash", "_text").toLocalIterator():
        if r["_hash"] not in taken:  # of texts that share a hash the first
            taken.add(r["_hash"])
            rows = features_of(r["_text"].encode())[0]
            sample += [(rows, value) for value in (0, 1) if r["_hash"] in chosen[value] and len(rows)]
    return fit_chain([rows for rows, _ in sample], [value for _, value in sample])


def label_lines(
    df: DataFrame, chain: Chain, text: str = "text", into: str = "lines"
) -> DataFrame:
    """Adds a struct column: the base counts, the label of each line that holds a word
    (1 content, 0 boilerplate), and the number of words in content lines."""
    ship_package(df.sparkSession)

    @F.arrow_udf(RESULT)
    def labelled(texts: pa.Array) -> pa.Array:
        in_use()
        rows = []
        for value in texts:
            data = (value.as_py() or "").encode()
            counts = base_counts(data)
            labels, content = [], 0
            if counts[0]:
                x, lines = features_of(data)
                labels = chain.viterbi(x)
                content = sum(len(line.split()) for line, k in zip(lines, labels) if k == CONTENT)
            rows.append((*counts, labels, content))
        columns = list(zip(*rows)) or [()] * 7
        arrays = [pa.array(column, pa.int64()) for column in columns[:5]]
        arrays += [pa.array(columns[5], pa.list_(pa.int8())), pa.array(columns[6], pa.int64())]
        return pa.StructArray.from_arrays(arrays, [*COUNTS, "labels", "content_words"])

    return df.withColumn(into, labelled(F.col(text)))


def base_failed(lines: Column) -> Column:
    n = lines["n_words"]
    return (n < LEAST_WORDS) | (100 * lines["n_repeat_words"] > 50 * n)


def retained(lines: Column, least: float = LEAST_CONTENT) -> Column:
    """Passes the base rules, and enough of its words stand in content lines."""
    return ~base_failed(lines) & (lines["content_words"] >= least * lines["n_words"])
