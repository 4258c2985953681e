"""From raw documents to token ids, in five stages of whole-table operators.

Each stage works on all that its predecessor kept and returns the columns of documents; the
last one returns the coded documents. Columns that a stage needs for itself begin with an
underscore and never reach the result, so other columns may have any names.

    rules       drops texts that the base rules or the line labels reject
    classifier  drops texts whose probability of good quality is below 0.3
    dedup       keeps one document of each group of near duplicates (five words, 0.8)
    benchmark   drops documents that contain a test item
    tokens      codes the texts: doc_id, n_tokens, ids, and the digest of the decoded text

Null or empty texts fail the base rules. Documents of null id pass all stages like others. Both
models are fitted on the labelled documents among those at hand; without labels of both
kinds the line labels and the classifier reject nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimenta.llm import bpe, contamination, lines, neardup, quality
from sedimenta.llm import queries as Q
from sedimenta.llm.common import read_table, stored

SHINGLE_WORDS = 5


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    chain = lines.train(docs, Q.label_table(spark, sf_dir))
    judged = lines.label_lines(docs, chain, into="_lines")
    return judged.where(lines.retained(F.col("_lines"))).select(*docs.columns)


def classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = stored(
        quality.with_stats(docs.select("doc_id", "text")).select("doc_id", "stats"), "document-stats"
    )
    model = quality.fit(Q.with_labels(rows, spark, sf_dir).select("stats", "quality"))
    scored = quality.score(quality.with_stats(docs, into="_stats"), model, "_stats", "_score")
    return scored.where(F.col("_score") >= Q.QUALITY_THRESHOLD).select(*docs.columns)


def dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.dedupe(docs, SHINGLE_WORDS)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return contamination.clean(docs, read_table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    shared = Q.vocabulary(spark)
    coded = bpe.decode(bpe.encode(docs.select("doc_id", "text"), shared), shared)
    return Q.token_digests(coded).select("doc_id", "n_tokens", "ids", "decoded_sha256")


STAGES = [
    ("rules", rules),
    ("classifier", classifier),
    ("dedup", dedup),
    ("benchmark", benchmark),
    ("tokens", tokens),
]
ORACLE_SQL = None  # a trained field and a trained classifier decide


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over documents, each stored for the next."""
    docs = read_table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = stored(docs, f"pipeline-{name}")
    return docs
