"""Registered queries of the operators: (spark, sf_dir) -> DataFrame, whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimenta.llm import bpe, chat, contamination, lines, lm, negatives, neardup, pages, pieces
from sedimenta.llm import quality, shards, urls, whitening
from sedimenta.llm.common import literal_rows, read_table, stored
from sedimenta.session import fresh_folder

URL_RULES = [
    {"host": "net", "path": "/", "verdict": "block"},
    {"host": "example.net", "path": "/en/", "verdict": "allow"},
    {"host": "example.com", "path": "/de/", "verdict": "block"},
    {"host": "org", "path": "/fr/", "verdict": "allow"},
]
SHARDS = 8


NEAR_WORDS = 2
QUALITY_THRESHOLD = 0.3


def op1_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = neardup.find(read_table(spark, sf_dir, "documents"), NEAR_WORDS)
    return found.select(
        "doc_id",
        "n_shingles",
        "component_id",
        (F.col("doc_id") == F.col("component_id")).alias("kept"),
    )


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    """Whether the checksum of the id falls in the fold; a null id does not."""
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % folds == fold, F.lit(False))


def label_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "labels").select("doc_id", "quality")


def with_labels(df: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = label_table(spark, sf_dir).withColumnRenamed("doc_id", "_id")
    return df.join(labels, F.col("doc_id") == F.col("_id")).drop("_id")


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = stored(
        quality.with_stats(documents).select(
            "doc_id", "stats", held_out(F.col("doc_id"), 5, 0).alias("held_out")
        ),
        "document-stats",
    )
    model = quality.fit(with_labels(rows.where(~F.col("held_out")), spark, sf_dir))
    return quality.score(rows, model).select(
        "doc_id",
        "held_out",
        "score",
        F.when(F.col("score") >= QUALITY_THRESHOLD, 1).otherwise(0).alias("predicted"),
    )


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    chain = lines.train(documents, label_table(spark, sf_dir))
    judged = F.col("lines")
    return lines.label_lines(documents, chain).select(
        "doc_id",
        *[judged[c].alias(c) for c in lines.COUNTS],
        lines.base_failed(judged).alias("base_failed"),
        lines.retained(judged).alias("kept"),
        F.size(judged["labels"]).cast("long").alias("n_lines"),
        judged["content_words"].alias("content_words"),
    )


def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = lm.fit(documents.where(~held_out(F.col("doc_id"), 7, 2)))
    return lm.score(documents, model).select(
        "doc_id",
        held_out(F.col("doc_id"), 7, 2).alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(model.n_tokens).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents")
    return contamination.find(documents, read_table(spark, sf_dir, "benchmark"))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = read_table(spark, sf_dir, "pages").select("page_id", "url")
    rules = literal_rows(spark, URL_RULES, "host string, path string, verdict string")
    judged = urls.judge(listed, rules)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pages.extract(read_table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return found.select("page_id", "url", "text", "n_chars")


def vocabulary(spark: SparkSession, path: str | None = None):
    return bpe.load_vocabulary(spark, path or public_tokenizers.path("word_bpe_49k.json"))


def token_digests(df: DataFrame, between: str = " ") -> DataFrame:
    """n_tokens and the digests of the columns ids and decoded."""
    return df.withColumns(
        {
            "n_tokens": F.size("ids").cast("long"),
            "ids_sha256": F.sha2(F.array_join(F.col("ids").cast("array<string>"), between), 256),
            "decoded_sha256": F.sha2(F.encode("decoded", "UTF-8"), 256),
        }
    )


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    shared = vocabulary(spark)
    coded = bpe.decode(bpe.encode(documents, shared), shared)
    return token_digests(coded).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


PLANTED_CHAT = [
    {"conv_id": -7, "turn": turn, "role": role, "text": "\\### Assistant: </turn> ok"}
    for turn, role in enumerate(("user", "assistant"))
]


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    ddl = "conv_id bigint, turn bigint, role string, text string"
    return chat.digests(chat.format_turns(turns.unionByName(literal_rows(spark, PLANTED_CHAT, ddl))))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shards of near-equal bytes; after_growth is the shard once there is one more."""
    documents = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    slotted = stored(
        shards.with_slots(documents, ["doc_id", "text"]).drop("text"), "slotted-documents"
    )
    totals = stored(shards.slot_totals(slotted), "slot-totals")
    sizes, _ = shards.read_totals(totals)
    folder = fresh_folder(spark, "slot-map")
    placed = shards.first_map(sizes, SHARDS)
    shards.store_map(spark, placed, folder, 1)
    shards.store_map(spark, shards.edited_map(placed, sizes, SHARDS + 1), folder, 2)
    grown = shards.load_map(spark, folder, 2).withColumnRenamed("shard", "after_growth")
    rows = shards.place(slotted, shards.load_map(spark, folder, 1), totals, ["doc_id", "text_crc32"])
    return rows.join(F.broadcast(grown), "virtual_slot").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "virtual_slot",
        "after_growth",
    )


def op11_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    shared = pieces.load_model(spark, public_tokenizers.path("piece_bpe_32k.model"))
    coded = pieces.decode(pieces.encode(documents, shared), shared)
    return token_digests(coded, ",").select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


COMPONENTS = 4


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    white = whitening.whiten(vectors, wanted=COMPONENTS)
    return white.select(
        "vec_id",
        "n",
        "deviation",
        "identity_error",
        F.posexplode(F.arrays_zip("whitened", "explained")).alias("place", "found"),
    ).select(
        "vec_id",
        (F.col("place") + 1).alias("component"),
        "n",
        "deviation",
        "found.whitened",
        "found.explained",
        "identity_error",
    )


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Anchors are the ids divisible by 100; ids divisible by 7 take the label after theirs."""
    vectors = read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(vectors.withColumn("label", moved), F.col("vec_id") % 100 == 0)


ALL = [
    op1_minhash_dedup,
    op2_quality_classifier,
    op3_quality_rules,
    op4_lm_scoring,
    op5_decontamination,
    op6_url_filter,
    op7_html_extraction,
    op8_chat_format,
    op9_bpe,
    op10_sharding,
    op11_sentencepiece,
    op12_embedding_whitening,
    op13_hard_negatives,
]
