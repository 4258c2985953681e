"""Benchmark decontamination: which documents contain a test item.

An item is contained in a document when at least THRESHOLD of its distinct word shingles
occur there. The search keeps a MinHash sketch of every item: the shingles that are the
minima of FUNCTIONS universal hash functions. Each of them lies in a document that contains a
share c of the item with probability c, so the share of the minima that a document holds
estimates the containment, and, other than a resemblance of two sketches, does so however
long the document is. Items are partitioned by size: a document meets only the classes of
items that its number of shingles can hold THRESHOLD of. Pairs with an estimate of at least
CANDIDATE are verified on all shingles, as text.

With 64 functions an item contained to 0.8 is estimated below 0.5 once in about a hundred
million cases. The sketches are broadcast only while they have at most BROADCAST_ROWS rows
and are joined by shuffle beyond. Documents are split into shingles within their rows, so a
long or hot document adds no shuffle, and only hits of minima are grouped.

Defined results: a document or item without words holds and is contained in nothing; an item
with fewer words than a shingle is one shingle of all its words; null ids are ordinary
values; repeated documents and items give one row per pair of ids, with the largest
containment. DataFrame functions only; other columns are carried by `clean` and ignored by `find`.
"""

from __future__ import annotations

import random
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sedimenta.llm.common import ascii_lower, stored, words_of

WORDS = 5
THRESHOLD = 0.8
FUNCTIONS = 64
CANDIDATE = 0.5
BROADCAST_ROWS = 1_000_000
_PRIME = (1 << 31) - 1


def _windows(words: Column, width: int, form) -> Column:
    """One value per window of `width` words; null where there are fewer.

    The words are bound by an outer loop of one step: the optimizer may move an expression
    into the place of a column, and the inner loop would then split the text once per window.
    """

    def windows(bound: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(bound) - width + 1)
        each = F.transform(starts, lambda k: form(F.slice(bound, k, width)))
        return F.when(F.size(bound) >= width, each)

    return F.transform(F.array(words), windows)[0]


def _hash(window: Column) -> Column:
    return F.xxhash64(window)


def _text(window: Column) -> Column:
    return F.array_join(window, " ")


def _shingles(words: Column, widths: list[int], form) -> Column:
    """The distinct shingles of the given widths."""
    empty = F.array().cast("array<bigint>" if form is _hash else "array<string>")
    each = [F.coalesce(_windows(words, width, form), empty) for width in widths]
    return F.array_distinct(reduce(F.concat, each) if len(each) > 1 else each[0])


def _items(benchmark: DataFrame, item_id: str, text: str) -> DataFrame:
    """Distinct items: id, width, shingles as hashes and as text, n and the size class."""
    words = words_of(ascii_lower(F.col(text)))
    named = benchmark.select(F.col(item_id).alias("item_id"), words.alias("words")).distinct()
    named = named.where(F.size("words") > 0).withColumn(
        "width", F.least(F.size("words"), F.lit(WORDS))
    )
    forms = {}
    for name, form in (("hashes", _hash), ("texts", _text)):
        by_width = F.lit(None)
        for width in range(1, WORDS + 1):
            windows = _windows(F.col("words"), width, form)
            by_width = F.when(F.col("width") == width, windows).otherwise(by_width)
        forms[name] = F.array_distinct(by_width)
    return (
        named.withColumns(forms)
        .withColumn("n", F.size("texts"))
        .withColumn("size_class", F.floor(F.log2("n")).cast("int"))
        .withColumn("item", F.xxhash64("item_id", "words"))
    )


def _sketches(items: DataFrame) -> DataFrame:
    """item, size_class, shingle and weight: how many of the minima the shingle is."""
    draw = random.Random(5)
    x = F.pmod(F.col("shingle"), F.lit(_PRIME))
    minima = []
    for _ in range(FUNCTIONS):
        a, b = draw.randrange(1, _PRIME), draw.randrange(_PRIME)
        minima.append(F.min_by("shingle", (x * F.lit(a) + F.lit(b)) % F.lit(_PRIME)))
    return (
        items.select("item", "size_class", F.explode("hashes").alias("shingle"))
        .groupBy("item", "size_class")
        .agg(F.array(*minima).alias("minima"))
        .select("item", "size_class", F.explode("minima").alias("shingle"))
        .groupBy("item", "size_class", "shingle")
        .agg(F.count(F.lit(1)).alias("weight"))
    )


def find(
    documents: DataFrame,
    benchmark: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """doc_id, item_id, n_shared, n_item and containment of every pair that reaches THRESHOLD."""
    items = stored(_items(benchmark, item_id, item_text), "benchmark-items")
    sketches = stored(_sketches(items), "benchmark-sketches")
    shape = items.agg(F.collect_set("width"), F.count(F.lit(1))).first()  # at most WORDS widths
    widths = sorted(shape[0]) or [WORDS]
    few = sketches.count() <= BROADCAST_ROWS
    by_size = F.broadcast(sketches) if few else sketches

    whole = documents.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("_text"))
    words = words_of(ascii_lower(F.col("_text"))).alias("_words")
    rows = whole.select("doc_id", F.xxhash64("_text").alias("_row"), words).select(
        "doc_id", "_row", _shingles(F.col("_words"), widths, _hash).alias("_shingles")
    ).select(
        "doc_id",
        "_row",
        F.size("_shingles").alias("_n"),
        F.explode_outer("_shingles").alias("_shingle"),  # the inner form would filter by them first
    )
    least = F.lit(THRESHOLD) * F.pow(F.lit(2.0), F.col("size_class"))
    hits = rows.join(by_size, (F.col("_shingle") == F.col("shingle")) & (F.col("_n") >= least))
    candidates = (
        hits.groupBy("doc_id", "_row", "item")
        .agg(F.sum("weight").alias("_weight"))
        .where(F.col("_weight") >= CANDIDATE * FUNCTIONS)
        .select(F.col("doc_id").alias("_id"), F.col("_row").alias("_of"), "item")
    )
    candidates = stored(candidates, "leak-candidates")

    small = F.broadcast(items) if few else items
    pairs = whole.withColumn("_row", F.xxhash64("_text")).join(
        candidates.groupBy("_id", "_of").agg(F.collect_set("item").alias("_items")),
        F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_row") == F.col("_of")),
    )
    texts = _shingles(F.col("_words"), widths, _text)
    verified = (
        pairs.select("doc_id", words, "_items")
        .select("doc_id", texts.alias("_texts"), F.explode("_items").alias("item"))
        .join(small.select("item", "item_id", "texts", "n"), "item")
        .withColumn("n_shared", F.size(F.array_intersect("_texts", "texts")))
        .where(F.col("n_shared") >= F.lit(THRESHOLD) * F.col("n"))
    )
    best = F.struct(F.col("n_shared") / F.col("n"), "n_shared", "n")
    return verified.groupBy("doc_id", "item_id").agg(F.max(best).alias("_best")).select(
        "doc_id",
        "item_id",
        F.col("_best.n_shared").cast("long").alias("n_shared"),
        F.col("_best.n").cast("long").alias("n_item"),
        F.col("_best.col1").alias("containment"),
    )


def clean(documents: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", **names) -> DataFrame:
    """The documents that contain no test item, with all their columns.

    Documents are told apart by id: if one of several rows of an id contains an item, all go.
    """
    leaked = find(documents, benchmark, doc_id=doc_id, **names).select(
        F.col("doc_id").alias("_leaked")
    ).distinct()
    return documents.join(leaked, documents[doc_id].eqNullSafe(leaked["_leaked"]), "left_anti")
