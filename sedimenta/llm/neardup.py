"""Near duplicates by MinHash: universal minima, bands, verified links, components.

Texts of the same words form one class, and all further work is on classes, so exact
copies cost no comparison. The distinct word shingles of a class are hashed, FUNCTIONS
universal hash functions are minimised over them, and the minima are cut into BANDS bands
of ROWS. Classes that agree in a band share a bucket. Two sets with a similarity of 0.8 agree
in no band once in ten million cases, and differ in two fifths of their minima practically never.

Within a bucket no pairs are made wholesale. The first pass compares every member with one
pivot. Inside the join a comparison looks at three things: the sizes of the sets, the Hamming
distance of their parity sketches, and how many of SIGNED minima differ in four bits (the
signature). Every shingle flips one bit of the sketch, so the distance never exceeds the size of the
symmetric difference, which is a ninth of the two sizes together at a similarity of 0.8: sizes and
sketches lose no link. What passes is compared on the full sets. Where a
bucket's members then still belong to different components, PIVOTS pivots are drawn, MORE times
as many with each further pass, and compared with the members of other components only. Of two
members in different components one is outside the bucket's largest, so a bucket with no more
members outside than there are to be pivots takes just these, and is done. This ends when every
bucket is one component or done, so no link that could join two components is lost.

Defined results: a null, empty or blank text has an empty set and is linked with nothing, not
even its like. A text of fewer words than a shingle is one shingle. A null id is no number, so
the component takes the smallest of the others' ids; it is null if there is none. Rows that
repeat an id are told apart by their texts. Result columns replace columns of their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache, reduce
from operator import add

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sedimenta.llm.common import in_use, ship_package, stored
from sedimenta.llm.components import connected

BANDS, ROWS = 40, 5
FUNCTIONS = BANDS * ROWS
SIMILAR = 80  # per cent
SIGNED = 128  # minima of a signature
#: Minima that may differ in their last four bits before the full sets are not compared. At a
#: similarity of 0.8 the mean is 24 of 128 with a deviation of 4.4; 51 are six deviations off.
MOST_DIFFERENT = 51
#: Words of 64 bits of a parity sketch and of the signature behind it.
SKETCH, SIGNATURE = 16, SIGNED // 16
_PLANES = 4
PIVOTS, MORE = 8, 64
#: Members of a bucket that meet all its pivots in one task: at most 17 million comparisons of some
#: 50 ns where as many are pivots.
BUCKET_PART = 4096
_REMEMBERED = 400_000
_UPPER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_ODD = np.uint64(0x9E3779B97F4A7C15)


@lru_cache(1)
def _functions() -> tuple[np.ndarray, np.ndarray]:
    """Factors and offsets of the hash functions x -> high half of a*x + b, a odd."""
    random = np.random.RandomState(41)
    draw = random.randint(0, 1 << 32, (2, 2, FUNCTIONS), dtype=np.uint64)
    wide = draw[0] << np.uint64(32) | draw[1]
    return wide[0] | np.uint64(1), wide[1]


_words: dict[bytes, int] = {}


def _word_hashes(words: list[bytes]) -> np.ndarray:
    if len(_words) > _REMEMBERED:
        _words.clear()
    get = _words.get
    out = [get(word) for word in words]
    for k, known in enumerate(out):
        if known is None:
            out[k] = _words[words[k]] = xxhash.xxh3_64_intdigest(words[k])
    return np.array(out, dtype=np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _ODD
    x = (x ^ (x >> np.uint64(29))) * _ODD
    return x ^ (x >> np.uint64(32))


def words_in(data: bytes) -> list[bytes]:
    """The words of a text, A-Z lower-cased."""
    return data.translate(_UPPER).split()


def shingle_set(words: list[bytes], width: int) -> np.ndarray:
    """Sorted distinct hashes of the word shingles."""
    if not words:
        return np.zeros(0, np.uint64)
    hashes = _word_hashes(words)
    n = max(1, len(words) - width + 1)
    total = np.full(n, len(words) if len(words) < width else width, np.uint64)
    for k in range(min(width, len(words))):
        total = _mixed(total + hashes[k : k + n])
    return np.unique(total)


def minima(shingles: np.ndarray) -> np.ndarray:
    """The minimum of every hash function, as 32-bit integers."""
    factors, offsets = _functions()
    x = shingles & np.uint64(0xFFFFFFFF)
    low = np.full(FUNCTIONS, np.uint64(0xFFFFFFFFFFFFFFFF))
    for k in range(0, len(x), 256):
        block = np.multiply.outer(factors, x[k : k + 256])
        block += offsets[:, None]
        np.minimum(low, block.min(axis=1), out=low)
    return (low >> np.uint64(32)).astype(np.uint32)


def sketch(shingles: np.ndarray) -> np.ndarray:
    """The parity of the number of shingles that fall on each of 64 * SKETCH bits."""
    places = (_mixed(shingles) & np.uint64(64 * SKETCH - 1)).astype(np.int64)
    odd = np.bincount(places, minlength=64 * SKETCH).astype(np.uint8) & 1
    return np.packbits(odd).view(np.int64)


def signature(low: np.ndarray) -> np.ndarray:
    """The last four bits of the first SIGNED minima: of every 64 minima four words, one a bit."""
    bits = low[:SIGNED, None] >> np.arange(_PLANES, dtype=np.uint32) & np.uint32(1)
    planes = bits.astype(np.uint8).reshape(-1, 64, _PLANES).transpose(0, 2, 1)
    return np.packbits(np.ascontiguousarray(planes)).view(np.int64)


def band_keys(low: np.ndarray) -> np.ndarray:
    """One 64-bit bucket per band of minima."""
    rows = low.astype(np.uint64).reshape(BANDS, ROWS)
    key = np.arange(BANDS, dtype=np.uint64)
    for k in range(ROWS):
        key = _mixed(key + rows[:, k])
    return key.view(np.int64)


def _text_key(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def with_classes(df: DataFrame, width: int, text: str = "text") -> DataFrame:
    """Adds the class of every row: its key (of the words), n_shingles, marks (sketch and signature) and buckets.

    Copies within a batch are hashed once.
    """
    ship_package(df.sparkSession)
    kind = (
        "struct<key: binary, n_shingles: bigint, marks: array<bigint>, buckets: array<bigint>>"
    )

    @F.arrow_udf(kind)
    def classes(texts: pa.Array) -> pa.Array:
        in_use(_words)
        known: dict[bytes, tuple] = {}
        rows = []
        for value in texts:
            words = words_in((value.as_py() or "").encode())
            key = hashlib.blake2b(b" ".join(words), digest_size=16).digest()
            if key not in known:
                shingles = shingle_set(words, width)
                if len(shingles):
                    low = minima(shingles)
                    marks = np.concatenate([sketch(shingles), signature(low)])
                    known[key] = (key, len(shingles), marks, band_keys(low))
                else:
                    known[key] = (key, 0, np.zeros(0, np.int64), np.zeros(0, np.int64))
            rows.append(known[key])
        columns = list(zip(*rows)) or [()] * 4
        types = (pa.binary(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()))
        arrays = [pa.array(list(c), t) for c, t in zip(columns, types)]
        return pa.StructArray.from_arrays(arrays, ["key", "n_shingles", "marks", "buckets"])

    return df.withColumn("_class", classes(F.col(text)))


def _with_sets(df: DataFrame, width: int, text: str) -> DataFrame:
    @F.arrow_udf("array<bigint>")
    def sets(texts: pa.Array) -> pa.Array:
        in_use(_words)
        each = [
            shingle_set(words_in((value.as_py() or "").encode()), width).view(np.int64)
            for value in texts
        ]
        return pa.array(each, pa.list_(pa.int64()))

    return df.withColumn("_set", sets(F.col(text)))


def likely(n: Column, marks: Column, other_n: Column, other_marks: Column) -> Column:
    """Whether the sizes, sketches and signatures of two sets leave a similarity of 0.8 possible.

    Evaluated inside the joins of buckets, so that pairs that only share a bucket never
    become rows.
    """
    differing = [
        F.get(marks, F.lit(k)).bitwiseXOR(F.get(other_marks, F.lit(k)))
        for k in range(SKETCH + SIGNATURE)
    ]
    flipped = reduce(add, [F.bit_count(x) for x in differing[:SKETCH]])
    minima_off = [
        F.bit_count(reduce(Column.bitwiseOR, differing[k : k + _PLANES]))
        for k in range(SKETCH, SKETCH + SIGNATURE, _PLANES)
    ]
    # 100 c >= SIMILAR (a + b - c) for the common c, so a + b - 2 c is at most this share of a + b
    return (
        (100 * F.least(n, other_n) >= SIMILAR * F.greatest(n, other_n))
        & ((100 + SIMILAR) * flipped <= (100 - SIMILAR) * (n + other_n))
        & (reduce(add, minima_off) <= MOST_DIFFERENT)
    )


def _sided(df: DataFrame, key: str, columns: dict[str, str]) -> DataFrame:
    return df.select(F.col("key").alias(key), *[F.col(c).alias(n) for c, n in columns.items()])


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Of the pairs (u, v), those whose full sets are similar enough."""
    common = F.size(F.array_intersect("_u", "_v"))
    union = F.size("_u") + F.size("_v") - common
    return (
        pairs.join(_sided(sets, "u", {"_set": "_u"}), "u")
        .join(_sided(sets, "v", {"_set": "_v"}), "v")
        .where(100 * common >= SIMILAR * union)
        .select("u", "v")
    )


def _pairs_to_test(
    members: DataFrame, marked: DataFrame, roots: DataFrame, tested: DataFrame, pivots: int
) -> tuple[DataFrame, DataFrame] | None:
    """Pairs of members of different components that share an unfinished bucket, one of them
    a pivot, and the members of buckets that are not done with these; None once there is no
    unfinished bucket left."""
    placed = members.join(
        roots.select(F.col("node").alias("key"), "root"), "key", "left"
    ).withColumn("root", F.coalesce("root", "key"))
    open_buckets = (
        placed.groupBy("bucket", "root")
        .agg(F.count(F.lit(1)).alias("_of_root"))
        .groupBy(F.col("bucket").alias("_bucket"))
        .agg(
            F.sum("_of_root").alias("_n"),
            F.max(F.struct("_of_root", "root")).alias("_largest"),
            F.count(F.lit(1)).alias("_roots"),
        )
        .where((F.col("_roots") > 1) & (F.col("_n") > 2))  # two members have been compared
        .select(
            "_bucket",
            "_n",
            F.col("_largest.root").alias("_main"),
            (F.col("_n") - F.col("_largest._of_root") <= pivots).alias("_last"),
        )
    )
    # the marks meet a class once with all its open buckets, of which it has BANDS at most
    outside = (F.col("root") != F.col("_main")).alias("_outside")
    placed = stored(
        placed.join(open_buckets, F.col("bucket") == F.col("_bucket"))
        .groupBy("key", "root")
        .agg(F.collect_list(F.struct("bucket", "_n", "_last", outside)).alias("_open"))
        .join(marked, "key")
        .select("key", "root", "n_shingles", "marks", F.inline("_open")),
        "open-buckets",
    )
    if placed.isEmpty():
        return None
    # about `pivots` of the n members, drawn by hash; all outside the largest component where
    # there are no more
    drawn = F.pmod(F.xxhash64("key", "bucket"), F.lit(1 << 20)) * F.col("_n") < F.lit(pivots << 20)
    # large buckets are dealt out in parts, each of which meets all pivots; the number of tasks
    # is fixed, as the comparisons cost far more than the bytes they read suggest
    parts = F.ceil(F.col("_n") / BUCKET_PART).cast("int")
    tasks = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    chosen = placed.where(F.when(F.col("_last"), F.col("_outside")).otherwise(drawn)).select(
        F.explode(F.sequence(F.lit(0), parts - 1)).alias("_part_of"),
        F.col("bucket").alias("_bucket"),
        F.col("key").alias("_pivot"),
        F.col("root").alias("_root"),
        F.col("n_shingles").alias("_size"),
        F.col("marks").alias("_marks"),
    )
    dealt = placed.withColumn("_part", F.pmod(F.xxhash64("key"), parts).cast("int"))
    pairs = dealt.repartition(tasks, "bucket", "_part").join(
        chosen.repartition(tasks, "_bucket", "_part_of"),
        (F.col("bucket") == F.col("_bucket"))
        & (F.col("_part") == F.col("_part_of"))
        & (F.col("root") != F.col("_root"))
        & likely(F.col("n_shingles"), F.col("marks"), F.col("_size"), F.col("_marks")),
    ).select(F.least("key", "_pivot").alias("u"), F.greatest("key", "_pivot").alias("v"))
    fresh = stored(pairs.distinct().join(tested, ["u", "v"], "left_anti"), "pairs")
    return fresh, placed.where(~F.col("_last")).select("key", "bucket")


def find(df: DataFrame, width: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, _key, n_shingles and component_id of every row; see `dedupe` for whole rows."""
    rows = df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("_text"))
    classed = stored(
        with_classes(rows, width, "_text").select(
            "doc_id", F.xxhash64("_text").alias("_text_hash"), "_class.*"
        ),
        "classed",
    )
    classes = classed.where(F.col("n_shingles") > 0).dropDuplicates(["key"])
    buckets = classes.select("key", F.explode("buckets").alias("bucket"))
    shared = (
        buckets.groupBy("bucket")
        .agg(F.min("key").alias("_first"), F.max("key").alias("_last"))
        .where(F.col("_first") != F.col("_last"))
        .select(F.col("bucket").alias("_bucket"), "_first")
    )
    placed = stored(
        buckets.join(shared, F.col("bucket") == F.col("_bucket")).drop("_bucket"), "buckets"
    )
    compared = placed.select("key").distinct()
    signed = stored(
        classes.select("key", "doc_id", "_text_hash", "n_shingles", "marks").join(
            compared, "key", "left_semi"
        ),
        "signatures",
    )
    marked = signed.select("key", "n_shingles", "marks")
    members = placed.select("key", "bucket")
    one = signed.select(F.col("doc_id").alias("_id"), F.col("_text_hash").alias("_hash"), "key")
    texts = rows.withColumn("_hash_of", F.xxhash64("_text")).join(
        one, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_hash_of") == F.col("_hash"))
    )
    sets = _with_sets(texts, width, "_text").select("key", "_set")
    sets = stored(sets.dropDuplicates(["key"]), "sets")

    first = placed.select(F.col("_first").alias("u"), F.col("key").alias("v"))
    first = first.where(F.col("u") != F.col("v")).distinct()
    met = first.join(marked.withColumnRenamed("key", "v"), "v").join(
        _sided(marked, "_u", {"n_shingles": "_size", "marks": "_marks"}),
        (F.col("u") == F.col("_u"))
        & likely(F.col("n_shingles"), F.col("marks"), F.col("_size"), F.col("_marks")),
    )
    pairs = stored(met.select("u", "v"), "pairs")
    tested, pivots = pairs, PIVOTS
    roots = stored(connected(_confirmed(pairs, sets)), "roots")
    while True:
        step = _pairs_to_test(members, marked, roots, tested, pivots)
        if step is None:
            break
        pairs, members = step
        found = stored(_confirmed(pairs, sets), "links")
        if not found.isEmpty():
            stars = roots.select(F.col("node").alias("u"), F.col("root").alias("v"))
            roots = stored(connected(stars.union(found)), "roots")
        tested = tested.union(pairs)
        pivots *= MORE

    by_class = (
        classed.where(F.col("n_shingles") > 0)
        .groupBy(F.col("key").alias("_of"))
        .agg(F.min("doc_id").alias("_low"))
        .join(roots.select(F.col("node").alias("_of"), "root"), "_of", "left")
        .withColumn("root", F.coalesce("root", "_of"))
    )
    lowest = by_class.groupBy("root").agg(F.min("_low").alias("component_id"))
    labelled = by_class.join(lowest, "root").select("_of", "component_id", "root")
    return classed.join(labelled, F.col("key") == F.col("_of"), "left").select(
        "doc_id",
        "_text_hash",
        "n_shingles",
        F.when(F.col("n_shingles") > 0, F.col("component_id"))
        .otherwise(F.col("doc_id"))
        .alias("component_id"),
        F.col("root").alias("component"),
    )


def dedupe(df: DataFrame, width: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of every component with all its columns, the one of the smallest id, and every
    row without words."""
    found = stored(find(df, width, doc_id, text), "components")
    alone = found.where(F.col("component").isNull()).select("doc_id", "_text_hash")
    row = F.struct(F.col("doc_id").isNull().alias("_none"), "doc_id", "_text_hash")
    best = (
        found.where(F.col("component").isNotNull())
        .groupBy("component")
        .agg(F.min(row).alias("_row"))
        .select("_row.doc_id", "_row._text_hash")
    )
    keep = alone.union(best).distinct().select(
        F.col("doc_id").alias("_id"), F.col("_text_hash").alias("_hash")
    )
    hashed = df.withColumn("_text_of", F.xxhash64(text))
    names = df.columns

    def chosen(rows: DataFrame) -> DataFrame:
        return hashed.join(
            rows,
            hashed[doc_id].eqNullSafe(F.col("_id")) & (F.col("_text_of") == F.col("_hash")),
            "left_semi",
        ).select(*names)

    repeated = (
        found.where(F.col("component").isNotNull())
        .groupBy("doc_id", "_text_hash")
        .agg(F.count(F.lit(1)).alias("_n"))
        .where(F.col("_n") > 1)
        .select(F.col("doc_id").alias("_id"), F.col("_text_hash").alias("_hash"))
    )
    again = stored(keep.intersect(repeated), "repeated")
    if again.isEmpty():
        return chosen(keep)
    return chosen(keep.subtract(again)).union(chosen(again).dropDuplicates([doc_id, text]))
