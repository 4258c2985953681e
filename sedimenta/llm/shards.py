"""Sharding over fixed virtual slots.

Every record belongs to one of a fixed number of virtual slots for good, by a hash of
its key columns. Bytes and rows are summed per slot, and a small versioned table says
which shard holds which slot. A new shard changes that table only: the records keep their
slots, and nothing but the rows of the slots handed over moves.

No Python runs on the executors. The driver handles one entry per slot, and the number of
slots is a parameter, not a property of the data.

Defined results: a null text has size 1 and checksum 0; rows that are equal in all key
columns share a slot; their positions are distinct, in any order among equal rows. An
empty table gives no rows. Columns of the input that carry the name of a result column
are replaced.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sedimenta.llm.common import literal_rows

SLOTS = 8192
MAP_DDL = "virtual_slot int, shard int"


def virtual_slot(keys: list[str], slots: int = SLOTS) -> Column:
    """The slot of a record; the number of shards plays no part in it."""
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(slots)).cast("int")


def with_slots(
    df: DataFrame, keys: list[str], text: str = "text", slots: int = SLOTS
) -> DataFrame:
    """Adds size (bytes of the text and its terminator), text_crc32 and virtual_slot."""
    whole = F.coalesce(F.col(text), F.lit(""))
    return df.withColumns(
        {
            "size": F.octet_length(whole).cast("long") + 1,
            "text_crc32": F.crc32(F.encode(whole, "UTF-8")),
            "virtual_slot": virtual_slot(keys, slots),
        }
    )


def slot_totals(slotted: DataFrame) -> DataFrame:
    """Bytes and rows of every slot that holds any."""
    return slotted.groupBy("virtual_slot").agg(
        F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n_rows")
    )


def first_map(totals: dict[int, int], shards: int, slots: int = SLOTS) -> dict[int, int]:
    """Slot to shard: the slots by falling bytes, each to the shard with the fewest so far."""
    load = [(0, 0, shard) for shard in range(shards)]  # bytes, slots, shard
    placed = {}
    for slot in sorted(range(slots), key=lambda s: (-totals.get(s, 0), s)):
        size, held, shard = heapq.heappop(load)
        placed[slot] = shard
        heapq.heappush(load, (size + totals.get(slot, 0), held + 1, shard))
    return placed


def edited_map(current: dict[int, int], totals: dict[int, int], shards: int) -> dict[int, int]:
    """The map for `shards` shards made from the current one by moving slots.

    Slots of shards that are no longer there go to the lightest of the others. Then the
    heaviest shard hands its largest fitting slot to the lightest for as long as that
    narrows the gap between the two, so a new shard is filled and all else stays put.
    """
    held: dict[int, list[int]] = {shard: [] for shard in range(shards)}
    homeless = []
    for slot, shard in current.items():
        held[shard].append(slot) if shard in held else homeless.append(slot)
    size = {shard: sum(totals.get(s, 0) for s in own) for shard, own in held.items()}

    def give(slot: int, shard: int) -> None:
        held[shard].append(slot)
        size[shard] += totals.get(slot, 0)

    for slot in sorted(homeless, key=lambda s: (-totals.get(s, 0), s)):
        give(slot, min(size, key=lambda shard: (size[shard], shard)))
    for own in held.values():
        own.sort(key=lambda s: (totals.get(s, 0), s))
    target = sum(size.values()) / shards
    while True:
        heavy = max(size, key=lambda shard: (size[shard], -shard))
        light = min(size, key=lambda shard: (size[shard], shard))
        room = min(size[heavy] - target, target - size[light])
        fitting = [s for s in held[heavy] if 0 < totals.get(s, 0) <= room]
        if not fitting:
            break
        slot = fitting[-1]
        held[heavy].remove(slot)
        size[heavy] -= totals.get(slot, 0)
        give(slot, light)
        held[light].sort(key=lambda s: (totals.get(s, 0), s))
    return {slot: shard for shard, own in held.items() for slot in own}


def store_map(spark: SparkSession, placed: dict[int, int], folder: str, version: int) -> None:
    """Writes one version of the map; a version is written once and never changed."""
    rows = [{"virtual_slot": slot, "shard": shard} for slot, shard in sorted(placed.items())]
    path = f"{folder}/version={version:06d}"
    literal_rows(spark, rows, MAP_DDL).coalesce(1).write.mode("errorifexists").parquet(path)


def load_map(spark: SparkSession, folder: str, version: int) -> DataFrame:
    return spark.read.schema(MAP_DDL).parquet(f"{folder}/version={version:06d}")


def read_totals(totals: DataFrame) -> tuple[dict[int, int], dict[int, int]]:
    """Bytes and rows by slot on the driver: as many entries as there are slots at most."""
    rows = totals.collect()
    return {r.virtual_slot: r.bytes for r in rows}, {r.virtual_slot: r.n_rows for r in rows}


def place(slotted: DataFrame, placed: DataFrame, totals: DataFrame, order: list[str]) -> DataFrame:
    """Adds shard and slot, the gapless position of a row within its shard from 0.

    Rows are numbered within their virtual slot; the rows of the slots before it in the
    same shard are added from the totals. So no shard is sorted as a whole.
    """
    before = Window.partitionBy("shard").orderBy("virtual_slot").rowsBetween(
        Window.unboundedPreceding, -1
    )
    starts = (
        placed.join(totals, "virtual_slot")
        .select(
            F.col("virtual_slot").alias("_slot"),
            F.col("shard").alias("_shard"),
            F.coalesce(F.sum("n_rows").over(before), F.lit(0)).alias("_start"),
        )
    )
    within = Window.partitionBy("virtual_slot").orderBy(*order)
    numbered = slotted.withColumn("_rank", F.row_number().over(within))
    joined = numbered.join(F.broadcast(starts), F.col("virtual_slot") == F.col("_slot"))
    return joined.withColumns(
        {"shard": F.col("_shard"), "slot": (F.col("_start") + F.col("_rank") - 1).cast("long")}
    ).drop("_slot", "_shard", "_start", "_rank")
