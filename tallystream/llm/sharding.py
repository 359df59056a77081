"""Shards by fixed virtual slots.

Records are hashed into 4,096 virtual slots for good. Bytes are summed per slot, and a small
table (version, virtual_slot, shard, bytes, rows) says which shard holds a slot. Version 1
deals slots out in turn; rebalancing edits it by moving slots from the fullest shard to the
emptiest until no move helps, and adding a shard moves slots into the new one only. Every
edit appends a version; the records never hash anew.

Rows: a null text has no bytes (size 1) and the CRC of nothing; a null id hashes like any
other, together with its text's CRC; repeated rows each get a place of their own; an empty
table gives no rows and an even map. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallystream.llm.ranks import ranked, stored_with_parts
from tallystream.session import fresh_dir

VIRTUAL_SLOTS = 4_096
SHARDS = 16
MAP_SCHEMA = "version int, virtual_slot int, shard int, bytes long, rows long"


def records(docs: DataFrame, slots: int = VIRTUAL_SLOTS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, size, text_crc32 and virtual_slot of every row."""
    raw = F.coalesce(F.col(text), F.lit(""))
    crc = F.crc32(raw.cast("binary"))
    return docs.select(
        F.col(doc_id).alias("doc_id"),
        (F.octet_length(raw) + 1).cast("long").alias("size"),
        crc.alias("text_crc32"),
        F.pmod(F.xxhash64(F.col(doc_id), crc), F.lit(slots)).cast("int").alias("virtual_slot"),
    )


def even_map(slots: int = VIRTUAL_SLOTS, shards: int = SHARDS) -> dict[int, int]:
    return {slot: slot % shards for slot in range(slots)}


def rebalanced(at: dict[int, int], load: dict[int, int], shards: int = SHARDS) -> dict[int, int]:
    """An edited copy of map ``at``: the fullest shard gives the emptiest the slot nearest to half
    their difference, as long as that makes them more equal. What remains between any two
    shards is less than the smallest used slot of the fullest one."""
    at = dict(at)
    full = [0] * shards
    held: list[set[int]] = [set() for _ in range(shards)]
    for slot, shard in at.items():
        full[shard] += load.get(slot, 0)
        held[shard].add(slot)
    while True:
        most, least = full.index(max(full)), full.index(min(full))
        gap = full[most] - full[least]
        movable = [s for s in held[most] if 0 < load.get(s, 0) < gap]
        if not movable:
            return at
        slot = min(movable, key=lambda s: (abs(2 * load[s] - gap), s))
        at[slot] = least
        held[most].remove(slot)
        held[least].add(slot)
        full[most] -= load[slot]
        full[least] += load[slot]


def grown(at: dict[int, int], load: dict[int, int], shards: int = SHARDS) -> dict[int, int]:
    """An edited copy with one shard more, which takes slots from the fullest shards up to its share."""
    at = dict(at)
    full = [0] * shards
    for slot, shard in at.items():
        full[shard] += load.get(slot, 0)
    share, taken = sum(full) / (shards + 1), 0
    for slot in sorted(at, key=lambda s: (-load.get(s, 0), s)):
        size = load.get(slot, 0)
        if full[at[slot]] - size >= share * 0.98 and taken + size <= share * 1.02:
            full[at[slot]] -= size
            taken += size
            at[slot] = shards
    return at


def map_table(spark: SparkSession, versions: list[dict[int, int]], load: dict[int, tuple[int, int]]) -> DataFrame:
    """The versioned map, written to the shared folder and read back: one row a version and slot."""
    rows = [
        (version, slot, shard, *load.get(slot, (0, 0)))
        for version, at in enumerate(versions, start=1)
        for slot, shard in sorted(at.items())
    ]
    path = fresh_dir(spark, "slot-map")
    spark.createDataFrame(rows, MAP_SCHEMA).coalesce(1).write.partitionBy("version").parquet(path)
    return spark.read.schema(MAP_SCHEMA).parquet(path)


def shard(docs: DataFrame, shards: int = SHARDS, slots: int = VIRTUAL_SLOTS, **columns) -> tuple[DataFrame, DataFrame]:
    """(every row with virtual_slot, shard and its place ``slot`` in the shard, the versioned map).

    Only the sums of the virtual slots, one row each, come to the driver.
    """
    spark = docs.sparkSession
    stored = stored_with_parts(records(docs, slots, **columns))
    sums = stored.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n")).collect()
    load = {r.virtual_slot: (r.bytes, r.n) for r in sums}
    first = even_map(slots, shards)
    table = map_table(spark, [first, rebalanced(first, {s: b for s, (b, _) in load.items()}, shards)], load)
    newest = table.filter(F.col("version") == 2).select(F.col("virtual_slot").alias("slot_at"), F.col("shard").alias("shard"), "rows")
    before = [0] * shards
    base = []
    for r in newest.orderBy("slot_at").collect():
        base.append((r.slot_at, r["shard"], before[r["shard"]]))
        before[r["shard"]] += r["rows"]
    places = spark.createDataFrame(base, "slot_at int, shard int, first_slot long")
    rows = ranked(stored, ["virtual_slot"], ["doc_id", "text_crc32", "size"], "place")
    placed = rows.join(F.broadcast(places), F.col("virtual_slot") == F.col("slot_at"))  # one row a virtual slot
    return (
        placed.select("doc_id", "size", "text_crc32", "virtual_slot", "shard", (F.col("first_slot") + F.col("place")).alias("slot")),
        table,
    )
