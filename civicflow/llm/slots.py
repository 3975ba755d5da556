"""Operator 6: sharding by fixed virtual slots.

Records hash into ``SLOTS`` virtual slots; bytes are aggregated per slot; a
versioned slot-to-shard map assigns slots to shards (largest slot first, to
the shard with fewest bytes).  Rebalancing edits that map: only the slots it
moves change shard, records are never hashed anew.

Records hash by their text, so equal texts share a slot and a shard; the assignment
takes the heaviest slots first, which levels what lighter ones can.  Only a group of equal texts
that weighs more than a whole shard cannot stay together: its records hash by
``doc_id`` instead, and where one ``doc_id`` (or null) alone weighs that much, by
their place in the staged rows.  There are fewer than ``shards`` of each, so their lists
are broadcast.

Every slot is numbered in ``SUBSLOTS`` parts (very many short or empty texts may share
one); a row's part is written with it, so counts and numbers agree whatever is recomputed.

The map is a Parquet table (version, slot, shard) with one row per slot and
version, below the shared folder; a new version is a new file set.

Edge cases: a null text has no bytes (size 8) and the text of the empty
string; null ``doc_id`` values and repeated rows are kept and placed like any
other; an empty table gives no row; extra columns are ignored.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from civicflow.llm.common import prepare, staged
from civicflow.session import shared_path

SLOTS = 8192
SUBSLOTS = 16
ROW_BYTES = 8
MAP_SCHEMA = "version int, slot int, shard int"


def assign(loads: dict[int, int], slots: int, shards: int) -> dict[int, int]:
    """Slot -> shard: largest slot first, to the shard with fewest bytes."""
    heap = [(0, s) for s in range(shards)]
    out = {}
    for slot in sorted(range(slots), key=lambda s: (-loads.get(s, 0), s)):
        load, shard = heapq.heappop(heap)
        out[slot] = shard
        heapq.heappush(heap, (load + loads.get(slot, 0), shard))
    return out


def rebalance(current: dict[int, int], loads: dict[int, int], shards: int) -> dict[int, int]:
    """The next version of a map: fewest moves that level the shards' bytes.

    Slots of shards that no longer exist move first; then the fullest shard
    gives the emptiest the slot that narrows their difference most."""
    out = dict(current)
    total = {s: 0 for s in range(shards)}
    own: dict[int, list[tuple[int, int]]] = {s: [] for s in range(shards)}
    homeless = []
    for slot, shard in out.items():
        if shard < shards:
            total[shard] += loads.get(slot, 0)
            own[shard].append((loads.get(slot, 0), slot))
        else:
            homeless.append(slot)
    for slot in sorted(homeless, key=lambda s: (-loads.get(s, 0), s)):
        shard = min(total, key=lambda s: (total[s], s))
        out[slot] = shard
        total[shard] += loads.get(slot, 0)
        own[shard].append((loads.get(slot, 0), slot))
    while True:
        high = max(total, key=lambda s: (total[s], -s))
        low = min(total, key=lambda s: (total[s], s))
        gap = total[high] - total[low]
        move = min((x for x in own[high] if 0 < x[0] < gap),
                   key=lambda x: (abs(gap - 2 * x[0]), x), default=None)
        # Level to within one slot: more moves would only trade slots of like size.
        if move is None or gap <= max(own[high])[0]:
            return out
        own[high].remove(move)
        own[low].append(move)
        out[move[1]] = low
        total[high] -= move[0]
        total[low] += move[0]


def save_map(spark: SparkSession, version: int, mapping: dict[int, int], path: str) -> DataFrame:
    rows = [(version, slot, shard) for slot, shard in sorted(mapping.items())]
    spark.createDataFrame(rows, MAP_SCHEMA).coalesce(1).write.parquet(f"{path}/version={version}")
    return load_map(spark, version, path)


def load_map(spark: SparkSession, version: int, path: str) -> DataFrame:
    return spark.read.schema(MAP_SCHEMA).parquet(f"{path}/version={version}")


def slotted(docs: DataFrame, shards: int, slots: int = SLOTS) -> DataFrame:
    """doc_id, size, text_crc32 and virtual slot of each record (a staged table without texts)."""
    prepare(docs.sparkSession)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    data = F.encode(text, "UTF-8")
    # The place is written with the row: it is read again for the part.
    rows = staged(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(data).alias("text_crc32"), F.xxhash64(text).alias("h"),
        F.monotonically_increasing_id().alias("place")), "slot_rows")
    total = rows.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("t"))
    hot = (rows.groupBy("h").agg(F.sum("size").alias("b")).join(F.broadcast(total))
           .where(F.col("b") * shards > F.col("t")).select("h", F.lit(True).alias("hot")))
    rows = rows.join(F.broadcast(hot), "h", "left")
    repeated = (rows.where("hot").groupBy(F.col("h").alias("g"), F.col("doc_id").alias("d"))
                .agg(F.sum("size").alias("b")).join(F.broadcast(total))
                .where(F.col("b") * shards > F.col("t"))
                .select("g", "d", F.lit(True).alias("repeated")))
    key = (F.when(F.col("repeated"), F.xxhash64("doc_id", "h", "place"))
           .when(F.col("hot"), F.xxhash64("doc_id", "h")).otherwise(F.col("h")))
    return (rows.join(F.broadcast(repeated), (F.col("h") == F.col("g")) & F.col("doc_id").eqNullSafe(F.col("d")), "left")
            .select("doc_id", "size", "text_crc32",
                    F.pmod(F.xxhash64("place"), F.lit(SUBSLOTS)).cast("int").alias("part"),
                    F.pmod(key, F.lit(slots)).cast("int").alias("virtual_slot")))


def slot_loads(rows: DataFrame) -> dict[int, int]:
    """Bytes per slot: at most as many rows as there are slots."""
    return {r[0]: r[1] for r in rows.groupBy("virtual_slot").agg(F.sum("size")).collect()}


def place(rows: DataFrame, mapping: DataFrame) -> DataFrame:
    """Rows with their shard and gapless position there (by virtual slot, part of it, then doc_id).

    ``rows`` are staged.  The position is the offset of the slot's part in its
    shard, a prefix sum over slots and parts, plus the row's number within the
    part: no window over rows spans a shard or a whole slot."""
    counts = rows.groupBy("virtual_slot", "part").agg(F.count("*").alias("n"))
    per_shard = Window.partitionBy("shard").orderBy("virtual_slot", "part").rowsBetween(
        Window.unboundedPreceding, -1)
    base = (mapping.select(F.col("slot").alias("virtual_slot"), "shard")
            .join(counts, "virtual_slot")
            .select("virtual_slot", "part", "shard",
                    F.coalesce(F.sum("n").over(per_shard), F.lit(0)).alias("base")))
    in_part = Window.partitionBy("virtual_slot", "part").orderBy("doc_id", "text_crc32", "size")
    return (rows.withColumn("k", F.row_number().over(in_part) - 1)
            .join(F.broadcast(base), ["virtual_slot", "part"])
            .select("doc_id", "size", "text_crc32", "shard",
                    (F.col("base") + F.col("k")).alias("slot"), "virtual_slot"))


def reshard(rows: DataFrame, shards: int, path: str, version: int) -> DataFrame:
    """Place staged ``rows`` of ``slotted`` under the next version of a stored map, which it saves."""
    spark = prepare(rows.sparkSession)
    current = {r["slot"]: r["shard"] for r in load_map(spark, version, path).collect()}
    return place(rows, save_map(spark, version + 1, rebalance(current, slot_loads(rows), shards), path))


def shard(docs: DataFrame, shards: int, slots: int = SLOTS, path: str | None = None) -> DataFrame:
    """Place ``docs`` (doc_id, text) in shards of near equal bytes under version 1 of a new map."""
    spark = docs.sparkSession
    prepare(spark)
    path = path or shared_path(spark, "llm", "slot_map", unique=True)
    rows = staged(slotted(docs, shards, slots), "slotted")
    mapping = save_map(spark, 1, assign(slot_loads(rows), slots, shards), path)
    return place(rows, mapping)
