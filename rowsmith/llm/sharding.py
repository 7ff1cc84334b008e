"""Sharding over fixed virtual slots.

A record's slot is a hash of its id and text, so it never changes. Only the map from slots to shards
does, and that map is a stored table with a version per edit. Version 1 deals the slots round robin; each
run reads the newest version, measures the bytes of every slot in one aggregate and moves slots from
shards above the mean to shards below it, which is stored as the next version if anything moved. Data
moves only where a slot's shard differs between versions.

Defined cases: a null text has no bytes; the size of a record is its bytes plus 8. A null id hashes
by its text. Rows that repeat an id and text share a slot and get different positions; where their
bytes together are above a hundredth of a shard, they are spread over all slots row by row. An empty
table gives an empty result and a map that still names every slot. Other columns are not read.
"""

from __future__ import annotations

import bisect
import heapq

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rowsmith.llm.common import whole_text
from rowsmith.session import Scratch, list_files, scratch_path

SLOTS = 8192
MAP_SCHEMA = "version int, vslot int, shard int"
# A slot above this part of a shard is looked into; repeated rows above half of it are spread.
FULL_SLOT = 50


def virtual_slot(slots: int, *keys: Column) -> Column:
    """The fixed slot of a record; nulls do not count."""
    return F.pmod(F.xxhash64(*keys), F.lit(slots)).cast("int")


def first_map(slots: int, shards: int) -> list[int]:
    """Version 1: slots dealt round robin."""
    return [s % shards for s in range(slots)]


def rebalance(shard_of: list[int], size: list[int], shards: int) -> list[int]:
    """The next version of a map: edits until no move or swap of slots brings the shards closer.

    The slots of the fullest shard are looked at against the emptiest one: the slot, or the pair
    of slots to swap, that comes nearest to levelling the two is moved. Bounded by the number of
    slots, never by the data.
    """
    shard_of = list(shard_of)
    own: list[set[int]] = [set() for _ in range(shards)]
    load = [0] * shards
    for slot, shard in enumerate(shard_of):
        if size[slot]:
            own[shard].add(slot)
            load[shard] += size[slot]
    for _ in range(4 * len(shard_of)):
        full = max(range(shards), key=load.__getitem__)
        bare = min(range(shards), key=load.__getitem__)
        gap = load[full] - load[bare]
        if gap <= max(1, sum(load) // (shards * 10_000)):
            return shard_of  # level
        choice = None  # how far from level, slot to move, slot to take back
        back = sorted((size[s], s) for s in own[bare])
        for slot in own[full]:
            if 0 < size[slot] < gap:
                choice = min(choice or (gap, -1, -1), (abs(gap - 2 * size[slot]), slot, -1))
            want = size[slot] - gap / 2  # the partner that would level both
            at = _nearest(back, want)
            if at is not None and 0 < size[slot] - at[0] < gap:
                choice = min(choice or (gap, -1, -1), (abs(gap - 2 * (size[slot] - at[0])), slot, at[1]))
        if choice is None or choice[0] >= gap:
            return shard_of
        _, slot, other = choice
        moved = size[slot] - (size[other] if other >= 0 else 0)
        own[full].discard(slot)
        own[bare].add(slot)
        shard_of[slot] = bare
        if other >= 0:
            own[bare].discard(other)
            own[full].add(other)
            shard_of[other] = full
        load[full] -= moved
        load[bare] += moved
    return shard_of


def _nearest(pairs: list[tuple[int, int]], want: float) -> tuple[int, int] | None:
    if not pairs:
        return None
    i = bisect.bisect_left(pairs, (want, -1))
    return min(pairs[max(0, i - 1) : i + 1], key=lambda p: abs(p[0] - want))


def grow(shard_of: list[int], size: list[int], shards: int) -> list[int]:
    """A map with one more shard: slots go into the new shard only, always from the fullest."""
    shard_of = list(shard_of)
    own: dict[int, list[int]] = {s: [] for s in range(shards)}
    load = [0] * shards
    for slot, shard in enumerate(shard_of):
        own[shard].append(slot)
        load[shard] += size[slot]
    for slots in own.values():
        slots.sort(key=lambda s: (size[s], s))
    heap = [(-load[s], s) for s in range(shards)]
    heapq.heapify(heap)
    target, new = sum(load) / (shards + 1), 0
    while heap and new < target:
        _, shard = heapq.heappop(heap)
        if not own[shard]:
            continue
        slot = own[shard].pop()
        if new + size[slot] > target + size[slot] / 2:
            continue  # this shard's slots are too large for the rest
        shard_of[slot] = shards
        new += size[slot]
        load[shard] -= size[slot]
        heapq.heappush(heap, (-load[shard], shard))
    return shard_of


def newest_map(spark: SparkSession, maps: str) -> tuple[int, list[int]]:
    """Number and content of the newest whole version in the folder ``maps``; 0 and nothing if there is none."""
    numbers = [int(p.split("/")[-2].split("=")[1]) for p, _ in list_files(spark, f"{maps}/version=*/_SUCCESS")]
    if not numbers:
        return 0, []
    rows = spark.read.schema("vslot int, shard int").parquet(f"{maps}/version={max(numbers)}")
    return max(numbers), [r["shard"] for r in rows.orderBy("vslot").collect()]  # a row per slot


def store_map(spark: SparkSession, maps: str, version: int, shard_of: list[int]) -> None:
    """Write a version. What a run that died left of it, without its success file, is replaced."""
    rows = spark.createDataFrame([(version, slot, shard) for slot, shard in enumerate(shard_of)], MAP_SCHEMA)
    rows.drop("version").coalesce(1).write.mode("overwrite").parquet(f"{maps}/version={version}")


def next_map(spark: SparkSession, maps: str, size: list[int], shards: int) -> tuple[int, list[int]]:
    """The map for the measured slots: the newest stored one, grown to ``shards`` and rebalanced, stored where it changed."""
    version, stored = newest_map(spark, maps)
    if not version:
        version, stored = 1, first_map(len(size), shards)
        store_map(spark, maps, version, stored)
    have = max(stored) + 1
    if len(stored) != len(size) or have > shards:
        raise ValueError(f"the stored map has {len(stored)} slots and {have} shards, asked for are {len(size)} and {shards}")
    grown = stored
    for n in range(have, shards):
        grown = grow(grown, size, n)
    after = rebalance(grown, size, shards)
    if after != stored:
        version += 1
        store_map(spark, maps, version, after)
    return version, after


def _measure(rows: DataFrame, slots: int) -> tuple[list[int], list[int]]:
    """Bytes and records of every slot."""
    size, count = [0] * slots, [0] * slots
    for r in rows.groupBy("vslot").agg(F.sum("size").alias("bytes"), F.count("*").alias("n")).collect():  # at most ``slots`` rows
        size[r["vslot"]], count[r["vslot"]] = r["bytes"], r["n"]
    return size, count


def _spread_repeats(rows: DataFrame, size: list[int], shards: int, slots: int) -> DataFrame | None:
    """``rows`` with repeated records that fill a slot spread over all slots; None if there are none.

    Only records of very full slots are grouped. At most ``2 * FULL_SLOT * shards`` groups can be that large.
    """
    spark, total = rows.sparkSession, sum(size)
    full = [(s,) for s, n in enumerate(size) if n * FULL_SLOT * shards > total]
    if not full:
        return None
    some = rows.join(F.broadcast(spark.createDataFrame(full, "vslot int")), "vslot")
    heavy = some.groupBy("doc_id", "text_crc32", "size").agg(F.count("*").alias("n"))
    heavy = heavy.where((F.col("n") > 1) & (F.col("n") * F.col("size") * (2 * FULL_SLOT * shards) > total)).collect()
    if not heavy:
        return None
    found = spark.createDataFrame([(r["doc_id"], r["text_crc32"], r["size"], True) for r in heavy], "h_id bigint, h_crc bigint, h_size bigint, heavy boolean")
    same = F.col("doc_id").eqNullSafe(F.col("h_id")) & (F.col("text_crc32") == F.col("h_crc")) & (F.col("size") == F.col("h_size"))
    slot = F.when(F.col("heavy"), virtual_slot(slots, "row")).otherwise(F.col("vslot"))
    return rows.join(F.broadcast(found), same, "left").withColumn("vslot", slot).select(*rows.columns)


def shard_documents(docs: DataFrame, shards: int = 24, slots: int = SLOTS, maps: str | None = None) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard, vslot, map_version`` of every record.

    The law is ``bytes``. ``slot`` is the position in the shard, gapless from 0: the rows of the
    shard's earlier virtual slots come first, then the rank within the virtual slot. Ranks are taken
    per virtual slot, thousands of small groups, never per shard. The versions of the map lie in the
    folder ``maps``, which outlives the run; without one, in a folder that goes with the driver.
    """
    spark = docs.sparkSession
    maps = maps or scratch_path(spark, "slot-maps")
    with Scratch(spark, "shard") as scratch:
        rows = docs.select(
            F.col("doc_id").cast("bigint").alias("doc_id"),
            (F.octet_length(whole_text()) + 8).cast("bigint").alias("size"),
            F.crc32(whole_text().cast("binary")).alias("text_crc32"),
            F.monotonically_increasing_id().alias("row"),
        )
        rows = rows.withColumn("vslot", virtual_slot(slots, "doc_id", "text_crc32"))
        rows = scratch.write(rows, "records", keep=True)
        size, count = _measure(rows, slots)
        spread = _spread_repeats(rows, size, shards, slots)
        if spread is not None:
            rows = spread
            size, count = _measure(rows, slots)
        version, shard_of = next_map(spark, maps, size, shards)
        first, seen = [], [0] * shards
        for slot, shard in enumerate(shard_of):
            first.append((slot, shard, seen[shard]))
            seen[shard] += count[slot]
        placed = F.broadcast(spark.createDataFrame(first, "vslot int, shard int, first bigint"))
        rank = F.row_number().over(W.partitionBy("vslot").orderBy(F.col("doc_id").asc_nulls_last(), "text_crc32", "size", "row")) - 1
        return rows.withColumn("rank", rank).join(placed, "vslot").select(
            "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("first") + F.col("rank")).alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"), "vslot", F.lit(version).alias("map_version"),
        )
