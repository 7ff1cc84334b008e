import random
import zlib
from collections import defaultdict

import pytest

from rowsmith.llm import sharding
from rowsmith.llm.queries import LLM_QUERIES


def check(rows, docs, shards):
    """One row per document, sizes and checksums right, positions gapless in every shard."""
    want = sorted(((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in docs), key=repr)
    assert sorted(((r["doc_id"], r["size"], r["text_crc32"]) for r in rows), key=repr) == want
    slots = defaultdict(list)
    for r in rows:
        assert 0 <= r["shard"] < shards and r["law"] == "bytes" and r["grown_shard"] is None
        slots[r["shard"]].append(r["slot"])
    for s in slots.values():
        assert sorted(s) == list(range(len(s)))


def test_query(spark, sf_dir):
    rows = LLM_QUERIES["op7_sharding"](spark, sf_dir).collect()
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    check(rows, docs, 24)
    load = defaultdict(int)
    for r in rows:
        load[r["shard"]] += r["size"]
    largest = max(r["size"] for r in rows)
    assert len(load) == 24 and max(load.values()) - min(load.values()) <= largest


def test_cases(cases, nothing):
    rows = sharding.shard_documents(cases, 3).collect()
    check(rows, [(r["doc_id"], r["text"]) for r in cases.collect()], 3)
    assert sharding.shard_documents(nothing, 3).count() == 0


def test_rebalancing_levels_and_moves_little():
    rng = random.Random(1)
    size = [rng.randint(1, 1000) if rng.random() < 0.9 else 0 for _ in range(2000)]
    before = sharding.first_map(2000, 8)
    after = sharding.rebalance(before, size, 8)
    load = [sum(s for s, shard in zip(size, after) if shard == k) for k in range(8)]
    assert max(load) - min(load) <= max(1, sum(load) // 80_000)
    assert sum(a != b for a, b in zip(before, after)) < 200
    assert sharding.rebalance(after, size, 8) == after


def test_growing_moves_into_the_new_shard_only():
    size = [1 + i % 7 for i in range(1000)]
    before = sharding.first_map(1000, 8)
    after = sharding.grow(before, size, 8)
    assert all(b == a or b == 8 for a, b in zip(before, after))
    new = sum(s for s, shard in zip(size, after) if shard == 8)
    assert abs(new - sum(size) / 9) <= 7


def test_maps_are_stored_by_version(spark, cases, tmp_path):
    sharding.shard_documents(cases, 3, slots=64, maps=str(tmp_path)).collect()
    maps = spark.read.parquet(str(tmp_path))
    assert {r["version"]: r["count"] for r in maps.groupBy("version").count().collect()} == {1: 64, 2: 64}


def test_the_newest_map_is_read_and_edited(spark, tmp_path):
    docs = spark.createDataFrame([(i, "x" * (i % 50)) for i in range(2000)], "doc_id bigint, text string")
    maps = str(tmp_path)
    first = {r["doc_id"]: r for r in sharding.shard_documents(docs, 4, slots=64, maps=maps).collect()}
    number, stored = sharding.newest_map(spark, maps)
    again = {r["doc_id"]: r for r in sharding.shard_documents(docs, 4, slots=64, maps=maps).collect()}
    assert sharding.newest_map(spark, maps) == (number, stored)  # level already
    assert all(again[i]["shard"] == r["shard"] == stored[r["vslot"]] and r["map_version"] == number for i, r in first.items())
    more = sharding.shard_documents(docs, 5, slots=64, maps=maps).collect()
    check(more, [(r["doc_id"], r["text"]) for r in docs.collect()], 5)
    assert sharding.newest_map(spark, maps)[0] == number + 1 == more[0]["map_version"]
    assert all(r["vslot"] == first[r["doc_id"]]["vslot"] for r in more)
    with pytest.raises(ValueError, match="stored map"):
        sharding.shard_documents(docs, 4, slots=64, maps=maps)


def test_a_hot_id_is_spread(spark):
    """A third of all rows share one id, once with many texts and once with one text."""
    for text in ("CONCAT('text ', id)", "'the same text for all of them'"):
        docs = spark.range(3000).selectExpr("IF(id % 3 = 0, 7, id) AS doc_id", f"{text} AS text")
        docs = docs.unionByName(spark.range(300).selectExpr("CAST(NULL AS BIGINT) AS doc_id", "'same' AS text"))
        rows = sharding.shard_documents(docs, 6, slots=256).collect()
        check(rows, [(r["doc_id"], r["text"]) for r in docs.collect()], 6)
        load = defaultdict(int)
        for r in rows:
            load[r["shard"]] += r["size"]
        assert max(load.values()) <= 1.02 * min(load.values())
