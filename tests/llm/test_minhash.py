import math
import random
import re

import numpy as np
import pandas as pd
import pytest

from rowsmith.llm import minhash
from rowsmith.llm.common import components
from rowsmith.llm.queries import LLM_QUERIES
from rowsmith.session import Scratch


def shingles(text, size):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    k = min(size, len(words))
    return frozenset(tuple(words[i : i + k]) for i in range(len(words) - k + 1)) if words else frozenset()


def brute(rows, size, percent=80):
    sets = [shingles(t, size) for _, t in rows]
    root = {i: i for i, _ in rows}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    distinct = {}
    for (i, _), s in zip(rows, sets):
        if s:
            a, b = sorted((find(i), find(distinct.setdefault(s, i))))
            root[b] = a
    items = list(distinct.items())
    for k, (x, i) in enumerate(items):
        for y, j in items[:k]:
            if min(len(x), len(y)) * 100 >= percent * max(len(x), len(y)):
                common = len(x & y)
                if 100 * common >= percent * (len(x) + len(y) - common):
                    a, b = sorted((find(i), find(j)))
                    root[b] = a
    return {i: (len(s), find(i)) for (i, _), s in zip(rows, sets)}


def found(df, **more):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in minhash.annotate(df, **more).collect()}


@pytest.mark.parametrize("size", [2, 5])
def test_documents(spark, sf_dir, size):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in LLM_QUERIES["op10_minhash"](spark, sf_dir).collect()} if size == 2 else found(docs, size=size)
    assert got == brute(rows, size)


def near_copies(seed, groups=6, members=40):
    """Groups whose members lie around the threshold, with chains, so that no single pivot links them."""
    rng = random.Random(seed)
    rows, i = [], 0
    for g in range(groups):
        text = [f"w{rng.randint(0, 400)}" for _ in range(rng.choice([8, 30, 80]))]
        for _ in range(members):
            for _ in range(rng.choice([0, 1, 1, 2])):
                text[rng.randrange(len(text))] = f"n{rng.randint(0, 10**6)}"
            rows.append((i * 7 % (groups * members), " ".join(text)))
            i += 1
    return rows


@pytest.mark.parametrize("seed", [0, 1])
def test_chains_and_hot_groups(spark, seed, monkeypatch):
    """Every link counts, whichever pairs the first step tries and however groups are cut into blocks."""
    rows = near_copies(seed)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    want = brute(rows, 2)
    assert found(docs, size=2) == want
    monkeypatch.setattr(minhash, "SMALL", 2)
    assert found(docs, size=2, block=9, set_block=300) == want
    assert found(docs, size=2, far=1.0) == want


def test_cases(spark, cases, nothing):
    out = minhash.annotate(cases, 2).collect()
    assert len(out) == cases.count()
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in out if r["doc_id"] is not None}
    assert got[2] == (0, 2, True) and got[3] == (0, 3, True) and got[4] == (0, 4, True)
    assert got[6][1:] == (1, False) and got[7][1:] == (1, False) and got[8] == (1, 8, True)
    assert got[10] == (1, 10, True) and got[11] == (1, 10, False)
    orphans = sorted((r["component_id"] or 0, r["kept"]) for r in out if r["doc_id"] is None)
    assert orphans == [(0, True), (1, False)]
    assert minhash.annotate(nothing, 2).count() == 0 == minhash.drop_near_copies(nothing).count()
    left = minhash.drop_near_copies(cases, 2)
    assert left.schema == cases.schema
    ids = [r["doc_id"] for r in left.collect()]
    assert {i for i in ids if i is not None} == {1, 2, 3, 4, 5, 8, 9, 10}


def test_pigeonhole():
    """Signatures that differ in fewer than CHUNKS * (ERRORS + 1) values always share a key."""
    rng = np.random.default_rng(2)
    a = rng.integers(0, 2**16, (200, minhash.VALUES)).astype(np.uint16)
    b = a.copy()
    for row in b:
        at = rng.choice(minhash.VALUES, minhash.CHUNKS * (minhash.ERRORS + 1) - 1, replace=False)
        row[at] ^= 1
    shared = [set(x) & set(y) for x, y in zip(minhash.keys_of(a), minhash.keys_of(b))]
    assert all(shared)


def test_stars_connect_what_links_connect():
    rng = np.random.default_rng(3)
    a, b = rng.integers(0, 60, 40), rng.integers(0, 60, 40)
    got = minhash._spanning(a, b)
    root = {i: i for i in range(60)}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for x, y in zip(a, b):
        low, high = sorted((find(x), find(y)))
        root[high] = low
    members = {int(i) for i in (*a, *b)}
    assert dict(zip(got["a"], got["b"])) == {i: find(i) for i in members if find(i) != i}
    assert len(minhash._spanning(a[:0], b[:0])) == 0


def test_rows_grow_with_members(spark, monkeypatch):
    """A group whose pairs all lie near the threshold, few of them above it, hands on rows like its members and not like its pairs."""
    handed = {}

    def group(members):
        rng = random.Random(members)
        base = [f"w{i}" for i in range(120)]
        rows = []
        for i in range(members):
            text = list(base)
            for at in rng.sample(range(120), 12):
                text[at] = f"n{i}x{at}"
            rows.append((i, " ".join(text)))
        return rows

    real = Scratch.write

    def counted(self, df, label, **more):
        out = real(self, df, label, **more)
        handed[label] = max(handed.get(label, 0), out.count())
        return out

    monkeypatch.setattr(Scratch, "write", counted)
    rows = group(150)
    assert found(spark.createDataFrame(rows, "doc_id bigint, text string"), size=1) == brute(rows, 1)
    assert max(handed.values()) <= minhash.VALUES * len(rows)
    once = dict(handed)
    handed.clear()
    rows = group(300)
    assert found(spark.createDataFrame(rows, "doc_id bigint, text string"), size=1) == brute(rows, 1)
    assert all(n <= 2.6 * max(once[label], 50) for label, n in handed.items()), {k: (once[k], n) for k, n in handed.items()}


def test_components(spark):
    rng = random.Random(7)
    links = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(250)] + [(i, i + 1) for i in range(1000, 1040)] + [(2000, i) for i in range(2001, 2100)]
    root = {}

    def find(i):
        while root.setdefault(i, i) != i:
            i = root[i]
        return i

    for x, y in links:
        a, b = sorted((find(x), find(y)))
        root[b] = a
    with Scratch(spark, "test") as scratch:
        got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a bigint, b bigint"), scratch).collect()}
        assert components(spark.createDataFrame([], "a bigint, b bigint"), scratch).count() == 0
    assert got == {i: find(i) for i in {x for p in links for x in p if p[0] != p[1]}}


def test_few_similar_pairs_are_far():
    n = minhash.VALUES
    lost = sum(math.comb(n, k) * 0.2**k * 0.8 ** (n - k) for k in range(int(n * minhash.FAR) + 1, n + 1))
    assert lost < 1e-7


def test_tasks_get_few_rows_at_a_time(spark):
    """A function that takes texts out of a batch never holds a whole batch of Python objects."""
    import pyarrow as pa

    from rowsmith.llm import common

    def make():
        return lambda batch: pa.record_batch([pa.array([batch.num_rows], pa.int64())], names=["n"])

    sizes = [r["n"] for r in common.map_batches(spark.range(2500).coalesce(1), make, "n bigint").collect()]
    assert sum(sizes) == 2500 and max(sizes) <= common.ROWS_AT_ONCE
