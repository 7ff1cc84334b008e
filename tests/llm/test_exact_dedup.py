import hashlib
import re
from collections import defaultdict

import pytest

from rowsmith.llm import exact_dedup
from rowsmith.llm.common import heavy_hitters


def digest(text):
    return hashlib.sha256(re.sub(r"[\x20\x09-\x0D]+", " ", text or "").encode()).hexdigest()


def expected(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[digest(t)].append(i)
    out = []
    for i, t in rows:
        ids = groups[digest(t)]
        keep = min((x for x in ids if x is not None), default=None)
        out.append((i, digest(t), keep, len(ids)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("share", [0.001, 0.2, 1.0])
def test_groups(cases, share):
    """Whichever digests count as heavy, the result is the same."""
    rows = [(r["doc_id"], r["text"]) for r in cases.collect()]
    found = exact_dedup.annotate_copies(cases, share).collect()
    assert sorted([(r["doc_id"], r["digest"], r["keep_id"], r["group_size"]) for r in found], key=repr) == expected(rows)
    for r in found:
        assert r["kept"] == (r["doc_id"] == r["keep_id"]) or r["keep_id"] is None


@pytest.mark.parametrize("share", [0.001, 0.2, 1.0])
def test_one_row_of_each_group_stays(cases, share):
    left = exact_dedup.drop_copies(cases, share)
    assert left.schema == cases.schema
    rows = left.collect()
    digests = [digest(r["text"]) for r in rows]
    assert len(set(digests)) == len(digests) == len({digest(r["text"]) for r in cases.collect()})
    assert {r["doc_id"] for r in rows} == {1, 2, 4, 5, 7, 8, 9, 10, None}


def test_empty_table(nothing):
    assert exact_dedup.annotate_copies(nothing).count() == 0
    assert exact_dedup.drop_copies(nothing).count() == 0


def test_heavy_hitters_are_exact(spark):
    rows = [("hot",)] * 400 + [("warm",)] * 60 + [(f"k{i}",) for i in range(500)] + [(None,)] * 50
    df = spark.createDataFrame(rows, "k string").repartition(7)
    assert sorted(heavy_hitters(df, "k", 0.05)) == [("hot", 400), ("warm", 60)]
    assert heavy_hitters(df.where("k is null"), "k") == []
