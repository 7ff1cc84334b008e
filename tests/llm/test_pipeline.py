import os
import sys

import corpus_pipeline
from rowsmith.llm import quality, secrets
from tests.llm.test_exact_dedup import digest
from tests.llm.test_minhash import brute


def test_stages_against_brute_force(spark, sf_dir, tmp_path):
    """Each stage on all that its predecessor kept, against a plain version of the same decision."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality_classifier", "exact_dedup", "minhash_near_dedup", "secret_scan", "packing"]
    kept = []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf_dir)
        if name != "packing":
            assert out.columns == docs.columns
        path = str(tmp_path / name)
        out.write.parquet(path)
        before = sorted(docs.collect(), key=lambda r: r["doc_id"])
        docs = spark.read.parquet(path)
        kept.append((name, before, docs.collect()))
    by = {name: (before, {r["doc_id"]: r for r in after}) for name, before, after in kept[:-1]}

    before, after = by["quality_classifier"]
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    good = [r["doc_id"] for r in before if labels.get(r["doc_id"]) == 1]
    bad = [r["doc_id"] for r in before if labels.get(r["doc_id"]) == 0]
    assert sum(i in after for i in good) >= 0.98 * len(good) and sum(i in after for i in bad) <= 0.3 * len(bad)

    before, after = by["exact_dedup"]
    smallest = {}
    for r in before:
        smallest.setdefault(digest(r["text"]), r["doc_id"])
    assert set(after) == set(smallest.values())

    before, after = by["minhash_near_dedup"]
    assert set(after) == {i for i, (_, c) in brute([(r["doc_id"], r["text"]) for r in before], 5).items() if i == c}

    before, after = by["secret_scan"]
    assert len(after) == len(before)
    for r in before:
        spans = secrets.base_spans(r["text"])
        assert (after[r["doc_id"]]["text"] == r["text"]) or "[secret]" in after[r["doc_id"]]["text"]
        assert not secrets.base_spans(after[r["doc_id"]]["text"]) and (not spans or after[r["doc_id"]]["text"] != r["text"])
        assert after[r["doc_id"]]["n_chars"] == len(after[r["doc_id"]]["text"])

    _, before, after = kept[-1]
    pieces = {}
    for r in after:
        pieces.setdefault(r["doc_id"], []).append((r["start"], r["length"], r["doc_tokens"]))
    assert set(pieces) == {r["doc_id"] for r in before}
    assert all(sum(n for _, n, _ in p) == p[0][2] for p in pieces.values())
    run = corpus_pipeline.run(spark, sf_dir)
    key = lambda r: (r["doc_id"], r["start"], r["length"], r["ids_crc32"])
    assert sorted(map(key, run.collect())) == sorted(map(key, after))


def test_scratch_is_removed(spark, sf_dir):
    """Operators leave nothing behind but the tables that back their results."""
    root = spark.conf.get("spark.checkpoint.dir").removeprefix("file:") + f"/rowsmith/{spark.sparkContext.applicationId}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = set(os.listdir(root)) if os.path.isdir(root) else set()
    quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    secrets.redact(docs).count()
    assert set(os.listdir(root)) == before if os.path.isdir(root) else not before


def test_the_rest_does_without(spark):
    """Without the optional modules the entry module still has the other queries."""
    import importlib

    import __spark_entry__

    hidden = {k: sys.modules.pop(k) for k in list(sys.modules) if k == "corpus_pipeline" or k.startswith("rowsmith.llm")}
    try:
        sys.modules["corpus_pipeline"] = None  # an import of it now fails
        module = importlib.reload(__spark_entry__)
        assert module.queries() and not any(k.startswith("op") and k[2].isdigit() for k in module.queries())
    except ModuleNotFoundError as e:
        assert e.name == "corpus_pipeline"
    finally:
        sys.modules.pop("corpus_pipeline", None)
        sys.modules.update(hidden)
        importlib.reload(__spark_entry__)
