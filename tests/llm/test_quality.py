import math
import zlib

import numpy as np
from pyspark.sql import functions as F

from rowsmith.llm import quality
from rowsmith.llm.queries import LLM_QUERIES


def test_query_and_held_out_accuracy(spark, sf_dir):
    rows = LLM_QUERIES["op4_quality"](spark, "/root/testdata/sf0.01").collect()
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    assert len(rows) == spark.read.parquet("/root/testdata/sf0.01/documents.parquet").count()
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7)
    held = [(r["predicted"], labels[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert sum(p == q for p, q in held) / len(held) >= 0.95


def labelled(spark, n=160):
    good = "Plain words follow each other here, in a calm line {}. "
    docs = [(i, (good.format(i) * 30) if i % 4 else (good.format(i) * 20 + "BUY!! NOW!! *** $$$ " * 25), "digest", i) for i in range(n)]
    labels = [(i, int(i % 4 != 0), 0) for i in range(n)]
    return (
        spark.createDataFrame(docs, "doc_id bigint, text string, score string, held_out int"),
        spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"),
    )


def test_learns_from_bags_and_never_from_held_out_rows(spark):
    docs, labels = labelled(spark)
    model = quality.train(docs, labels)
    got = {r["doc_id"]: r for r in quality.score(docs, model).collect()}
    assert all(r["predicted"] == int(i % 4 != 0) for i, r in got.items() if r["held_out"])
    # Wrong labels of held out rows change nothing, nor do copies, nulls and contradictions.
    wrong = labels.selectExpr("doc_id", "CASE WHEN crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 4 = 2 THEN 1 - quality ELSE quality END AS quality", "toxic")
    more = spark.createDataFrame([(None, 1, 0), (5000, None, 0), (5001, 0, 0), (5001, 1, 0), (5002, 7, 0)], labels.schema)
    other = quality.train(docs, wrong.unionByName(labels.limit(0)).unionByName(more))
    assert all(np.array_equal(other.weights[k], v) for k, v in model.weights.items())
    kept = quality.keep_good(docs, model)
    assert kept.schema == docs.schema and {r["doc_id"] for r in kept.collect()} == {i for i, r in got.items() if r["predicted"]}


def test_cases(spark, cases, nothing):
    docs, labels = labelled(spark)
    model = quality.train(docs, labels)
    assert quality.score(cases, model).count() == cases.count()
    assert quality.score(nothing, model).count() == 0 == quality.keep_good(nothing, model).count()
    empty = {r["doc_id"]: r["score"] for r in quality.score(cases, model).collect() if r["doc_id"] in (2, 3)}
    assert empty[2] == empty[3] and 0 <= empty[2] <= 1
    assert quality.train(docs, labels.limit(0)).constant == 1.0
    assert quality.train(docs, labels.where("quality = 1")).constant == 1.0
    assert quality.train(nothing, labels).constant > 0.5


def test_passages_cover_every_byte():
    texts = [b"", b"a b " * 1000, b"x" * quality.PASSAGE, b"y" * (quality.PASSAGE + 1)]
    features, counts = quality.passages(texts)
    assert counts.tolist() == [1, 6, 1, 2] and features.shape == (10, quality.FEATURES)
    alone = np.concatenate([quality.passages([t])[0] for t in texts])
    assert np.array_equal(features, alone)


def test_gradient():
    """The gradient of the loss, against differences."""
    rng = np.random.default_rng(0)
    counts = np.array([3, 1, 4])
    x, y, weight = rng.normal(size=(8, 5)), np.array([1.0, 0.0, 1.0]), np.array([1.0, 2.0, 0.5])
    w = {"W": rng.normal(size=(5, 4)), "b": rng.normal(size=4), "V": rng.normal(size=(4, 3)), "U": rng.normal(size=(4, 3)), "a": rng.normal(size=3), "c": rng.normal(size=4), "d": rng.normal(size=1)}

    def loss():
        p = quality._forward(w, x, counts)["p"]
        return -(weight * (y * np.log(p) + (1 - y) * np.log(1 - p))).sum() / weight.sum()

    grad = quality._gradient(w, x, counts, y, weight)
    for k, v in w.items():
        for i in np.ndindex(v.shape):
            old = v[i]
            v[i] = old + 1e-5
            up = loss()
            v[i] = old - 1e-5
            down = loss()
            v[i] = old
            assert abs((up - down) / 2e-5 - grad[k][i]) < 1e-6


def test_long_documents_are_learnt_from(spark):
    """Passages of every part of a text that has more of them than a bag holds."""
    text = b"".join(bytes([65 + i % 26]) * quality.PASSAGE for i in range(10)) + b"end"
    parts = [quality.spread(text, 4)[i : i + quality.PASSAGE] for i in range(0, 4 * quality.PASSAGE, quality.PASSAGE)]
    assert [set(p.decode()) for p in parts] == [{"A"}, {"C"}, {"F"}, {"I"}] and quality.spread(text, 11) == text
    docs, labels = labelled(spark, 80)
    long = docs.withColumn("text", F.when(F.col("doc_id") % 4 == 0, F.repeat(F.lit("BUY!! NOW!! *** "), 300)).otherwise(F.repeat("text", 3)))
    model = quality.train(long, labels, bag=3)
    got = {r["doc_id"]: r for r in quality.score(long, model).collect()}
    assert model.constant is None and all(r["predicted"] == int(i % 4 != 0) for i, r in got.items())


def test_repeated_documents_count_once(spark):
    docs, labels = labelled(spark, 40)
    first = docs.where("doc_id = 1")
    many = docs.unionByName(spark.range(200).join(first, F.lit(True)).drop("id"))
    assert all(np.array_equal(quality.train(many, labels).weights[k], v) for k, v in quality.train(docs, labels).weights.items())


def test_scores_against_a_plain_version(spark):
    """The forward pass, passage by passage with plain loops."""
    docs, labels = labelled(spark, 60)
    model = quality.train(docs, labels)
    w = model.weights
    for r in quality.score(docs, model).collect():
        text = docs.where(F.col("doc_id") == r["doc_id"]).first()["text"].encode() if r["doc_id"] % 15 == 0 else None
        if text is None:
            continue
        encoded, _ = quality.passages([text])
        hidden, gates = [], []
        for x in encoded:
            z = [min(8, max(-8, (a - m) / s)) for a, m, s in zip(x, model.mean, model.scale)]
            h = [math.tanh(sum(a * b for a, b in zip(z, col)) + bias) for col, bias in zip(w["W"].T, w["b"])]
            t = [math.tanh(sum(a * b for a, b in zip(h, col))) for col in w["V"].T]
            g = [1 / (1 + math.exp(-sum(a * b for a, b in zip(h, col)))) for col in w["U"].T]
            hidden.append(h)
            gates.append(sum(a * b * c for a, b, c in zip(w["a"], t, g)))
        weight = [math.exp(e) for e in gates]
        bag = [sum(a * h[i] for a, h in zip(weight, hidden)) / sum(weight) for i in range(len(hidden[0]))]
        logit = sum(a * b for a, b in zip(bag, w["c"])) + w["d"][0]
        assert abs(1 / (1 + math.exp(-logit)) - r["score"]) < 1e-5
