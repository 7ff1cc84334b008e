import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from rowsmith.llm import language_model as lm
from rowsmith.llm.queries import LLM_QUERIES
from rowsmith.session import Scratch


def tokens(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", low) + [None]


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 7 == 2


def brute(rows):
    """``held_out, n_tokens, n_known, train_tokens`` and the base score, row by row."""
    counts = Counter()
    for i, text in rows:
        if not held(i):
            counts.update(tokens(text))
    total, words = sum(counts.values()), len(counts)
    out = []
    for i, text in rows:
        found = tokens(text)
        base = math.fsum(math.log10((counts[t] + 1) / (total + words + 1)) for t in found)
        out.append((i, held(i), len(found), sum(counts[t] > 0 for t in found), total, base))
    return out


def check(rows, got):
    def order(r):
        return (r[0] is None, r[0] or 0, r[2], r[5])

    want, have = sorted(brute(rows), key=order), sorted((tuple(r)[:6] for r in got), key=order)
    assert [w[:5] for w in want] == [h[:5] for h in have]
    assert np.allclose([w[5] for w in want], [h[5] for h in have], rtol=1e-12)
    assert all(math.isfinite(r["score"]) and r["score"] <= 0 for r in got)


COLUMNS = ("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


@pytest.mark.parametrize("known", [lm.KNOWN, 600])
def test_documents(spark, sf_dir, monkeypatch, known):
    """Counts and base scores of a plain loop, with all words known to the tasks and with most of them joined."""
    monkeypatch.setattr(lm, "KNOWN", known)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = LLM_QUERIES["op12_language_model"](spark, sf_dir).select(*COLUMNS).collect()
    check([(r["doc_id"], r["text"]) for r in docs.collect()], got)


def test_learns(spark, sf_dir):
    """The trained model explains held-out documents better than the base, though it read only a few documents."""
    got = LLM_QUERIES["op12_language_model"](spark, sf_dir.replace("sf0.001", "sf0.01"))
    base, score = got.where("held_out").agg(F.sum("base_score"), F.sum("score")).first()
    assert score > 0.97 * base


def test_cases(spark, cases, nothing, monkeypatch):
    rows = [(r["doc_id"], r["text"]) for r in cases.collect()]
    check(rows, lm.score(cases.withColumn("score", F.lit(1)).withColumn("row", F.lit(1))).select(*COLUMNS).collect())
    monkeypatch.setattr(lm, "COUNTED", 2)
    monkeypatch.setattr(lm, "STRETCH", 10)
    check(rows, lm.score(cases).select(*COLUMNS).collect())
    assert lm.score(nothing).count() == 0
    # Nothing to learn from: counts of 0, and still a score.
    only = [(i, "some words " * 3) for i in range(200) if held(i)]
    check(only, lm.score(spark.createDataFrame(only, "doc_id bigint, text string")).select(*COLUMNS).collect())


def known_of(spark, words):
    frame = spark.createDataFrame([(bytearray(w), n) for w, n in words.items()], "key binary, n bigint")
    with Scratch(spark, "test") as scratch:
        return lm.vocabulary(scratch.write(frame, "counts"))


def counted():
    words = {lm.END: 50} | {f"word{i}.".encode(): 4000 // (i + 2) for i in range(1500)}
    return words | {b"\x00odd": 3, b"x": 2, "é".encode(): 9}


def random_model(scale=0.3):
    rng = np.random.default_rng(5)
    return lm.Model(rng.normal(0, scale, sum(int(np.prod(s)) for s in lm.Model.shapes())).astype(np.float32))


def test_probabilities_add_up(spark):
    """Over all counted words and one unseen word of each class, after any context."""
    words = counted()
    known = known_of(spark, words)
    assert known.total == sum(words.values()) and known.words == len(words)
    model, n = random_model(), lm.SHORT + lm.CLASSES
    for context in ([n, n], [3, n], [n - 1, 5]):
        symbols = np.arange(n)
        p = np.exp(lm.log_probabilities(model, symbols, np.array([context] * n, dtype=np.int32)))
        assert abs(p.sum() - 1) < 1e-5
        whole = sum(p[s] * 10**w for s, w in zip(known.symbol[: len(known.keys)], known.within))
        whole += sum(p[lm.SHORT + c] / (known.class_total[c] + known.class_words[c] + 1) for c in range(lm.CLASSES))
        assert abs(whole - 1) < 1e-5


def test_scores_of_a_plain_loop(spark, monkeypatch):
    """Products over distinct contexts, stretches and joins give what one token after another gives."""
    monkeypatch.setattr(lm, "KNOWN", 700)
    words, model = counted(), random_model()
    monkeypatch.setattr(lm, "train", lambda rows, known: model)
    monkeypatch.setattr(lm, "token_counts", lambda rows: rows.sparkSession.createDataFrame([(bytearray(w), n) for w, n in words.items()], "key binary, n bigint"))
    rng = np.random.default_rng(6)
    vocabulary = [w.decode() for w in words if w] + ["never", "seen", "WORD3.", "z" * 5000]
    rows = [(i, " ".join(rng.choice(vocabulary, rng.integers(0, 60)))) for i in range(40)]
    got = {r["doc_id"]: r["score"] for r in lm.score(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    r, c, q, b = (p.astype(np.float64) for p in model.parts())
    order = sorted(words, key=lambda w: (w != lm.END, -words[w], w))
    short = {w: k for k, w in enumerate(order[: lm.SHORT])}
    sizes = Counter()
    for w, n in words.items():
        if w not in short:
            sizes[zlib.crc32(w[-2:]) % lm.CLASSES] += n + 1
    for i, text in rows:
        symbols, total = [lm.SHORT + lm.CLASSES] * lm.CONTEXT, 0.0
        for t in tokens(text):
            w = lm.END if t is None else lm.words_of(t.encode())[0]
            of_class = zlib.crc32(w[-2:]) % lm.CLASSES
            s = short.get(w, lm.SHORT + of_class)
            predicted = sum(r[symbols[-1 - k]] * c[k] for k in range(lm.CONTEXT))
            scores = q @ predicted + b
            total += (scores[s] - np.log(np.exp(scores).sum())) / math.log(10)
            if w not in short:
                total += math.log10((words.get(w, 0) + 1) / (sizes[of_class] + 1))
            symbols.append(s)
        assert abs(total - got[i]) < 1e-3 * max(1, abs(total))


def test_blocks_of_products():
    rng = np.random.default_rng(8)
    x, y, z = (rng.normal(size=s).astype(np.float32) for s in ((1001, 32), (32, 512), (1001, 64)))
    assert np.allclose(lm.product(x, y), x @ y, atol=1e-4) and np.allclose(lm.product(x[:3], y), x[:3] @ y, atol=1e-4)
    assert np.allclose(lm.inner_product(z, x), z.T @ x, atol=1e-3) and lm.product(x[:0], y).shape == (0, 512)


def test_frequent_words_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(lm, "KNOWN", 50)
    counts = spark.createDataFrame([(bytearray(f"w{i}".encode()), 1 + i // 30) for i in range(300)] + [(bytearray(lm.END), 2)], "key binary, n bigint")
    got = lm.frequent(counts)
    assert got[0] == (lm.END, 2) and {k for k, _ in got[1:]} == {f"w{i}".encode() for i in range(270, 300)}
    monkeypatch.setattr(lm, "KNOWN", 20)
    assert lm.frequent(counts.where("n = 1")) == [(lm.END, 0)]


def test_gradient():
    """A small first step goes up the noise-contrastive objective."""
    rng = np.random.default_rng(7)
    n = lm.SHORT + lm.CLASSES
    noise = rng.random(n) + 0.1
    noise /= noise.sum()
    symbols = rng.choice(20, 800)
    context = lm.contexts(symbols, np.array([0, 300]))
    model = lm.Model.fresh(noise)

    def logs(m):
        return lm.log_probabilities(m, symbols, context).mean()

    before, moments = logs(model), np.zeros_like(model.weights)
    for _ in range(60):
        lm.train_steps(model, symbols, context, noise, rng, lm.RATE, moments)
    assert logs(model) > before + 1


def test_contexts():
    start = lm.SHORT + lm.CLASSES
    got = lm.contexts(np.array([1, 2, 3, 4, 9, 8]), np.array([0, 4]))
    assert got.tolist() == [[start, start], [1, start], [2, 1], [3, 2], [start, start], [9, start]]


def test_class_of_a_word(spark):
    """Tasks and the join place words in the same classes."""
    keys = [b"", b"x", b"ab", b"long word", b"\x00\xff", "日本".encode()]
    rows = spark.createDataFrame([(bytearray(k),) for k in keys], "key binary").select("key", lm.class_column("key").alias("c")).collect()
    assert all(r["c"] == lm.class_of(bytes(r["key"])) for r in rows)


def test_long_words_keep_apart():
    a, b, short = b"a" * 5000, b"a" * 4999 + b"b", b"a" * 40
    keys = lm.words_of(b" ".join([a, b, a, short]))
    assert keys[0] == keys[2] != keys[1] and keys[3] == short and all(len(k) <= 41 for k in keys)


def test_symbols_of_whole_texts(spark):
    """All words at once get the symbols that one word after another gets."""
    long = "y" * 300
    words = counted() | {lm.words_of(long.encode())[0]: 5000, b"eight888": 3000, b"nine99999": 2900, b"a" * 40: 2800}
    known = known_of(spark, words)
    texts = ["", " ", "Word3. word3. x", f"\n{long} {'z' * 41} eight888 nine99999 eight88 nine9999", "a" * 40 + "\t" + "a" * 39, "é\x0b日本\x0cX \x00 \x00odd\r\n", "é", ""]
    texts = [t.encode() for t in texts + [" ".join(k.decode() for k in words if k.isascii())]]
    for some in (texts, texts[:1], texts[2:3]):
        flat, starts, _ = lm.coded(some, lm.Codes(known))
        got, places = lm.Symbols(known).of(some)
        assert got.tolist() == known.symbol[flat].tolist() and places.tolist() == starts.tolist()
    only = known_of(spark, {lm.END: 1})
    assert lm.Symbols(only).of([b"a", b""])[0].tolist() == [lm.SHORT + lm.class_of(b"a"), 0, 0]


def test_groups_of_one_context():
    rng = np.random.default_rng(4)
    context = rng.integers(0, 4, (900, 2)).astype(np.int32)
    order, starts = lm.shared_contexts(context, 16, rng)
    assert sorted(order) == list(range(900))
    for group in np.split(order, starts[1:]):
        assert 0 < len(group) <= 16 and len({tuple(context[i]) for i in group}) == 1


def test_a_step_of_a_plain_loop():
    """One step over tokens that share contexts equals the sum over tokens."""
    rng, n = np.random.default_rng(9), lm.SHORT + lm.CLASSES
    noise = np.full(n, 1 / n)
    symbols = rng.integers(0, 6, 64)
    context = rng.integers(0, 2, (64, 2)).astype(np.int32)
    model = random_model()
    r, c, q, b = (p.astype(np.float64) for p in model.parts())
    rng.bit_generator.state = state = np.random.default_rng(3).bit_generator.state
    lm.shared_contexts(context, 2048 // lm.SHARE, rng)
    drawn = np.minimum(np.searchsorted(np.cumsum(noise), rng.random(lm.NOISE)), n - 1)
    want = [np.zeros_like(p) for p in (r, c, q, b)]
    for s, ctx in zip(symbols, context):
        predicted = sum(r[ctx[k]] * c[k] for k in range(2))
        for other, sign in [(s, 1)] + [(d, -1) for d in drawn]:
            score = q[other] @ predicted + b[other] - math.log(noise[other] * lm.NOISE)
            g = sign / (1 + math.exp(sign * score)) / 64
            want[2][other] += g * predicted
            want[3][other] += g
            for k in range(2):
                want[0][ctx[k]] += g * q[other] * c[k]
                want[1][k] += g * q[other] * r[ctx[k]]
    flat = np.concatenate([w.ravel() for w in want])
    before, moments = model.weights.copy(), np.zeros_like(model.weights)
    rng.bit_generator.state = state
    lm.train_steps(model, symbols, context, noise, rng, 0.1, moments)
    assert np.allclose(model.weights - before, 0.1 * flat / np.sqrt(flat * flat + 1e-8), atol=2e-3)
    lm.train_steps(model, symbols[:0], context[:0], noise, rng, 0.1, moments)


def test_totals_of_contexts_are_kept(monkeypatch):
    """A context is multiplied with all symbols once, and later calls give the same."""
    model, n = random_model(), lm.SHORT + lm.CLASSES
    rng = np.random.default_rng(4)
    symbols, context = rng.integers(0, n, 500), rng.integers(0, 6, (500, 2)).astype(np.int32)
    alone, totals = lm.log_probabilities(model, symbols, context), lm.fresh_totals()
    first = lm.log_probabilities(model, symbols[:300], context[:300], totals)
    assert np.isfinite(totals).sum() == len({tuple(c) for c in context[:300]})
    rows = []
    product = lm.product
    monkeypatch.setattr(lm, "product", lambda x, y: (rows.append(len(x)), product(x, y))[1])
    again = lm.log_probabilities(model, symbols, context, totals)
    assert sum(rows) == len({tuple(c) for c in context}) - len({tuple(c) for c in context[:300]})
    assert np.allclose(first, alone[:300]) and np.allclose(again, alone)
