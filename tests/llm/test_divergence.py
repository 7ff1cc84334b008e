import random
import re
from collections import Counter, defaultdict

import pytest

from rowsmith.llm import divergence
from rowsmith.llm.queries import LLM_QUERIES


def brute(rows, least=10, top=10):
    counts, df, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        terms = re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", low)
        groups.add((lang, source))
        counts[lang, source].update(terms)
        df[lang].update(set(terms))
    out = set()
    for lang in {g[0] for g in groups}:
        kept = sorted(t for t, n in df[lang].items() if n >= least)
        sources = sorted(s for g, s in groups if g == lang)

        def shares(c):
            total = sum(c[t] for t in kept) + 2 * len(kept)
            return {t: 1 + 10**9 * (c[t] + 2) // total for t in kept}

        p = {s: shares(counts[lang, s]) for s in sources}
        q = shares(sum((counts[lang, s] for s in sources), Counter()))

        def f(x, y):
            return (x - y) ** 2 // (x + y)

        for s in sources:
            pairs = [("pair", o, sum(f(p[s][t], p[o][t]) for t in kept)) for o in sources if o != s]
            terms = [("term", t, f(p[s][t], q[t])) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, limit in ((pairs, None), (terms, top)):
                order = sorted(part, key=lambda x: (-x[2], x[1].encode()))[:limit]
                out |= {(lang, s, kind, item, value, i + 1) for i, (kind, item, value) in enumerate(order)}
    return out


def got(df):
    rows = [tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def rows_of(docs):
    return [(r["text"], r["lang"], r["source"]) for r in docs.select("text", "lang", "source").collect()]


def test_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert got(LLM_QUERIES["op11_divergence"](spark, sf_dir)) == brute(rows_of(docs))


def made(seed, rows=300):
    """Hot sources, copies in many sources, sources without kept terms, ties, nulls beside empty strings."""
    rng = random.Random(seed)
    copies = [" ".join(f"w{'abcdefgh'[rng.randrange(8)] * rng.randint(1, 3)}" for _ in range(30)) for _ in range(4)]
    out = []
    for i in range(rows):
        text = rng.choice(copies) if rng.random() < 0.4 else " ".join(rng.choice(["Alpha", "beta", "gämma", "delta9x", "日本", "rare" + "xyz"[i % 3] * (i % 40)]) for _ in range(rng.randint(0, 12)))
        source = "hot" if rng.random() < 0.35 else f"s{rng.randrange(23)}"
        out.append((rng.choice([text, text, text, None, ""]), rng.choice(["en", "en", "de", "", None]), rng.choice([source, source, source, None, ""])))
    return out + [("nothing kept here", "lone", "a"), ("", "lone", "b"), ("single", "one", "only")]


@pytest.mark.parametrize("seed", [0, 1])
def test_blocks_and_copies(spark, seed, monkeypatch):
    rows = made(seed)
    docs = spark.createDataFrame(rows, "text string, lang string, source string")
    want = brute(rows)
    assert got(divergence.audit(docs)) == want
    for name, value in (("SPREAD", 2), ("COUNTED", 5)):
        monkeypatch.setattr(divergence, name, value)
    real = divergence.pair_values
    monkeypatch.setattr(divergence, "pair_values", lambda *a: real(*a, sources=4, terms=3))
    assert got(divergence.audit(docs)) == want
    assert got(divergence.audit(docs, least=2, top=3)) == brute(rows, 2, 3)


def test_cases(spark, cases, nothing):
    """The shared fixture has no source column, and columns named like the operator's own."""
    from pyspark.sql import functions as F

    rows = cases.withColumn("source", F.when(F.col("doc_id") > 5, "a")).withColumn("value", F.lit(1)).withColumn("rank", F.lit(2)).withColumn("term", F.lit("x"))
    assert got(divergence.audit(rows, least=2)) == brute(rows_of(rows), 2)
    assert got(divergence.audit(rows)) == brute(rows_of(rows))
    assert divergence.audit(nothing.withColumn("source", F.lit("a"))).count() == 0


def test_copies_are_tokenised_once(spark, monkeypatch):
    """A text that many rows share reaches the tokeniser in one row."""
    rows = [("shared words of many", "en", f"s{i % 7}") for i in range(200)] + [(f"own {i}", "en", "x") for i in range(20)]
    docs = spark.createDataFrame(rows, "text string, lang string, source string").repartition(5)
    sizes, real = [], divergence.tokenised

    def counted(texts):
        sizes.append(texts.count())
        return real(texts)

    monkeypatch.setattr(divergence, "tokenised", counted)
    assert got(divergence.audit(docs)) == brute(rows)
    assert sizes == [1]


def test_large_counts_stay_exact(spark):
    one = spark.createDataFrame([(8 * 10**15, 9 * 10**15 + 7, 10**7)], "n bigint, total bigint, terms bigint")
    p = one.select(divergence.share("n", "total", "terms")).first()[0]
    assert p == 1 + 10**9 * (8 * 10**15 + 2) // (9 * 10**15 + 7 + 2 * 10**7)
