import re
import zlib
from collections import Counter

import numpy as np
import pytest

from rowsmith.llm import spelling
from rowsmith.llm.queries import LLM_QUERIES


def near(a, b):
    """Exactly one code point inserted, deleted or replaced."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(rows):
    counts = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    n = {w: c for w, c in counts.items() if len(w) >= 5 and c >= 3}
    # Near words share a word that lacks one letter of either, or are such a word.
    lacking = {}
    for w in n:
        for k in {w} | {w[:i] + w[i + 1 :] for i in range(len(w))}:
            lacking.setdefault(k, set()).add(w)
    out, form = {}, {}
    for w in n:
        others = set().union(*(lacking[k] for k in {w} | {w[:i] + w[i + 1 :] for i in range(len(w))}))
        others = {v for v in others if near(w, v)}
        best = min(others, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
        out[w] = len(others)
    def root(w):
        while form[w] is not None:
            w = form[w]
        return w
    return {(w, form[w], root(w), n[w], out[w], None if form[w] is None else n[form[w]]) for w in n}


def got(df):
    rows = df.select("word", "form", "root", "n", "n_near", "form_n").collect()
    assert len(rows) == len(set(rows))
    return {tuple(r) for r in rows}


def test_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    want = brute([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert len(want) > 1000 and any(f for _, f, *_ in want)
    assert got(LLM_QUERIES["op13_spelling"](spark, sf_dir)) == want


@pytest.mark.parametrize("symbols", [2, 9])
def test_chains_ties_and_lengths(spark, symbols):
    """Pointers over several steps, ties, letters beyond ASCII, a word of many letters and its variant."""
    long = "abcdefghij" * 300
    words = {"apple": 40, "appla": 12, "applé": 12, "bppla": 4, "bppl÷": 3, "pplaÿz": 3, "apples": 40, "aapple": 3, long: 9, long[:-1]: 4, "zzzzz": 3, "zzzzzz": 5, "other": 2}
    rows = [(i, f" {w}, " * n + "Ā一" + w.upper().replace("É", "É")) for i, (w, n) in enumerate(words.items())]
    want = brute(rows)
    assert {f for w, f, *_ in want if w == "bppla"} == {"appla"} and {r for w, _, r, *_ in want if w == "bppla"} != {"appla"}
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert got(spelling.group_variants(docs, symbols)) == want


def test_cases(spark, cases, nothing):
    rows = [(r["doc_id"], r["text"]) for r in cases.collect()]
    assert got(spelling.group_variants(cases)) == brute(rows)
    assert spelling.group_variants(nothing).count() == 0
    assert spelling.group_variants(cases.where("text = 'word'")).count() == 0


def test_counts_are_handed_on_in_parts(spark, cases, monkeypatch):
    """A task's counts and neighbours leave it in bounded parts, with the same sums."""
    monkeypatch.setattr(spelling, "COUNTED", 3)
    monkeypatch.setattr(spelling, "ROWS", 50)
    rows = [(r["doc_id"], r["text"]) for r in cases.collect()]
    assert got(spelling.group_variants(cases)) == brute(rows)


def test_neighbourhood_is_full():
    rng = np.random.default_rng(4)
    for n in (0, 1, 2, 5, 9):
        word = rng.integers(1, 4, n).astype(np.uint64)

        def hashed(w):
            return int(spelling.reduced_hash(np.array(w, dtype=np.uint64))[-1])

        w = word.tolist()
        want = {hashed(w)}
        want |= {hashed(w[:i] + w[i + 1 :]) for i in range(n)}
        want |= {hashed(w[:i] + [s] + w[i + 1 :]) for i in range(n) for s in (1, 2, 3)}
        want |= {hashed(w[:i] + [s] + w[i:]) for i in range(n + 1) for s in (1, 2, 3)}
        assert set(map(int, spelling.neighbourhood(word, 3))) == want


def test_few_symbols_for_all_letters():
    table = spelling.symbol_table(5)
    assert set(table[97:123]) == {1, 2, 3, 4, 5}
