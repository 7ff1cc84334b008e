import hashlib
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from rowsmith.llm import secrets
from rowsmith.llm.queries import LLM_QUERIES

ASSIGN = re.compile(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def brute(text):
    """The base spans, straight from the patterns."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if m.end() - m.start() >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if m.end() - m.start() >= 24]
    return [f"{secrets.KINDS[k]}:{s}:{e}" for s, k, e in sorted(found)]


PARTS = ["password", "TOKEN", "api_key", "apikey", "secret", '"', "'", " ", ":", "=", "AKIA", "ABCDEF0123456789XYZ", "deadbeef", "0123456789abcdef", "é", "K", "ſ", "x.y-z/", "\n"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=20).map("".join))
def test_base_spans(text):
    assert [f"{k}:{s}:{e}" for s, e, k in secrets.base_spans(text)] == brute(text)


def check(rows, docs):
    want = []
    for i, text in docs:
        spans = brute(text or "")
        counts = tuple(sum(s.startswith(k + ":") for s in spans) for k in secrets.KINDS)
        want.append((i, *counts, hashlib.sha256(",".join(spans).encode()).hexdigest()))
    assert sorted([(r["doc_id"], r["n_assign"], r["n_access"], r["n_hex"], r["base_sha256"]) for r in rows], key=repr) == sorted(want, key=repr)
    texts = dict(docs)
    for r in rows:
        spans = [s for s in r["spans"].split(",") if s]
        assert [s for s in spans if not s.startswith("learned")] == brute(texts[r["doc_id"]] or "")
        assert sum(s.startswith("learned") for s in spans) == r["n_learned"]


def test_query(spark, sf_dir):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    check(LLM_QUERIES["op1_secrets"](spark, sf_dir).collect(), docs)


def test_cases(cases, nothing):
    check(secrets.scan(cases).where("doc_id is not null").collect(), [(r["doc_id"], r["text"]) for r in cases.collect() if r["doc_id"] is not None])
    assert secrets.scan(nothing).count() == 0
    clean = secrets.redact(cases)
    assert clean.schema == cases.schema
    before, after = ({(r["doc_id"], i): r for i, r in enumerate(sorted(d.collect(), key=repr))} for d in (cases, clean))
    changed = [r for r in clean.collect() if r["text"] is not None and "[secret]" in r["text"]]
    assert [r["doc_id"] for r in changed] == [9] and changed[0]["n_chars"] == len(changed[0]["text"])
    assert changed[0]["text"] == '[secret]" and <|endoftext|> é 日本'
    assert len(before) == len(after)
    assert secrets.redact(nothing).count() == 0


def sample(rng, n):
    """Labelled findings: hexadecimal secrets in assignments, and long words in prose."""
    items, y, digits, raw = [], [], [], []
    for i in range(n):
        token = "".join(rng.choices("0123456789abcdef", k=40)) if i % 2 else "".join(rng.choices(["th", "er", "ing", "ou", "an", "tion"], k=7))
        before, after = ('said token = "', '" then') if i % 2 else ("and so the ", " went on.")
        raw.append((before, token, after))
        items.append(secrets.symbols(before, token, after))
        y.append(float(i % 2))
        digits.append(bool(i % 2))
    return items, np.array(y), np.array(digits), raw


def test_network_separates_held_out_findings():
    rng = random.Random(2)
    items, y, digits, _ = sample(rng, 400)
    net = secrets.train(items, y, digits, epochs=8)
    fresh, z, d, _ = sample(rng, 200)
    p = net.probabilities(fresh)
    assert ((p >= 0.5) == (z == 1)).mean() > 0.97
    assert net.accepts(fresh, d)[z == 1].mean() >= 0.95
    assert not net.accepts(fresh, d)[z == 0].any()


def test_gradient_step_matches_pooling_of_any_length():
    """A candidate of any length is pooled over all its windows, alone or among others."""
    rng = random.Random(3)
    items, y, digits, _ = sample(rng, 100)
    net = secrets.train(items, y, digits, epochs=2)
    long = secrets.symbols("a ", "Ab9" * 5000, " b")
    together = net.logits([items[0], long, items[1]])
    assert together[1] == pytest.approx(net.logits([long])[0])


def test_learned_spans_are_added(spark):
    """Secrets that no pattern knows are found once the network has seen enough labelled ones."""
    rng = random.Random(5)
    _, _, _, raw = sample(rng, 300)
    rows = [(i, f"{b}{t}{a}") for i, (b, t, a) in enumerate(raw)]
    hidden = "".join(rng.choices("0123456789abcdef", k=20)) + "_" + "".join(rng.choices("0123456789abcdef", k=20))
    rows.append((1000, f'said taken = "{hidden}" then'))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r for r in secrets.scan(docs).collect()}
    assert got[1000]["spans"] == f"learned:14:{14 + len(hidden)}"
    assert sum(r["n_learned"] for r in got.values()) == 1
    left = {r["doc_id"]: r["text"] for r in secrets.redact(docs).collect()}
    assert left[1000] == 'said taken = "[secret]" then'


def test_all_findings_are_learnt_from(spark, monkeypatch):
    """Slices, calibration and thresholds take in every distinct finding, long ones too; tables give what arrays give."""
    rng = random.Random(7)
    _, _, _, raw = sample(rng, 400)
    raw.append(('token = "', "a1" * 400, '"'))
    found = [[{"start": 0, "stop": 1, "before": b, "token": t, "after": a, "secret": "token" in b}] for b, t, a in raw]
    rows = spark.createDataFrame([(f,) for f in found], "found array<struct<start:int,stop:int,before:string,token:string,after:string,secret:boolean>>")
    read = []
    train_round, logits = secrets._train_round, secrets._held_logits
    monkeypatch.setattr(secrets, "_train_round", lambda r, *a: (read.append((r.count(), r.select("half", "part").distinct().count())), train_round(r, *a))[1])
    monkeypatch.setattr(secrets, "_held_logits", lambda r, *a: (read.append((r.count(), 0)), logits(r, *a))[1])
    networks = secrets.learn(rows, part=50)
    assert read[0][0] + read[-1][0] == len(set(raw)) and read[0][1] > 4 and len(read) == secrets.ROUNDS + 1
    fresh, z, d, _ = sample(rng, 100)
    assert all((net.accepts(fresh, d) == (z == 1)).mean() > 0.9 for net in networks)


def test_thresholds_of_tables(spark):
    rng = np.random.default_rng(1)
    y = rng.integers(0, 2, 500)
    x = np.round(rng.normal(3 * y - 1.5, 1.5), 2)
    held = spark.createDataFrame([(bool(s), float(v)) for s, v in zip(y, x)], "secret boolean, x double")
    assert secrets._calibrated(held) == pytest.approx(secrets._calibrate(x, y))
    a, b = secrets._calibrate(x, y)
    p = 1 / (1 + np.exp(-(a * x + b)))
    assert secrets._limit(held, (a, b), 0.6) == pytest.approx(secrets._threshold(p, y, 0.6))
    assert [secrets._kth(held, k) for k in (0, 7, 499)] == [np.sort(x)[k] for k in (0, 7, 499)]
