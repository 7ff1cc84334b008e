import hashlib
import random
import struct
import zlib
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from rowsmith.llm import bpe, packing
from rowsmith.llm.queries import LLM_QUERIES


@pytest.fixture(scope="module")
def tokenizer(vocabulary):
    return Tokenizer.from_file(vocabulary)


def ids_of(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


ODD = ["a", " ", "\n", "  ", "'s", "9", "é", "!", "th", " the", "\t", "<|endoftext|>", "ing", " ", "日", "'", "\u0085", "²", "́", "🙂"]


def test_odd_mixtures(vocabulary, tokenizer):
    rng = random.Random(4)
    texts = ["".join(rng.choices(ODD, k=rng.randint(0, 40))) for _ in range(3000)]
    texts += ["x" * 5000 + " b", " " * 3000 + "z", "\n" * 2000, "-" * 300, "\x00\x01 \x7f", "a\r\n b \n"]
    for text, ids in zip(texts, bpe.encoder(vocabulary).encode_batch(texts)):
        want = ids_of(tokenizer, text)
        assert ids.tolist() == want
        packed = packing.token_bytes(text, vocabulary)
        assert list(struct.unpack(f"<{len(packed) // 4}I", packed)) == want
        assert bpe.encoder(vocabulary).decode(ids) == text == tokenizer.decode(want, skip_special_tokens=False)


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60))
def test_any_text(vocabulary, tokenizer, text):
    ids = bpe.encoder(vocabulary).encode_batch([text])[0]
    assert ids.tolist() == ids_of(tokenizer, text)
    assert bpe.encoder(vocabulary).decode(ids) == text


def test_caches_turn_over(vocabulary, tokenizer, monkeypatch):
    """Generations that hold next to nothing change no result."""
    monkeypatch.setattr(bpe, "GENERATION", 5)
    monkeypatch.setattr(bpe, "LONGEST_KEPT", 4)
    monkeypatch.setattr(bpe, "GROUP_CHARS", 30)
    own = bpe.Encoder(vocabulary)
    rng = random.Random(8)
    for _ in range(5):
        texts = ["".join(rng.choices(ODD, k=20)) for _ in range(60)]
        assert [i.tolist() for i in own.encode_batch(texts)] == [ids_of(tokenizer, t) for t in texts]


def test_broken_utf8_is_replaced(vocabulary, tokenizer):
    ids = ids_of(tokenizer, "日")[:1]
    import numpy as np

    assert bpe.encoder(vocabulary).decode(np.array(ids)) == tokenizer.decode(ids, skip_special_tokens=False)
    with pytest.raises(IndexError):
        bpe.encoder(vocabulary).decode(np.array([10_000_000]))


def check_round_trip(tokenizer, rows, docs):
    want = []
    for i, text in docs:
        ids = ids_of(tokenizer, text)
        want.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    assert sorted(map(tuple, rows), key=repr) == sorted(want, key=repr)


def test_encode_decode(vocabulary, tokenizer, cases, nothing, spark, sf_dir):
    docs = [(r["doc_id"], r["text"]) for r in cases.collect()]
    check_round_trip(tokenizer, bpe.round_trip(cases, vocabulary).collect(), docs)
    tokens = bpe.encode(cases, vocabulary)
    assert sorted([(r["doc_id"], r["ids"]) for r in tokens.collect()], key=repr) == sorted([(i, ids_of(tokenizer, t)) for i, t in docs], key=repr)
    assert sorted([(r["doc_id"], r["text"]) for r in bpe.decode(tokens, vocabulary).collect()], key=repr) == sorted([(i, t or "") for i, t in docs], key=repr)
    assert bpe.round_trip(nothing, vocabulary).count() == 0
    whole = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    check_round_trip(tokenizer, LLM_QUERIES["op6_bpe"](spark, sf_dir).collect(), whole)


def check_packing(tokenizer, rows, docs, capacity):
    """Every id in exactly one piece, sequences gapless and within capacity."""
    pieces = defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append((r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]))
    want = defaultdict(list)
    for i, text in docs:
        ids = ids_of(tokenizer, text) + [1]
        for at in range(0, len(ids), capacity):
            part = ids[at : at + capacity]
            want[i].append((at, len(part), zlib.crc32(struct.pack(f"<{len(part)}I", *part)), len(ids)))
    assert {k: sorted(v) for k, v in pieces.items()} == {k: sorted(v) for k, v in want.items()}
    sequences = defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    assert sorted(sequences) == list(range(len(sequences)))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return sum(r["length"] for r in rows) / (capacity * max(1, len(sequences)))


def test_pack(vocabulary, tokenizer, cases, nothing, spark, sf_dir, monkeypatch):
    docs = [(r["doc_id"], r["text"]) for r in cases.collect()]
    check_packing(tokenizer, packing.pack(cases, vocabulary, capacity=64).collect(), docs, 64)
    assert packing.pack(nothing, vocabulary).count() == 0
    monkeypatch.setattr(packing, "PLACES_BOUND", 0)  # the placement table is joined by a shuffle
    whole = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert check_packing(tokenizer, LLM_QUERIES["op2_packing"](spark, sf_dir).collect(), whole, 2048) > 0.97


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(1, 50), st.integers(1, 300), max_size=30))
def test_patterns_use_up_the_histogram(histogram):
    patterns = packing.pack_histogram(histogram, 50)
    used = Counter()
    for pattern, n in patterns:
        assert n > 0 and sum(pattern) <= 50
        for length in pattern:
            used[length] += n
    assert used == Counter(histogram)
    # At most one pattern in two is less than half full: two such would have been one.
    assert sum(n for p, n in patterns if sum(p) <= 25) <= 1
