"""Byte-level BPE encoding and decoding with a prefix-sharing trie.

A word's encoding is not found by merging pairs. For every prefix of a word there is exactly one
token that ends its encoding, the *last token* of the prefix: the vocabulary entry that is a suffix
of the prefix and forms a stable pair with the last token of what remains before it. (Two tokens
are a stable pair when encoding their joined bytes gives the two back.) That state depends on the
prefix alone, so distinct words are put into a trie and one depth-first walk passes the states
from node to child: shared prefixes are computed once. A word's tokens are read back from its end.

Texts are cut at blanks first, which is safe where neither side of the cut has more white space
(a blank before a character that is none always begins a word); the encoding of each distinct piece is kept in a bounded cache, in
which a full generation replaces the one before. Nothing is ever cut off or skipped: a piece that
is not in the cache is computed, and one of any length is encoded in steps linear in its length.

Defined cases: a null or empty text has no tokens and decodes to an empty text. The strings of added
tokens become their ids. Ids that do not form UTF-8 decode with replacement characters; an unknown id
raises.
"""

from __future__ import annotations

import hashlib
import json
import struct
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowsmith.llm.common import map_batches, whole_text

# How a byte-level vocabulary cuts text into words.
WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# Entries per cache generation and process, and the longest text kept there.
GENERATION, LONGEST_KEPT = 500_000, 64
# Characters of the texts whose new words go into one trie.
GROUP_CHARS = 2_000_000


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary file."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in plain}
    rest = (b for b in range(256) if b not in set(plain))
    letters.update((chr(256 + i), b) for i, b in enumerate(rest))
    return letters


class Vocabulary:
    """Tokens as bytes, and which merge made each."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            stored = json.load(f)
        letters = byte_letters()
        model = stored["model"]
        self.added = {t["content"]: t["id"] for t in stored.get("added_tokens", [])}
        self.ids = {bytes(letters[c] for c in t): i for t, i in model["vocab"].items() if t not in self.added}
        self.bytes_of = {i: b for b, i in self.ids.items()}
        self.merged: dict[tuple[int, int], tuple[int, int]] = {}  # pair -> rank, token
        self.halves: dict[int, tuple[int, int, int]] = {}  # token -> rank, left, right
        for rank, (a, b) in enumerate(m.split(" ") if isinstance(m, str) else m for m in model["merges"]):
            left, right = (self.ids[bytes(letters[c] for c in x)] for x in (a, b))
            token = self.ids[self.bytes_of[left] + self.bytes_of[right]]
            self.merged[left, right] = rank, token
            self.halves.setdefault(token, (rank, left, right))
        self.length_of = {i: len(b) for i, b in self.bytes_of.items()}
        self.longest = max(map(len, self.ids))
        self.size = 1 + max([*self.bytes_of, *self.added.values()])
        self._stable: dict[int, bool] = {}

    def stable(self, a: int, b: int) -> bool:
        """Whether encoding the bytes of ``a`` and ``b`` together gives the two tokens back."""
        key = a << 32 | b
        known = self._stable.get(key)
        if known is None:
            if len(self._stable) > 4_000_000:
                self._stable.clear()
            known = self._stable[key] = self._meet(a, b)
        return known

    def _meet(self, a: int, b: int) -> bool:
        """Undo the later of the two tokens' merges step by step and look for a merge across the border.

        At any time of the merging, the border lies between the right end of ``a`` and the left end
        of ``b`` as they were then. A merge of those two wins if it ranks before the merge that
        consumed either; on equal rank the one further left goes first.
        """
        later = len(self.merged) + 1
        by_right = False  # the bound was set by a merge right of the border
        while True:
            across = self.merged.get((a, b))
            if across is not None and (across[0] < later or (across[0] == later and by_right)):
                return False
            made_a, made_b = self.halves.get(a), self.halves.get(b)
            if made_a is None and made_b is None:
                return True
            if made_b is None or (made_a is not None and made_a[0] > made_b[0]):
                later, a, by_right = made_a[0], made_a[2], False
            else:
                later, b, by_right = made_b[0], made_b[1], True

    def read_back(self, last: list[int], end: int) -> bytes:
        """The tokens that end at ``end``, as little-endian unsigned 32-bit integers."""
        out = []
        length = self.length_of
        while end:
            token = last[end]
            out.append(token)
            end -= length[token]
        out.reverse()
        return struct.pack(f"<{len(out)}I", *out)

    def encode_words(self, words: list[bytes]) -> dict[bytes, bytes]:
        """Token ids of every distinct word, by one depth-first walk over their trie.

        The trie is held as its words in order: a node is the run of words that share a prefix, and
        reading the list is the depth-first walk. ``last[i]`` is the state of the node at depth
        ``i`` on the current path, so a word only computes what its predecessor does not share.
        """
        out: dict[bytes, bytes] = {}
        words = sorted(words)
        ids, known, longest = self.ids.get, self._stable.get, self.longest
        last = [0] * (1 + max(map(len, words), default=0))
        previous, before = b"", 0
        for word in words:
            size = len(word)
            shared, most = 0, min(size, before)
            while shared < most and word[shared] == previous[shared]:
                shared += 1
            for end in range(shared + 1, size + 1):
                for start in range(end - longest if end > longest else 0, end):
                    token = ids(word[start:end])
                    if token is not None:
                        if not start:
                            break
                        left = last[start]
                        stable = known(left << 32 | token)
                        if stable or (stable is None and self.stable(left, token)):
                            break
                else:
                    raise ValueError("the vocabulary has no token for a byte")
                last[end] = token
            out[word] = self.read_back(last, size)
            previous, before = word, size
        return out


class _Cache(dict):
    """Encodings by text: the new generation, which asks the old one on a miss and notes what neither has.

    With ``after_blank``, None marks a text that is empty or begins with white space: cutting at the
    blank before it is not safe.
    """

    def __init__(self, after_blank: bool = False, old: dict | None = None):
        super().__init__()
        self.after_blank, self.old = after_blank, old or {}
        self.missing, self.misses = set(), 0

    def __missing__(self, text: str):
        found = self.old.get(text, b"")
        if found == b"":
            if not self.after_blank or (text and not text[0].isspace()):
                self.missing.add(text)
                self.misses += 1
                return b""
            found = None
        self[text] = found
        return found

    def renewed(self) -> _Cache:
        """Itself, or the next generation if it is full."""
        return self if len(self) <= GENERATION else _Cache(self.after_blank, dict(self))


class Encoder:
    """Encodes and decodes texts; one per process, see :func:`encoder`."""

    def __init__(self, path: str):
        self.vocab = Vocabulary(path)
        self._words = regex.compile(WORDS)
        self._pieces = _Cache(after_blank=True)
        self._bare = _Cache()
        self._known = _Cache()
        self._added = regex.compile("(" + "|".join(map(regex.escape, sorted(self.vocab.added, key=len, reverse=True))) + ")") if self.vocab.added else None
        empty = b""
        spelled = [self.vocab.bytes_of.get(i, empty) for i in range(self.vocab.size)]
        for text, i in self.vocab.added.items():
            spelled[i] = text.encode()
        self._spelled = _Gather(spelled)
        self._decimal = _Gather([b"%d," % i for i in range(self.vocab.size)])

    def encode_batch(self, texts: list[str]) -> list[np.ndarray]:
        """Token ids of each text as unsigned 32-bit integers."""
        return [np.frombuffer(x, dtype="<u4") for x in self.encode_bytes(texts)]

    def encode_bytes(self, texts: list[str]) -> list[bytes]:
        """Token ids of each text as little-endian unsigned 32-bit integers."""
        out: list[bytes] = []
        group: list[str] = []
        size = 0
        for text in texts:
            group.append(text)
            size += len(text)
            if size > GROUP_CHARS:
                out += self._encode_some(group)
                group, size = [], 0
        return out + self._encode_some(group)

    def _encode_some(self, texts: list[str]) -> list[bytes]:
        """Looks every piece up once to learn what is missing, encodes that in one trie, then joins."""
        caches = self._pieces, self._bare, self._known = [c.renewed() for c in (self._pieces, self._bare, self._known)]
        pieces, bare, known = caches
        found: list[list[tuple]] = []
        for text in texts:
            parts: list[tuple] = []
            for part, is_added in self._sections(text):
                if is_added:
                    parts.append((None, [self.vocab.added[part].to_bytes(4, "little")], None))
                    continue
                first, *rest = part.split(" ")
                misses = pieces.misses
                codes = list(map(pieces.__getitem__, rest))
                if None in codes:  # blanks next to other white space: word by word
                    words = self._words.findall(part)
                    codes = list(map(known.__getitem__, words))
                    parts.append((None, codes, (known, words)))
                    continue
                if first:
                    bare[first]
                parts.append((first, codes, (pieces, rest) if pieces.misses > misses else None))
            found.append(parts)
        too_long = self._encode_missing()
        out = []
        for parts in found:
            joined: list[bytes] = []
            for first, codes, again in parts:
                if first:
                    joined.append(bare[first])
                joined += list(map(again[0].__getitem__, again[1])) if again else codes
            out.append(b"".join(joined))
        for cache, texts_ in zip(caches, too_long):
            for text in texts_:
                del cache[text]
        return out

    def _sections(self, text: str) -> list[tuple[str, bool]]:
        """A text cut at added tokens."""
        if not text:
            return []
        if self._added is None or not any(t in text for t in self.vocab.added):
            return [(text, False)]
        return [(s, s in self.vocab.added) for s in self._added.split(text) if s]

    def _words_of(self, text: str) -> list[str]:
        """The words of a piece; letters, perhaps with a mark at the end, need no pattern."""
        if text.isalpha():
            return [text]
        body = text[1:-1] if text[0] == " " else text[:-1]
        if body.isalpha() and text[-1] in ".,;:!?":
            return [text[:-1], text[-1]]
        if text[0] == " " and text[1:].isalpha():
            return [text]
        return self._words.findall(text)

    def _encode_missing(self) -> list[list[str]]:
        """Fills the caches with what they lacked; returns the entries of each that are too long to stay."""
        known = self._known
        work = []
        for cache, lead in ((self._pieces, " "), (self._bare, "")):
            missing, cache.missing, cache.misses = cache.missing, set(), 0
            split = {p: self._words_of(lead + p) for p in missing}
            work.append((cache, split))
            for words in split.values():
                for word in words:
                    known[word]
        fresh, known.missing, known.misses = known.missing, set(), 0
        spelled = {w: w.encode("utf-8") for w in fresh}
        codes = self.vocab.encode_words(list(spelled.values()))
        known.update((w, codes[b]) for w, b in spelled.items())
        for cache, split in work:
            cache.update((p, known[ws[0]] if len(ws) == 1 else b"".join([known[w] for w in ws])) for p, ws in split.items())
        return [[p for p in some if len(p) > LONGEST_KEPT] for some in (work[0][1], work[1][1], fresh)]

    def decode_bytes(self, ids: np.ndarray) -> bytes:
        return self._spelled(ids)

    def decode(self, ids: np.ndarray) -> str:
        """The text that token ids spell."""
        return self.decode_bytes(ids).decode("utf-8", errors="replace")

    def decimal(self, ids: np.ndarray) -> bytes:
        """The ids in decimal, joined by commas."""
        return self._decimal(ids)[:-1]


class _Gather:
    """Joins table entries by index without a Python step per entry."""

    def __init__(self, entries: list[bytes]):
        self.blob = np.frombuffer(b"".join(entries), dtype=np.uint8)
        self.length = np.array([len(e) for e in entries], dtype=np.int64)
        self.start = np.concatenate([[0], np.cumsum(self.length)[:-1]])

    def __call__(self, index: np.ndarray, step: int = 65_536) -> bytes:
        return b"".join([self._some(index[i : i + step]) for i in range(0, len(index), step)])

    def _some(self, index: np.ndarray) -> bytes:
        length = self.length[index]
        before = np.cumsum(length) - length
        return self.blob[np.repeat(self.start[index] - before, length) + np.arange(length.sum())].tobytes()


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """The encoder of this process for a vocabulary file."""
    return Encoder(path)


def encode(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id, ids`` (an array) of every whole text."""

    def make():
        enc = encoder(path)

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            ids = [x.astype(np.int32) for x in enc.encode_batch(batch.column(1).to_pylist())]
            return pa.record_batch([batch.column(0), pa.array(ids, type=pa.list_(pa.int32()))], names=["doc_id", "ids"])

        return work

    return map_batches(docs.select("doc_id", whole_text().alias("text")), make, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, ids array<int>")


def decode(tokens: DataFrame, path: str) -> DataFrame:
    """``doc_id, text`` from ``doc_id, ids``."""

    def make():
        enc = encoder(path)

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = [enc.decode(np.array(x or [], dtype=np.int64)) for x in batch.column(1).to_pylist()]
            return pa.record_batch([batch.column(0), pa.array(texts, type=pa.string())], names=["doc_id", "text"])

        return work

    ids = F.coalesce(F.col("ids"), F.array().cast("array<int>"))
    return map_batches(tokens.select("doc_id", ids.alias("ids")), make, f"doc_id {tokens.schema['doc_id'].dataType.simpleString()}, text string")


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256``: digests of the ids and of the text that they decode to."""

    def make():
        enc = encoder(path)
        sha = hashlib.sha256

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            n, of_ids, of_text = [], [], []
            for ids in enc.encode_batch(batch.column(1).to_pylist()):
                n.append(len(ids))
                of_ids.append(sha(enc.decimal(ids)).hexdigest())
                of_text.append(sha(enc.decode(ids).encode("utf-8")).hexdigest())
            return pa.record_batch(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_text, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

        return work

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), whole_text().alias("text"))
    return map_batches(rows, make, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
