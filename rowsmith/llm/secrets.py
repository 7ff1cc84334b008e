"""Secret scans: fixed patterns, and a character convolutional network over every candidate.

The patterns give the base spans of a text. Besides, every run of at least ``SHORTEST`` token characters
is a candidate; the network reads the whole candidate and ``CONTEXT`` characters on either side, in
which context characters have embeddings of their own. It is trained in numpy on labelled findings: a
candidate that overlaps a base span is a secret, the others are not. A part of the findings is set
aside to calibrate the scores, and the threshold of each group of candidates keeps at least
``RECALL`` of the set-aside secrets and lets through as few others as that allows. A finding that no pattern knows is labelled
as no secret, so there are two networks, each trained on the tokens of one half by hash, and a
candidate is judged by the one that did not learn from it. Candidates above it that overlap no base
span are added as spans of kind ``learned``; base spans always stay.

One pass reads the texts and writes the findings, one row per document; training reads all distinct
findings in slices, whose weights are averaged after each round; calibration and thresholds are aggregates over all
that were set aside; a second pass over the narrow findings scores every candidate. Only the distinct findings are shuffled.

Defined cases: a null text counts as empty and has no finding. Offsets are code points, the end is
exclusive. Two secrets in one run are one candidate. With fewer than ``LEAST`` findings of either label
in a half, nothing is learnt and no span is added. Rows that repeat an id are scanned each by itself.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowsmith.llm.common import map_batches, whole_text
from rowsmith.session import Scratch

# The kinds of base findings, in order, with the shortest match that counts.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex")
KEYWORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 6, 20, 24

SHORTEST, CONTEXT, RECALL, LEAST = 16, 24, 0.98, 20
WIDTH, FILTERS, EPOCHS, SEED = 5, 24, 25, 11
# Findings that one task learns from together, rounds of averaging where there are more, symbols of a step, ranges of a count.
PART, ROUNDS, STEP_SYMBOLS, BINS = 4000, 5, 50_000, 1024
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % SHORTEST)

# Bytes that mark runs, for finding them without a pattern.
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_HEX_RUN = bytes(120 if chr(b) in "0123456789abcdef" else 32 for b in range(256))
_TOKEN_RUN = bytes(120 if b < 128 and (chr(b).isalnum() or chr(b) in "+/_=-") else 32 for b in range(256))


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """``start, end, kind`` of the base findings, ordered by start, then by kind as listed."""
    raw = text.encode("utf-8")
    low = raw.translate(_LOWER)
    found = []
    if any(k in low for k in KEYWORDS):
        found += [(m.start(), m.end(), 0) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    if b"AKIA" in raw:
        found += [(m.start(), m.end(), 1) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    if b"x" * HEX_LEAST in raw.translate(_HEX_RUN):
        found += [(m.start(), m.end(), 2) for m in HEX.finditer(text)]
    return [(s, e, KINDS[k]) for s, e, k in sorted(found, key=lambda f: (f[0], f[2]))]


def candidates(text: str) -> list[tuple[int, int]]:
    """Every run of token characters that is long enough."""
    if b"x" * SHORTEST not in text.encode("utf-8").translate(_TOKEN_RUN):
        return []
    return [m.span() for m in CANDIDATE.finditer(text)]


# Symbols: 0 padding, ASCII in the context, ASCII in the candidate, one for all other characters of the context.
SYMBOLS = 2 + 128 + 128


def symbols(before: str, token: str, after: str) -> np.ndarray:
    """A candidate and its context as numbers, padded so that every window of the network is whole."""

    def plain(s: str) -> np.ndarray:
        codes = np.frombuffer(s.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int64)
        return np.where(codes < 128, codes + 1, SYMBOLS - 1)

    inside = np.frombuffer(token.encode("ascii"), dtype=np.uint8).astype(np.int64) + 129
    pad = np.zeros(WIDTH - 1, dtype=np.int64)
    return np.concatenate([pad, plain(before), inside, plain(after), pad])


def _flatten(items: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Window starts of all items in one array, the first window of each item, and the item of each window."""
    flat = np.concatenate(items)
    windows = np.array([len(i) - WIDTH + 1 for i in items])
    start = np.cumsum([0, *(len(i) for i in items[:-1])])
    first = np.cumsum(windows) - windows
    owner = np.repeat(np.arange(len(items)), windows)
    position = np.arange(windows.sum()) - first[owner] + start[owner]
    return flat[position[:, None] + np.arange(WIDTH)], first, owner


@dataclass
class Network:
    """One convolution over characters, the largest response of each filter, and a logistic output."""

    table: np.ndarray  # a filter's response to each symbol at each place of the window
    bias: np.ndarray
    out: np.ndarray
    level: float
    calibration: tuple[float, float] = (1.0, 0.0)
    thresholds: tuple[float, float] = (2.0, 2.0)

    def logits(self, items: list[np.ndarray]) -> np.ndarray:
        parts = []
        for i in range(0, len(items), 256):
            parts.append(self._pooled(items[i : i + 256])[0] @ self.out + self.level)
        return np.concatenate(parts) if parts else np.zeros(0)

    def _pooled(self, items: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        windows, first, owner = _flatten(items)
        response = np.repeat(self.bias[None, :], len(windows), axis=0)
        for k in range(WIDTH):
            response += self.table[k][windows[:, k]]
        return np.maximum(np.maximum.reduceat(response, first, axis=0), 0), windows, response, owner

    def probabilities(self, items: list[np.ndarray]) -> np.ndarray:
        a, b = self.calibration
        return 1 / (1 + np.exp(-np.clip(a * self.logits(items) + b, -30, 30)))

    def accepts(self, items: list[np.ndarray], digits: np.ndarray) -> np.ndarray:
        """Whether each candidate is above its group's threshold."""
        return self.probabilities(items) >= np.where(digits, self.thresholds[1], self.thresholds[0])


def fresh_network(rng) -> Network:
    net = Network(rng.normal(0, 0.1, (WIDTH, SYMBOLS, FILTERS)), np.zeros(FILTERS), rng.normal(0, 0.3, FILTERS), 0.0)
    net.table[:, 0] = 0
    return net


def _portions(order: np.ndarray, items: list[np.ndarray]) -> list[np.ndarray]:
    """``order`` in steps of at most 64 items, and fewer where items are long."""
    out, first, size = [], 0, 0
    for i, j in enumerate(order):
        size += len(items[j])
        if i + 1 - first == 64 or size > STEP_SYMBOLS or i + 1 == len(order):
            out.append(order[first : i + 1])
            first, size = i + 1, 0
    return out


def descend(net: Network, items: list[np.ndarray], y: np.ndarray, weight: np.ndarray, rng, epochs: int) -> None:
    """Gradient steps over all items, in place."""
    names = ("table", "bias", "out")
    m, v = ({n: np.zeros_like(getattr(net, n)) for n in names} for _ in range(2))
    m["level"], v["level"], step = 0.0, 0.0, 0
    for _ in range(epochs):
        order = rng.permutation(len(items))
        for chosen in _portions(order, items):
            pooled, windows, response, owner = net._pooled([items[j] for j in chosen])
            p = 1 / (1 + np.exp(-np.clip(pooled @ net.out + net.level, -30, 30)))
            err = weight[chosen] * (p - y[chosen]) / weight[chosen].sum()
            # Only the window with the largest response passes a filter's error on.
            d_pooled = err[:, None] * net.out * (pooled > 0)
            grad = {"out": pooled.T @ err, "bias": d_pooled.sum(axis=0), "table": np.zeros_like(net.table), "level": err.sum()}
            best = np.full((len(chosen), FILTERS), -1)
            rows, cols = np.nonzero((response == pooled[owner]) & (pooled[owner] > 0))
            best[owner[rows], cols] = rows
            item, filt = np.nonzero(best >= 0)
            for k in range(WIDTH):
                np.add.at(grad["table"][k], (windows[best[item, filt], k], filt), d_pooled[item, filt])
            grad["table"][:, 0] = 0
            step += 1
            for n in (*names, "level"):
                m[n] = 0.9 * m[n] + 0.1 * grad[n]
                v[n] = 0.999 * v[n] + 0.001 * grad[n] ** 2
                move = 0.01 * (m[n] / (1 - 0.9**step)) / (np.sqrt(v[n] / (1 - 0.999**step)) + 1e-8)
                setattr(net, n, getattr(net, n) - move)


def train(items: list[np.ndarray], y: np.ndarray, digits: np.ndarray, recall: float = RECALL, epochs: int = EPOCHS) -> Network:
    """A network from labelled findings; a quarter of them is set aside for calibration and thresholds.

    ``digits`` tells candidates with a digit from those without; each group has its own threshold.
    A group without set-aside secrets accepts nothing.
    """
    rng = np.random.default_rng(SEED)
    aside = np.zeros(len(items), dtype=bool)
    for label in (0, 1):
        of = np.flatnonzero(y == label)
        aside[rng.permutation(of)[: max(1, len(of) // 4)]] = True
    net = fresh_network(rng)
    learn = np.flatnonzero(~aside)
    weight = np.where(y == 1, 0.5 / max(1, (y[learn] == 1).sum()), 0.5 / max(1, (y[learn] == 0).sum()))
    descend(net, [items[j] for j in learn], y[learn], weight[learn], rng, epochs)
    held = np.flatnonzero(aside)
    logits = net.logits([items[j] for j in held])
    net.calibration = _calibrate(logits, y[held])
    p = net.probabilities([items[j] for j in held])
    net.thresholds = tuple(_threshold(p[digits[held] == g], y[held][digits[held] == g], recall) for g in (False, True))
    return net


def _calibrate(logits: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Scale and shift of a logistic calibration, by Newton steps on smoothed labels."""
    a, b = 1.0, 0.0
    n1, n0 = (y == 1).sum(), (y == 0).sum()
    target = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x = np.stack([np.clip(logits, -20, 20), np.ones(len(logits))], axis=1)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ [a, b], -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        move = np.linalg.solve(h, x.T @ (p - target) + 1e-3 * np.array([a - 1, b]))
        a, b = a - np.clip(move[0], -1, 1), b - np.clip(move[1], -1, 1)
        if np.abs(move).max() < 1e-8:
            break
    return float(max(a, 1e-3)), float(b)


def _threshold(p: np.ndarray, y: np.ndarray, recall: float) -> float:
    """A threshold that keeps ``recall`` of the secrets, at least 0.5.

    Of those that let no more of the others through than the highest such one, it is halfway down
    to the next of the others.
    """
    good = np.sort(p[y == 1])
    if not len(good):
        return 2.0
    highest = good[int(np.floor((1 - recall) * len(good)))]
    below = p[(y == 0) & (p < highest)]
    return float(max(0.5, (highest + below.max(initial=0.0)) / 2))


FINDINGS = (
    "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base array<struct<start:int,stop:int,kind:string>>, "
    "found array<struct<start:int,stop:int,before:string,token:string,after:string,secret:boolean>>"
)
_SPAN = pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("kind", pa.string())])
_FOUND = pa.struct(
    [("start", pa.int32()), ("stop", pa.int32()), ("before", pa.string()), ("token", pa.string()), ("after", pa.string()), ("secret", pa.bool_())]
)


def find(docs: DataFrame) -> DataFrame:
    """Base spans and candidates of every whole text, one row per document."""

    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            counts: dict[str, list[int]] = {k: [] for k in KINDS}
            base, found = [], []
            for text in batch.column(1).to_pylist():
                spans = base_spans(text)
                for k in KINDS:
                    counts[k].append(sum(kind == k for _, _, kind in spans))
                base.append([{"start": s, "stop": e, "kind": k} for s, e, k in spans])
                own, reach, at = [], 0, 0
                for s, e in candidates(text):
                    while at < len(spans) and spans[at][0] < e:  # spans are ordered by start
                        reach = max(reach, spans[at][1])
                        at += 1
                    own.append({"start": s, "stop": e, "before": text[max(0, s - CONTEXT) : s], "token": text[s:e], "after": text[e : e + CONTEXT], "secret": reach > s})
                found.append(own)
            columns = [batch.column(0), *(pa.array(counts[k], pa.int64()) for k in KINDS), pa.array(base, pa.list_(_SPAN)), pa.array(found, pa.list_(_FOUND))]
            return pa.record_batch(columns, names=["doc_id", "n_assign", "n_access", "n_hex", "base", "found"])

        return work

    return map_batches(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), whole_text().alias("text")), make, FINDINGS)


def _has_digit(token: str) -> bool:
    return any("0" <= c <= "9" for c in token)


def _half(token: str) -> int:
    return zlib.crc32(token.encode("ascii")) & 1


def _vector(net: Network) -> np.ndarray:
    return np.concatenate([net.table.ravel(), net.bias, net.out, [net.level]])


def _network(vector: np.ndarray) -> Network:
    size = WIDTH * SYMBOLS * FILTERS
    table, bias, out = vector[:size].reshape(WIDTH, SYMBOLS, FILTERS).copy(), vector[size : size + FILTERS].copy(), vector[size + FILTERS : -1].copy()
    return Network(table, bias, out, float(vector[-1]))


def _train_round(rows: DataFrame, vectors: dict[int, np.ndarray], weights: dict, number: int, epochs: int) -> dict[int, np.ndarray]:
    """The weights of each half's network after ``epochs`` over all ``rows``, averaged over slices by their findings."""

    def run(key: tuple, some: pa.Table) -> pa.Table:
        half, part = (k.as_py() for k in key)
        found = sorted(some.to_pylist(), key=lambda r: (r["token"], r["before"], r["after"], r["secret"]))
        y = np.array([float(r["secret"]) for r in found])
        net = _network(vectors[half])
        items = [symbols(r["before"], r["token"], r["after"]) for r in found]
        descend(net, items, y, np.array([weights[half, r["secret"]] for r in found]), np.random.default_rng([SEED, number, part]), epochs)
        return pa.table({"half": pa.array([half], pa.int64()), "n": pa.array([len(y)], pa.int64()), "w": pa.array([_vector(net)], pa.list_(pa.float64()))})

    made = rows.groupBy("half", "part").applyInArrow(run, "half bigint, n bigint, w array<double>")
    each = made.select("half", "n", F.posexplode("w").alias("place", "w")).groupBy("half", "place")
    found = each.agg((F.sum(F.col("w") * F.col("n")) / F.sum("n")).alias("w")).collect()  # two networks
    out = {half: np.zeros(len(v)) for half, v in vectors.items()}
    for r in found:
        out[r["half"]][r["place"]] = r["w"]
    return out


def _held_logits(rows: DataFrame, vectors: dict[int, np.ndarray]) -> DataFrame:
    """``half, secret, digit, x`` of findings that were set aside; ``x`` is what the network of their half says."""

    def make():
        networks = {half: _network(v) for half, v in vectors.items()}

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = batch.to_pylist()
            x = np.zeros(len(found))
            for half, net in networks.items():
                own = [i for i, r in enumerate(found) if r["half"] == half]
                x[own] = net.logits([symbols(found[i]["before"], found[i]["token"], found[i]["after"]) for i in own])
            digit = pa.array([_has_digit(r["token"]) for r in found], pa.bool_())
            return pa.record_batch([batch.column(0), batch.column(4), digit, pa.array(x)], names=["half", "secret", "digit", "x"])

        return work

    return map_batches(rows.select("half", "before", "token", "after", "secret"), make, "half bigint, secret boolean, digit boolean, x double")


def _calibrated(held: DataFrame) -> tuple[float, float]:
    """``_calibrate`` of a table; each Newton step is one aggregate."""
    n = {r["secret"]: r["count"] for r in held.groupBy("secret").count().collect()}
    n1, n0 = n.get(True, 0), n.get(False, 0)
    a, b = 1.0, 0.0
    x, target = F.greatest(F.lit(-20.0), F.least(F.lit(20.0), "x")), F.when(F.col("secret"), (n1 + 1) / (n1 + 2)).otherwise(1 / (n0 + 2))
    for _ in range(30):
        p = 1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), x * a + b))))
        v = p * (1 - p)
        sums = held.agg(*(F.coalesce(F.sum(c), F.lit(0.0)) for c in (x * x * v, x * v, v, x * (p - target), p - target))).first()
        h = np.array([[sums[0], sums[1]], [sums[1], sums[2]]]) + 1e-3 * np.eye(2)
        move = np.linalg.solve(h, np.array(sums[3:]) + 1e-3 * np.array([a - 1, b]))
        a, b = a - np.clip(move[0], -1, 1), b - np.clip(move[1], -1, 1)
        if np.abs(move).max() < 1e-8:
            break
    return float(max(a, 1e-3)), float(b)


def _kth(rows: DataFrame, k: int) -> float:
    """The ``k``-th smallest ``x``, from 0: ever narrower ranges are counted until one value is left."""
    low, high = rows.agg(F.min("x"), F.max("x")).first()
    while low < high:
        place = F.least(F.lit(BINS - 1), F.floor((F.col("x") - low) / (high - low) * BINS))
        bins = rows.where(F.col("x").between(low, high)).groupBy(place.alias("bin")).agg(F.count("*").alias("n"), F.min("x").alias("low"), F.max("x").alias("high"))
        for r in sorted(bins.collect(), key=lambda r: r["bin"]):  # at most ``BINS`` rows
            if k < r["n"]:
                low, high = r["low"], r["high"]
                break
            k -= r["n"]
    return low


def _limit(held: DataFrame, calibration: tuple[float, float], recall: float) -> float:
    """``_threshold`` of a table."""
    good = held.where("secret")
    n = good.count()
    if not n:
        return 2.0
    highest = _kth(good, int(np.floor((1 - recall) * n)))

    def probability(x: float) -> float:
        return 1 / (1 + np.exp(-np.clip(calibration[0] * x + calibration[1], -30, 30)))

    below = held.where(~F.col("secret") & (F.col("x") < highest)).agg(F.max("x")).first()[0]
    return float(max(0.5, (probability(highest) + (0.0 if below is None else probability(below))) / 2))


def learn(findings: DataFrame, part: int = PART) -> tuple[Network, Network] | None:
    """The networks that judge the tokens of half 0 and 1, each trained on the other half.

    All distinct findings are learnt from or set aside, in slices of about ``part``. With several slices each round goes
    on from the average of their weights. Calibration and thresholds are of all findings that were set aside.
    """
    rows = findings.select(F.explode("found").alias("f")).select("f.before", "f.token", "f.after", "f.secret").distinct()  # copies teach nothing new
    # The half is that of the network, so the other one than the token's.
    half = (1 - F.crc32(F.col("token").cast("binary")) % 2).alias("half")
    order = F.xxhash64("before", "token", "after")
    with Scratch(findings.sparkSession, "learn") as scratch:
        rows = scratch.write(rows.select(half, "before", "token", "after", "secret", order.alias("order")), "distinct")
        aside = F.pmod("order", F.lit(4)) == 0
        counts = {(r["half"], r["secret"], r["aside"]): r["count"] for r in rows.groupBy("half", "secret", aside.alias("aside")).count().collect()}
        for h in (0, 1):
            for label in (True, False):
                if counts.get((h, label, True), 0) + counts.get((h, label, False), 0) < LEAST:
                    return None
        parts = -(-max(sum(counts.get((h, label, False), 0) for label in (True, False)) for h in (0, 1)) // part)
        weights = {(h, label): 0.5 / max(1, counts.get((h, label, False), 0)) for h in (0, 1) for label in (True, False)}
        taught = rows.where(~aside).withColumn("part", F.pmod(F.shiftright("order", 2), F.lit(parts)))
        vectors = {h: _vector(fresh_network(np.random.default_rng(SEED))) for h in (0, 1)}
        rounds = 1 if parts == 1 else ROUNDS
        for number in range(rounds):
            vectors = _train_round(taught, vectors, weights, number, EPOCHS // rounds)
        held = scratch.write(_held_logits(rows.where(aside), vectors), "held")
        networks = []
        for h in (0, 1):
            net, own = _network(vectors[h]), held.where(F.col("half") == h)
            net.calibration = _calibrated(own)
            net.thresholds = tuple(_limit(own.where(F.col("digit") == g), net.calibration, RECALL) for g in (False, True))
            networks.append(net)
    return tuple(networks)


def _learned(networks: tuple[Network, Network] | None, found: list[list[dict]]) -> list[list[tuple[int, int, str]]]:
    """The accepted candidates of each document that overlap no base span."""
    out: list[list[tuple[int, int, str]]] = [[] for _ in found]
    asked = [(i, f) for i, fs in enumerate(found) for f in fs if not f["secret"]]
    if networks is None or not asked:
        return out
    for at in range(0, len(asked), 4096):
        some = asked[at : at + 4096]
        items = [symbols(f["before"], f["token"], f["after"]) for _, f in some]
        digits = np.array([_has_digit(f["token"]) for _, f in some])
        half = np.array([_half(f["token"]) for _, f in some])
        yes = np.where(half == 0, networks[0].accepts(items, digits), networks[1].accepts(items, digits))
        for (i, f), accepted in zip(some, yes):
            if accepted:
                out[i].append((f["start"], f["stop"], "learned"))
    return out


def _spelled(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{stop}" for start, stop, kind in spans)


def judge(findings: DataFrame, networks: tuple[Network, Network] | None) -> DataFrame:
    """``doc_id``, counts of base findings, ``base_sha256``, ``spans`` and ``n_learned`` of every document."""

    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            base = [[(b["start"], b["stop"], b["kind"]) for b in bs] for bs in batch.column(4).to_pylist()]
            learned = _learned(networks, batch.column(5).to_pylist())
            order = {k: i for i, k in enumerate((*KINDS, "learned"))}
            spans = [_spelled(sorted(b + n, key=lambda s: (s[0], order[s[2]]))) for b, n in zip(base, learned)]
            digest = [hashlib.sha256(_spelled(b).encode()).hexdigest() for b in base]
            columns = [*batch.columns[:4], pa.array(digest, pa.string()), pa.array(spans, pa.string()), pa.array([len(n) for n in learned], pa.int64())]
            return pa.record_batch(columns, names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_learned"])

        return work

    return map_batches(findings, make, "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string, n_learned bigint")


def scan(docs: DataFrame) -> DataFrame:
    """The findings of every document."""
    with Scratch(docs.sparkSession, "secrets") as scratch:
        findings = scratch.write(find(docs), "findings", keep=True)
        return judge(findings, learn(findings))


def redact(docs: DataFrame, mark: str = "[secret]") -> DataFrame:
    """``docs`` with every span, base or learned, replaced by ``mark``; ``n_chars`` follows the text.

    Overlapping spans are replaced together. Texts without a span stay as they are, null ones too.
    """
    with Scratch(docs.sparkSession, "secrets") as scratch:
        networks = learn(scratch.write(find(docs), "findings"))
    columns = docs.columns
    at = columns.index("text")
    size = columns.index("n_chars") if "n_chars" in columns else None

    def clean(text: str, spans: list[tuple[int, int, str]]) -> str:
        out, reach, last = [], -1, 0
        for s, e, _ in sorted(spans):
            if s >= reach:  # a new run of spans
                out += [text[last:s], mark]
            reach = max(reach, e)
            last = reach
        return "".join([*out, text[last:]])

    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = batch.column(at).to_pylist()
            base = [base_spans(t or "") for t in texts]
            found = []
            for t, spans in zip(texts, base):
                own = []
                for s, e in candidates(t or ""):
                    if not any(a < e and s < b for a, b, _ in spans):
                        own.append({"start": s, "stop": e, "before": t[max(0, s - CONTEXT) : s], "token": t[s:e], "after": t[e : e + CONTEXT], "secret": False})
                found.append(own)
            changed = [b + n for b, n in zip(base, _learned(networks, found))]
            if not any(changed):
                return batch
            arrays = list(batch.columns)
            cleaned = [clean(t, s) if s else t for t, s in zip(texts, changed)]
            arrays[at] = pa.array(cleaned, batch.schema.field(at).type)
            if size is not None:
                lengths = [len(c) if s else n for c, s, n in zip(cleaned, changed, batch.column(size).to_pylist())]
                arrays[size] = pa.array(lengths, batch.schema.field(size).type)
            return pa.RecordBatch.from_arrays(arrays, schema=batch.schema)

        return work

    return map_batches(docs, make, docs.schema)
