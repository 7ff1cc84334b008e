"""How far the sources of a language differ in their words, with copies of a text read once.

Identical texts of a language are collapsed before anything is tokenised: a first pass counts rows by
language, text digest and source, and only texts that occur more than once are gathered, one row for each.
A text is tokenised once, and what is found is multiplied by the number of its copies in each
source. Texts that occur once never move; their counts are combined in the task that reads them.

Sources are compared sparsely. Each of a pair's terms without any occurrence adds the same number, so a
pair is that number times the size of the vocabulary, corrected at the terms that one of both
has. Corrections are added up in blocks of sources and buckets of terms of bounded size, in
64-bit integers throughout.

Defined cases: null text, lang and source count as empty strings, so null and '' are one language or source. A
document without terms makes its group occur. A language without kept terms has pairs of value 0 and no
terms. A language with one source has no pairs. Rows that repeat an id or a text all count. Ties rank by
the UTF-8 order of the item. An empty table gives an empty result. Further columns are not read, whatever
their names are.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowsmith.llm.common import drop_ids, whole_text
from rowsmith.session import Scratch

SCALE = 1_000_000_000
# Sources of a block and terms of a bucket: a block's numbers take 8 bytes for each pair of them.
SOURCES, TERMS = 128, 4096
# A text in more sources than this is met by several tasks.
SPREAD = 1000
# Counted (lang, source, term) entries that a task holds.
COUNTED = 250_000

# Bytes of terms stay, A-Z become lower case, every other ASCII byte parts terms; longer code points have no ASCII bytes.
_TERM = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 0x80 else 32 for b in range(256))


def terms_of(text: bytes) -> list[bytes]:
    """The terms of a UTF-8 text, in order."""
    return text.translate(_TERM).split()


def keyed(docs: DataFrame) -> DataFrame:
    """``key, lang, source, text`` of every row; ``key`` names the pair of language and text."""
    rows = docs.select(whole_text("lang").alias("lang"), whole_text("source").alias("source"), whole_text().alias("text"))
    return rows.select(F.sha2(F.concat(F.sha2("lang", 256), F.sha2("text", 256)), 256).alias("key"), "lang", "source", "text")


def single_counts(rows: DataFrame) -> DataFrame:
    """``lang, source, term, n, df``, partly summed, of rows whose texts occur once."""

    def tables(totals: dict) -> Iterator[pa.RecordBatch]:
        while totals:
            (lang, source), (n, df) = totals.popitem()
            terms = pa.array([t.decode("utf-8") for t in n], pa.string())
            groups = [pa.array([x] * len(n), pa.string()) for x in (lang, source)]
            numbers = [pa.array(x, pa.int64()) for x in (list(n.values()), list(map(df.__getitem__, n)))]
            yield pa.record_batch([*groups, terms, *numbers], names=["lang", "source", "term", "n", "df"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict = defaultdict(lambda: (Counter(), Counter()))
        held = 0
        for batch in batches:
            for lang, source, text in zip(*(c.to_pylist() for c in batch.columns)):
                n, df = totals[lang, source]
                held -= len(n)
                terms = terms_of(text)
                n.update(terms)
                df.update(set(terms))
                held += len(n)
                if held > COUNTED:
                    yield from tables(totals)
                    held = 0
        yield from tables(totals)

    rows = rows.select("lang", "source", F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(run, "lang string, source string, term string, n bigint, df bigint")


def tokenised(texts: DataFrame) -> DataFrame:
    """``key, terms`` of each text, its terms with their counts."""
    kind = pa.list_(pa.struct([("term", pa.string()), ("c", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [[{"term": t.decode("utf-8"), "c": c} for t, c in Counter(terms_of(text)).items()] for text in batch.column(1).to_pylist()]
            yield pa.record_batch([batch.column(0), pa.array(found, kind)], names=["key", "terms"])

    return texts.select("key", F.col("text").cast("binary").alias("text")).mapInArrow(run, "key string, terms array<struct<term: string, c: bigint>>")


def term_counts(docs: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """``lang, source, term, n, df`` over all rows, and ``lang, source`` of every group that occurs."""
    rows = keyed(docs)
    copies = scratch.write(rows.groupBy("key", "lang", "source").agg(F.count("*").alias("copies")), "copies")
    groups = copies.select("lang", "source").distinct()
    per_text = copies.groupBy("key").agg(F.sum("copies").alias("total"), F.count("*").alias("sources")).where("total > 1")
    per_text = scratch.write(per_text, "repeated")
    keys = per_text.select("key")
    once = drop_ids(rows, keys, "key")
    # One row for each repeated text, combined before it is shuffled, tokenised once.
    texts = drop_ids(rows, keys, "key", "left_semi").select("key", "text").distinct()
    parts = F.ceil(F.col("sources") / SPREAD).cast("int")
    found = scratch.write(tokenised(texts), "terms").join(per_text.select("key", parts.alias("parts")), "key")
    found = found.select("key", "terms", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    held = copies.join(per_text.select("key", parts.alias("parts")), "key")
    held = held.select("key", "lang", "source", "copies", F.pmod(F.xxhash64("source"), F.col("parts")).cast("int").alias("part"))
    weighted = held.join(found, ["key", "part"]).select("lang", "source", "copies", F.inline("terms"))
    weighted = weighted.select("lang", "source", "term", (F.col("c") * F.col("copies")).alias("n"), F.col("copies").alias("df"))
    # Tasks have combined what they could, so these rows go straight to where they are summed; the copies are combined first.
    group = ("lang", "source", "term")
    sums = (F.sum("n").alias("n"), F.sum("df").alias("df"))
    counts = single_counts(once).unionByName(weighted.groupBy(*group).agg(*sums)).repartition(*group).groupBy(*group).agg(*sums)
    return scratch.write(counts, "counts"), groups


def share(n: str, total: str, terms: str) -> Column:
    """``1 + floor(SCALE * (n + 2) / (total + 2 * terms))``, exact for any counts."""
    over = f"CAST({total} AS DECIMAL(20,0)) + 2 * CAST({terms} AS DECIMAL(18,0))"
    return F.expr(f"1 + CAST({SCALE} AS DECIMAL(10,0)) * (CAST({n} AS DECIMAL(19,0)) + 2) div ({over})").cast("bigint")


def _block(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
    """``a, b, delta`` for the pairs of two blocks of sources over one bucket of terms.

    Rows with term -1 name the sources; the first bucket also brings in what all terms add.
    """
    if not len(left) or not len(right):
        return pd.DataFrame({"a": [], "b": [], "delta": []}, dtype="int64")
    bucket, size = int(left["bucket"].iloc[0]), int(left["terms"].iloc[0])
    _, terms = np.unique(np.concatenate([left["term"], right["term"]]), return_inverse=True)
    width = terms.max() + 1
    sides = []
    for rows, places in ((left, terms[: len(left)]), (right, terms[len(left) :])):
        ids, at = np.unique(rows["gid"], return_inverse=True)
        zero = np.zeros(len(ids), dtype=np.int64)
        zero[at] = rows["zero"]
        shares = np.repeat(zero[:, None], width, axis=1)
        shares[at, places] = rows["p"]
        sides.append((ids, zero, shares[:, 1:]))  # the least term is -1
    (a, zero_a, p), (b, zero_b, q) = sides
    out = []
    for i in range(len(a)):
        more = b > a[i] if left["block"].iloc[0] == right["block"].iloc[0] else np.ones(len(b), dtype=bool)
        if more.any():
            none = (zero_a[i] - zero_b[more]) ** 2 // (zero_a[i] + zero_b[more])
            each = (p[i][None, :] - q[more]) ** 2 // (p[i][None, :] + q[more])
            total = each.sum(axis=1) - none * each.shape[1] + (none * size if bucket == 0 else 0)
            out.append(pd.DataFrame({"a": a[i], "b": b[more], "delta": total}))
    return pd.concat(out) if out else pd.DataFrame({"a": [], "b": [], "delta": []}, dtype="int64")


def pair_values(cells: DataFrame, groups: DataFrame, scratch: Scratch, sources: int = SOURCES, terms: int = TERMS) -> DataFrame:
    """``a, b, value`` for each unordered pair of groups of a language, by their numbers.

    ``cells`` has ``lang, gid, term_id, p`` for each occurring term, ``groups`` has ``lang, gid, zero, terms``.
    """
    sizes = groups.groupBy("lang").agg(F.count("*").alias("n"), F.max("terms").alias("t"))
    sizes = sizes.select(
        "lang", F.ceil(F.col("n") / sources).cast("int").alias("blocks"), F.greatest(F.lit(1), F.ceil(F.col("t") / terms)).cast("int").alias("buckets")
    )
    placed = groups.join(sizes, "lang").withColumn("block", F.pmod(F.xxhash64("gid"), F.col("blocks")).cast("int"))
    placed = scratch.write(placed, "placed")
    every = placed.withColumn("bucket", F.explode(F.sequence(F.lit(0), F.col("buckets") - 1)))
    named = every.select("lang", "bucket", "block", "blocks", "gid", "zero", "terms", F.lit(-1).cast("bigint").alias("term"), F.col("zero").alias("p"))
    bucket = F.pmod(F.xxhash64("term_id"), F.col("buckets")).cast("int").alias("bucket")
    filled = cells.select("gid", "term_id", "p").join(placed, "gid")
    rows = named.unionByName(filled.select("lang", bucket, "block", "blocks", "gid", "zero", "terms", F.col("term_id").alias("term"), "p"))
    kept = ("lang", "bucket", "block", "gid", "zero", "terms", "term", "p")
    # Each pair of blocks meets once, the lower block on the left.
    left = rows.withColumn("other", F.explode(F.sequence(F.col("block"), F.col("blocks") - 1)))
    right = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("block"))))
    left = left.select(*(F.col(c).alias("x_" + c) for c in (*kept, "other")))
    right = right.select(*(F.col(c).alias("y_" + c) for c in (*kept, "other")))

    def meet(x: pd.DataFrame, y: pd.DataFrame) -> pd.DataFrame:
        return _block(x.rename(columns=lambda c: c[2:]), y.rename(columns=lambda c: c[2:]))

    met = left.groupBy("x_lang", "x_bucket", "x_block", "x_other").cogroup(right.groupBy("y_lang", "y_bucket", "y_other", "y_block"))
    return met.applyInPandas(meet, "a bigint, b bigint, delta bigint").groupBy("a", "b").agg(F.sum("delta").alias("value"))


def audit(docs: DataFrame, least: int = 10, top: int = 10) -> DataFrame:
    """``lang, source, part, item, value, rank``: every pair of sources, and the ``top`` terms of each source.

    A language keeps the terms that at least ``least`` of its documents hold.
    """
    with Scratch(docs.sparkSession, "divergence") as scratch:
        counts, groups = term_counts(docs, scratch)
        kept = counts.groupBy("lang", "term").agg(F.sum("df").alias("df"), F.sum("n").alias("lang_n")).where(F.col("df") >= least)
        kept = scratch.write(kept.select("lang", "term", "lang_n", F.monotonically_increasing_id().alias("term_id")), "kept")
        cells = scratch.write(counts.drop("df").join(kept, ["lang", "term"]), "cells")
        per_lang = kept.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("lang_n").alias("lang_total"))
        totals = cells.groupBy("lang", "source").agg(F.sum("n").alias("total"))
        groups = groups.join(totals, ["lang", "source"], "left").join(per_lang, "lang", "left")
        zero = F.lit(0).cast("bigint")
        groups = groups.select(
            "lang", "source", F.monotonically_increasing_id().alias("gid"),
            *(F.coalesce(c, zero).alias(c) for c in ("total", "terms", "lang_total")),
        )
        # Without terms every share is the same number, and no term adds anything.
        empty = F.when(F.col("terms") > 0, share("0", "total", "greatest(terms, 1)")).otherwise(F.lit(1)).cast("bigint")
        groups = scratch.write(groups.withColumn("zero", empty), "groups")
        cells = cells.join(groups, ["lang", "source"])
        cells = cells.select(
            "lang", "source", "gid", "term", "term_id", share("n", "total", "terms").alias("p"), share("lang_n", "lang_total", "terms").alias("q")
        )
        cells = scratch.write(cells, "shares")

        values = scratch.write(pair_values(cells, groups.select("lang", "gid", "zero", "terms"), scratch), "values")
        both = values.unionByName(values.select(F.col("b").alias("a"), F.col("a").alias("b"), "value"))
        one = groups.select(F.col("gid").alias("a"), "lang", "source")
        other = groups.select(F.col("gid").alias("b"), F.col("source").alias("item"))
        pairs = both.join(one, "a").join(other, "b").select("lang", "source", F.lit("pair").alias("part"), "item", "value")

        over = cells.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), F.expr("(p - q) * (p - q) div (p + q)").alias("value"))
        order = Window.partitionBy("lang", "source", "part").orderBy(F.col("value").desc(), "item")
        ranked = F.row_number().over(order).alias("rank")
        out = pairs.select("*", ranked).unionByName(over.select("*", ranked).where(F.col("rank") <= top))
        return scratch.write(out, "rows", keep=True)


def oracle(least: int = 10, top: int = 10) -> str:
    """The audit as SQL over ``documents``."""
    return rf"""
    WITH d AS (
      SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
             regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS found FROM documents),
    w AS (SELECT r, lang, source, unnest(found) AS term FROM d),
    kept AS (SELECT lang, term, count(*) AS n FROM w GROUP BY ALL HAVING count(DISTINCT r) >= {least}),
    langs AS (SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang),
    counted AS (SELECT lang, source, term, count(*) AS n FROM w SEMI JOIN kept USING (lang, term) GROUP BY ALL),
    totals AS (SELECT lang, source, sum(n) AS total FROM counted GROUP BY ALL),
    groups AS (
      SELECT g.lang, g.source, coalesce(t.total, 0) AS total, coalesce(l.v, 0) AS v, l.total AS lang_total
      FROM (SELECT DISTINCT lang, source FROM d) g LEFT JOIN totals t USING (lang, source) LEFT JOIN langs l ON l.lang = g.lang),
    shares AS (
      SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, 1 + {SCALE} * (coalesce(c.n, 0) + 2) // (g.total + 2 * g.v) AS p,
             1 + {SCALE} * (k.n + 2) // (g.lang_total + 2 * g.v) AS q
      FROM groups g JOIN kept k USING (lang) LEFT JOIN counted c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
    added AS (
      SELECT x.lang, x.source, y.source AS item, sum((x.p - y.p) * (x.p - y.p) // (x.p + y.p)) AS value
      FROM shares x JOIN shares y ON x.lang = y.lang AND x.term = y.term AND x.source != y.source GROUP BY ALL),
    pairs AS (
      SELECT x.lang, x.source, 'pair' AS part, y.source AS item, CAST(coalesce(a.value, 0) AS BIGINT) AS value
      FROM groups x JOIN groups y ON x.lang = y.lang AND x.source != y.source
      LEFT JOIN added a ON a.lang = x.lang AND a.source = x.source AND a.item = y.source),
    terms AS (
      SELECT lang, source, 'term' AS part, term AS item, CAST((p - q) * (p - q) // (p + q) AS BIGINT) AS value FROM shares WHERE n > 0 AND p > q),
    ranked AS (
      SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INT) AS rank
      FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
    SELECT * FROM ranked WHERE part = 'pair' OR rank <= {top}
    """
