"""Splits, folds and samples."""

from __future__ import annotations

from rowsmith.operators import split as S
from rowsmith.queries.base import CLEAN_SQL, clean_orders, query

HASHED = f"""{CLEAN_SQL}, hashed AS (
  SELECT o_orderkey, order_status, md5('42:' || o_orderkey) AS h FROM clean WHERE order_status IS NOT NULL)"""

SIZES = """, sizes AS (SELECT order_status, count(*) AS n FROM hashed GROUP BY 1),
whole AS (SELECT sum(n)::BIGINT AS n, ceil(0.2 * sum(n))::BIGINT AS n_test FROM sizes)"""


@query(
    "split_random",
    f"""{HASHED}{SIZES}, ranked AS (SELECT o_orderkey, order_status, row_number() OVER (ORDER BY h) AS r FROM hashed)
    SELECT o_orderkey, order_status, CASE WHEN r <= n_test THEN 'test' ELSE 'train' END AS split FROM ranked, whole""",
)
def split_random(spark, sf):
    parts = S.train_test_split(clean_orders(spark, sf), ["o_orderkey"], "order_status", stratify=False)
    return parts.select("o_orderkey", "order_status", "split")


@query(
    "split_stratified",
    f"""{HASHED}{SIZES}, shares AS (
      SELECT order_status, s.n, (w.n - n_test) * s.n // w.n AS q, (w.n - n_test) * s.n % w.n AS rest,
        w.n - n_test AS n_train FROM sizes s, whole w),
    quotas AS (
      SELECT order_status, n - q - CASE WHEN row_number() OVER (ORDER BY rest DESC, order_status)
        <= n_train - sum(q) OVER () THEN 1 ELSE 0 END AS test_rows FROM shares),
    ranked AS (SELECT o_orderkey, order_status,
      row_number() OVER (PARTITION BY order_status ORDER BY h) AS r FROM hashed)
    SELECT o_orderkey, order_status, CASE WHEN r <= test_rows THEN 'test' ELSE 'train' END AS split
    FROM ranked JOIN quotas USING (order_status)""",
)
def split_stratified(spark, sf):
    parts = S.train_test_split(clean_orders(spark, sf), ["o_orderkey"], "order_status")
    return parts.select("o_orderkey", "order_status", "split")


@query(
    "cv_folds",
    f"""{HASHED}, dealt AS (SELECT order_status, (row_number() OVER (ORDER BY order_status) - 1) % 5 AS fold FROM hashed),
    quotas AS (SELECT order_status, fold, count(*) AS n FROM dealt GROUP BY 1, 2),
    reach AS (SELECT order_status, fold, sum(n) OVER (PARTITION BY order_status ORDER BY fold) AS upto, n FROM quotas),
    ranked AS (SELECT o_orderkey, order_status,
      row_number() OVER (PARTITION BY order_status ORDER BY h) AS r FROM hashed)
    SELECT o_orderkey, order_status, fold::INTEGER AS fold FROM ranked JOIN reach USING (order_status)
    WHERE r > upto - n AND r <= upto""",
)
def cv_folds(spark, sf):
    folds = S.stratified_folds(clean_orders(spark, sf), ["o_orderkey"], "order_status", folds=5)
    return folds.select("o_orderkey", "order_status", "fold")


@query(
    "sample_balanced",
    f"""{HASHED}, ranked AS (SELECT *, row_number() OVER (PARTITION BY order_status ORDER BY h) AS r FROM hashed),
    drawn AS (SELECT * FROM ranked WHERE r <= greatest(1, 100 // (SELECT count(DISTINCT order_status) FROM hashed))),
    rest AS (SELECT * FROM ranked ANTI JOIN drawn USING (o_orderkey) ORDER BY h
      LIMIT (SELECT greatest(0, 100 - count(*)) FROM drawn)),
    both_parts AS (SELECT o_orderkey, order_status, h, 0 AS part FROM drawn
      UNION ALL SELECT o_orderkey, order_status, h, 1 FROM rest)
    SELECT o_orderkey, order_status, CAST(row_number() OVER (ORDER BY part, order_status, h) AS INTEGER) AS sample_rank
    FROM both_parts QUALIFY sample_rank <= 100""",
)
def sample_balanced(spark, sf):
    sample = S.balanced_sample(clean_orders(spark, sf), ["o_orderkey"], "order_status", n=100)
    return sample.select("o_orderkey", "order_status", "sample_rank")
