"""Registration and the input tables shared by several queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowsmith.spec import CategoryField, DateYear, NumericField, TableSpec, TargetField

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    """Register a query under ``name``; ``oracle`` is the equivalent SQL, if there is one."""

    def wrap(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return wrap


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def derive(spark: SparkSession, sf_dir: str, sql: str, *names: str) -> DataFrame:
    """Run SQL whose ``{table}`` placeholders are the given tables."""
    return spark.sql(sql, **{n: table(spark, sf_dir, n) for n in names})


def plain(sql: str) -> str:
    """The same SQL with bare table names."""
    for name in ("orders", "lineitem", "part", "documents", "labels", "events", "embeddings", "customer"):
        sql = sql.replace("{" + name + "}", name)
    return sql


def r6(c: Column | str) -> Column:
    """Rounded to six digits, because summation order differs between engines."""
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


# Orders as a raw table: foreign headers, text dates, decorated labels, missing and bad cells.
RAW_ORDERS = """
SELECT o_orderkey,
  CASE WHEN o_orderkey % 17 = 0 THEN NULL
       WHEN o_orderkey % 23 = 0 THEN -o_totalprice
       WHEN o_orderkey % 29 = 0 THEN CAST('NaN' AS DOUBLE)
       ELSE o_totalprice END AS TotalPrice,
  CASE WHEN o_orderkey % 59 = 0 THEN 'n/k'
       WHEN o_orderkey % 61 = 0 THEN NULL
       ELSE CAST(o_custkey AS STRING) END AS CustNo,
  CASE WHEN o_orderkey % 31 = 0 THEN 'unknown'
       ELSE CAST(month(o_orderdate) AS STRING) || '/' || CAST(day(o_orderdate) AS STRING) || '/'
            || lpad(CAST(year(o_orderdate) % 100 AS STRING), 2, '0') END AS OrderDate,
  CASE WHEN o_orderkey % 13 = 0 THEN '.'
       WHEN o_orderkey % 19 = 0 THEN '  '
       WHEN o_orderkey % 37 = 0 THEN o_orderpriority || ' '
       ELSE o_orderpriority END AS Priority,
  CASE WHEN o_orderkey % 67 = 0 THEN 'FAX'
       WHEN o_orderkey % 71 = 0 THEN NULL
       WHEN o_custkey % 3 = 0 THEN 'WEB'
       WHEN o_custkey % 3 = 1 THEN 'STORE'
       ELSE 'PHONE' END AS Channel,
  CASE WHEN o_orderkey % 41 = 0 THEN 'Open, soon Final'
       WHEN o_orderkey % 43 = 0 THEN 'Cancelled'
       WHEN o_orderkey % 47 = 0 THEN NULL
       WHEN o_orderkey % 53 = 0 THEN ''
       WHEN o_orderstatus = 'F' THEN 'Final order (closed)'
       WHEN o_orderstatus = 'O' THEN 'Open order (running)'
       ELSE 'Pending order (held)' END AS Status,
  o_custkey AS Extra
FROM {orders}
"""

ORDERS_SPEC = TableSpec(
    key=("o_orderkey",),
    numeric=(
        NumericField("total_price", "double", low=0, score_low=2000, score_high=400000),
        NumericField("cust_no", "int", low=0, score_low=1, score_high=1000000),
        NumericField("order_year", "int", low=1995, high=2000),
    ),
    categorical=(
        CategoryField(
            "priority",
            ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"),
            null_tokens=(".",),
            blank_is_null=True,
        ),
        CategoryField("channel", ("WEB", "STORE", "PHONE")),
    ),
    target=TargetField("order_status", ("Final", "Open", "Pending"), by_substring=True),
    rename={
        "TotalPrice": "total_price",
        "CustNo": "cust_no",
        "OrderDate": "order_date",
        "Priority": "priority",
        "Channel": "channel",
        "Status": "order_status",
    },
    date_year=DateYear("order_date", "order_year", ("M/d/yy",)),
    key_type="bigint",
)

# The same cleaning as plain SQL: canonical cells and the broken rules of each row.
CLEAN_SQL = f"""
WITH raw AS ({plain(RAW_ORDERS)}),
typed AS (
  SELECT o_orderkey,
    CASE WHEN isnan(TotalPrice) THEN NULL ELSE TotalPrice END AS total_price,
    TRY_CAST(CustNo AS INTEGER) AS cust_no,
    CAST(year(try_strptime(OrderDate, '%m/%d/%y')) AS INTEGER) AS order_year,
    CASE WHEN Priority = '.' OR trim(Priority) = '' THEN NULL ELSE Priority END AS priority,
    Channel AS channel,
    CASE WHEN contains(Status, 'Final') THEN 'Final' WHEN contains(Status, 'Open') THEN 'Open'
         WHEN contains(Status, 'Pending') THEN 'Pending' ELSE Status END AS order_status,
    CustNo IS NOT NULL AND TRY_CAST(CustNo AS INTEGER) IS NULL AS bad_type
  FROM raw),
flagged AS (
  SELECT *, concat_ws(',',
    CASE WHEN total_price < 0 THEN 'total_price:range' END,
    CASE WHEN bad_type THEN 'cust_no:type' END,
    CASE WHEN order_year NOT BETWEEN 1995 AND 2000 THEN 'order_year:range' END,
    CASE WHEN priority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED', '5-LOW')
         THEN 'priority:vocabulary' END,
    CASE WHEN channel NOT IN ('WEB', 'STORE', 'PHONE') THEN 'channel:vocabulary' END,
    CASE WHEN order_status NOT IN ('Final', 'Open', 'Pending') THEN 'order_status:vocabulary' END
  ) AS reasons
  FROM typed),
clean AS (
  SELECT o_orderkey, total_price, cust_no, order_year, priority, channel, order_status
  FROM flagged WHERE reasons = '')
"""

# Predictions with a label that is only true (T) and one that is only predicted (P).
PREDICTED = """
SELECT l_orderkey, l_linenumber,
  CASE WHEN l_partkey % 97 = 0 THEN 'T' ELSE l_returnflag END AS y_true,
  CASE WHEN l_suppkey % 89 = 0 THEN 'P' WHEN l_quantity > 40 THEN 'N'
       WHEN l_partkey % 7 = 0 THEN 'R' ELSE l_returnflag END AS y_pred
FROM {lineitem}
"""


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive(spark, sf_dir, RAW_ORDERS, "orders")


def clean_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rowsmith.operators.clean import clean

    return clean(raw_orders(spark, sf_dir), ORDERS_SPEC, mode="drop")


def predicted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive(spark, sf_dir, PREDICTED, "lineitem")
