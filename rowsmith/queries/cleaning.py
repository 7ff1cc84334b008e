"""Sources, cleaning, validation and profiling."""

from __future__ import annotations

from pyspark.sql import functions as F

from rowsmith.functions.expressions import first_contained, nan_to_null, tokens_to_null, year_from_text
from rowsmith.operators import clean as C
from rowsmith.operators import profile as P
from rowsmith.operators.infer import infer_columns
from rowsmith.queries.base import CLEAN_SQL, ORDERS_SPEC, RAW_ORDERS, clean_orders, derive, plain, query, raw_orders
from rowsmith.session import scratch_path
from rowsmith.sources.files import read_csv, write_csv
from rowsmith.spec import DateYear, NumericField, TableSpec

RAW = f"WITH raw AS ({plain(RAW_ORDERS)})"
CLEAN_COLUMNS = "o_orderkey, total_price, cust_no, order_year, priority, channel, order_status"


@query("src_csv_roundtrip", f"{CLEAN_SQL} SELECT {CLEAN_COLUMNS} FROM clean")
def src_csv_roundtrip(spark, sf):
    path = scratch_path(spark, "csv")
    write_csv(clean_orders(spark, sf), path)
    return C.clean(read_csv(spark, path), ORDERS_SPEC, mode="strict")


def _inferred(name: str, text: str) -> str:
    """What SQL says of one column."""
    return f"""SELECT '{name}' AS "column", count(t) AS n,
      count(*) FILTER (WHERE regexp_full_match(t, '[+-]?[0-9]{{1,18}}')) AS n_integer,
      count(*) FILTER (WHERE regexp_full_match(t, '[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]{{1,3}})?')) AS n_number,
      count(try_strptime(t, '%m/%d/%y')) AS n_date, count(DISTINCT t) AS d, string_agg(DISTINCT t, '|' ORDER BY t) AS v
      FROM (SELECT {text} AS t FROM raw)"""


@query(
    "spec_inferred",
    RAW
    + ", each AS ("
    + " UNION ALL ".join(
        _inferred(name, text)
        for name, text in (
            ("o_orderkey", "CAST(o_orderkey AS VARCHAR)"), ("TotalPrice", "CASE WHEN NOT isnan(TotalPrice) THEN CAST(TotalPrice AS VARCHAR) END"),
            ("CustNo", "CustNo"), ("OrderDate", "OrderDate"), ("Priority", "Priority"), ("Channel", "Channel"), ("Status", "nullif(Status, '')"),
            ("Extra", "CAST(Extra AS VARCHAR)"),
        )
    )
    + """), typed AS (SELECT *, CASE WHEN n_integer >= 0.95 * n THEN 'integer' WHEN n_number >= 0.95 * n THEN 'double'
      WHEN n_date >= 0.95 * n THEN 'date' WHEN d <= 50 THEN 'category' ELSE 'text' END AS type FROM each)
    SELECT "column", type, n, n_integer, n_number, n_date, CASE WHEN type = 'category' THEN v END AS vocabulary FROM typed""",
)
def spec_inferred(spark, sf):
    """Types and vocabularies of the raw orders as a CSV file shows them."""
    path = scratch_path(spark, "csv")
    write_csv(raw_orders(spark, sf), path)
    rows = infer_columns(read_csv(spark, path), formats=("M/d/yy",))
    return rows.select("column", "type", "n", "n_integer", "n_number", "n_date", F.array_join("vocabulary", "|").alias("vocabulary"))


@query(
    "clean_rename_project",
    f"""{RAW} SELECT o_orderkey, TotalPrice AS total_price, CustNo AS cust_no, Priority AS priority,
        Channel AS channel, Status AS order_status FROM raw WHERE TotalPrice IS NULL OR NOT isnan(TotalPrice)""",
)
def clean_rename_project(spark, sf):
    renamed = C.rename_columns(raw_orders(spark, sf), ORDERS_SPEC)
    return C.project_available(renamed, ORDERS_SPEC).filter("total_price IS NULL OR NOT isnan(total_price)")


@query("clean_features_target", f"{CLEAN_SQL} SELECT {CLEAN_COLUMNS} FROM clean WHERE order_status IS NOT NULL")
def clean_features_target(spark, sf):
    return C.features_and_target(clean_orders(spark, sf), ORDERS_SPEC)


@query(
    "clean_date_year",
    f"{RAW} SELECT o_orderkey, CAST(year(try_strptime(OrderDate, '%m/%d/%y')) AS INTEGER) AS order_year FROM raw",
)
def clean_date_year(spark, sf):
    return raw_orders(spark, sf).select("o_orderkey", year_from_text(F.col("OrderDate"), ("M/d/yy",)).alias("order_year"))


@query(
    "clean_nulls",
    f"""{RAW} SELECT o_orderkey, CASE WHEN isnan(TotalPrice) THEN NULL ELSE TotalPrice END AS total_price,
        TRY_CAST(CustNo AS DOUBLE) AS cust_no FROM raw""",
)
def clean_nulls(spark, sf):
    return raw_orders(spark, sf).select(
        "o_orderkey",
        nan_to_null(F.col("TotalPrice")).alias("total_price"),
        nan_to_null(F.col("CustNo").try_cast("double")).alias("cust_no"),
    )


@query(
    "clean_null_tokens",
    f"""{RAW} SELECT o_orderkey,
        CASE WHEN Priority = '.' OR trim(Priority) = '' THEN NULL ELSE Priority END AS priority FROM raw""",
)
def clean_null_tokens(spark, sf):
    return raw_orders(spark, sf).select(
        "o_orderkey", tokens_to_null(F.col("Priority"), (".",), blank=True).alias("priority")
    )


@query(
    "clean_canonical_target",
    f"""{RAW} SELECT o_orderkey, CASE WHEN contains(Status, 'Final') THEN 'Final'
        WHEN contains(Status, 'Open') THEN 'Open' WHEN contains(Status, 'Pending') THEN 'Pending'
        ELSE Status END AS order_status FROM raw""",
)
def clean_canonical_target(spark, sf):
    return raw_orders(spark, sf).select(
        "o_orderkey", first_contained(F.col("Status"), ("Final", "Open", "Pending")).alias("order_status")
    )


@query("clean_full", f"{CLEAN_SQL} SELECT {CLEAN_COLUMNS} FROM clean")
def clean_full(spark, sf):
    return clean_orders(spark, sf)


@query("quarantine_rows", f"{CLEAN_SQL} SELECT o_orderkey, reasons FROM flagged WHERE reasons <> ''")
def quarantine_rows(spark, sf):
    _, rejected = C.quarantine(raw_orders(spark, sf), ORDERS_SPEC)
    reason = F.transform("violations", lambda v: F.concat_ws(":", v["field"], v["rule"]))
    return rejected.select("o_orderkey", F.concat_ws(",", reason).alias("reasons"))


@query(
    "validate_violations",
    f"""{CLEAN_SQL}, broken AS (SELECT unnest(string_split(reasons, ',')) AS reason FROM flagged WHERE reasons <> '')
    SELECT split_part(reason, ':', 1) AS field, split_part(reason, ':', 2) AS rule, count(*) AS n
    FROM broken GROUP BY 1, 2""",
)
def validate_violations(spark, sf):
    flagged = C.canonicalise(raw_orders(spark, sf), ORDERS_SPEC)
    return flagged.select(F.inline("violations")).groupBy("field", "rule").agg(F.count("*").alias("n"))


@query(
    "profile_target_dist",
    f"{CLEAN_SQL} SELECT order_status AS label, count(*) AS n FROM clean WHERE order_status IS NOT NULL GROUP BY 1",
)
def profile_target_dist(spark, sf):
    return P.target_distribution(clean_orders(spark, sf), "order_status")


@query(
    "profile_summary",
    f"""{CLEAN_SQL} SELECT count(*) AS total_rows, count(order_status) AS rows_with_target,
        3 AS numeric_features, 2 AS categorical_features, 5 AS total_features FROM clean""",
)
def profile_summary(spark, sf):
    return P.row_summary(clean_orders(spark, sf), ORDERS_SPEC)


@query(
    "profile_missing",
    f"""{CLEAN_SQL}, kept AS (SELECT * FROM clean WHERE order_status IS NOT NULL), counted AS (
      SELECT 'total_price' AS feature, count(*) - count(total_price) AS missing FROM kept UNION ALL
      SELECT 'cust_no', count(*) - count(cust_no) FROM kept UNION ALL
      SELECT 'order_year', count(*) - count(order_year) FROM kept UNION ALL
      SELECT 'priority', count(*) - count(priority) FROM kept UNION ALL
      SELECT 'channel', count(*) - count(channel) FROM kept)
    SELECT feature, missing FROM counted WHERE missing > 0""",
)
def profile_missing(spark, sf):
    return P.missing_counts(clean_orders(spark, sf), ORDERS_SPEC)


@query(
    "spec_catalog",
    f"""{CLEAN_SQL} SELECT * FROM (
      SELECT 0 AS position, 'total_price' AS feature, 'numeric' AS role, 'double' AS dtype,
        0.0::DOUBLE AS low, NULL::DOUBLE AS high, NULL::VARCHAR AS allowed, count(total_price) AS filled_rows FROM clean UNION ALL
      SELECT 1, 'cust_no', 'numeric', 'int', 0.0, NULL, NULL, count(cust_no) FROM clean UNION ALL
      SELECT 2, 'order_year', 'numeric', 'int', 1995.0, 2000.0, NULL, count(order_year) FROM clean UNION ALL
      SELECT 3, 'priority', 'categorical', 'string', NULL, NULL,
        '1-URGENT|2-HIGH|3-MEDIUM|4-NOT SPECIFIED|5-LOW', count(priority) FROM clean UNION ALL
      SELECT 4, 'channel', 'categorical', 'string', NULL, NULL, 'WEB|STORE|PHONE', count(channel) FROM clean UNION ALL
      SELECT 5, 'order_status', 'target', 'string', NULL, NULL, 'Final|Open|Pending', count(order_status) FROM clean)""",
)
def spec_catalog(spark, sf):
    return C.spec_catalogue(clean_orders(spark, sf), ORDERS_SPEC)


@query(
    "score_validate",
    f"""{RAW}, checked AS (SELECT o_orderkey, concat_ws(',',
        CASE WHEN TotalPrice IS NULL OR isnan(TotalPrice) THEN 'total_price:required' END,
        CASE WHEN TotalPrice < 0 THEN 'total_price:range' END,
        CASE WHEN NOT isnan(TotalPrice) AND TotalPrice NOT BETWEEN 2000 AND 400000 THEN 'total_price:scoring_range' END,
        CASE WHEN CustNo IS NULL THEN 'cust_no:required' END,
        CASE WHEN CustNo = 'n/k' THEN 'cust_no:type' END,
        CASE WHEN TRY_CAST(CustNo AS INTEGER) NOT BETWEEN 1 AND 1000000 THEN 'cust_no:scoring_range' END,
        CASE WHEN OrderDate = 'unknown' THEN 'order_year:required' END,
        CASE WHEN year(try_strptime(OrderDate, '%m/%d/%y')) NOT BETWEEN 1995 AND 2000 THEN 'order_year:range' END,
        CASE WHEN Priority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED', '5-LOW')
             THEN 'priority:vocabulary' END,
        CASE WHEN Channel IS NULL THEN 'channel:required' END,
        CASE WHEN Channel NOT IN ('WEB', 'STORE', 'PHONE') THEN 'channel:vocabulary' END) AS reasons FROM raw)
    SELECT o_orderkey, reasons, reasons = '' AS accepted FROM checked""",
)
def score_validate(spark, sf):
    rows = C.derive_year(C.rename_columns(raw_orders(spark, sf), ORDERS_SPEC), ORDERS_SPEC)
    checked = C.check_scoring_input(rows, ORDERS_SPEC)
    reason = F.transform("violations", lambda v: F.concat_ws(":", v["field"], v["rule"]))
    return checked.select(
        "o_orderkey",
        F.concat_ws(",", reason).alias("reasons"),
        (F.size("violations") == 0).alias("accepted"),
    )


NOTED = f"""
SELECT *, ' said "' || coalesce(Priority, '') || '", twice ' AS Note FROM ({RAW_ORDERS})
"""


@query(
    "src_csv_raw",
    f"""{RAW} SELECT o_orderkey, CASE WHEN isnan(TotalPrice) THEN NULL ELSE TotalPrice END AS price,
        CASE WHEN CustNo IN ('', 'n/a') THEN NULL ELSE CustNo END AS cust, Priority AS priority, nullif(Channel, '') AS channel,
        nullif(Status, '') AS status, ' said "' || coalesce(Priority, '') || '", twice ' AS note FROM raw""",
)
def src_csv_raw(spark, sf):
    """All raw rows through a file: missing texts, blanks, quotes and bad cells come back as they were."""
    path = scratch_path(spark, "csv")
    write_csv(derive(spark, sf, NOTED, "orders"), path)
    back = read_csv(spark, path)
    return back.select(
        F.col("o_orderkey").cast("bigint").alias("o_orderkey"), F.col("TotalPrice").cast("double").alias("price"),
        F.col("CustNo").alias("cust"), F.col("Priority").alias("priority"), F.col("Channel").alias("channel"),
        F.col("Status").alias("status"), F.col("Note").alias("note"),
    )


WIDE_NUMBERS = """
SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN CAST(o_custkey AS DOUBLE) * 10000000 WHEN o_orderkey % 7 = 0 THEN NULL
  ELSE CAST(o_custkey AS DOUBLE) END AS amount FROM {orders}
"""


@query(
    "clean_int_overflow",
    f"""WITH w AS ({plain(WIDE_NUMBERS)}) SELECT o_orderkey, CASE WHEN abs(amount) <= 2147483647 THEN CAST(amount AS INTEGER) END AS amount,
        CASE WHEN amount > 2147483647 THEN 'amount:type' ELSE '' END AS reasons FROM w""",
)
def clean_int_overflow(spark, sf):
    """A number that the declared type cannot hold is a violation, not a missing value."""
    spec = TableSpec(key=("o_orderkey",), numeric=(NumericField("amount", "int"),))
    rows = C.clean(derive(spark, sf, WIDE_NUMBERS, "orders"), spec, mode="flag")
    reason = F.transform("violations", lambda v: F.concat_ws(":", v["field"], v["rule"]))
    return rows.select("o_orderkey", "amount", F.concat_ws(",", reason).alias("reasons"))


DATED = """
SELECT o_orderkey, CASE o_orderkey % 5
  WHEN 0 THEN CAST(month(o_orderdate) AS STRING) || '/' || CAST(day(o_orderdate) AS STRING) || '/' || lpad(CAST(year(o_orderdate) % 100 AS STRING), 2, '0')
  WHEN 1 THEN CAST(month(o_orderdate) AS STRING) || '/' || CAST(day(o_orderdate) AS STRING) || '/' || CAST(year(o_orderdate) AS STRING)
  WHEN 2 THEN CAST(CAST(o_orderdate AS DATE) AS STRING)
  WHEN 3 THEN 'some day' ELSE NULL END AS day, o_orderdate FROM {orders}
"""


@query(
    "clean_date_formats",
    f"""WITH d AS ({plain(DATED)}) SELECT o_orderkey, CASE WHEN o_orderkey % 5 < 3 THEN CAST(year(o_orderdate) AS INTEGER) END AS order_year,
        CASE WHEN o_orderkey % 5 = 3 THEN 'order_year:date' ELSE '' END AS reasons FROM d""",
)
def clean_date_formats(spark, sf):
    """Dates in several formats, and those in none of them flagged."""
    spec = TableSpec(key=("o_orderkey",), numeric=(NumericField("order_year", "int"),), date_year=DateYear("day", "order_year", flag_unparsable=True))
    rows = C.clean(derive(spark, sf, DATED, "orders"), spec, mode="flag")
    reason = F.transform("violations", lambda v: F.concat_ws(":", v["field"], v["rule"]))
    return rows.select("o_orderkey", "order_year", F.concat_ws(",", reason).alias("reasons"))
