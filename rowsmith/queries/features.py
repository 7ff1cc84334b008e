"""Fitted statistics and feature transforms."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from rowsmith.operators import statistics as st
from rowsmith.operators.features import Preprocessor, preprocess
from rowsmith.operators.split import train_test_split
from rowsmith.queries.base import CLEAN_SQL, ORDERS_SPEC, clean_orders, derive, query, r6
from rowsmith.queries.splitting import HASHED, SIZES
from rowsmith.spec import CategoryField, TableSpec

NUMBERS = ("total_price", "cust_no", "order_year")
PRIORITIES = ORDERS_SPEC.categorical[0].allowed
CHANNELS = ORDERS_SPEC.categorical[1].allowed


def _per_column(expression: str, source: str = "clean", columns=NUMBERS) -> str:
    """``UNION ALL`` of one statistic for several columns."""
    return " UNION ALL ".join(
        f"SELECT '{c}' AS feature, {expression.format(c=c)} AS value FROM {source}" for c in columns
    )


@query("fit_impute_mean", f"{CLEAN_SQL} SELECT feature, round(value, 6) AS value FROM ({_per_column('avg({c})')})")
def fit_impute_mean(spark, sf):
    found = st.moments(clean_orders(spark, sf), list(NUMBERS))
    means = spark.createDataFrame([(n, m.mean) for n, m in found.items()], "feature string, value double")
    return means.select("feature", r6("value").alias("value"))


@query(
    "fit_impute_median",
    f"{CLEAN_SQL} SELECT feature, round(value, 6) AS value FROM ({_per_column('CAST(median({c}) AS DOUBLE)')})",
)
def fit_impute_median(spark, sf):
    found = st.medians(clean_orders(spark, sf), list(NUMBERS))
    medians = spark.createDataFrame(list(found.items()), "feature string, value double")
    return medians.select("feature", r6("value").alias("value"))


MODE = "(SELECT {c} FROM clean WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)"


@query(
    "fit_impute_mode",
    f"""{CLEAN_SQL} SELECT 'priority' AS feature, {MODE.format(c='priority')} AS value
        UNION ALL SELECT 'channel', {MODE.format(c='channel')}""",
)
def fit_impute_mode(spark, sf):
    found = st.modes(clean_orders(spark, sf), ["priority", "channel"], "string")
    return spark.createDataFrame(list(found.items()), "feature string, value string")


@query(
    "fit_impute_mode_numeric",
    f"""{CLEAN_SQL} SELECT 'cust_no' AS feature, CAST({MODE.format(c='cust_no')} AS DOUBLE) AS value
        UNION ALL SELECT 'order_year', {MODE.format(c='order_year')}""",
)
def fit_impute_mode_numeric(spark, sf):
    found = st.modes(clean_orders(spark, sf), ["cust_no", "order_year"], "double")
    return spark.createDataFrame(list(found.items()), "feature string, value double")


FILLED = "coalesce({c}, (SELECT avg({c}) FROM clean))"


@query(
    "fit_scale_stats",
    f"""{CLEAN_SQL} SELECT feature, round(mean, 6) AS mean, round(std, 6) AS std FROM ("""
    + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, avg({FILLED.format(c=c)}) AS mean, stddev_pop({FILLED.format(c=c)}) AS std FROM clean"
        for c in NUMBERS
    )
    + ")",
)
def fit_scale_stats(spark, sf):
    fitted = Preprocessor(ORDERS_SPEC).fit(clean_orders(spark, sf))
    rows = [(s.name, s.mean, s.std) for s in fitted.numeric]
    return spark.createDataFrame(rows, "feature string, mean double, std double").select(
        "feature", r6("mean").alias("mean"), r6("std").alias("std")
    )


@query(
    "fit_categories",
    f"""{CLEAN_SQL} SELECT 'priority' AS feature, coalesce(priority, 'Missing') AS category FROM clean GROUP BY 2
        UNION ALL SELECT 'channel', coalesce(channel, 'Missing') FROM clean GROUP BY 2""",
)
def fit_categories(spark, sf):
    fitted = Preprocessor(ORDERS_SPEC).fit(clean_orders(spark, sf))
    rows = [(s.name, c) for s in fitted.categorical for c in s.categories]
    return spark.createDataFrame(rows, "feature string, category string")


def _imputed(strategy: str):
    def run(spark, sf):
        df = clean_orders(spark, sf)
        fitted = Preprocessor(ORDERS_SPEC, numeric_strategy=strategy).fit(df)
        filled = fitted.impute(df, ["o_orderkey"])
        return filled.select("o_orderkey", *[r6(c).alias(c) for c in NUMBERS])

    return run


def _imputed_sql(agg: str) -> str:
    cells = ", ".join(f"round(coalesce({c}, (SELECT {agg}({c}) FROM clean))::DOUBLE, 6) AS {c}" for c in NUMBERS)
    return f"{CLEAN_SQL} SELECT o_orderkey, {cells} FROM clean"


query("feat_impute_mean", _imputed_sql("avg"))(_imputed("mean"))
query("feat_impute_median", _imputed_sql("median"))(_imputed("median"))


@query(
    "feat_impute_cat",
    f"""{CLEAN_SQL} SELECT o_orderkey, coalesce(priority, 'Missing') AS priority_const,
        coalesce(priority, {MODE.format(c='priority')}) AS priority_mode FROM clean""",
)
def feat_impute_cat(spark, sf):
    df = clean_orders(spark, sf)
    constant = Preprocessor(ORDERS_SPEC).fit(df)
    frequent = Preprocessor(ORDERS_SPEC, categorical_strategy="most_frequent").fit(df)
    fills = [next(s.fill for s in f.categorical if s.name == "priority") for f in (constant, frequent)]
    return df.select(
        "o_orderkey",
        F.coalesce("priority", F.lit(fills[0])).alias("priority_const"),
        F.coalesce("priority", F.lit(fills[1])).alias("priority_mode"),
    )


def _scaled_sql(c: str, rows: str = "clean") -> str:
    return (
        f"round((coalesce({c}, (SELECT avg({c}) FROM {rows})) - (SELECT avg({c}) FROM {rows})) / "
        f"(SELECT stddev_pop(coalesce({c}, (SELECT avg({c}) FROM {rows}))) FROM {rows}), 6) AS {c}"
    )


SCALED = ", ".join(_scaled_sql(c) for c in NUMBERS)


@query("feat_scale", f"{CLEAN_SQL} SELECT o_orderkey, {SCALED} FROM clean")
def feat_scale(spark, sf):
    df = clean_orders(spark, sf)
    fitted = Preprocessor(ORDERS_SPEC.with_features(list(NUMBERS), [])).fit(df)
    return fitted.transform(df, ["o_orderkey"]).select("o_orderkey", *[(r6(c) + 0.0).alias(c) for c in NUMBERS])


def _onehot_sql(column: str, categories, fill: str | None = "Missing") -> str:
    cell = f"coalesce({column}, '{fill}')" if fill else column
    return ", ".join(
        f"CASE WHEN {cell} = '{c}' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS \"{column}_{c}\"" for c in categories
    )


ONEHOT = ", ".join(
    [_onehot_sql("priority", [*PRIORITIES, "Missing"]), _onehot_sql("channel", ["Missing", *sorted(CHANNELS)])]
)
TEXT_SPEC = ORDERS_SPEC.with_features([], ["priority", "channel"])


@query("feat_onehot", f"{CLEAN_SQL} SELECT o_orderkey, {ONEHOT} FROM clean")
def feat_onehot(spark, sf):
    df = clean_orders(spark, sf)
    return Preprocessor(TEXT_SPEC).fit(df).transform(df, ["o_orderkey"])


@query(
    "feat_onehot_drop_first",
    f"""{CLEAN_SQL} SELECT o_orderkey, {_onehot_sql("priority", [*PRIORITIES[1:], "Missing"])},
        {_onehot_sql("channel", sorted(CHANNELS))} FROM clean""",
)
def feat_onehot_drop_first(spark, sf):
    df = clean_orders(spark, sf)
    return Preprocessor(TEXT_SPEC, drop_first=True).fit(df).transform(df, ["o_orderkey"])


@query(
    "feat_onehot_unknown",
    f"""{CLEAN_SQL} SELECT o_orderkey, {_onehot_sql("priority", ["1-URGENT", "2-HIGH", "Missing"])},
        {_onehot_sql("channel", ["Missing", *sorted(CHANNELS)])} FROM clean""",
)
def feat_onehot_unknown(spark, sf):
    df = clean_orders(spark, sf)
    seen = df.filter("priority IS NULL OR priority IN ('1-URGENT', '2-HIGH')")
    return Preprocessor(TEXT_SPEC).fit(seen).transform(df, ["o_orderkey"])


@query("feat_full", f"{CLEAN_SQL} SELECT o_orderkey, {SCALED}, {ONEHOT} FROM clean")
def feat_full(spark, sf):
    df = clean_orders(spark, sf)
    out = Preprocessor(ORDERS_SPEC).fit(df).transform(df, ["o_orderkey"])
    return out.withColumns({c: r6(c) + 0.0 for c in NUMBERS})


TRAIN_SPLIT = f"""{HASHED}{SIZES}, ranked AS (SELECT o_orderkey, row_number() OVER (ORDER BY h) AS r FROM hashed),
parts AS (SELECT clean.*, CASE WHEN r <= n_test THEN 'test' ELSE 'train' END AS split
  FROM ranked JOIN clean USING (o_orderkey), whole),
train AS (SELECT * FROM parts WHERE split = 'train')"""


@query(
    "feat_train_test",
    f"{TRAIN_SPLIT} SELECT o_orderkey, split, {', '.join(_scaled_sql(c, 'train') for c in NUMBERS)}, {ONEHOT} FROM parts",
)
def feat_train_test(spark, sf):
    parts = train_test_split(clean_orders(spark, sf), ["o_orderkey"], "order_status", stratify=False)
    train, test = parts.filter("split = 'train'"), parts.filter("split = 'test'")
    train_x, test_x, _ = preprocess(train, test, ORDERS_SPEC, keep=["o_orderkey", "split"])
    return train_x.unionByName(test_x).withColumns({c: r6(c) + 0.0 for c in NUMBERS})


INFO_NUMBERS = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, '{s}' AS statistic, round({e}, 6) AS value, NULL::VARCHAR AS text FROM clean"
    for c in NUMBERS
    for s, e in (
        ("fill", f"avg({c})"),
        ("mean", f"avg({FILLED.format(c=c)})"),
        ("scale", f"stddev_pop({FILLED.format(c=c)})"),
    )
)


@query(
    "feat_info",
    f"""{CLEAN_SQL}, cats AS (
      SELECT 0 AS p, 'priority' AS feature, coalesce(priority, 'Missing') AS category FROM clean GROUP BY 3
      UNION ALL SELECT 1, 'channel', coalesce(channel, 'Missing') FROM clean GROUP BY 3)
    {INFO_NUMBERS}
    UNION ALL SELECT unnest(['priority', 'channel']), 'fill', NULL, 'Missing'
    UNION ALL SELECT feature, 'category', (row_number() OVER (PARTITION BY feature ORDER BY category) - 1)::DOUBLE,
      category FROM cats
    UNION ALL SELECT unnest(['total_price', 'cust_no', 'order_year']), 'output', unnest([0.0, 1.0, 2.0])::DOUBLE, NULL
    UNION ALL SELECT feature || '_' || category, 'output',
      (row_number() OVER (ORDER BY p, category) + 2)::DOUBLE, NULL FROM cats""",
)
def feat_info(spark, sf):
    info = Preprocessor(ORDERS_SPEC).fit(clean_orders(spark, sf)).info(spark)
    return info.withColumn("value", r6("value"))


@query("feat_onehot_wide", "SELECT o_orderkey, 'cust_' || CAST(o_custkey % 300 AS VARCHAR) AS dense, 'cust_' || CAST(o_custkey % 300 AS VARCHAR) AS sparse FROM orders")
def feat_onehot_wide(spark, sf):
    """A column with well over 256 values: dense and sparse encodings have the same names and cells."""
    rows = derive(spark, sf, "SELECT o_orderkey, CAST(o_custkey % 300 AS STRING) AS cust FROM {orders}", "orders")
    found = []
    for sparse in (False, True):
        spec = TableSpec(key=("o_orderkey",), categorical=(CategoryField("cust", sparse=sparse),))
        fitted = Preprocessor(spec, max_dense=300).fit(rows)
        names = F.array(*map(F.lit, fitted.feature_names()))
        if sparse:
            hot = F.array_position(vector_to_array("cust_onehot"), F.lit(1.0))
            cells = fitted.transform(rows, ["o_orderkey"])
        else:
            cells = PipelineModel(fitted.stages()).transform(rows)
            hot = F.array_position(vector_to_array("features"), F.lit(1.0))
        found.append(cells.select("o_orderkey", F.element_at(names, hot.cast("int")).alias("sparse" if sparse else "dense")))
    return found[0].join(found[1], "o_orderkey")
