"""Classification, ranking and regression metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from rowsmith.operators import auc as U
from rowsmith.operators import curves as C
from rowsmith.operators import evaluate as E
from rowsmith.operators.profile import distinct_labels
from rowsmith.operators.vote import assemble_scores, soft_vote
from rowsmith.queries.base import PREDICTED, derive, plain, predicted, query, r6
from rowsmith.session import scratch_path
from rowsmith.sources.metrics import MetricsStore

LABELS = f"""WITH pred AS ({plain(PREDICTED)}),
labels_ AS (SELECT y_true AS label FROM pred UNION SELECT y_pred FROM pred),
cells AS (SELECT y_true, y_pred, count(*) AS n FROM pred GROUP BY 1, 2),
totals AS (SELECT label,
  coalesce((SELECT sum(n) FROM cells WHERE y_true = label AND y_pred = label), 0)::DOUBLE AS tp,
  coalesce((SELECT sum(n) FROM cells WHERE y_true = label), 0)::DOUBLE AS support,
  coalesce((SELECT sum(n) FROM cells WHERE y_pred = label), 0)::DOUBLE AS predicted FROM labels_),
scores AS (SELECT *, coalesce(tp / nullif(predicted, 0), 0) AS p, coalesce(tp / nullif(support, 0), 0) AS r,
  coalesce(2 * tp / nullif(predicted + support, 0), 0) AS f FROM totals)"""


PARTS = ["accuracy", "precision", "recall", "f1_score", "balanced_accuracy", "total_samples", "num_classes"]


@query(
    "eval_document",
    f"""{LABELS}, whole AS (SELECT sum(tp) / sum(support) AS accuracy, sum(p * support) / sum(support) AS precision,
      sum(r * support) / sum(support) AS recall, sum(f * support) / sum(support) AS f1_score,
      avg(r) FILTER (support > 0) AS balanced_accuracy, sum(support) AS total_samples, count(*)::DOUBLE AS num_classes FROM scores),
    means AS (SELECT unnest(['macro', 'weighted']) AS scope, unnest([avg(p), sum(p * support) / sum(support)]) AS p,
      unnest([avg(r), sum(r * support) / sum(support)]) AS r, unnest([avg(f), sum(f * support) / sum(support)]) AS f, sum(support) AS n FROM scores),
    cells_ AS (
      SELECT 'overall' AS scope, NULL AS label, unnest({PARTS}) AS metric,
        unnest([{", ".join(PARTS)}]) AS value FROM whole
      UNION ALL SELECT 'class', label, unnest(['precision', 'recall', 'f1_score', 'support']), unnest([p, r, f, support]) FROM scores
      UNION ALL SELECT scope, NULL, unnest(['precision', 'recall', 'f1_score', 'support']), unnest([p, r, f, n]) FROM means)
    SELECT 'm' AS model_id, 'test' AS split, scope, label, metric, round(value, 6) AS value FROM cells_""",
)
def eval_document(spark, sf):
    """All metrics as one document, saved as an entry of a metric store and read back."""
    store = MetricsStore(spark, scratch_path(spark, "metrics"))
    store.save(E.evaluate(predicted(spark, sf), "y_true", "y_pred"), "m")
    return store.load("m").select("model_id", "split", "scope", F.col("class").alias("label"), "metric", r6("value").alias("value"))


@query("eval_classes", f"{LABELS} SELECT label FROM labels_")
def eval_classes(spark, sf):
    return distinct_labels(predicted(spark, sf), "y_true", "y_pred")


@query(
    "eval_confusion",
    f"""{LABELS} SELECT t.label AS y_true, p.label AS y_pred, coalesce(n, 0) AS n FROM labels_ t CROSS JOIN labels_ p
        LEFT JOIN cells ON y_true = t.label AND y_pred = p.label""",
)
def eval_confusion(spark, sf):
    return E.confusion_matrix(predicted(spark, sf), "y_true", "y_pred")


@query(
    "eval_per_class",
    f"""{LABELS} SELECT label, round(p, 6) AS precision, round(r, 6) AS recall, round(f, 6) AS f1_score,
        support::BIGINT AS support FROM scores""",
)
def eval_per_class(spark, sf):
    rows = E.per_class_metrics(predicted(spark, sf), "y_true", "y_pred")
    return rows.select("label", *[r6(s).alias(s) for s in E.SCORES], "support")


@query(
    "eval_overall",
    f"""{LABELS} SELECT round(sum(tp) / sum(support), 6) AS accuracy, round(sum(p * support) / sum(support), 6) AS precision,
        round(sum(r * support) / sum(support), 6) AS recall, round(sum(f * support) / sum(support), 6) AS f1_score,
        sum(support)::BIGINT AS total_samples, count(*) AS num_classes FROM scores""",
)
def eval_overall(spark, sf):
    row = E.overall_metrics(predicted(spark, sf), "y_true", "y_pred")
    return row.select("accuracy", *[r6(s).alias(s) for s in E.SCORES], "total_samples", "num_classes").withColumn(
        "accuracy", r6("accuracy")
    )


@query(
    "eval_averages",
    f"""{LABELS} SELECT average, round(pp, 6) AS precision, round(rr, 6) AS recall, round(ff, 6) AS f1_score FROM (
      SELECT 'weighted' AS average, sum(p * support) / sum(support) AS pp, sum(r * support) / sum(support) AS rr,
        sum(f * support) / sum(support) AS ff FROM scores
      UNION ALL SELECT 'macro', avg(p), avg(r), avg(f) FROM scores
      UNION ALL SELECT 'micro', sum(tp) / sum(predicted), sum(tp) / sum(support),
        2 * sum(tp) / (sum(predicted) + sum(support)) FROM scores)""",
)
def eval_averages(spark, sf):
    rows = E.averages(predicted(spark, sf), "y_true", "y_pred")
    return rows.select("average", *[r6(s).alias(s) for s in E.SCORES])


@query(
    "eval_balanced_accuracy",
    f"""{LABELS} SELECT round(avg(r), 6) AS balanced_accuracy FROM scores WHERE support > 0""",
)
def eval_balanced_accuracy(spark, sf):
    row = E.averages_row(E.per_class_metrics(predicted(spark, sf), "y_true", "y_pred"))
    return row.select(r6("balanced_accuracy").alias("balanced_accuracy"))


@query(
    "eval_report",
    f"""{LABELS}, lines AS (
      SELECT 'class' AS scope, label, p, r, f, support FROM scores
      UNION ALL SELECT 'accuracy', 'accuracy', sum(tp) / sum(support), sum(tp) / sum(support),
        sum(tp) / sum(support), sum(support) FROM scores
      UNION ALL SELECT 'macro', 'macro avg', avg(p), avg(r), avg(f), sum(support) FROM scores
      UNION ALL SELECT 'weighted', 'weighted avg', sum(p * support) / sum(support), sum(r * support) / sum(support),
        sum(f * support) / sum(support), sum(support) FROM scores)
    SELECT scope, label, round(p, 6) AS precision, round(r, 6) AS recall, round(f, 6) AS f1_score,
      support::BIGINT AS support FROM lines""",
)
def eval_report(spark, sf):
    report = E.classification_report(predicted(spark, sf), "y_true", "y_pred")
    return report.select("scope", "label", *[r6(s).alias(s) for s in E.SCORES], "support")


RANKED = """, counted AS (SELECT grp, score, sum(hit)::DOUBLE AS pos, (count(*) - sum(hit))::DOUBLE AS neg
  FROM scored GROUP BY grp, score),
running AS (SELECT *, coalesce(sum(neg) OVER (PARTITION BY grp ORDER BY score
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM counted),
aucs AS (SELECT grp, sum(pos * (below + neg / 2)) / (sum(pos) * sum(neg)) AS auc, sum(pos) AS pos, sum(neg) AS neg
  FROM running GROUP BY grp)"""


@query(
    "eval_auc_binary",
    f"""WITH scored AS (SELECT 'all' AS grp, n_chars::DOUBLE AS score, CASE WHEN quality = 1 THEN 1 ELSE 0 END AS hit
      FROM labels JOIN documents USING (doc_id)){RANKED}
    SELECT round(auc, 6) AS roc_auc, pos::BIGINT AS positives, neg::BIGINT AS negatives FROM aucs""",
)
def eval_auc_binary(spark, sf):
    df = derive(spark, sf, "SELECT quality, n_chars FROM {labels} JOIN {documents} USING (doc_id)", "labels", "documents")
    return U.binary_auc(df, "quality", F.col("n_chars"), "1").withColumn("roc_auc", r6("roc_auc"))


@query(
    "eval_auc_scores",
    f"""WITH scored AS (SELECT 'all' AS grp, l_extendedprice * (1 - l_discount) AS score,
      CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS hit FROM lineitem){RANKED}
    SELECT round(auc, 6) AS roc_auc, pos::BIGINT AS positives, neg::BIGINT AS negatives FROM aucs""",
)
def eval_auc_scores(spark, sf):
    df = derive(
        spark, sf, "SELECT l_returnflag, l_extendedprice * (1 - l_discount) AS score FROM {lineitem}", "lineitem"
    )
    return U.binary_auc(df, "l_returnflag", F.col("score"), "R").withColumn("roc_auc", r6("roc_auc"))


# Class probabilities from a fixed rule, one weight per label.
WEIGHTS = """
SELECT l_orderkey, l_linenumber, l_returnflag,
  CAST(1 + l_partkey % 10 + CASE WHEN l_returnflag = 'A' THEN 3 ELSE 0 END AS DOUBLE) AS wa,
  CAST(1 + l_suppkey % 7 + CASE WHEN l_returnflag = 'N' THEN 2 ELSE 0 END AS DOUBLE) AS wn,
  CAST(1 + l_quantity AS DOUBLE) / 10 AS wr
FROM {lineitem}
"""


def _with_probabilities(spark, sf):
    total = F.col("wa") + F.col("wn") + F.col("wr")
    cells = [x for label, w in (("A", "wa"), ("N", "wn"), ("R", "wr")) for x in (F.lit(label), F.col(w) / total)]
    return derive(spark, sf, WEIGHTS, "lineitem").withColumn("proba", F.create_map(*cells))


@query(
    "eval_auc_ovr",
    f"""WITH w AS ({plain(WEIGHTS)}), scored AS (
      SELECT 'A' AS grp, wa / (wa + wn + wr) AS score, CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END AS hit FROM w
      UNION ALL SELECT 'N', wn / (wa + wn + wr), CASE WHEN l_returnflag = 'N' THEN 1 ELSE 0 END FROM w
      UNION ALL SELECT 'R', wr / (wa + wn + wr), CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END FROM w){RANKED}
    SELECT round(sum(auc * pos) / sum(pos), 6) AS weighted_auc, round(avg(auc), 6) AS macro_auc FROM aucs""",
)
def eval_auc_ovr(spark, sf):
    per_class = U.ovr_auc_per_class(_with_probabilities(spark, sf), "l_returnflag", "proba")
    weighted, macro = (U.average_auc(a) for a in ("weighted", "macro"))
    return per_class.agg(r6(weighted).alias("weighted_auc"), r6(macro).alias("macro_auc"))


@query(
    "eval_regression",
    """WITH d AS (SELECT l_extendedprice / 1000 AS y, 1.5::DOUBLE * l_quantity AS p FROM lineitem)
    SELECT round(avg(abs(y - p)), 6) AS mae, round(avg((y - p) * (y - p)), 6) AS mse,
      round(sqrt(avg((y - p) * (y - p))), 6) AS rmse,
      round(1 - sum((y - p) * (y - p)) / (count(*) * var_pop(y)), 6) AS r2, count(*) AS total_samples FROM d""",
)
def eval_regression(spark, sf):
    df = derive(spark, sf, "SELECT l_extendedprice / 1000 AS y, 1.5D * l_quantity AS p FROM {lineitem}", "lineitem")
    row = E.regression_metrics(df, "y", "p")
    return row.select(*[r6(c).alias(c) for c in ("mae", "mse", "rmse", "r2")], "total_samples")


@query(
    "score_assemble",
    f"""WITH w AS ({plain(WEIGHTS)}), p AS (SELECT *, wa / (wa + wn + wr) AS pa, wn / (wa + wn + wr) AS pn,
      wr / (wa + wn + wr) AS pr FROM w)
    SELECT l_orderkey, l_linenumber, CASE WHEN pa >= pn AND pa >= pr THEN 'A' WHEN pn >= pr THEN 'N' ELSE 'R' END
      AS prediction, round(greatest(pa, pn, pr), 6) AS confidence, round(pa, 6) AS p_a, round(pn, 6) AS p_n,
      round(pr, 6) AS p_r FROM p""",
)
def score_assemble(spark, sf):
    total = F.col("wa") + F.col("wn") + F.col("wr")
    rows = derive(spark, sf, WEIGHTS, "lineitem").withColumn(
        "p", F.array(F.col("wa") / total, F.col("wn") / total, F.col("wr") / total)
    )
    scored = assemble_scores(rows, "p", ["A", "N", "R"])
    return scored.select(
        "l_orderkey",
        "l_linenumber",
        "prediction",
        r6("confidence").alias("confidence"),
        *[r6(F.col("probabilities")[c]).alias(f"p_{c.lower()}") for c in "ANR"],
    )


@query(
    "score_soft_vote",
    f"""WITH w AS ({plain(WEIGHTS)}), p AS (SELECT *,
      (wa / (wa + wn + wr) + 0.2 + 0.5) / 3 AS pa, (wn / (wa + wn + wr) + 0.3 + 0.25) / 3 AS pn,
      (wr / (wa + wn + wr) + 0.5 + 0.25) / 3 AS pr FROM w)
    SELECT l_orderkey, l_linenumber, CASE WHEN pa >= pn AND pa >= pr THEN 'A' WHEN pn >= pr THEN 'N' ELSE 'R' END
      AS prediction, round(greatest(pa, pn, pr), 6) AS confidence FROM p""",
)
def score_soft_vote(spark, sf):
    total = F.col("wa") + F.col("wn") + F.col("wr")
    rows = derive(spark, sf, WEIGHTS, "lineitem").withColumns(
        {
            "p1": F.array(F.col("wa") / total, F.col("wn") / total, F.col("wr") / total),
            "p2": F.array(F.lit(0.2), F.lit(0.3), F.lit(0.5)),
            "p3": F.array(F.lit(0.5), F.lit(0.25), F.lit(0.25)),
        }
    )
    voted = soft_vote(rows, ["p1", "p2", "p3"], ["A", "N", "R"])
    return voted.select("l_orderkey", "l_linenumber", "prediction", r6("confidence").alias("confidence"))


UNSCORED = """
SELECT l_orderkey, l_linenumber, l_returnflag AS y_true,
  CASE WHEN l_partkey % 11 = 0 THEN NULL WHEN l_partkey % 7 = 0 THEN 'R' ELSE l_returnflag END AS y_pred
FROM {lineitem}
"""


@query(
    "eval_unscored",
    f"""WITH pred AS ({plain(UNSCORED)}) SELECT round(avg(CASE WHEN y_true IS NOT DISTINCT FROM y_pred THEN 1.0 ELSE 0 END), 6) AS accuracy,
        count(*) AS total_samples, count(*) FILTER (WHERE y_pred IS NULL) AS unscored FROM pred""",
)
def eval_unscored(spark, sf):
    """Rows without a prediction count as wrong."""
    pairs = E.label_pairs(derive(spark, sf, UNSCORED, "lineitem"), "y_true", "y_pred")
    row = E.averages_row(E.per_class_metrics(derive(spark, sf, UNSCORED, "lineitem"), "y_true", "y_pred"))
    missing = pairs.agg(F.sum(F.when(F.col("y_pred") == E.UNSCORED, F.col("n")).otherwise(0)).alias("unscored"))
    return row.select(r6("accuracy").alias("accuracy"), "total_samples").crossJoin(missing)


GROUPED_SCORES = """
SELECT l_linestatus || l_returnflag AS grp, l_quantity > 25 AS hit,
  CASE WHEN l_returnflag = 'R' AND l_partkey % 1000 = 0 THEN NULL WHEN l_returnflag = 'A' AND l_partkey % 1000 = 1 THEN CAST('NaN' AS DOUBLE)
       ELSE l_extendedprice END AS score
FROM {lineitem} WHERE l_linestatus = 'F' OR l_quantity > 25
"""


@query(
    "eval_auc_undefined",
    f"""WITH s AS ({plain(GROUPED_SCORES)}),
    r AS (SELECT *, rank() OVER (PARTITION BY grp ORDER BY score) + (count(*) OVER (PARTITION BY grp, score) - 1) / 2.0::DOUBLE AS k FROM s),
    g AS (SELECT grp, count(*) FILTER (WHERE hit)::DOUBLE AS p, count(*) FILTER (WHERE NOT hit)::DOUBLE AS n,
      sum(k) FILTER (WHERE hit) AS won, count(*) FILTER (WHERE score IS NULL OR isnan(score)) AS missing FROM r GROUP BY grp)
    SELECT grp, CASE WHEN missing = 0 AND n > 0 THEN round((won - p * (p + 1) / 2) / (p * n), 6) END AS roc_auc,
      p::BIGINT AS support, n::BIGINT AS negatives FROM g""",
)
def eval_auc_undefined(spark, sf):
    """A group with a row without score, or without negatives, has no AUC; its counts are still whole."""
    rows = U.grouped_auc(derive(spark, sf, GROUPED_SCORES, "lineitem"))
    return rows.select("grp", r6("roc_auc").alias("roc_auc"), "support", "negatives")


@query(
    "eval_average_precision",
    """WITH counted AS (
      SELECT l_extendedprice * (1 - l_discount) AS score, count(*) FILTER (l_returnflag = 'R') AS pos, count(*) AS n FROM lineitem GROUP BY 1),
    running AS (SELECT pos, sum(pos) OVER w / sum(n) OVER w AS precision FROM counted WINDOW w AS (ORDER BY score DESC))
    SELECT round(sum(pos * precision) / sum(pos), 6) AS average_precision, sum(pos)::BIGINT AS positives FROM running""",
)
def eval_average_precision(spark, sf):
    df = derive(spark, sf, "SELECT l_returnflag, l_extendedprice * (1 - l_discount) AS score FROM {lineitem}", "lineitem")
    return C.binary_average_precision(df, "l_returnflag", F.col("score"), "R").withColumn("average_precision", r6("average_precision"))


PAIRWISE = """SELECT l_returnflag, (l_quantity % 7) / 10 AS pa, (l_partkey % 11) / 20 AS pn, (l_suppkey % 5) / 10 AS pr FROM {lineitem}"""


@query(
    "eval_auc_ovo",
    f"""WITH rows AS ({plain(PAIRWISE)}), scores AS (
      SELECT l_returnflag AS truth, unnest(['A', 'A', 'N']) AS a, unnest(['N', 'R', 'R']) AS b, pa, pn, pr FROM rows),
    scored AS (
      SELECT a || b || f.side AS grp, truth, a, b, CASE (CASE f.side WHEN 'a' THEN a ELSE b END) WHEN 'A' THEN pa WHEN 'N' THEN pn ELSE pr END AS score,
             CASE WHEN truth = (CASE f.side WHEN 'a' THEN a ELSE b END) THEN 1 ELSE 0 END AS hit
      FROM scores, (VALUES ('a'), ('b')) f(side) WHERE truth IN (a, b)){RANKED}
    SELECT grp[1] AS a, grp[2] AS b, round(avg(auc), 6) AS roc_auc, max(pos + neg)::BIGINT AS support FROM aucs GROUP BY ALL""",
)
def eval_auc_ovo(spark, sf):
    df = derive(spark, sf, PAIRWISE, "lineitem")
    proba = F.create_map(F.lit("A"), F.col("pa"), F.lit("N"), F.col("pn"), F.lit("R"), F.col("pr"))
    return C.ovo_auc_per_pair(df.withColumn("proba", proba), "l_returnflag", "proba").withColumn("roc_auc", r6("roc_auc"))
