"""Evaluation of scores against labels."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.operators import evaluate as ev
from ledgerline.queries.base import query
from ledgerline.queries.frames import SCORED, frame, sql

_SCORED = sql(SCORED)


def _curve(score: str, by: str = "") -> str:
    keys = f"{by}, " if by else ""
    part = f"PARTITION BY {by}" if by else ""
    return f"""(
      SELECT {keys}s AS threshold, pos, neg, sum(pos) OVER ({part} ORDER BY s DESC) AS tp, sum(neg) OVER ({part} ORDER BY s DESC) AS fp,
        sum(pos) OVER ({part}) AS n_pos, sum(neg) OVER ({part}) AS n_neg
      FROM (SELECT {keys}{score} AS s, sum(label) AS pos, count(*) - sum(label) AS neg FROM {_SCORED} AS x GROUP BY {keys}{score}) AS h)"""


_RANKING = """
  sum(neg * (tp - pos / 2e0)) / max(n_pos * 1e0 * n_neg) AS auc_roc,
  sum(pos * 1e0 * tp / (tp + fp)) / max(n_pos) AS auc_pr,
  max(tp * 1e0 / n_pos - fp * 1e0 / n_neg) AS ks
"""

_CONFUSION = """
  count(*) FILTER ({s} >= {t} AND label = 1) AS tp, count(*) FILTER ({s} >= {t} AND label = 0) AS fp,
  count(*) FILTER ({s} < {t} AND label = 1) AS fn, count(*) FILTER ({s} < {t} AND label = 0) AS tn
"""

_RATES = """
  (tp + tn) * 1e0 / (tp + fp + fn + tn) AS accuracy,
  CASE WHEN tp + fp = 0 THEN 0e0 ELSE tp * 1e0 / (tp + fp) END AS "precision",
  CASE WHEN tp + fn = 0 THEN 0e0 ELSE tp * 1e0 / (tp + fn) END AS recall,
  CASE WHEN 2 * tp + fp + fn = 0 THEN 0e0 ELSE 2e0 * tp / (2 * tp + fp + fn) END AS f1
"""


def _scored(spark, sf):
    return frame(spark, sf, SCORED)


@query(
    "roc_points_all", "V1 W4",
    sql=f"""
    SELECT threshold, fp * 1e0 / n_neg AS fpr, tp * 1e0 / n_pos AS tpr FROM {_curve('coarse')} AS c
    UNION ALL SELECT 'inf'::DOUBLE, 0e0, 0e0
    """,
    doubles="threshold fpr tpr",
)
def _(spark, sf):
    return ev.roc_points(_scored(spark, sf), "coarse", "label", drop_intermediate=False)


_CORNERS = f"""(
  SELECT threshold, fp * 1e0 / n_neg AS fpr, tp * 1e0 / n_pos AS tpr FROM (
    SELECT *, lead(pos) OVER (ORDER BY threshold DESC) AS next_pos, lead(neg) OVER (ORDER BY threshold DESC) AS next_neg,
      row_number() OVER (ORDER BY threshold DESC) AS place FROM {{curve}} AS c) AS n
  WHERE place = 1 OR next_pos IS NULL OR next_pos <> pos OR next_neg <> neg
  UNION ALL SELECT 'inf'::DOUBLE, 0e0, 0e0)"""


@query(
    "roc_corner_points", "V1 W4",
    sql=f"SELECT * FROM {_CORNERS.format(curve=_curve('fine'))} AS p",
    doubles="threshold fpr tpr",
)
def _(spark, sf):
    return ev.roc_points(_scored(spark, sf), "fine", "label")


@query(
    "ranking_metrics_tied_scores", "V2 V3 V5",
    sql=f"SELECT cast(max(n_pos) AS bigint) AS n_pos, cast(max(n_neg) AS bigint) AS n_neg, {_RANKING} FROM {_curve('coarse')} AS c",
    doubles="auc_roc auc_pr ks",
)
def _(spark, sf):
    return ev.ranking_metrics(_scored(spark, sf), "coarse", "label")


@query(
    "ranking_metrics_fine_scores", "V2 V3 V5",
    sql=f"SELECT cast(max(n_pos) AS bigint) AS n_pos, cast(max(n_neg) AS bigint) AS n_neg, {_RANKING} FROM {_curve('fine')} AS c",
    doubles="auc_roc auc_pr ks",
)
def _(spark, sf):
    return ev.ranking_metrics(_scored(spark, sf), "fine", "label")


@query(
    "ranking_metrics_by_part", "V13 V2 V3",
    sql=f"SELECT part, cast(max(n_pos) AS bigint) AS n_pos, cast(max(n_neg) AS bigint) AS n_neg, {_RANKING} FROM {_curve('fine', 'part')} AS c GROUP BY part",
    doubles="auc_roc auc_pr ks",
)
def _(spark, sf):
    return ev.ranking_metrics(_scored(spark, sf), "fine", "label", by=["part"])


@query(
    "precision_recall_points", "V4",
    sql=f"""
    SELECT threshold, tp * 1e0 / (tp + fp) AS "precision", tp * 1e0 / n_pos AS recall, n_pos * 1e0 / (n_pos + n_neg) AS prior FROM {_curve('coarse')} AS c
    UNION ALL SELECT NULL, 1e0, 0e0, avg(label) FROM {_SCORED} AS x
    """,
    doubles='threshold "precision" recall prior',
)
def _(spark, sf):
    return ev.precision_recall_points(_scored(spark, sf), "coarse", "label")


@query("confusion_at_threshold", "V6", sql=f"SELECT {_CONFUSION.format(s='fine', t='0.5e0')} FROM {_SCORED} AS x")
def _(spark, sf):
    return ev.confusion_at(_scored(spark, sf), "fine", "label", 0.5)


@query(
    "normalized_confusion", "V7",
    sql=f"""
    SELECT label AS actual, CASE WHEN fine >= 0.5e0 THEN 1 ELSE 0 END AS predicted, count(*) AS n,
      100e0 * count(*) / sum(count(*)) OVER (PARTITION BY label) AS pct
    FROM {_SCORED} AS x GROUP BY 1, 2
    """,
    doubles="pct",
)
def _(spark, sf):
    return ev.normalized_confusion(_scored(spark, sf), "fine", "label", 0.5)


@query(
    "metrics_at_threshold", "V8",
    sql=f"SELECT *, {_RATES} FROM (SELECT {_CONFUSION.format(s='fine', t='0.4e0')} FROM {_SCORED} AS x) AS c",
    doubles='accuracy "precision" recall f1',
)
def _(spark, sf):
    return ev.metrics_at(_scored(spark, sf), "fine", "label", 0.4)


@query(
    "full_evaluation", "V2 V3 V5 V8",
    sql=f"""
    SELECT auc_roc, auc_pr, ks, accuracy, "precision", recall, f1
    FROM (SELECT {_RANKING} FROM {_curve('fine')} AS c) AS r,
      (SELECT {_RATES} FROM (SELECT {_CONFUSION.format(s='fine', t='0.5e0')} FROM {_SCORED} AS x) AS c) AS m
    """,
    doubles='auc_roc auc_pr ks accuracy "precision" recall f1',
)
def _(spark, sf):
    return ev.evaluate(_scored(spark, sf), "fine", "label")


@query(
    "metrics_at_youden", "V9 V8",
    sql=f"""
    SELECT *, {_RATES} FROM (
      SELECT threshold, cast(tp AS bigint) AS tp, cast(fp AS bigint) AS fp, cast(n_pos - tp AS bigint) AS fn, cast(n_neg - fp AS bigint) AS tn
      FROM {_curve('fine')} AS c ORDER BY tp * 1e0 / n_pos - fp * 1e0 / n_neg DESC, threshold DESC LIMIT 1) AS b
    """,
    doubles='threshold accuracy "precision" recall f1',
)
def _(spark, sf):
    return ev.at_youden(_scored(spark, sf), "fine", "label")


@query(
    "threshold_sweep", "V10 V6",
    sql=f"""
    SELECT *, {_RATES}, (tp + fp) * 1e0 / (tp + fp + fn + tn) AS flagged FROM (
      SELECT t AS threshold, {_CONFUSION.format(s='fine', t='t')}
      FROM {_SCORED} AS x, (SELECT i / 100e0 AS t FROM range(5, 96) AS r(i)) AS th GROUP BY t) AS c
    """,
    doubles='threshold accuracy "precision" recall f1 flagged',
)
def _(spark, sf):
    return ev.threshold_sweep(_scored(spark, sf), "fine", "label", ev.sweep_thresholds())


@query(
    "roc_operating_point", "V11",
    sql=f"SELECT 0.45e0 AS threshold, fpr, tpr FROM {_CORNERS.format(curve=_curve('fine'))} AS p WHERE threshold <= 0.45e0 ORDER BY p.threshold DESC LIMIT 1",
    doubles="threshold fpr tpr",
)
def _(spark, sf):
    return ev.operating_point(ev.roc_points(_scored(spark, sf), "fine", "label"), 0.45)


@query(
    "score_comparison", "V12 U3 O5",
    sql=f"""
    SELECT 'coarse' AS model, auc_roc AS val_auc_roc, auc_pr AS val_auc_pr FROM (SELECT {_RANKING} FROM {_curve('coarse')} AS c) AS a
    UNION ALL SELECT 'fine', auc_roc, auc_pr FROM (SELECT {_RANKING} FROM {_curve('fine')} AS c) AS b
    """,
    doubles="val_auc_roc val_auc_pr",
)
def _(spark, sf):
    rows = [
        ev.ranking_metrics(_scored(spark, sf), s, "label").select(
            F.lit(s).alias("model"), F.col("auc_roc").alias("val_auc_roc"), F.col("auc_pr").alias("val_auc_pr")
        )
        for s in ("coarse", "fine")
    ]
    return ev.comparison(*rows)
