"""Models on learnable rows: first 80 % of the days train, the rest validate."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.operators import evaluate as ev
from ledgerline.operators import features as fe
from ledgerline.operators import models as md
from ledgerline.operators import histograms, neighbors, runs, selection, split
from ledgerline.operators.ensembles import TreeTable, node_rows
from ledgerline.queries.base import query, table
from ledgerline.queries.frames import LEARNABLE, frame, frame_once, sql
from ledgerline.session import shared_path, stored

_NUMBERS = ["quantity", "price", "discount", "tax", "line", "total"]
_KEPT = ["row_id", "label", "day"]


def _parts(spark, sf):
    """Scaled features of the training and validation rows, fitted on the former."""
    rows = frame_once(spark, sf, LEARNABLE)
    cutoff = split.rank_cutoff(rows, "day", 0.8)
    train = rows.filter(F.col("day") <= F.lit(cutoff))
    model = fe.fit_features(train, fe.FeatureSpec(exclude=_KEPT))
    made = model.transform(rows, _KEPT)
    early = F.col("day") <= F.lit(cutoff)
    return made.filter(early), made.filter(~early), made.withColumn("split", F.when(early, "train").otherwise("val"))


def _metrics(spark, fitted: md.Fitted):
    return md.results_table(spark, [fitted]).drop("fit_time_s")


@query(
    "class_weights", "L9",
    sql=f"""
    SELECT n / (2e0 * neg) AS balanced_0, n / (2e0 * pos) AS balanced_1, neg * 1e0 / pos AS ratio_1, n * 1e0 / neg AS inverse_0, n * 1e0 / pos AS inverse_1
    FROM (SELECT count(*) AS n, count(*) FILTER (label = 0) AS neg, count(*) FILTER (label = 1) AS pos FROM {sql(LEARNABLE)} AS l) AS c
    """,
    doubles="balanced_0 balanced_1 ratio_1 inverse_0 inverse_1",
)
def _(spark, sf):
    counts = md.class_counts(frame(spark, sf, LEARNABLE), "label")
    balanced, ratio, inverse = (md.class_weights(*counts, s) for s in ("balanced", "ratio", "inverse"))
    row = (*balanced, ratio[1], *inverse)
    return spark.createDataFrame(
        [row], "balanced_0 double, balanced_1 double, ratio_1 double, inverse_0 double, inverse_1 double"
    )


# One feature of two values: the fits have a closed form, so SQL can state what they must predict.
_SHARES = f"""
    SELECT x, sum(label) AS pos, count(*) - sum(label) AS neg, sum(sum(label)) OVER () AS all_pos, sum(count(*) - sum(label)) OVER () AS all_neg
    FROM (SELECT CASE WHEN quantity > 25 THEN 1e0 ELSE 0e0 END AS x, label FROM {sql(LEARNABLE)} AS l) AS r GROUP BY x
"""


def _two_values(spark, sf):
    x = F.when(F.col("quantity") > 25, 1.0).otherwise(0.0)
    return stored(frame(spark, sf, LEARNABLE).select(x.alias("x"), "label"), "frame")


def _by_value(model, rows, digits=None):
    probability = F.first("score") if digits is None else F.round(F.first("score"), digits)
    return md.predict(model, rows, ["x"]).withColumnRenamed(md.SCORE, "score").groupBy("x").agg(probability.alias("probability"))


@query(
    "logistic_of_two_values", "L1 R3",
    sql=f"SELECT x, round(pos * all_neg * 1e0 / (pos * all_neg + neg * all_pos), 3) AS probability FROM ({_SHARES}) AS s",
    doubles="x probability",
)
def _(spark, sf):
    """Without a penalty, balanced logistic regression predicts the weighted share of each value."""
    rows = _two_values(spark, sf)
    return _by_value(md.fit_logistic(rows, ["x"], "label", c=1e12), rows, 3)


@query(
    "tree_of_two_values", "L3",
    sql=f"SELECT x, pos * all_neg * 1e0 / (pos * all_neg + neg * all_pos) AS probability FROM ({_SHARES}) AS s",
    doubles="x probability",
)
def _(spark, sf):
    """A tree of depth one predicts the weighted share of its leaf."""
    rows = _two_values(spark, sf)
    return _by_value(md.fit_tree(rows, ["x"], "label", max_depth=1), rows)


@query(
    "boosting_of_two_values", "L4 L5",
    sql=f"""
    SELECT x, 1 / (1 + exp(-2 * (pos * all_neg * 1e0 - neg * all_pos) / (pos * all_neg + neg * all_pos))) AS probability
    FROM ({_SHARES}) AS s
    """,
    doubles="x probability",
)
def _(spark, sf):
    """One round of boosting predicts the logistic of twice the leaf's weighted mean of -1 and 1."""
    rows = _two_values(spark, sf)
    return _by_value(md.fit_boosted(rows, ["x"], "label", trees=1, max_depth=1), rows)


@query("logistic_regression", "L1")
def _(spark, sf):
    train, val, _ = _parts(spark, sf)
    return _metrics(spark, md.fit_and_score("LogisticRegression", "baseline", md.fit_logistic, train, val, _NUMBERS, "label"))


@query("logistic_cross_validation", "L2")
def _(spark, sf):
    train, _, _ = _parts(spark, sf)
    rows, _ = md.cross_validate_logistic(train, _NUMBERS, "label", "row_id")
    return spark.createDataFrame([(r["c"], r["mean_auc"], r["std_auc"]) for r in rows], "c double, mean_auc double, std_auc double")


@query("decision_tree", "L3")
def _(spark, sf):
    train, val, _ = _parts(spark, sf)
    return _metrics(spark, md.fit_and_score("DecisionTree", "baseline", md.fit_tree, train, val, _NUMBERS, "label", max_depth=8))


@query("boosted_trees", "L4")
def _(spark, sf):
    train, val, _ = _parts(spark, sf)
    return _metrics(
        spark,
        md.fit_and_score(
            "BoostedTrees", "baseline", histograms.fit_boosted, train, val, _NUMBERS, "label",
            trees=300, max_depth=5, row_share=0.8, column_share=0.8, scheme="ratio",
        ),
    )


@query("histogram_boosted_trees", "L5")
def _(spark, sf):
    train, val, _ = _parts(spark, sf)
    return _metrics(
        spark,
        md.fit_and_score(
            "HistogramBoostedTrees", "baseline", histograms.fit_boosted, train, val, _NUMBERS, "label",
            trees=200, max_depth=5, max_bins=256, min_leaf=20, scheme="inverse",
        ),
    )


@query("calibrated_linear_svm", "L6")
def _(spark, sf):
    train, val, _ = _parts(spark, sf)
    model, auc = md.best_svm(train, val, _NUMBERS, "label", "row_id")
    return spark.createDataFrame([(model.c, float(auc))], "c double, val_auc_roc double")


@query(
    "nearest_neighbor_scores", "L7",
    sql="""
    WITH v AS (SELECT vec_id, cast(embedding AS DOUBLE[]) AS x, label FROM embeddings),
    p AS (SELECT q.vec_id, t.label, row_number() OVER (PARTITION BY q.vec_id ORDER BY list_distance(q.x, t.x), t.vec_id) AS place
      FROM v AS q, v AS t WHERE q.vec_id <> t.vec_id)
    SELECT vec_id, avg(CASE WHEN label >= 5 THEN 1e0 ELSE 0e0 END) AS score FROM p WHERE place <= 10 GROUP BY 1
    """,
    doubles="score",
)
def _(spark, sf):
    vectors = table(spark, sf, "embeddings").select(
        "vec_id", "embedding", (F.col("label") >= 5).cast("int").alias("positive")
    )
    near = neighbors.nearest_neighbors(vectors, vectors, "vec_id", "embedding", "positive", k=10, skip_self=True)
    return neighbors.neighbor_score(near, "vec_id", "positive")


@query("tree_search", "L8 L3")
def _(spark, sf):
    train, val, _ = _parts(spark, sf)
    found = md.search("DecisionTree", md.CELL_TREE, md.TREE_SPACE, train, val, _NUMBERS, "label", trials=50)
    return spark.createDataFrame(
        [(t["trial"], t["max_depth"], t["min_leaf"], t["criterion"], t["auc"]) for t in found.trials],
        "trial int, max_depth int, min_leaf int, criterion string, val_auc_roc double",
    )


@query("model_selection", "L10 L8 V12 O5")
def _(spark, sf):
    train, val, _ = _parts(spark, sf)
    fitted = selection.select_models(train, val, _NUMBERS, "label", "row_id")
    path = shared_path(spark, "best-model")
    md.save_model(md.best_tuned(fitted).model, path)
    again = ev.evaluate(md.predict(md.load_model(path), val, ["label"]), md.SCORE, "label")
    results = md.results_table(spark, fitted).drop("fit_time_s")
    best = md.best_model_row(results).select("model", F.lit(True).alias("chosen"))
    return results.join(F.broadcast(best), "model", "left").join(
        F.broadcast(again.select(F.col("auc_roc").alias("val_auc_roc"), F.lit(True).alias("reloaded_equal"))), "val_auc_roc", "left"
    )


# AUC of a score that is higher for one of two values of x.
_AUC = f"""
    SELECT abs(sum(CASE WHEN x = 1 THEN pos * 1e0 / all_pos ELSE 0 END) - sum(CASE WHEN x = 1 THEN neg * 1e0 / all_neg ELSE 0 END)) / 2 + 0.5 AS auc
    FROM ({_SHARES}) AS s
"""


@query(
    "selection_of_two_values", "L8 L10",
    sql=f"""
    SELECT name AS model, CASE name WHEN 'LogisticRegression' THEN 'baseline' ELSE 'tuned' END AS type,
      CASE name WHEN 'LogisticRegression' THEN NULL ELSE 0 END AS trial, auc AS val_auc_roc, name = 'BoostedTrees' AS chosen
    FROM ({_AUC}) AS a, (VALUES ('LogisticRegression'), ('DecisionTree'), ('BoostedTrees'), ('HistogramBoostedTrees')) AS m(name)
    """,
    doubles="val_auc_roc",
)
def _(spark, sf):
    """On a feature of two values every trial orders the rows alike, so the first one wins each search; of equal models the least name."""
    rows = _two_values(spark, sf).withColumn("row_id", F.xxhash64(F.monotonically_increasing_id()))
    fitted = selection.select_models(rows, rows, ["x"], "label", "row_id", trials=9)
    best = md.best_model_row(md.results_table(spark, fitted)).first()["model"]
    return spark.createDataFrame(
        [(f.name, f.kind, f.params.get("trial"), f.metrics["auc_roc"], f.name == best) for f in fitted],
        "model string, type string, trial int, val_auc_roc double, chosen boolean",
    )


@query("logged_runs", "L11")
def _(spark, sf):
    train, val, _ = _parts(spark, sf)
    path = shared_path(spark, "runs")
    for seed in (42, 43):
        fitted = md.search("DecisionTree", md.CELL_TREE, md.TREE_SPACE, train, val, _NUMBERS, "label", trials=50, seed=seed)
        md.append_runs(spark, [fitted], path)
    logged = spark.read.parquet(path)
    return logged.select("run_name", "is_best", F.col("params")["max_depth"].alias("max_depth"), F.col("metrics")["val_auc_roc"].alias("val_auc_roc"))


@query(
    "runs_after_retry", "L11 L10",
    sql=f"""
    SELECT name AS run_name, batch, CASE name WHEN 'Holdout' THEN NULL ELSE auc END AS val_auc_roc,
      CASE name WHEN 'Holdout' THEN auc END AS test_auc_roc
    FROM ({_AUC}) AS a, (VALUES ('Tree_BEST', '2'), ('Logit', '1'), ('Holdout', '2')) AS r(name, batch)
    """,
    doubles="val_auc_roc test_auc_roc",
)
def _(spark, sf):
    """Two batches, each written twice: every run once, the tuned tree as logged last."""
    rows = _two_values(spark, sf)
    logit = md.fit_and_score("Logit", "baseline", md.fit_logistic, rows, rows, ["x"], "label")
    tree = md.fit_and_score("Tree", "tuned", md.fit_tree, rows, rows, ["x"], "label", max_depth=1)
    path = shared_path(spark, "runs")
    held = runs.holdout_run(spark, "Holdout", tree.model, rows, "label")
    batches = {"1": md.runs_table(spark, [logit, tree]), "2": runs.all_runs([md.runs_table(spark, [tree]), held])}
    for batch, frame_of_runs in batches.items():
        for _ in range(2):
            runs.log_runs(frame_of_runs, path, batch)
    metrics = F.col("metrics")
    return runs.latest_runs(spark, path).select(
        "run_name", "batch", metrics["val_auc_roc"].alias("val_auc_roc"), metrics["test_auc_roc"].alias("test_auc_roc")
    )


@query(
    "holdout_evaluation", "L10 V9",
    sql=f"""
    SELECT ks / 2 + 0.5 AS auc_roc, ks, precision, recall, 2 * precision * recall / (precision + recall) AS f1, threshold FROM (
      SELECT pos * 1e0 / all_pos - neg * 1e0 / all_neg AS ks, pos * 1e0 / (pos + neg) AS precision, pos * 1e0 / all_pos AS recall,
        pos * all_neg * 1e0 / (pos * all_neg + neg * all_pos) AS threshold
      FROM ({_SHARES}) AS s ORDER BY pos * 1e0 / neg DESC LIMIT 1) AS h
    """,
    doubles="auc_roc ks precision recall f1 threshold",
)
def _(spark, sf):
    """A stored model, read back and scored once on the holdout rows."""
    rows, path = _two_values(spark, sf), shared_path(spark, "model")
    md.save_model(md.fit_tree(rows, ["x"], "label", max_depth=1), path)
    metrics = F.col("metrics")
    return runs.holdout_run(spark, "Tree", path, rows, "label").select(
        *[metrics[f"test_{m}"].alias(m) for m in ("auc_roc", "ks", "precision", "recall", "f1", "threshold")]
    )


@query("stratified_fold_sizes", "L2 L6")
def _(spark, sf):
    """Rows of each class in three folds; about a third each, as rows that share a key share a fold."""
    drawn = stored(frame(spark, sf, LEARNABLE).select("row_id", "label", md.fold_draw("row_id")), "frame")
    return md.with_fold(drawn, "label", 3).groupBy(F.col(md.FOLD).alias("fold"), "label").agg(F.count("*").alias("n"))


@query(
    "sigmoid_of_two_margins", "L6",
    sql=f"""
    WITH t AS (SELECT x, (pos * (all_pos + 1e0) / (all_pos + 2e0) + neg / (all_neg + 2e0)) / (pos + neg) AS p FROM ({_SHARES}) AS s)
    SELECT round(ln(b.p / (1 - b.p)) - ln(a.p / (1 - a.p)), 3) AS slope, round(ln(a.p / (1 - a.p)), 3) AS intercept
    FROM t AS a, t AS b WHERE a.x = 0 AND b.x = 1
    """,
    doubles="slope intercept",
)
def _(spark, sf):
    """The calibration of margins 0 and 1 meets the smoothed share of either."""
    rows = _two_values(spark, sf).withColumnRenamed("x", "margin")
    slope, intercept = md.sigmoid(rows, "label")
    return spark.createDataFrame([(round(slope, 3), round(intercept, 3))], "slope double, intercept double")


@query(
    "ablation_of_two_values", "L12",
    sql=f"""
    SELECT name AS model, CASE name WHEN 'base' THEN 0.5e0 ELSE auc END AS val_auc_roc, CASE name WHEN 'base' THEN 0e0 ELSE auc - 0.5e0 END AS delta
    FROM ({_AUC}) AS a, (VALUES ('base'), ('base + extra')) AS m(name)
    """,
    doubles="val_auc_roc delta",
)
def _(spark, sf):
    """A constant ranks nothing; the feature of two values adds all there is."""
    rows = _two_values(spark, sf).withColumn("flat", F.lit(1.0))
    return md.ablation(rows, rows, ["flat"], ["x"], "label").drop("val_auc_pr")


@query("feature_ablation", "L12")
def _(spark, sf):
    train, val, _ = _parts(spark, sf)
    return md.ablation(train, val, ["price", "tax", "line", "total"], ["quantity", "discount"], "label")


@query("feature_importance", "L13")
def _(spark, sf):
    train, _, _ = _parts(spark, sf)
    model = md.fit_tree(train, _NUMBERS, "label", max_depth=6)
    return md.feature_importance(model, _NUMBERS)


@query(
    "importance_of_two_values", "L13 L3",
    sql="SELECT * FROM (VALUES ('x', 1e0), ('flat', 0e0)) AS v(feature, importance)",
)
def _(spark, sf):
    """All gain falls to the one feature that varies."""
    rows = _two_values(spark, sf).withColumn("flat", F.lit(2.0))
    return md.feature_importance(md.fit_boosted(rows, ["flat", "x"], "label", trees=3, max_depth=2), ["flat", "x"])


@query(
    "nodes_of_two_values", "L3 L13",
    sql=f"""
    SELECT node, feature, threshold, "left", "right", value FROM (
      SELECT 0 AS node, 'x' AS feature, 0.5e0 AS threshold, 1 AS "left", 2 AS "right", 0.5e0 AS value
      UNION ALL
      SELECT CAST(1 + x AS INTEGER), NULL, NULL, NULL, NULL, pos * all_neg * 1e0 / (pos * all_neg + neg * all_pos) FROM ({_SHARES}) AS s
    ) AS n
    """,
    doubles="threshold value",
)
def _(spark, sf):
    """A tree of depth one as a table: its root splits between the values, its leaves hold the weighted shares."""
    model = md.fit_tree(_two_values(spark, sf), ["x"], "label", max_depth=1)
    return node_rows(model, ["x"]).select("node", "feature", "threshold", "left", "right", "value")


@query(
    "node_scores_of_two_values", "R3 L4",
    sql=f"""
    SELECT x, 1 / (1 + exp(-2 * (pos * all_neg * 1e0 - neg * all_pos) / (pos * all_neg + neg * all_pos))) AS probability
    FROM ({_SHARES}) AS s
    """,
    doubles="x probability",
)
def _(spark, sf):
    """The first of three rounds, scored from the node table after storing it."""
    rows = _two_values(spark, sf)
    table_of_nodes = TreeTable.of(md.fit_boosted(rows, ["x"], "label", trees=3, max_depth=1), ["x"])
    path = shared_path(spark, "trees")
    md.save_model(table_of_nodes.first(1), path)
    return _by_value(md.load_model(path), rows)


@query("split_metrics", "V13 R6")
def _(spark, sf):
    train, _, both = _parts(spark, sf)
    model = md.fit_logistic(train, _NUMBERS, "label")
    return md.split_metrics(model, both, "label", "split")
