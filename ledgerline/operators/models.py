"""Model training with pyspark.ml; nothing is collected but the fitted models and their scores.

A training frame holds scalar feature columns and a 0/1 label. Every ``fit_*`` returns a
``PipelineModel`` (assembler and classifier) that scores such a frame.
"""

from __future__ import annotations

import math
import random
import time
import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field
from multiprocessing.pool import ThreadPool

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.ml import Estimator, PipelineModel
from pyspark.ml.common import _py2java
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LinearSVC,
    LinearSVCModel,
    LogisticRegression,
    LogisticRegressionModel,
)
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions.numeric import quote_name
from ledgerline.functions.quantiles import exact_quantiles
from ledgerline.operators import linear_fits as lf
from ledgerline.operators.ensembles import TreeTable, importance, node_rows
from ledgerline.operators.evaluate import evaluate, ranking_metrics
from ledgerline.operators.histograms import cut_points, paired_cells, weights_of
from ledgerline.operators.ranking import best_row
from ledgerline.operators.tree_trials import Trials

FEATURES = "features"
WEIGHT = "_weight"
FOLD = "_fold"
DRAW = "_draw"
SCORE = "score"
SMALL_TABLE_BYTES = 256 << 20
PARTITION_BYTES = 4 << 20
MOST_TASKS = 24  # of a pass of a fit over few bytes; iterative fits make thousands of passes, and every task of each reports to the driver
TASK_BYTES = 512 << 20  # of vectors of a task, beyond which there are more tasks


# Class weights.

def class_counts(df: DataFrame, label: str) -> tuple[int, int]:
    """Negatives and positives."""
    row = df.agg(F.count_if(F.col(label) == 0), F.count_if(F.col(label) == 1)).first()
    return row[0], row[1]


def class_weights(negatives: int, positives: int, scheme: str) -> tuple[float, float]:
    """Weights of a negative and a positive row.

    ``balanced``: n / (2 n_class); ``ratio``: 1 and negatives / positives; ``inverse``: 1 / class share.
    """
    n = negatives + positives
    if not negatives or not positives:
        return 1.0, 1.0
    return {
        "balanced": (n / (2 * negatives), n / (2 * positives)),
        "ratio": (1.0, negatives / positives),
        "inverse": (n / negatives, n / positives),
        "none": (1.0, 1.0),
    }[scheme]


def weight_column(label: str, weights: tuple[float, float]) -> Column:
    return F.when(F.col(label) == 1, F.lit(float(weights[1]))).otherwise(F.lit(float(weights[0])))


# Fitting.

def assembler(features: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol=FEATURES)


def fit_tasks(held: int) -> int:
    """Tasks of a pass over ``held`` bytes of vectors: one for each ``PARTITION_BYTES`` up to ``MOST_TASKS``, then one for each ``TASK_BYTES``."""
    return max(min(math.ceil((held + 1) / PARTITION_BYTES), MOST_TASKS), math.ceil(held / TASK_BYTES))


@contextmanager
def training_rows(
    df: DataFrame, features: Sequence[str], label: str, scheme: str = "none", keep: Sequence[Column] = ()
) -> Iterator[DataFrame]:
    """Label, weight and assembled vector, kept on the executors for the passes of one or many fits.

    The class counts are taken from the kept rows, so the input is computed once.
    """
    slim = assembler(features).transform(df).select(F.col(label).cast("double").alias(label), FEATURES, *keep)
    kept = [slim.persist(StorageLevel.MEMORY_AND_DISK)]
    try:
        negatives, positives = class_counts(kept[0], label)
        held = (negatives + positives) * len(features) * 8
        tasks = fit_tasks(held)
        if held < SMALL_TABLE_BYTES:
            # Small enough for the planner to have packed it into a task or two; a boosted fit runs thousands of jobs, so no more
            # tasks than the rows are worth. Subsampled trees draw per partition: their number follows the rows, not the cores.
            kept.append(kept[0].repartition(tasks).persist(StorageLevel.MEMORY_AND_DISK))
        elif kept[0].rdd.getNumPartitions() > tasks:
            # The kept blocks stay as they are; a task of a pass reads several.
            kept.append(kept[0].coalesce(tasks))
        yield kept[-1].withColumn(WEIGHT, weight_column(label, class_weights(negatives, positives, scheme)))
    finally:
        for rows in reversed(kept):
            rows.unpersist()


def _fit(train: DataFrame, features: Sequence[str], label: str, scheme: str, estimator: Estimator) -> PipelineModel:
    with training_rows(train, features, label, scheme) as rows:
        return PipelineModel([assembler(features), estimator.fit(rows)])


def logistic(label: str, c: float, weight_total: float, max_iter: int) -> LogisticRegression:
    """L2 penalty 1 / (c * sum of weights): the penalised mean loss equals the penalised sum of losses."""
    return LogisticRegression(
        featuresCol=FEATURES, labelCol=label, weightCol=WEIGHT, maxIter=max_iter,
        regParam=1.0 / (c * weight_total), elasticNetParam=0.0, standardization=False,
    )


def tree(
    label: str, max_depth: int = 5, min_leaf: int = 1, criterion: str = "gini", max_bins: int = 32, seed: int = 42
) -> DecisionTreeClassifier:
    return DecisionTreeClassifier(
        featuresCol=FEATURES, labelCol=label, weightCol=WEIGHT, maxDepth=max_depth,
        minInstancesPerNode=min_leaf, impurity=criterion, maxBins=max_bins, seed=seed,
    )


def boosted(
    label: str,
    trees: int = 100,
    max_depth: int = 6,
    learning_rate: float = 0.1,
    row_share: float = 1.0,
    column_share: float = 1.0,
    min_leaf: int = 1,
    max_bins: int = 32,
    seed: int = 42,
) -> GBTClassifier:
    """Gradient-boosted trees; the two boosted variants differ in class weights and these parameters."""
    return GBTClassifier(
        featuresCol=FEATURES, labelCol=label, weightCol=WEIGHT, maxIter=trees, maxDepth=max_depth,
        stepSize=learning_rate, subsamplingRate=row_share,
        featureSubsetStrategy="all" if column_share >= 1 else str(column_share),
        minInstancesPerNode=min_leaf, maxBins=max_bins, seed=seed,
    )


def fit_logistic(
    train: DataFrame, features: Sequence[str], label: str, c: float = 1.0, scheme: str = "balanced", max_iter: int = 1000
) -> PipelineModel:
    with training_rows(train, features, label, scheme) as rows:
        total = rows.agg(F.sum(WEIGHT)).first()[0]
        return PipelineModel([assembler(features), logistic(label, c, total, max_iter).fit(rows)])


def fit_tree(
    train: DataFrame, features: Sequence[str], label: str, scheme: str = "balanced", **params
) -> PipelineModel:
    return _fit(train, features, label, scheme, tree(label, **params))


def fit_boosted(
    train: DataFrame, features: Sequence[str], label: str, scheme: str = "ratio", **params
) -> PipelineModel:
    return _fit(train, features, label, scheme, boosted(label, **params))


def predict(model, df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """``keep`` columns and the probability of the positive class."""
    if hasattr(model, "predict"):
        return model.predict(df, keep)
    return model.transform(df).select(
        *[F.col(quote_name(c)) for c in keep], vector_to_array("probability")[1].alias(SCORE)
    )


# Cross-validation.

def fold_draw(*key: str, seed: int = 42) -> Column:
    """The number that decides a row's fold: a hash of the key, exact as a double."""
    return F.pmod(F.xxhash64(F.lit(seed), *[F.col(quote_name(k)) for k in key]), F.lit(2**52)).cast("double").alias(DRAW)


def with_fold(rows: DataFrame, label: str, folds: int) -> DataFrame:
    """A fold number per row of ``rows`` with ``fold_draw``; every fold has an equal share of each class, up to one row.

    Exact quantiles of the draw cut each class; rows that share a draw share a fold.
    """
    classes = {str(y): F.when(F.col(label) == y, F.col(DRAW)) for y in (0, 1)}
    cuts = exact_quantiles(rows, classes, [i / folds for i in range(1, folds)])

    def fold(y: int) -> Column:
        above = [(F.col(DRAW) > F.lit(c)).cast("int") for c in cuts[str(y)] if c is not None]
        return sum(above, F.lit(0))

    return rows.withColumn(FOLD, F.when(F.col(label) == 1, fold(1)).otherwise(fold(0)))


def map_parallel(spark: SparkSession, task: Callable, items: Sequence, parallelism: int) -> list:
    with ThreadPool(max(1, parallelism)) as pool:
        return pool.map(inheritable_thread_target(spark)(task), items)


def _fold_weights(rows: DataFrame) -> dict[int, float]:
    return {r[0]: r[1] for r in rows.groupBy(FOLD).agg(F.sum(WEIGHT)).collect()}


def _scalars(df: DataFrame, features: Sequence[str]) -> bool:
    return all(isinstance(df.schema[f].dataType, (T.NumericType, T.BooleanType)) for f in features)


@contextmanager
def _fold_blocks(train: DataFrame, features: Sequence[str], label: str, key: str, folds: int) -> Iterator[tuple]:
    """The rows with their fold, the same as kept blocks, their moments and the balanced class weights."""
    columns = [F.col(quote_name(f)).cast("double").alias(f) for f in features]
    rows = with_fold(train.select(F.col(quote_name(label)).cast("int").alias(label), *columns, fold_draw(key)), label, folds)
    with lf.kept_blocks(rows, features, label, FOLD, folds, fit_tasks) as blocks:
        moments = lf.Moments.of(blocks, len(features), folds)
        negatives, positives = (int(n) for n in moments.n.sum(0))
        yield rows, blocks, moments, class_weights(negatives, positives, "balanced")


def _linear_model(spark: SparkSession, python: type, coefficients, intercept: float):
    """A model of the library with these coefficients."""
    java = getattr(spark._jvm.org.apache.spark.ml.classification, python.__name__)
    vector = _py2java(spark.sparkContext, Vectors.dense(coefficients))
    return python(java(f"{python.__name__}_{uuid.uuid4().hex[:12]}", vector, float(intercept))).setFeaturesCol(FEATURES)


def linear_margin(features: Sequence[str], coefficients: Sequence[float], intercept: float) -> Column:
    return sum((F.col(quote_name(f)) * F.lit(float(w)) for f, w in zip(features, coefficients)), F.lit(float(intercept)))


def cross_validate_logistic(
    train: DataFrame,
    features: Sequence[str],
    label: str,
    key: str,
    cs: Sequence[float] = (0.01, 0.1, 1.0, 10.0),
    folds: int = 3,
    max_iter: int = 200,
    parallelism: int = 4,
) -> tuple[list[dict], PipelineModel]:
    """AUC of every penalty over the folds, and the best one refitted on all rows.

    The fits of all penalties and folds share their passes, and one pass over the kept rows scores them.
    """
    if not _scalars(train, features):
        return _cross_validate_vectors(train, features, label, key, cs, folds, max_iter, parallelism)
    spark = train.sparkSession
    with _fold_blocks(train, features, label, key, folds) as (_, blocks, moments, weights):
        numbers = [f for f in range(folds) if moments.n[f].any()]
        jobs = [(c, held) for c in cs for held in numbers]
        others = [(c, [f for f in numbers if f != held]) for c, held in jobs]
        fitted = lf.fit_linear(blocks, moments, lf.LOGISTIC, weights, others, max_iter)
        aucs = dict(zip(jobs, lf.aucs(blocks, moments, [(held, *m) for (_, held), m in zip(jobs, fitted)])))
        table = []
        for c in cs:
            own = [aucs[c, held] for held in numbers]
            mean = sum(own) / len(own)
            table.append({"c": c, "mean_auc": mean, "std_auc": math.sqrt(sum((a - mean) ** 2 for a in own) / len(own))})
        best = max(table, key=lambda r: r["mean_auc"])["c"]
        ((coefficients, intercept),) = lf.fit_linear(blocks, moments, lf.LOGISTIC, weights, [(best, numbers)], max_iter)
    return table, PipelineModel([assembler(features), _linear_model(spark, LogisticRegressionModel, coefficients, intercept)])


def _cross_validate_vectors(
    train: DataFrame,
    features: Sequence[str],
    label: str,
    key: str,
    cs: Sequence[float],
    folds: int,
    max_iter: int,
    parallelism: int,
) -> tuple[list[dict], PipelineModel]:
    """``cross_validate_logistic`` by the library, a fit after another, for features that are vectors."""
    spark = train.sparkSession
    with training_rows(train, features, label, "balanced", [fold_draw(key)]) as kept:
        rows = with_fold(kept, label, folds)
        totals = _fold_weights(rows)

        def run(job):
            c, fold = job
            weight = sum(w for f, w in totals.items() if f != fold)
            fitted = logistic(label, c, weight, max_iter).fit(rows.filter(F.col(FOLD) != fold))
            held = fitted.transform(rows.filter(F.col(FOLD) == fold))
            scored = held.select(F.col(label).cast("int").alias(label), vector_to_array("probability")[1].alias(SCORE))
            return c, ranking_metrics(scored, SCORE, label).first()["auc_roc"]

        aucs = map_parallel(spark, run, [(c, f) for c in cs for f in sorted(totals)], parallelism)
        table = []
        for c in cs:
            own = [a for k, a in aucs if k == c]
            mean = sum(own) / len(own)
            table.append({"c": c, "mean_auc": mean, "std_auc": math.sqrt(sum((a - mean) ** 2 for a in own) / len(own))})
        best = max(table, key=lambda r: r["mean_auc"])["c"]
        fitted = logistic(label, best, sum(totals.values()), max_iter).fit(rows)
    return table, PipelineModel([assembler(features), fitted])


# Linear SVM with sigmoid calibration.

@dataclass
class CalibratedSvm:
    """One margin model and one sigmoid per fold; the probability is their mean."""

    features: list[str]
    folds: list[tuple[object, float, float]]
    c: float = 1.0

    def predict(self, df: DataFrame, keep: Sequence[str]) -> DataFrame:
        rows = assembler(self.features).transform(df)
        probabilities = []
        for i, (svc, slope, intercept) in enumerate(self.folds):
            marked = svc.copy().setRawPredictionCol(f"_raw{i}").setPredictionCol(f"_label{i}")
            rows = marked.transform(rows)
            margin = vector_to_array(f"_raw{i}")[1]
            probabilities.append(1.0 / (1.0 + F.exp(-(margin * slope + intercept))))
        mean = sum(probabilities[1:], probabilities[0]) / float(len(probabilities))
        return rows.select(*[F.col(quote_name(c)) for c in keep], mean.alias(SCORE))


def sigmoid(margins: DataFrame, label: str) -> tuple[float, float]:
    """Slope and intercept of the calibration, with smoothed targets.

    A smoothed target t is a positive row of weight t and a negative row of weight 1 - t.
    """
    negatives, positives = class_counts(margins, label)
    high, low = (positives + 1.0) / (positives + 2.0), 1.0 / (negatives + 2.0)
    t = F.when(F.col(label) == 1, F.lit(high)).otherwise(F.lit(low))
    halves = margins.select(
        "margin", F.inline(F.array(F.struct(F.lit(1.0).alias("y"), t.alias("w")), F.struct(F.lit(0.0).alias("y"), (1 - t).alias("w"))))
    )
    rows = VectorAssembler(inputCols=["margin"], outputCol=FEATURES).transform(halves)
    fitted = LogisticRegression(featuresCol=FEATURES, labelCol="y", weightCol="w", regParam=0.0, maxIter=100).fit(rows)
    return float(fitted.coefficients[0]), float(fitted.intercept)


def fit_calibrated_svm(
    train: DataFrame,
    features: Sequence[str],
    label: str,
    key: str,
    c: float = 1.0,
    folds: int = 3,
    max_iter: int = 100,
    parallelism: int = 3,
) -> CalibratedSvm:
    """For each fold: margin model on the other rows, sigmoid on the fold."""
    return fit_calibrated_svms(train, features, label, key, [c], folds, max_iter, parallelism)[0]


def fit_calibrated_svms(
    train: DataFrame, features: Sequence[str], label: str, key: str, cs: Sequence[float], folds: int = 3, max_iter: int = 100, parallelism: int = 3
) -> list[CalibratedSvm]:
    """``fit_calibrated_svm`` for every penalty; the fits of all penalties and folds share their passes."""
    if not _scalars(train, features):
        return [_calibrated_svm_of_vectors(train, features, label, key, c, folds, max_iter, parallelism) for c in cs]
    spark = train.sparkSession
    with _fold_blocks(train, features, label, key, folds) as (_, blocks, moments, weights):
        numbers = [f for f in range(folds) if moments.n[f].any()]
        jobs = [(c, held) for c in cs for held in numbers]
        fitted = lf.fit_linear(blocks, moments, lf.HINGE, weights, [(c, [f for f in numbers if f != held]) for c, held in jobs], max_iter)
        sigmoids = lf.fit_sigmoids(blocks, moments, [(held, *m) for (_, held), m in zip(jobs, fitted)])
    made = [(_linear_model(spark, LinearSVCModel, *m), *s) for m, s in zip(fitted, sigmoids)]
    return [CalibratedSvm(list(features), [m for (k, _), m in zip(jobs, made) if k == c], c) for c in cs]


def _calibrated_svm_of_vectors(
    train: DataFrame,
    features: Sequence[str],
    label: str,
    key: str,
    c: float,
    folds: int,
    max_iter: int,
    parallelism: int,
) -> CalibratedSvm:
    """``fit_calibrated_svm`` by the library, for features that are vectors."""
    spark = train.sparkSession
    with training_rows(train, features, label, "balanced", [fold_draw(key)]) as kept:
        rows = with_fold(kept, label, folds)
        totals = _fold_weights(rows)

        def run(fold):
            weight = sum(w for f, w in totals.items() if f != fold)
            svc = LinearSVC(
                featuresCol=FEATURES, labelCol=label, weightCol=WEIGHT, regParam=1.0 / (c * weight),
                maxIter=max_iter, standardization=False,
            ).fit(rows.filter(F.col(FOLD) != fold))
            held = svc.transform(rows.filter(F.col(FOLD) == fold))
            margins = held.select(label, vector_to_array("rawPrediction")[1].alias("margin"))
            return (svc, *sigmoid(margins, label))

        fitted = map_parallel(spark, run, sorted(totals), parallelism)
    return CalibratedSvm(list(features), fitted, c)


def best_svm(
    train: DataFrame, val: DataFrame, features: Sequence[str], label: str, key: str,
    cs: Sequence[float] = (0.01, 0.1, 1.0), max_iter: int = 100,
) -> tuple[CalibratedSvm, float]:
    """The calibrated SVM with the best validation AUC."""
    tried = []
    for model in fit_calibrated_svms(train, features, label, key, cs, max_iter=max_iter):
        tried.append((model, validation_metrics(model, val, label)["auc_roc"]))
    return max(tried, key=lambda t: t[1])


# Search over parameters.

def whole(low: int, high: int) -> Callable:
    return lambda rng: rng.randint(low, high)


def uniform(low: float, high: float) -> Callable:
    return lambda rng: rng.uniform(low, high)


def log_uniform(low: float, high: float) -> Callable:
    return lambda rng: math.exp(rng.uniform(math.log(low), math.log(high)))


def choice(*options) -> Callable:
    return lambda rng: rng.choice(options)


# Ranges searched.
TREE_SPACE = {"max_depth": whole(3, 20), "min_leaf": whole(1, 50), "criterion": choice("gini", "entropy")}
BOOSTED_SPACE = {
    "trees": whole(100, 500), "max_depth": whole(3, 10), "learning_rate": log_uniform(0.01, 0.3),
    "row_share": uniform(0.6, 1.0), "column_share": uniform(0.6, 1.0), "min_leaf": whole(1, 10),
}
HISTOGRAM_BOOSTED_SPACE = {
    "trees": whole(100, 500), "max_depth": whole(3, 15), "learning_rate": log_uniform(0.01, 0.3),
    "min_leaf": whole(10, 200),
}


@dataclass
class Fitted:
    """A fitted model with what is reported about it."""

    name: str
    kind: str
    model: object
    params: dict
    metrics: dict
    seconds: float
    trials: list[dict] = field(default_factory=list)

    def row(self) -> tuple:
        m = self.metrics
        return self.name, self.kind, m["auc_roc"], m["auc_pr"], m["ks"], self.seconds


RESULT_SCHEMA = "model string, type string, val_auc_roc double, val_auc_pr double, val_ks double, fit_time_s double"


@contextmanager
def scored_once(model, df: DataFrame, keep: Sequence[str]) -> Iterator[DataFrame]:
    """``keep`` and the score, held on the executors so that several metrics share one scoring pass."""
    scored = predict(model, df, keep).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield scored
    finally:
        scored.unpersist()


def validation_metrics(model, val: DataFrame, label: str) -> dict:
    with scored_once(model, val, [label]) as scored:
        return evaluate(scored, SCORE, label).first().asDict()


def fit_and_score(
    name: str, kind: str, fit: Callable[..., object], train: DataFrame, val: DataFrame, features: Sequence[str], label: str,
    **params,
) -> Fitted:
    started = time.monotonic()
    model = fit(train, features, label, **params)
    seconds = time.monotonic() - started
    return Fitted(name, kind, model, params, validation_metrics(model, val, label), seconds)


def draw(space: Mapping[str, Callable], trials: int, seed: int = 42) -> list[dict]:
    """The parameter sets of a seeded random search."""
    rng = random.Random(seed)
    return [{k: pick(rng) for k, pick in space.items()} for _ in range(trials)]


@dataclass(frozen=True)
class CellTrees:
    """What a search makes: decision trees, or boosted ensembles of them, that grow from cells of ``max_bins`` bins a feature."""

    boosted: bool = False
    max_bins: int = 32


CELL_TREE, CELL_BOOSTED = CellTrees(), CellTrees(boosted=True)


@contextmanager
def cell_trials(
    make: CellTrees, train: DataFrame, val: DataFrame, features: Sequence[str], label: str, drawn: Sequence[Mapping], scheme: str
) -> Iterator[Trials]:
    """The trees of the parameter sets ``drawn``, grown together."""
    cuts = cut_points(train, features, make.max_bins)
    cells = paired_cells(train, val, features, label, cuts, [F.lit(0), F.lit(0)])
    with Trials(cells, features, cuts, drawn, weights_of(cells, scheme)) as grown:
        yield grown


def search(
    name: str,
    make: Callable[..., Estimator] | CellTrees,
    space: Mapping[str, Callable],
    train: DataFrame,
    val: DataFrame,
    features: Sequence[str],
    label: str,
    trials: int = 50,
    seed: int = 42,
    parallelism: int = 2,
    scheme: str = "balanced",
    **fixed,
) -> Fitted:
    """Random search by validation AUC, then a refit of the best parameters.

    ``make`` builds the estimator; all trials share one copy of the assembled rows. A ``CellTrees`` grows all trials together.
    """
    if isinstance(make, CellTrees):
        started, drawn = time.monotonic(), draw(space, trials, seed)
        with cell_trials(make, train, val, features, label, drawn, scheme) as grown:
            aucs = grown.aucs()
            seconds = time.monotonic() - started
            first = max(range(len(aucs)), key=lambda i: aucs[i])
            table = grown.model(first)
        done = [{"trial": i, "auc": a, **p} for i, (a, p) in enumerate(zip(aucs, drawn))]
        return Fitted(name, "tuned", table, {**drawn[first], **fixed, "scheme": scheme}, validation_metrics(table, val, label), seconds, done)
    started = time.monotonic()
    held = [F.col(label).cast("int").alias(label)]
    with training_rows(train, features, label, scheme) as rows, training_rows(val, features, label) as held_rows:

        def run(params):
            scored = make(label, **params, **fixed).fit(rows).transform(held_rows)
            scored = scored.select(*held, vector_to_array("probability")[1].alias(SCORE))
            return ranking_metrics(scored, SCORE, label).first()["auc_roc"]

        drawn = draw(space, trials, seed)
        aucs = map_parallel(train.sparkSession, run, drawn, parallelism)
        seconds = time.monotonic() - started
        best = drawn[max(range(len(aucs)), key=lambda i: aucs[i])]
        model = PipelineModel([assembler(features), make(label, **best, **fixed).fit(rows)])
    done = [{"trial": i, "auc": a, **p} for i, (a, p) in enumerate(zip(aucs, drawn))]
    return Fitted(name, "tuned", model, {**best, **fixed, "scheme": scheme}, validation_metrics(model, val, label), seconds, done)


def results_table(spark: SparkSession, fitted: Sequence[Fitted]) -> DataFrame:
    return spark.createDataFrame([f.row() for f in fitted], RESULT_SCHEMA)


def best_tuned(fitted: Sequence[Fitted]) -> Fitted:
    """The tuned model with the highest validation AUC."""
    return max((f for f in fitted if f.kind == "tuned"), key=lambda f: f.metrics["auc_roc"])


def best_model_row(results: DataFrame) -> DataFrame:
    return best_row(results.filter(F.col("type") == "tuned"), "val_auc_roc", ["model"])


def save_model(model: PipelineModel | TreeTable, path: str) -> None:
    """A pipeline in its own form, a tree table as Parquet below ``path``/nodes."""
    if isinstance(model, TreeTable):
        model.save(SparkSession.active(), f"{path}/nodes")
    else:
        model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel | TreeTable:
    try:
        return TreeTable.load(SparkSession.active(), f"{path}/nodes")
    except AnalysisException:  # no such folder: not a tree table
        return PipelineModel.load(path)


RUN_SCHEMA = "run_name string, params map<string,string>, metrics map<string,double>, is_best boolean"


def runs_table(spark: SparkSession, fitted: Sequence[Fitted]) -> DataFrame:
    """Parameters and metrics of each fitted model, the best tuned one marked."""
    best = best_tuned(fitted).name if any(f.kind == "tuned" for f in fitted) else None
    rows = [
        (
            f.name + ("_BEST" if f.name == best else ""),
            {k: str(v) for k, v in f.params.items() if isinstance(v, (int, float, str, bool))},
            {
                "val_auc_roc": f.metrics["auc_roc"], "val_auc_pr": f.metrics["auc_pr"],
                "val_ks": f.metrics["ks"], "fit_time_s": f.seconds,
            },
            f.name == best,
        )
        for f in fitted
    ]
    return spark.createDataFrame(rows, RUN_SCHEMA)


def append_runs(spark: SparkSession, fitted: Sequence[Fitted], path: str) -> None:
    runs_table(spark, fitted).withColumn("logged_at", F.current_timestamp()).write.mode("append").parquet(path)


def ablation(
    train: DataFrame, val: DataFrame, base: Sequence[str], extra: Sequence[str], label: str, max_iter: int = 200
) -> DataFrame:
    """Logistic regression without and with extra features: ``(model, val_auc_roc, val_auc_pr, delta)``."""
    rows = []
    for name, features in (("base", list(base)), ("base + extra", [*base, *extra])):
        model = fit_logistic(train, features, label, max_iter=max_iter)
        m = validation_metrics(model, val, label)
        rows.append((name, m["auc_roc"], m["auc_pr"]))
    full = [(*r, r[1] - rows[0][1]) for r in rows]
    return train.sparkSession.createDataFrame(
        full, "model string, val_auc_roc double, val_auc_pr double, delta double"
    )


def feature_importance(model: PipelineModel | TreeTable, features: Sequence[str], top: int = 20) -> DataFrame:
    """``(feature, importance)`` of a tree model, largest first, from its node table."""
    nodes = model.to_frame(SparkSession.active()) if isinstance(model, TreeTable) else node_rows(model, features)
    return importance(nodes, features).orderBy(F.desc("importance"), "feature").limit(top)


def split_metrics(model, df: DataFrame, label: str, split: str) -> DataFrame:
    """AUC-ROC and AUC-PR of every split, scored and ranked in one pass."""
    return ranking_metrics(predict(model, df, [label, split]), SCORE, label, by=[split])
