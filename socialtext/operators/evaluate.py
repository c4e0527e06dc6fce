"""Folds, scores, top-k accuracy, step-wise tuning, model comparison."""

from __future__ import annotations

import time
from collections.abc import Callable
from functools import partial
from itertools import product

from pyspark.ml.evaluation import Evaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from socialtext.operators.classify import default_model
from socialtext.operators.sampling import hash_place

# Default grids by model.
DEFAULT_GRIDS = {
    "bayes": {"step0": {"alpha": [1e-10, 0.001, 0.01, 0.1, 0.5, 1, 2], "tfidf": [False, True], "ngrams": [1, 2]}},
    "svm": {"step0": {"C": [0.01, 0.1, 1.0, 2.5, 5.0], "ngrams": [1, 2], "tfidf": [False, True]}},
    "fasttext": {
        "step0": {"epoch": [1, 3, 5, 10, 15]},
        "step1": {"loss": ["softmax", "ns", "hs"]},
        "step2": {"wordNgrams": [1, 2, 3], "minCount": [1, 5, 25, 100]},
        "step3": {"dim": [50, 100, 300]},
        "step4": {"t": [0.0001, 0.001, 0.01]},
        "step5": [{"lr": [0.01], "epoch": [10, 15, 25]}, {"lr": [0.05], "epoch": [5, 10, 15, 25]},
                  {"lr": [0.1], "epoch": [1, 3, 5, 10]}]},
}


# ---- folds ------------------------------------------------------------------------------

def stratified_folds(df: DataFrame, label: str, unique: list[str], k: int = 3, seed: str = "24",
                     out_col: str = "fold") -> DataFrame:
    """Fold 0 … k−1; the folds of each label differ by one row at most."""
    if k < 2:
        raise ValueError("need at least two folds")
    placed = hash_place(df, [label], unique, seed, "_place")
    return placed.withColumn(out_col, F.pmod(F.col("_place") - 1, F.lit(k)).cast("int")).drop("_place")


def holdout(df: DataFrame, fraction: float, unique: list[str], seed: str = "24", out_col: str = "fold") -> DataFrame:
    """Fold 0 is a test set of ``ceil(fraction · n)`` rows, −1 the training rows."""
    if not 0 < fraction < 1:
        raise ValueError("fraction must lie between 0 and 1")
    size = df.agg(F.ceil(F.count(F.lit(1)) * F.lit(fraction)).alias("n")).scalar()
    placed = hash_place(df, [], unique, seed, "_place")
    return placed.withColumn(out_col, F.when(F.col("_place") <= size, 0).otherwise(-1)).drop("_place")


def group_folds(df: DataFrame, group: str, k: int, seed: str = "24", out_col: str = "fold") -> DataFrame:
    """All rows of a group (a file) fall into one fold."""
    digits = F.substring(F.md5(F.concat_ws("|", F.lit(seed), F.col(group).cast("string"))), 1, 8)
    return df.withColumn(out_col, F.pmod(F.conv(digits, 16, 10).cast("long"), F.lit(k)).cast("int"))


def splits(df: DataFrame, fold_col: str = "fold"):
    """``(fold, train, test)`` for every fold; −1 is always training."""
    for row in df.filter(F.col(fold_col) >= 0).select(fold_col).distinct().orderBy(fold_col).collect():
        yield row[0], df.filter(F.col(fold_col) != row[0]), df.filter(F.col(fold_col) == row[0])


# ---- scores -----------------------------------------------------------------------------

def weighted_scores(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """One row: accuracy and precision, recall, F1 weighted by true label. Computed on the confusion counts."""
    cells = df.groupBy(F.col(label).cast("string").alias("t"), F.col(prediction).cast("string").alias("p")).agg(
        F.count(F.lit(1)).alias("n")).filter("t is not null")
    true = cells.groupBy("t").agg(F.sum("n").alias("support"), F.sum(F.when(F.col("t") == F.col("p"), F.col("n")).otherwise(0)).alias("hit"))
    guessed = cells.groupBy("p").agg(F.sum("n").alias("guessed"))
    rows = true.join(guessed, F.col("t") == F.col("p"), "left").select(
        "support", "hit", F.coalesce(F.col("hit") / F.col("guessed"), F.lit(0.0)).alias("precision"),
        (F.col("hit") / F.col("support")).alias("recall"))
    f1 = F.coalesce(2 * F.col("precision") * F.col("recall") / F.nullif(F.col("precision") + F.col("recall"), F.lit(0.0)), F.lit(0.0))
    total = F.sum("support")
    return rows.withColumn("f1", f1).agg(
        (F.sum("hit") / total).alias("accuracy"), (F.sum(F.col("precision") * F.col("support")) / total).alias("precision"),
        (F.sum(F.col("recall") * F.col("support")) / total).alias("recall"),
        (F.sum(F.col("f1") * F.col("support")) / total).alias("f1"))


def log_loss(df: DataFrame, true_probability: str, eps: float = 1e-15) -> DataFrame:
    """Mean negative log of the probability given to the true label."""
    p = F.least(F.greatest(F.col(true_probability), F.lit(eps)), F.lit(1 - eps))
    return df.agg((-F.avg(F.ln(p))).alias("log_loss"))


def true_probability(df: DataFrame, probability: str = "probability", label_index: str = "label") -> DataFrame:
    return df.withColumn("true_probability", F.element_at(vector_to_array(probability), F.col(label_index).cast("int") + 1))


def top_k_accuracy(long: DataFrame, id_col: str, label: str, p: str, truth: str, k: int = 3) -> DataFrame:
    """Share of documents whose true label is among the ``k`` most probable; ties go to the later label.

    A document has one row per class, so a group is as large as the number of classes.
    """
    ranked = long.groupBy(id_col).agg(
        F.first(truth).alias("_truth"), F.sort_array(F.collect_list(F.struct(F.col(p).alias("p"), F.col(label).alias("l"))), asc=False).alias("_r"))
    hit = F.array_contains(F.transform(F.slice("_r", 1, k), lambda r: r["l"]), F.col("_truth"))
    return ranked.agg(F.avg(hit.cast("double")).alias("top_k_accuracy"))


def best_label(long: DataFrame, id_col: str, label: str, p: str) -> DataFrame:
    """The most probable label; ties go to the later label."""
    return long.groupBy(id_col).agg(F.max_by(label, F.struct(F.col(p), F.col(label))).alias("prediction"))


class TopKAccuracy(Evaluator):
    """Spark evaluator: the true label index is among the ``k`` largest entries of the probability vector."""

    def __init__(self, k: int = 3, probability_col: str = "probability", label_col: str = "label"):
        super().__init__()
        self.k, self.probability_col, self.label_col = k, probability_col, label_col

    def _evaluate(self, dataset):
        p = vector_to_array(self.probability_col)
        own = F.element_at(p, F.col(self.label_col).cast("int") + 1)
        above = F.size(F.filter(p, lambda x: x > own))
        return float(dataset.agg(F.avg((above < self.k).cast("double"))).first()[0])

    def isLargerBetter(self):
        return True


SCORES = ("accuracy", "precision", "recall", "f1", "neg_log_loss", "top_k_accuracy")


def score_predictions(predicted: DataFrame, scoring: str | Evaluator = "accuracy", k: int = 3) -> float:
    """One number for a table with ``label, prediction, probability``."""
    if isinstance(scoring, Evaluator):
        return float(scoring.evaluate(predicted))
    if scoring == "top_k_accuracy":
        return TopKAccuracy(k)._evaluate(predicted)
    if scoring == "neg_log_loss":
        return -float(log_loss(true_probability(predicted), "true_probability").first()[0])
    if scoring not in SCORES:
        raise ValueError(f"scoring must be one of {SCORES} or an Evaluator")
    return float(weighted_scores(predicted).first()[scoring])


def cross_validate(df: DataFrame, estimator, fold_col: str = "fold", scoring="accuracy", k: int = 3) -> list[dict]:
    """Score and seconds of every fold."""
    out = []
    for fold, train, test in splits(df, fold_col):
        start = time.time()
        predicted = estimator.fit(train).transform(test)
        out.append({"fold": fold, "value": score_predictions(predicted, scoring, k), "seconds": time.time() - start})
    return out


# ---- tuning -----------------------------------------------------------------------------

def grid_steps(grid: dict) -> list[list[dict]]:
    """Steps of a grid: a plain grid is one step, a step may be a list of grids; a missing step is a KeyError."""
    if "step0" not in grid:
        grid = {"step0": grid}
    steps = []
    for i in range(len(grid)):
        if f"step{i}" not in grid:
            raise KeyError(f"step{i} is not in the grid")
        step = grid[f"step{i}"]
        steps.append(step if isinstance(step, list) else [step])
    return steps


def tune(df: DataFrame, make_estimator: Callable[..., object] | None, grid: dict | str, *, fold_col: str = "fold",
         scoring="accuracy", k: int = 3) -> tuple[dict, float, DataFrame]:
    """Best parameters, best value and a table of all trials.

    The best values of a step stay fixed in the next ones. The data is kept between the trials. A grid given by name is the default
    one of that model; without ``make_estimator`` its own model is tuned.
    """
    if isinstance(grid, str):
        if grid not in DEFAULT_GRIDS:
            raise ValueError(f"no default grid for {grid!r}")
        make_estimator, grid = make_estimator or partial(default_model, grid), DEFAULT_GRIDS[grid]
    steps = grid_steps(grid)
    kept = df.persist()
    trials, fixed, best_value = [], {}, None
    try:
        for number, grids in enumerate(steps):
            best = None
            for one in grids:
                names = sorted(one)
                for values in product(*(one[n] for n in names)):
                    params = dict(zip(names, values))
                    scores = cross_validate(kept, make_estimator(**{**fixed, **params}), fold_col, scoring, k)
                    value = sum(s["value"] for s in scores) / len(scores)
                    trials.append((number, str({**fixed, **params}), value, sum(s["seconds"] for s in scores)))
                    if best is None or value > best[1]:
                        best = (params, value)
            fixed.update(best[0])
            best_value = best[1]
    finally:
        kept.unpersist()
    table = df.sparkSession.createDataFrame(trials, "step int, params string, value double, seconds double")
    return fixed, best_value, table


def compare_models(df: DataFrame, estimators: dict[str, object], fold_col: str = "fold") -> DataFrame:
    """``model, fold, accuracy, precision, recall, f1, seconds`` for every model and fold."""
    kept = df.persist()
    rows = []
    try:
        for name, estimator in estimators.items():
            for fold, train, test in splits(kept, fold_col):
                start = time.time()
                s = weighted_scores(estimator.fit(train).transform(test)).first()
                rows.append((name, fold, s["accuracy"], s["precision"], s["recall"], s["f1"], time.time() - start))
    finally:
        kept.unpersist()
    return df.sparkSession.createDataFrame(
        rows, "model string, fold int, accuracy double, precision double, recall double, f1 double, seconds double")
