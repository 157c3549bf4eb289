"""Supervised window classifier: boosted trees or logistic weights over 30-row windows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field, replace

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigilseries.functions.scalars import binarize_score
from vigilseries.operators.boosting import BoostedWindows, train_boosted
from vigilseries.operators.evaluate import optimise_threshold, prf
from vigilseries.operators.split import class_weight, last_window, scaler_values
from vigilseries.operators.trainer import LogisticWeights, score_blocks, stored_folds, stored_windows, train_logistic, window_blocks
from vigilseries.session import materialize, setting

FOLDS = 4
#: Overlapping windows take few bytes in a file and many in memory, where boosting keeps them: a file holds
#: so many rows, and a task reads so many bytes, counting 4 MB for opening a file.
FILE_ROWS = 100_000
TASK_BYTES = 16 << 20


def window_vector(features: Column, layout: str = "flat") -> Column:
    """A window (array of steps) as one array: all steps, or the newest step and the mean step.

    ``ready`` takes the array as it is, for rows of ``window_summaries``.
    """
    if layout == "ready":
        return features
    if layout == "flat":
        return F.flatten(features)
    zero = F.transform(F.element_at(features, 1), lambda x: F.lit(0.0))
    total = F.aggregate(features, zero, lambda acc, step: F.zip_with(acc, step, lambda a, b: a + b))
    return F.concat(F.element_at(features, -1), F.transform(total, lambda x: x / F.size(features)))


@dataclass
class WindowClassifier:
    model: object
    kind: str
    layout: str
    threshold: float = 0.5
    metrics: dict = field(default_factory=dict)
    feature_count: int = 0
    window: int = 30
    history: list = field(default_factory=list)

    def probability(self, df: DataFrame, features_col: str = "features") -> DataFrame:
        """Add ``anomaly_score``; rows without features get null."""
        if isinstance(self.model, (LogisticWeights, BoostedWindows)):
            return df.withColumn("anomaly_score", F.when(F.col(features_col).isNotNull(), self.model.score(window_vector(F.col(features_col), self.layout))))
        vectors = df.withColumn("_vec", array_to_vector(F.coalesce(
            window_vector(F.col(features_col), self.layout), F.array_repeat(F.lit(0.0), self.model.numFeatures))))
        scored = self.model.transform(vectors)
        score = F.when(F.col(features_col).isNotNull(), vector_to_array("probability")[1])
        return scored.withColumn("anomaly_score", score).drop("_vec", "rawPrediction", "probability", "prediction")

    def transform(self, df: DataFrame, features_col: str = "features") -> DataFrame:
        scored = self.probability(df, features_col)
        return scored.withColumns({
            "is_anomaly_pred": binarize_score(F.col("anomaly_score"), self.threshold), "threshold": F.lit(self.threshold)})


def _boosting(budget: int) -> GBTClassifier:
    return GBTClassifier(maxIter=budget, maxDepth=4, seed=42, validationIndicatorCol="_val", featuresCol="_vec", labelCol="label", weightCol="_weight")


def _better(history: list[dict], patience: int) -> int:
    """The step of the best validation F1 before ``patience`` steps passed without a gain."""
    best = history[0]
    for row in history[1:]:
        if row["step"] - best["step"] > patience:
            break
        best = row if row["val_f1"] > best["val_f1"] else best
    return best["step"]


def _boosted(ready: DataFrame, max_iter: int, patience: int):
    """Grow all trees once, score every prefix of them in one pass, and refit to the best length."""
    full = _boosting(max_iter).fit(ready)
    held, weights = ready.where("_val").select("_vec", "label"), full.treeWeights
    for i, tree in enumerate(full.trees):
        held = tree.setPredictionCol(f"_t{i}").setFeaturesCol("_vec").transform(held)
    margin, marks = F.lit(0.0), []
    for i, w in enumerate(weights):
        margin = margin + F.lit(float(w)) * F.col(f"_t{i}")
        marks.append((margin >= 0).cast("int"))
    held = materialize(held.select("label", F.array(*marks).alias("_hits")), "prefixes").select("label", F.posexplode("_hits").alias("step", "hit"))
    y, p = F.col("label") == 1, F.col("hit") == 1
    counts = held.groupBy("step").agg(F.count_if(y & p).alias("tp"), F.count_if(~y & p).alias("fp"), F.count_if(y & ~p).alias("fn"))
    scored = counts.select("step", *[c.alias(f"val_{n}") for n, c in prf(F.col("tp"), F.col("fp"), F.col("fn")).items()]).orderBy("step").collect()
    history = [{**r.asDict(), "step": r["step"] + 1} for r in scored]
    best = _better(history, patience) if history else max_iter
    return (full if best == len(weights) else _boosting(best).fit(ready)), history


def _regressed(rows: DataFrame, features_col: str, label_col: str, layout: str, steps: int, max_iter: int, patience: int):
    """Train in mini-batches of whole windows; at most ``max_iter`` epochs. Windows that overlap are kept as their rows."""
    flat, span = window_vector(F.col(features_col), layout), steps if layout == "flat" else 1
    size = rows.select(F.size(flat)).first()[0]
    stored = stored_windows(rows, flat, F.col(label_col), F.col("_val"), FOLDS, span)
    return train_logistic(stored, 1, size, FOLDS, max_iter, patience, span=span)


def _tuned(fitted: WindowClassifier, scored: DataFrame, label_col: str) -> WindowClassifier:
    """With the threshold of the best F1 over scored windows."""
    found = optimise_threshold(scored, "anomaly_score", label_col).first().asDict()
    fitted.threshold = float(found["threshold"])
    fitted.metrics = {k: float(v) for k, v in found.items()}
    return fitted


def fit_window_classifier(train: DataFrame, val: DataFrame, kind: str = "gbt", max_iter: int = 50, patience: int = 10,
                          tune_on: str = "val", test: DataFrame | None = None, layout: str = "flat",
                          features_col: str = "features", label_col: str = "label", window: int = 30) -> WindowClassifier:
    """Keep the number of iterations of the best validation F1 at 0.5, then tune the threshold.

    Iterations after ``patience`` of them without a gain do not count.
    Positives weigh as many times more as they are rarer.
    """
    if layout != "ready":
        window, n_features = train.select(F.size(features_col), F.size(F.element_at(features_col, 1))).first()
    else:
        n_features = train.select(F.size(features_col)).first()[0] // 2
    rows = train.withColumn("_val", F.lit(False)).unionByName(val.withColumn("_val", F.lit(True)))
    if kind not in ("logreg", "gbt"):
        raise ValueError(f"unknown kind {kind!r}")
    if kind == "logreg":
        best, history = _regressed(rows, features_col, label_col, layout, window, max_iter, patience)
    else:
        weight = class_weight(train.select(F.col(label_col).alias("y")), "y").first()["pos_weight"]
        ready = materialize(rows.select(
            array_to_vector(window_vector(F.col(features_col), layout)).alias("_vec"), F.col(label_col).cast("double").alias("label"), "_val",
            F.when(F.col(label_col) == 1, F.lit(float(weight or 1.0))).otherwise(F.lit(1.0)).alias("_weight")), "windows", FILE_ROWS)
        with setting(train.sparkSession, "spark.sql.files.maxPartitionBytes", str(TASK_BYTES)):
            best, history = _boosted(ready, max_iter, patience)
    fitted = WindowClassifier(best, kind, layout, window=window, feature_count=n_features, history=history)
    return _tuned(fitted, fitted.probability(test if tune_on == "test" else val, features_col), label_col)


def fit_row_classifier(df: DataFrame, feature_cols: Sequence[str], label_col: str, order_col, window: int = 30, series_cols=None,
                       max_iter: int = 50, patience: int = 10, folds: int = FOLDS, kind: str = "logreg") -> WindowClassifier:
    """The classifier over whole windows, trained from the rows of the splits ``train`` and ``val``.

    The same windows as those of ``sliding_sequences``, but none is written
    out, so all features of all steps can take part on long series. The model
    scores windows like any other, and rows by ``score_blocks``. Windows with a
    null feature or without a label take no part.
    """
    blocks = materialize(window_blocks(df.where("split IN ('train', 'val')"), feature_cols, label_col, order_col, window, series_cols=series_cols), "blocks")
    return fit_block_classifier(blocks, len(feature_cols), window, max_iter, patience, folds, kind)


def fit_block_classifier(blocks: DataFrame, n_features: int, window: int = 30, max_iter: int = 50, patience: int = 10, folds: int = FOLDS,
                         kind: str = "logreg") -> WindowClassifier:
    """``fit_row_classifier`` on blocks that were written before; those of other splits take no part."""
    blocks = blocks.where("split IN ('train', 'val')")
    if kind == "logreg":
        keys = [c for c in blocks.columns if c not in ("steps", "y", "ends")]
        rows = stored_folds(blocks, F.col("split") == "val", keys, folds)
        model, history = train_logistic(rows, window, n_features, folds, max_iter, patience)
    elif kind == "gbt":
        model, history = train_boosted(blocks, F.col("split") == "val", window, n_features, max_iter, patience)
    else:
        raise ValueError(f"unknown kind {kind!r}")
    fitted = WindowClassifier(model, kind, "flat", window=window, feature_count=n_features, history=history)
    held = score_blocks(blocks.where("split = 'val'"), model).where("label IS NOT NULL AND anomaly_score IS NOT NULL")
    return _tuned(fitted, materialize(held.select("label", "anomaly_score"), "held"), "label")


def for_windows(model: WindowClassifier) -> WindowClassifier:
    """A model fitted on ``window_summaries`` rows, ready to score raw windows."""
    return replace(model, layout="summary")


def scale_window(features: Column, params: DataFrame) -> Column:
    """Scale every step of a window with fitted per-feature values."""
    values = scaler_values(params)
    means, scales = F.lit([m for _, m, _ in values]), F.lit([s for _, _, s in values])
    return F.transform(features, lambda step: F.zip_with(
        F.zip_with(step, means, lambda x, m: x - m), scales, lambda x, s: x / s))


def score_windows(df: DataFrame, model: WindowClassifier, params: DataFrame | None = None, features_col: str = "features") -> DataFrame:
    """Newest window of each request, scaled, scored and flagged; too short ones carry an ``error``."""
    ready = last_window(df, features_col, model.window)
    if params is not None:
        ready = ready.withColumn(features_col, scale_window(F.col(features_col), params))
    return model.transform(ready, features_col)
