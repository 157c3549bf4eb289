"""Metrics, threshold search, reports, leaderboard and table comparison."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigilseries.operators.layout import CHUNK, ROW_IDX, chunk_over, group_of, index_rows, null_safe_join, running_sum


def ratio(num: Column, den: Column) -> Column:
    """num / den, 0.0 when the denominator is 0."""
    return F.when(den != 0, num / den).otherwise(F.lit(0.0))


def prf(tp: Column, fp: Column, fn: Column) -> dict[str, Column]:
    return {"precision": ratio(tp, tp + fp), "recall": ratio(tp, tp + fn), "f1": ratio(2 * tp, 2 * tp + fp + fn)}


def score_counts(df: DataFrame, score_col: str, label_col: str, **more: Column) -> DataFrame:
    """Per distinct score, in score order, its positives ``p`` and negatives ``q``; ``df`` is read once.

    ``more`` are further sums per score. Everything else about a scored frame
    follows from these rows.
    """
    y = F.col(label_col) == 1
    counts = df.groupBy(F.col(score_col).cast("double").alias("s")).agg(F.count_if(y).alias("p"), F.count_if(~y).alias("q"), *[c.alias(n) for n, c in more.items()])
    return index_rows(counts, "s")


def rank_area(counts: DataFrame) -> float:
    """Exact area under the ROC curve of ``score_counts``: the share of (positive, negative) pairs in the right order, ties half.

    Running counts stay inside chunks of distinct scores; one row per chunk
    carries the rest. Rows without a score are left out. 0.0 without positives,
    1.0 without negatives.
    """
    whole = "decimal(19,0)"
    chunks = counts.where("s IS NOT NULL").withColumn(CHUNK, group_of(ROW_IDX, None))
    below = f"coalesce(sum(q) OVER ({chunk_over()} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0L)"
    twice = chunks.selectExpr(CHUNK, "p", "q", f"CAST(p AS {whole}) * CAST(2 * {below} + q AS {whole}) AS w")
    each = twice.groupBy(CHUNK).agg(*[F.sum(c).alias(c) for c in ("p", "q", "w")])
    placed = running_sum(each, {"before": "q"}, idx=CHUNK, levels=1, inclusive=False)
    row = placed.selectExpr("sum(p) AS p", "sum(q) AS q", f"sum(w + 2 * CAST(p AS {whole}) * CAST(before AS {whole})) AS w").first()
    if not row["p"]:
        return 0.0
    return int(row["w"]) / (2 * row["p"] * row["q"]) if row["q"] else 1.0


def roc_auc(df: DataFrame, score_col: str, label_col: str) -> float:
    """Exact area under the ROC curve; 0.0 without positives."""
    return rank_area(score_counts(df, score_col, label_col))


def binary_metrics(df: DataFrame, label_col: str, pred_col: str, score_col: str) -> DataFrame:
    """One row: precision, recall, F1 and ROC AUC, from one pass over ``df``."""
    y, p = F.col(label_col) == 1, F.col(pred_col) == 1
    cells = {"tp": F.count_if(y & p), "fp": F.count_if(~y & p), "fn": F.count_if(y & ~p)}
    counts = score_counts(df, score_col, label_col, **cells)
    sums = counts.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in cells])
    area = rank_area(counts)
    return sums.select(*[c.alias(n) for n, c in prf(F.col("tp"), F.col("fp"), F.col("fn")).items()], F.lit(area).alias("roc_auc"))


def confusion_matrix(df: DataFrame, label_col: str, pred_col: str) -> DataFrame:
    """The four cells of a binary problem, zeros included."""
    y, p = F.col(label_col), F.col(pred_col)
    cells = [(a, b) for a in (0, 1) for b in (0, 1)]
    counts = df.agg(*[F.count_if((y == a) & (p == b)).alias(f"c{a}{b}") for a, b in cells])
    return counts.select(F.inline(F.array(*[
        F.struct(F.lit(a).alias("actual"), F.lit(b).alias("predicted"), F.col(f"c{a}{b}").alias("count")) for a, b in cells])))


def _per_class(df: DataFrame, label_col: str, pred_col: str) -> DataFrame:
    cells = df.groupBy(F.col(label_col).cast("string").alias("y"), F.col(pred_col).cast("string").alias("p")).agg(F.count(F.lit(1)).alias("n"))
    sides = cells.select(F.inline(F.array(
        F.struct(F.col("y").alias("label"), F.when(F.col("y").eqNullSafe(F.col("p")), F.col("n")).otherwise(0).alias("tp"),
                 F.lit(0).cast("bigint").alias("predicted"), F.col("n").alias("support")),
        F.struct(F.col("p").alias("label"), F.lit(0).cast("bigint").alias("tp"), F.col("n").alias("predicted"),
                 F.lit(0).cast("bigint").alias("support")))))
    sums = sides.groupBy("label").agg(*[F.sum(c).alias(c) for c in ("tp", "predicted", "support")])
    tp = F.col("tp")
    scores = prf(tp, F.col("predicted") - tp, F.col("support") - tp)
    return sums.select("label", *[c.alias(n) for n, c in scores.items()], "support", "tp")


def classification_report(df: DataFrame, label_col: str, pred_col: str) -> DataFrame:
    """Precision, recall, F1 and support per class, plus accuracy, macro and weighted averages."""
    classes = _per_class(df, label_col, pred_col)
    parts = ["precision", "recall", "f1"]
    total = F.sum("support")
    summary = classes.agg(
        *[F.avg(p).alias(f"m_{p}") for p in parts],
        *[ratio(F.sum(F.col(p) * F.col("support")), total).alias(f"w_{p}") for p in parts],
        ratio(F.sum("tp"), total).alias("acc"), F.coalesce(total, F.lit(0)).alias("support"))
    averages = summary.select(F.inline(F.array(
        F.struct(F.lit("accuracy").alias("label"), F.col("acc").alias("precision"), F.col("acc").alias("recall"), F.col("acc").alias("f1"), "support"),
        F.struct(F.lit("macro avg").alias("label"), *[F.col(f"m_{p}").alias(p) for p in parts], "support"),
        F.struct(F.lit("weighted avg").alias("label"), *[F.col(f"w_{p}").alias(p) for p in parts], "support"))))
    return classes.select("label", *parts, "support").unionByName(averages)


def macro_f1(df: DataFrame, label_col: str, pred_col: str) -> DataFrame:
    """F1 per class and their plain mean under ``macro``."""
    classes = _per_class(df, label_col, pred_col).select("label", "f1")
    return classes.unionByName(classes.agg(F.avg("f1").alias("f1")).select(F.lit("macro").alias("label"), "f1"))


def threshold_counts(counts: DataFrame, lo: float, hi: float, n: int) -> DataFrame:
    """Per threshold of an even grid, how many rows of each class reach it, from ``score_counts``."""
    step = (hi - lo) / (n - 1)
    s = F.col("s")

    def grid(k):
        return F.when(k >= n - 1, F.lit(float(hi))).otherwise(k * F.lit(step) + F.lit(float(lo)))

    # The last grid value not above the score; the guess is put right by comparing with the grid itself.
    guess = F.greatest(F.least(F.floor((s - lo) / step), F.lit(n - 1)), F.lit(-1)).cast("int")
    up = F.when((guess < n - 1) & (grid(guess + 1) <= s), guess + 1).otherwise(guess)
    reached = F.when((up >= 0) & (grid(up) > s), up - 1).otherwise(up)
    hits = counts.where(s.isNotNull()).groupBy(reached.alias("k")).agg(F.sum("p").alias("p"), F.sum("q").alias("q"))
    spine = counts.sparkSession.range(-1, n).select(F.col("id").cast("int").alias("k"))
    above = Window.partitionBy(F.lit(0)).orderBy(F.desc("k")).rowsBetween(Window.unboundedPreceding, 0)
    everyone = Window.partitionBy(F.lit(0))
    filled = spine.join(hits, "k", "left").fillna(0, ["p", "q"])  # n + 1 rows
    return filled.select(
        "k", grid(F.col("k")).alias("threshold"), F.sum("p").over(above).alias("tp"), F.sum("q").over(above).alias("fp"),
        (F.sum("p").over(everyone) - F.sum("p").over(above)).alias("fn")).where("k >= 0")


def optimise_threshold(df: DataFrame, score_col: str, label_col: str, lo: float = 0.01, hi: float = 0.99, n: int = 200) -> DataFrame:
    """The lowest threshold with the best F1, its metrics and the AUC, from one pass over ``df``."""
    counts = score_counts(df, score_col, label_col)
    scores = threshold_counts(counts, lo, hi, n).select("k", "threshold", *[c.alias(m) for m, c in prf(F.col("tp"), F.col("fp"), F.col("fn")).items()])
    best = scores.orderBy(F.desc("f1"), "k").limit(1)
    return best.select("threshold", "precision", "recall", "f1", F.lit(rank_area(counts)).alias("roc_auc"))


def leaderboard(metrics: DataFrame) -> DataFrame:
    """Models by F1, best first; values rounded to 4 places."""
    names = {"precision": "Precision", "recall": "Recall", "f1": "F1", "roc_auc": "ROC-AUC"}
    return metrics.select(
        F.col("model").alias("Model"), *[F.round(F.coalesce(F.col(c), F.lit(0.0)), 4).alias(n) for c, n in names.items()]
    ).orderBy(F.desc("F1"), "Model")


def reconcile_outputs(a: DataFrame, b: DataFrame, keys: Sequence[str], cols: Sequence[str], tol: float = 1e-4) -> DataFrame:
    """Per column: the largest difference, rows found on one side only, and whether it is within ``tol``."""
    left = a.select(*keys, *[F.col(c).alias(f"a_{c}") for c in cols], F.lit(True).alias("in_a"))
    right = b.select(*keys, *[F.col(c).alias(f"b_{c}") for c in cols], F.lit(True).alias("in_b"))
    both = null_safe_join(left, right, keys, "full")
    sums = both.agg(
        F.count_if(F.col("in_b").isNull()).alias("only_a"), F.count_if(F.col("in_a").isNull()).alias("only_b"),
        *[F.max(F.abs(F.col(f"a_{c}") - F.col(f"b_{c}"))).alias(f"d_{c}") for c in cols],
        *[F.count_if(F.col("in_a") & F.col("in_b") & (F.col(f"a_{c}").isNull() != F.col(f"b_{c}").isNull())).alias(f"u_{c}") for c in cols])
    out = sums.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"d_{c}").alias("max_abs_diff"), F.col(f"u_{c}").alias("one_side_null"),
                 "only_a", "only_b") for c in cols])))
    return out.withColumn("ok", F.coalesce(F.col("max_abs_diff") < tol, F.lit(False)))


def stack_metrics(rows: dict[str, DataFrame]) -> DataFrame:
    """Metric rows of several models as one table."""
    return reduce(DataFrame.unionByName, [df.select(F.lit(m).alias("model"), "precision", "recall", "f1", "roc_auc") for m, df in rows.items()])
