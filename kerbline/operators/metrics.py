"""Quality of 0/1 predictions: tables with `label`, `prediction` and `prob_occupied`."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbline.plans.slices import ordered_frames, running_sums

TINY = 1e-9


def _cells() -> dict:
    hit, truth = F.col("prediction").cast("int"), F.col("label").cast("int")
    return {
        "tp": F.count_if((hit == 1) & (truth == 1)),
        "fp": F.count_if((hit == 1) & (truth == 0)),
        "fn": F.count_if((hit == 0) & (truth == 1)),
        "tn": F.count_if((hit == 0) & (truth == 0)),
    }


def _tallied(preds: DataFrame) -> DataFrame:
    return preds.agg(*[value.alias(name) for name, value in _cells().items()])


def _share(part, whole):
    return F.coalesce(part / F.nullif(whole, F.lit(0)), F.lit(0.0))


def confusion_counts(preds: DataFrame) -> DataFrame:
    return (
        preds.groupBy("prediction", "label")
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy("prediction", "label")
    )


def confusion_matrix(preds: DataFrame) -> DataFrame:
    """Four rows: true and predicted class with count and share of the true class.

    A class without rows stays in the table with share null.
    """
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))

    def cell(truth, hit, count, row):
        return F.struct(
            F.lit(truth).alias("label"),
            F.lit(hit).alias("prediction"),
            count.alias("count"),
            (count / F.nullif(row, F.lit(0))).alias("share"),
        )

    cells = F.array(
        cell(0, 0, tn, tn + fp), cell(0, 1, fp, tn + fp),
        cell(1, 0, fn, fn + tp), cell(1, 1, tp, fn + tp),
    )
    return _tallied(preds).select(F.inline(cells))


def binary_metrics(preds: DataFrame) -> DataFrame:
    """Counts with accuracy, precision and recall, each 0 where it is undefined."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return _tallied(preds).select(
        "tp", "fp", "fn", "tn",
        _share(tp + tn, tp + tn + fp + fn).alias("accuracy"),
        _share(tp, tp + fp).alias("precision"),
        _share(tp, tp + fn).alias("recall"),
    )


def kpi_model(preds: DataFrame) -> DataFrame:
    """Accuracy and F1 of class 1, with a tiny guard in each denominator."""
    counted = preds.agg(
        F.avg((F.col("label") == F.col("prediction")).cast("int")).alias("accuracy"),
        *[value.alias(name) for name, value in _cells().items()],
    )
    precision = F.col("tp") / (F.col("tp") + F.col("fp") + TINY)
    recall = F.col("tp") / (F.col("tp") + F.col("fn") + TINY)
    return counted.select(
        "accuracy", (2 * precision * recall / (precision + recall + TINY)).alias("f1_positive")
    )


def f1_weighted(preds: DataFrame) -> DataFrame:
    """F1 of each class weighted by its true rows, as multiclass evaluators report it."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    rows = tp + fp + fn + tn
    one = _share(2 * tp, 2 * tp + fp + fn) * (tp + fn)
    zero = _share(2 * tn, 2 * tn + fn + fp) * (tn + fp)
    return _tallied(preds).select(_share(one + zero, rows).alias("f1_weighted"))


def _by_score(preds: DataFrame, score: str, label: str) -> DataFrame:
    """Per distinct score its positives and negatives and their sums from the highest score down.

    `_down` orders the scores from high to low.
    """
    counts = (
        preds.filter(F.col(score).isNotNull() & F.col(label).isNotNull())
        .groupBy(F.col(score).alias("threshold"))
        .agg(F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg"))
        .withColumn("_down", -F.col("threshold"))
    )
    return running_sums(counts, [], ["_down"], {"tp": F.col("pos"), "fp": F.col("neg")})


def roc_curve(
    preds: DataFrame,
    score: str = "prob_occupied",
    label: str = "label",
    drop_intermediate: bool = True,
) -> DataFrame:
    """Threshold, fpr and tpr from the highest score down, after a start at (0, 0).

    `drop_intermediate` leaves out points on a straight line between their neighbours, as plots
    want it. The start has an infinite threshold.
    """
    scored = _by_score(preds, score, label)
    if drop_intermediate:

        def build(w):
            next_pos, next_neg = F.lead("pos", 1).over(w), F.lead("neg", 1).over(w)
            at_end = next_pos.isNull() | F.lag("pos", 1).over(w).isNull()
            turns = (next_pos != F.col("pos")) | (next_neg != F.col("neg"))
            return {"_bend": at_end | turns}

        scored = ordered_frames(scored, [], ["_down"], build, before=1, after=1).filter("_bend")
    sizes = preds.filter(F.col(score).isNotNull()).agg(
        F.struct(
            F.count_if(F.col(label) == 1).alias("p"), F.count_if(F.col(label) == 0).alias("n")
        )
    )
    points = scored.withColumn("_all", sizes.scalar()).select(
        "threshold",
        (F.col("fp") / F.nullif(F.col("_all.n"), F.lit(0))).alias("fpr"),
        (F.col("tp") / F.nullif(F.col("_all.p"), F.lit(0))).alias("tpr"),
    )
    start = preds.sparkSession.range(1).select(
        F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")
    )
    return start.unionByName(points)


def auc(preds: DataFrame, score: str = "prob_occupied", label: str = "label") -> DataFrame:
    """Area under the curve by trapezoids, tied scores sharing one step; null with one class only."""
    step = F.col("neg") * (F.col("tp") - F.col("pos") / 2)
    area = F.sum(step) / F.nullif(
        F.sum("pos").cast("double") * F.sum("neg").cast("double"), F.lit(0.0)
    )
    return _by_score(preds, score, label).agg(area.alias("auc"))
