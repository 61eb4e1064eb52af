"""Classification metrics as aggregates over (actual, predicted) and (class, score) rows.

Predictions collapse to a confusion count before anything else, so every later step works on
classes, not rows. ``by`` evaluates many models or segments in the same pass.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordered import running_totals

METRICS = ["accuracy", "f1", "precision", "recall"]


def confusion_counts(
    preds: DataFrame, actual: str, predicted: str, by: Sequence[str] = ()
) -> DataFrame:
    return preds.groupBy(*by, F.col(actual).alias("actual"), F.col(predicted).alias("predicted")).agg(
        F.count(F.lit(1)).alias("n")
    )


def confusion_matrix(
    preds: DataFrame, actual: str, predicted: str, classes: Sequence
) -> DataFrame:
    """Actual by predicted, a column per class, 0 where nothing was predicted."""
    return preds.groupBy(F.col(actual).alias("actual")).agg(
        *[F.count_if(F.col(predicted) == c).alias(f"pred_{c}") for c in classes]
    )


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def class_report(
    preds: DataFrame, actual: str, predicted: str, by: Sequence[str] = ()
) -> DataFrame:
    """Per class: precision, recall, f1 and support; undefined ratios are 0."""
    counts = confusion_counts(preds, actual, predicted, by)
    same = F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(F.lit(0))

    def part(cls: str, support: Column, hit: Column, said: Column) -> Column:
        return F.struct(
            F.col(cls).alias("class"), support.cast("bigint").alias("support"),
            hit.cast("bigint").alias("hit"), said.cast("bigint").alias("said"),
        )

    zero = F.lit(0)
    sides = F.array(
        part("actual", F.col("n"), same, zero), part("predicted", zero, zero, F.col("n"))
    )
    per = (
        counts.select(*by, F.inline(sides))
        .groupBy(*by, "class")
        .agg(F.sum("support").alias("support"), F.sum("hit").alias("hit"), F.sum("said").alias("said"))
    )
    precision = _ratio(F.col("hit"), F.col("said"))
    recall = _ratio(F.col("hit"), F.col("support"))
    return per.select(
        *by, "class", precision.alias("precision"), recall.alias("recall"),
        _ratio(2 * precision * recall, precision + recall).alias("f1"), "support", "hit",
    )


def weighted_metrics(
    preds: DataFrame, actual: str, predicted: str, by: Sequence[str] = ()
) -> DataFrame:
    """Accuracy and support-weighted F1, precision and recall."""
    per = class_report(preds, actual, predicted, by)
    total = F.sum("support")

    def weighted(col: str) -> Column:
        return (F.sum(F.col(col) * F.col("support")) / total).alias(col)

    return per.groupBy(*by).agg(
        (F.sum("hit") / total).alias("accuracy"),
        weighted("f1"), weighted("precision"), weighted("recall"), total.alias("support"),
    )


def full_report(preds: DataFrame, actual: str, predicted: str) -> DataFrame:
    """The per-class report followed by accuracy, macro and weighted averages."""
    per = class_report(preds, actual, predicted)
    total = F.sum("support")
    cells = per.groupBy().agg(
        total.alias("_n"),
        (F.sum("hit") / total).alias("_acc"),
        *[F.avg(c).alias(f"_m_{c}") for c in ("precision", "recall", "f1")],
        *[(F.sum(F.col(c) * F.col("support")) / total).alias(f"_w_{c}")
          for c in ("precision", "recall", "f1")],
    )

    def line(name: str, precision: str, recall: str, f1: str) -> Column:
        return F.struct(
            F.lit(name).alias("row"), F.col(precision).alias("precision"),
            F.col(recall).alias("recall"), F.col(f1).alias("f1"), F.col("_n").alias("support"),
        )

    averages = cells.select(
        F.inline(
            F.array(
                line("accuracy", "_acc", "_acc", "_acc"),
                line("macro avg", "_m_precision", "_m_recall", "_m_f1"),
                line("weighted avg", "_w_precision", "_w_recall", "_w_f1"),
            )
        )
    )
    classes = per.select(
        F.col("class").cast("string").alias("row"), "precision", "recall", "f1", "support"
    )
    return classes.unionByName(averages)


def roc_auc(
    scored: DataFrame, positive: str, score: str, by: Sequence[str] = ()
) -> DataFrame:
    """Area under the ROC curve with ties counted half; NaN when one side is empty.

    ``positive`` is a 0/1 column. Rows collapse to counts per distinct score first; the
    running count of negatives is then carried over score buckets.
    """
    flag = F.col(positive)
    ties = (
        scored.where(F.col(score).isNotNull())
        .groupBy(*by, F.col(score).cast("double").alias("_s"))
        .agg(F.sum(flag).alias("_pos"), F.sum(1 - flag).alias("_neg"))
    )
    below = running_totals(ties, "_s", ["_neg"], by)
    won = F.sum(F.col("_pos") * (F.col("_neg_before") + F.col("_neg") / 2))
    pairs = F.sum("_pos").cast("double") * F.sum("_neg")
    return below.groupBy(*by).agg(
        F.when(pairs > 0, won / pairs).otherwise(F.lit(float("nan"))).alias("auc"),
        F.sum("_pos").alias("support"),
    )


def roc_auc_ovr(
    preds: DataFrame, actual: str, scores: dict[object, str], by: Sequence[str] = ()
) -> DataFrame:
    """One-vs-rest AUC weighted by support; ``scores`` maps a class to its score column."""
    sides = F.array(
        *[
            F.struct(
                F.lit(str(c)).alias("class"),
                (F.col(actual).cast("string") == str(c)).cast("int").alias("positive"),
                F.col(col).cast("double").alias("score"),
            )
            for c, col in scores.items()
        ]
    )
    long = preds.select(*by, F.inline(sides))
    per = roc_auc(long, "positive", "score", [*by, "class"])
    return per.groupBy(*by).agg(
        (F.sum(F.col("auc") * F.col("support")) / F.sum("support")).alias("auc")
    )


def metric_long(results: DataFrame, keys: Sequence[str], metrics: Sequence[str] = METRICS) -> DataFrame:
    """Results with one row per metric."""
    cells = [F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in metrics]
    return results.select(*keys, F.inline(F.array(*cells)))


def displayed(results: DataFrame) -> DataFrame:
    """Rounded leaderboard figures, an undefined AUC shown as 0."""
    return results.select(
        "embedding", "model",
        F.concat_ws(" + ", "embedding", "model").alias("name"),
        *[F.round(m, 4).alias(m) for m in METRICS],
        F.round(F.nanvl(F.coalesce("auc", F.lit(0.0)), F.lit(0.0)), 4).alias("auc"),
    )
