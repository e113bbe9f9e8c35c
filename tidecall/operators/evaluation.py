"""Classification metrics as aggregates over rows that carry label and prediction together."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidecall import fixed_values as V
from tidecall.functions.ordered import ROWS_PER_RANGE, counts_before


def _cells(label: str, prediction: str) -> dict[str, Column]:
    y, p = F.col(f"`{label}`"), F.col(f"`{prediction}`")
    return {
        "tn": F.count_if((y == 0) & (p == 0)),
        "fp": F.count_if((y == 0) & (p == 1)),
        "fn": F.count_if((y == 1) & (p == 0)),
        "tp": F.count_if((y == 1) & (p == 1)),
    }


def confusion(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """``tn, fp, fn, tp`` as one row."""
    return df.agg(*[c.alias(n) for n, c in _cells(label, prediction).items()])


def confusion_matrix(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """The four cells as rows ``label, prediction, n``, empty cells included."""
    cells = [
        F.struct(F.lit(y).alias("label"), F.lit(p).alias("prediction"), F.col(c).alias("n"))
        for c, y, p in [("tn", 0, 0), ("fp", 0, 1), ("fn", 1, 0), ("tp", 1, 1)]
    ]
    return confusion(df, label, prediction).select(F.explode(F.array(*cells)).alias("c")).select("c.*")


def _ratio(part, whole) -> Column:
    """Zero where the denominator is zero."""
    return F.coalesce(F.try_divide(part.cast("double"), whole), F.lit(0.0))


def _precision(tp: Column, fp: Column) -> Column:
    return _ratio(tp, tp + fp)


def _f1(tp: Column, fp: Column, fn: Column) -> Column:
    return _ratio(tp * 2, tp * 2 + fp + fn)


def metrics(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Accuracy, precision, recall and F1 as one row; no row for an empty input."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    return (
        confusion(df, label, prediction)
        .where(tn + fp + fn + tp > 0)
        .select(
            _ratio(tp + tn, tn + fp + fn + tp).alias("accuracy"),
            _precision(tp, fp).alias("precision"),
            _ratio(tp, tp + fn).alias("recall"),
            _f1(tp, fp, fn).alias("f1"),
        )
    )


def roc_auc(
    df: DataFrame, label: str = "label", score: str = "score", rows_per_range: int = ROWS_PER_RANGE
) -> DataFrame:
    """Exact area under the ROC curve with ties, as one row; null if only one class occurs.

    Equal scores are collapsed first, so that a frequent score is one row. Distinct scores are
    then ordered in ranges whose number follows from their count, and each range carries the
    negatives of all ranges below it: no task orders more than about ``rows_per_range`` scores.
    """
    data = df.select(F.col(f"`{score}`").cast("double").alias("__s"), F.col(f"`{label}`").alias("__y"))
    per_score = (
        data.where(F.col("__s").isNotNull())
        .groupBy("__s")
        .agg(
            F.count_if(F.col("__y") == 1).cast("double").alias("pos"),
            F.count_if(F.col("__y") == 0).cast("double").alias("neg"),
        )
    )
    won = F.col("pos") * (F.col("neg_before") + F.col("neg") / 2)
    return counts_before(per_score, ["__s"], ["neg"], rows_per_range).agg(
        F.try_divide(F.sum(won), F.sum("pos") * F.sum("neg")).alias("roc_auc")
    )


def roc_auc_hard(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Area under the curve of 0/1 predictions: the mean of both classes' recall."""
    tn, fp, fn, tp = (F.col(c).cast("double") for c in ("tn", "fp", "fn", "tp"))
    return confusion(df, label, prediction).select(
        ((F.try_divide(tp, tp + fn) + F.try_divide(tn, tn + fp)) / 2).alias("roc_auc_hard")
    )


def metric_bundle(
    df: DataFrame, label: str = "label", prediction: str = "prediction", score: str = "score"
) -> DataFrame:
    """All five quality metrics as one row; no row for an empty input."""
    auc = roc_auc(df, label, score).scalar()
    return metrics(df, label, prediction).withColumn("roc_auc", auc)


def class_report(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Precision, recall, F1 and support per class, with accuracy, macro and weighted averages."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))

    def row(name, precision, recall, f1, support):
        return F.struct(
            F.lit(name).alias("class"),
            precision.alias("precision"),
            recall.alias("recall"),
            f1.alias("f1"),
            support.alias("support"),
        )

    zero = (_precision(tn, fn), _ratio(tn, tn + fp), _f1(tn, fn, fp), tn + fp)
    one = (_precision(tp, fp), _ratio(tp, tp + fn), _f1(tp, fp, fn), tp + fn)
    both = zero[3] + one[3]
    accuracy = _ratio(tp + tn, both)
    macro = [(a + b) / 2 for a, b in zip(zero[:3], one[:3])]
    weighted = [_ratio(a * zero[3] + b * one[3], both) for a, b in zip(zero[:3], one[:3])]
    rows = [
        row("0", *zero),
        row("1", *one),
        row("accuracy", accuracy, accuracy, accuracy, both),
        row("macro avg", *macro, both),
        row("weighted avg", *weighted, both),
    ]
    return confusion(df, label, prediction).select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def prediction_summary(df: DataFrame, prediction: str = "prediction", threshold: float = V.THRESHOLD) -> DataFrame:
    """Count, positives and rate of final predictions; the mean only for more than one row."""
    p = F.col(f"`{prediction}`")
    n = F.count("*")
    return df.agg(
        n.alias("count"),
        F.coalesce(F.sum(p), F.lit(0)).cast("bigint").alias("positive_count"),
        F.avg((p == 1).cast("double")).alias("positive_rate"),
        F.when(n > 1, F.avg(p.cast("double"))).alias("mean_prediction"),
    ).withColumn("threshold", F.lit(float(threshold)))


def actual_vs_predicted(df: DataFrame, actual: DataFrame, key: str, label: str = V.LABEL_COLUMN) -> DataFrame:
    """Predictions next to the labels of the same rows, joined on the row key."""
    return df.join(actual.select(key, F.col(f"`{label}`").alias("label")), key)
