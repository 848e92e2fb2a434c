"""Classification metrics from (label, prediction) rows, by aggregation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def confusion_counts(predictions: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return predictions.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(
        F.count(F.lit(1)).alias("n")
    )


def confusion_matrix(
    predictions: DataFrame, classes: list[str], label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    """One row per true class, one column per predicted class."""
    counted = confusion_counts(predictions, label, prediction)
    return counted.groupBy("label").agg(*[
        F.coalesce(F.sum(F.when(F.col("prediction") == c, F.col("n"))), F.lit(0)).alias(str(c)) for c in classes
    ])


def class_counts(counted: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, class, precision, recall, f1_score, support, hit) from counted (keys, label, prediction, n); an undefined ratio counts as 0."""
    sides = counted.select(*keys, F.explode(F.array(
        F.struct(F.col("label").alias("class"), F.col("n").alias("true"), F.lit(0).cast("bigint").alias("guessed"),
                 F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0).cast("bigint").alias("hit")),
        F.struct(F.col("prediction").alias("class"), F.lit(0).cast("bigint").alias("true"), F.col("n").alias("guessed"),
                 F.lit(0).cast("bigint").alias("hit")),
    )).alias("s")).select(*keys, "s.*")
    per_class = sides.groupBy(*keys, "class").agg(F.sum("true").alias("support"), F.sum("guessed").alias("guessed"), F.sum("hit").alias("hit"))
    return per_class.withColumns({
        "precision": F.coalesce(F.try_divide("hit", "guessed"), F.lit(0.0)),
        "recall": F.coalesce(F.try_divide("hit", "support"), F.lit(0.0)),
    }).select(
        *keys, "class", "precision", "recall",
        F.coalesce(F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")), F.lit(0.0)).alias("f1_score"),
        "support", "hit",
    )


def class_report(predictions: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """(class, precision, recall, f1_score, support); an undefined ratio counts as 0."""
    return class_counts(confusion_counts(predictions, label, prediction), [])


def grouped_metrics(counted: DataFrame, keys: list[str]) -> DataFrame:
    """Per group of ``keys``: accuracy and the support-weighted precision, recall and F1 of counted predictions."""
    total = F.sum("support")
    return class_counts(counted, keys).groupBy(*keys).agg(
        (F.sum("hit") / total).alias("accuracy"),
        *[(F.sum(F.col(c) * F.col("support")) / total).alias(c) for c in ("precision", "recall", "f1_score")],
    )


def weighted_metrics(predictions: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """One row: accuracy and the support-weighted precision, recall and F1."""
    return grouped_metrics(confusion_counts(predictions, label, prediction), [])


def with_gap(test: DataFrame, train: DataFrame) -> DataFrame:
    """Add the training accuracy and how far it exceeds the test accuracy."""
    return test.withColumn("train_accuracy", train.select("accuracy").scalar()).withColumn(
        "overfitting_gap", F.col("train_accuracy") - F.col("accuracy")
    )
