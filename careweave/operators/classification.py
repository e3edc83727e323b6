"""Label counts, confusion matrix and the classification metrics read from it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from careweave import fixed_values as fv
from careweave.functions.numbers import ratio, round_columns

METRICS = ["accuracy", "macro_precision", "macro_recall", "macro_f1", "weighted_f1"]


def label_distribution(df: DataFrame, label: str, *by: str) -> DataFrame:
    return df.groupBy(*by, F.col(label).alias("label")).agg(F.count("*").alias("n"))


def majority_label(df: DataFrame, label: str) -> DataFrame:
    """The most frequent label (one row); ties go to the smaller label."""
    return label_distribution(df, label).orderBy(F.desc("n"), F.asc("label")).limit(1)


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Balanced weights n / (classes * n_class) per label."""
    counts = label_distribution(df, label)
    totals = counts.agg(F.sum("n").alias("n"), F.count("*").alias("k"))
    return counts.select(
        "label", "n",
        (totals.select("n").scalar() / (totals.select("k").scalar() * F.col("n"))).alias("weight"))


def argmax_label(probabilities: Column, labels: Sequence[str]) -> tuple[Column, Column, Column]:
    """(label, confidence, map of all) from an array of class probabilities."""
    best = F.array_max(probabilities)
    position = F.array_position(probabilities, best)
    names = F.array(*[F.lit(x) for x in labels])
    return F.element_at(names, position.cast("int")), best, F.map_from_arrays(names, probabilities)


def confusion_matrix(
    df: DataFrame, gold: str = "gold_intent", predicted: str = "predicted_intent",
    by: Sequence[str] = (), fill: str = fv.GENERAL_INTENT,
) -> DataFrame:
    """Counts per (gold, predicted), pre-aggregated before the shuffle."""
    return df.groupBy(
        *by, F.col(gold).alias("gold"), F.coalesce(F.col(predicted), F.lit(fill)).alias("predicted")
    ).agg(F.count("*").alias("n"))


def dense_confusion(confusion: DataFrame, labels: Sequence[str]) -> DataFrame:
    return confusion.groupBy("gold").pivot("predicted", list(labels)).agg(F.sum("n")).fillna(0)


def class_scores(confusion: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Per label of the union of gold and predicted: precision, recall, f1, support."""
    sides = confusion.select(
        *by, "gold", "predicted", "n",
        F.explode(F.array_distinct(F.array("gold", "predicted"))).alias("label"))
    n = F.col("n")
    totals = sides.groupBy(*by, "label").agg(
        F.sum(F.when((F.col("gold") == F.col("label")) & (F.col("predicted") == F.col("label")), n)
              .otherwise(0)).alias("tp"),
        F.sum(F.when(F.col("predicted") == F.col("label"), n).otherwise(0)).alias("n_predicted"),
        F.sum(F.when(F.col("gold") == F.col("label"), n).otherwise(0)).alias("support"))
    return totals.select(
        *by, "label", "tp", "support",
        ratio(F.col("tp"), F.col("n_predicted")).alias("precision"),
        ratio(F.col("tp"), F.col("support")).alias("recall"),
        ratio(2.0 * F.col("tp"), F.col("n_predicted") + F.col("support")).alias("f1"))


def classification_metrics(
    df: DataFrame, gold: str = "gold_intent", predicted: str = "predicted_intent",
    by: Sequence[str] = (),
) -> DataFrame:
    """Accuracy, macro precision/recall/f1 and weighted f1, 4 places, optionally per group."""
    scores = class_scores(confusion_matrix(df, gold, predicted, by), by)
    support = F.sum("support")
    out = scores.groupBy(*by).agg(
        ratio(F.sum("tp"), support).alias("accuracy"),
        F.avg("precision").alias("macro_precision"),
        F.avg("recall").alias("macro_recall"),
        F.avg("f1").alias("macro_f1"),
        ratio(F.sum(F.col("f1") * F.col("support")), support).alias("weighted_f1"))
    return round_columns(out, METRICS)


def per_class_report(
    df: DataFrame, labels: Sequence[str] = fv.INTENTS, gold: str = "gold_intent",
    predicted: str = "predicted_intent",
) -> DataFrame:
    """Scores of every taxonomy label; 0 for labels that never occur."""
    taxonomy = df.sparkSession.createDataFrame([(x,) for x in labels], "label string")
    scores = class_scores(confusion_matrix(df, gold, predicted))
    # The taxonomy side decides the rows; both sides hold one row per label.
    out = taxonomy.join(scores, "label", "left").select(
        "label", *[F.coalesce(c, F.lit(0.0)).alias(c) for c in ("precision", "recall", "f1")],
        F.coalesce("support", F.lit(0)).alias("support"))
    return round_columns(out, ["precision", "recall", "f1"])
