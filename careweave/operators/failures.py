"""Which predictions failed, how, and why."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from careweave import fixed_values as fv
from careweave.functions import text as tx
from careweave.functions.numbers import py_round, shortest_text

FAILURE_COLUMNS = [
    "pair_id", "customer_message", "gold_intent", "predicted_intent", "confidence",
    "routing_decision", "retrieved_case", "generated_reply", "failure_type", "what_failed",
    "likely_cause", "potential_improvement",
]


def failure_cases(predictions: DataFrame) -> DataFrame:
    """Failing predictions with type, description, cause and improvement; first rule wins."""
    gold, predicted = F.col("gold_intent"), F.col("predicted_intent")
    overall = F.coalesce("overall_quality_score", F.lit(fv.DEFAULT_OVERALL))
    wrong, unsafe, low, overcautious = fv.FAILURE_TEXTS
    auto = F.col("system_auto_handled")
    kind = (
        F.when(~gold.eqNullSafe(predicted), wrong)
        .when(F.col("gold_should_escalate") & auto, unsafe)
        .when(overall < fv.LOW_OVERALL, low)
        .when(~F.col("gold_should_escalate") & ~auto
              & (F.col("confidence") > fv.OVERCAUTIOUS_CONFIDENCE), overcautious))
    shown = F.coalesce(predicted, F.lit("nan"))
    described = (
        F.when(F.col("failure_type") == wrong, F.format_string(
            fv.WHAT_FAILED_FORMATS[wrong], shown, gold))
        .when(F.col("failure_type") == unsafe, F.lit(fv.WHAT_FAILED_FORMATS[unsafe]))
        .when(F.col("failure_type") == low, F.format_string(
            fv.WHAT_FAILED_FORMATS[low], shortest_text(overall)))
        .otherwise(F.lit(fv.WHAT_FAILED_FORMATS[overcautious])))
    failing = tx.computed_once(predictions, failure_type=kind).where("failure_type is not null")
    return failing.select(
        "pair_id", F.col("customer_clean_text").alias("customer_message"), "gold_intent",
        "predicted_intent", py_round("confidence", 4).alias("confidence"),
        F.col("routing_action").alias("routing_decision"),
        F.coalesce("top_response", F.lit(fv.NO_CASE_TEXT)).alias("retrieved_case"),
        "generated_reply", "failure_type", described.alias("what_failed"),
        tx.mapped(F.col("failure_type"), {k: v[0] for k, v in fv.FAILURE_TEXTS.items()}, "")
        .alias("likely_cause"),
        tx.mapped(F.col("failure_type"), {k: v[1] for k, v in fv.FAILURE_TEXTS.items()}, "")
        .alias("potential_improvement"),
    )


def subcategory(gold: Column, predicted: Column, confidence: Column) -> Column:
    bare = tx.strip(F.coalesce(predicted, F.lit("")))
    return (
        F.when(bare.isin("", "nan"), fv.SUB_UNMAPPED)
        .when((gold == "PRIME_SUBSCRIPTION") & (bare == "DELIVERY_STATUS"), fv.SUB_PRIME_DELIVERY)
        .when((gold == "REFUND_RETURN") & (bare == "PAYMENT_CHARGE"), fv.SUB_REFUND_CHARGE)
        .when(confidence < fv.SUB_CONFIDENCE, fv.SUB_LOW_CONFIDENCE)
        .otherwise(fv.SUB_OTHER))


def with_subcategory(failures: DataFrame) -> DataFrame:
    return failures.withColumn("empirical_subcategory", subcategory(
        F.col("gold_intent"), F.col("predicted_intent"), F.coalesce("confidence", F.lit(0.0))))


def failure_counts(failures: DataFrame) -> DataFrame:
    """Counts by type and sub-category with subtotals; the word ``all`` marks a total."""
    counted = with_subcategory(failures).rollup("failure_type", "empirical_subcategory").agg(
        F.count("*").alias("n"))
    return counted.select(
        F.coalesce("failure_type", F.lit("all")).alias("failure_type"),
        F.coalesce("empirical_subcategory", F.lit("all")).alias("empirical_subcategory"), "n")


def case_by_id(failures: DataFrame, pair_id: str) -> DataFrame:
    return failures.where(F.col("pair_id") == pair_id)


def cases_by_id(failures: DataFrame, ids: DataFrame) -> DataFrame:
    """The cases of many ids at once (column ``pair_id``, each once)."""
    return failures.join(ids, "pair_id", "left_semi")
