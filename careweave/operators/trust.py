"""How safe the automation is, and what it decides."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from careweave.functions.numbers import ratio, round_columns

_RATES = ["unsafe_auto_handle_rate", "automation_rate", "escalation_share", "escalation_precision",
          "escalation_recall", "escalation_f1"]


def trust_metrics(
    df: DataFrame, gold: str = "gold_should_escalate", auto: str = "system_auto_handled"
) -> DataFrame:
    """Unsafe and automation rates, escalation precision/recall/f1, counts; empty for no rows."""
    g, a = F.col(gold), F.col(auto)
    counts = df.agg(
        F.count("*").alias("total_evaluated"),
        F.count_if(g).alias("gold_escalations_total"),
        F.count_if(g & a).alias("unsafe_auto_handles_count"),
        F.count_if(a).alias("_auto"),
        F.count_if(g & ~a).alias("_hit"),
        F.count_if(~a).alias("_escalated"),
    ).where("total_evaluated > 0")
    hit, total, n_gold = F.col("_hit"), F.col("total_evaluated"), F.col("gold_escalations_total")
    out = counts.withColumns({
        "unsafe_auto_handle_rate": F.col("unsafe_auto_handles_count") / F.greatest(F.lit(1), n_gold),
        "automation_rate": F.col("_auto") / total,
        "escalation_share": F.col("_escalated") / total,
        "escalation_precision": ratio(hit, F.col("_escalated")),
        "escalation_recall": ratio(hit, n_gold),
        "escalation_f1": ratio(2 * hit, F.col("_escalated") + n_gold),
    }).drop("_auto", "_hit", "_escalated")
    return round_columns(out, _RATES).select(
        *_RATES, "total_evaluated", "gold_escalations_total", "unsafe_auto_handles_count")


def routing_outcomes(
    df: DataFrame, gold: str = "gold_should_escalate", auto: str = "system_auto_handled"
) -> DataFrame:
    """Counts of the four outcomes; an outcome without rows is 0."""
    g, a = F.col(gold), F.col(auto)
    counts = df.agg(
        F.count_if(~g & a).alias("correct_auto_handle"),
        F.count_if(g & ~a).alias("correct_escalation"),
        F.count_if(g & a).alias("unsafe_auto_handle"),
        F.count_if(~g & ~a).alias("unnecessary_escalation"))
    return counts.unpivot([], counts.columns, "outcome", "n")


def confidence_quartiles(
    df: DataFrame, value: str = "confidence", action: str = "routing_action"
) -> DataFrame:
    """Box statistics of the (4-place) confidence per action, from its histogram.

    Rounded confidences take at most 10,001 values, so the counts that meet in one group are few.
    """
    histogram = round_columns(df.select(F.col(action).alias("action"), F.col(value).alias("v")),
                              ["v"]).groupBy("action", "v").agg(F.count("*").alias("n"))
    points = {"q1": 0.25, "median": 0.5, "q3": 0.75}
    out = histogram.groupBy("action").agg(
        F.sum("n").alias("n"), F.min("v").alias("minimum"), F.max("v").alias("maximum"),
        *[F.percentile("v", p, F.col("n")).alias(name) for name, p in points.items()])
    return round_columns(out, list(points))
