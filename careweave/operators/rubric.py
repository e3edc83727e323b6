"""Rule-based reply scores: six dimensions and their composite."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from careweave import fixed_values as fv
from careweave.functions import text as tx
from careweave.functions.numbers import py_round


def judge_replies(
    df: DataFrame, *, query: str = "customer_clean_text", intent: str = "predicted_intent",
    reply: str = "generated_reply", top_response: str = "top_response",
) -> DataFrame:
    """Add the six scores, ``overall_quality_score`` and ``judge_type``.

    ``top_response`` is the answer of the best case; null where nothing was retrieved.
    """
    q, label, answer, precedent = (F.col(c) for c in (query, intent, reply, top_response))
    generic = tx.contains_any(answer, fv.GENERIC_PHRASES) & (
        tx.token_count(answer) <= fv.GENERIC_MAX_TOKENS)
    df = df.withColumn("_generic", generic)
    g = F.col("_generic")
    vague = g & label.isin(fv.VAGUE_INTENTS)
    shared = F.lit(False)
    for word in fv.GROUNDING_WORDS:
        shared = shared | (tx.contains_any(precedent, [word]) & tx.contains_any(answer, [word]))
    df = df.withColumns({
        "relevance": F.when(vague, 3).when(
            g & label.isin(fv.SPECIFIC_RELEVANCE_INTENTS), 4).otherwise(5),
        "groundedness": F.when(shared, 5).otherwise(4),
        "helpfulness": F.when(vague | (g & label.isin(fv.SPECIFIC_HELP_INTENTS)), 3).when(
            tx.contains_any(answer, fv.HELP_WORDS), 5).otherwise(3),
        "tone": F.when(tx.contains_any(answer, fv.POLITE_WORDS), 5).otherwise(4),
        "safety": F.when(tx.contains_any(answer, fv.UNSAFE_WORDS), 1).when(
            ~g & tx.contains_any(q, fv.PRIVATE_QUERY_WORDS), 3).otherwise(5),
        "hallucination_risk": F.when(tx.contains_any(answer, fv.PROMISE_PHRASES), 5).otherwise(1),
    }).drop("_generic")
    total = sum((F.col(c) for c in fv.RUBRIC_SCORES[:-1]), 6 - F.col("hallucination_risk"))
    return df.withColumn("_total", total).withColumns({
        "overall_quality_score": py_round("_total / 6D", 2),
        "judge_type": F.lit(fv.JUDGE_TYPE),
    }).drop("_total")
