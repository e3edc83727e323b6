"""Auto-handle or escalate: additive risk signals with readable reasons."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from careweave import fixed_values as fv
from careweave.functions import text as tx
from careweave.functions.numbers import fixed_text, py_round

SEPARATOR = "; "


def _plain(number: float) -> str:
    return str(float(number))


def _signals(
    query: Column, intent: Column, confidence_name: str, sim_name: str, *,
    risk_keywords: Sequence[str], whole_word: bool, sensitive_intents: Sequence[str],
    general_intent: str, min_confidence: float, min_sim: float, general_min_confidence: float,
) -> list[tuple[Column, str, Column]]:
    """(fires, weight name, reason text) per signal, in reporting order."""
    confidence, top_sim, texts = F.col(confidence_name), F.col(sim_name), fv.REASON_FORMATS
    hits = tx.keyword_hits(query, risk_keywords, whole_word=whole_word)
    listed = F.concat(F.lit("['"), F.array_join(hits, "', '"), F.lit("']"))
    return [
        (tx.contains_any(query, risk_keywords, whole_word=whole_word), "keywords",
         F.format_string(texts["keywords"], listed)),
        (intent.isin(list(sensitive_intents)), "sensitive",
         F.format_string(texts["sensitive"], intent)),
        (confidence < min_confidence, "confidence",
         F.format_string(texts["confidence"], fixed_text(confidence_name, 2),
                         F.lit(_plain(min_confidence)))),
        (top_sim < min_sim, "evidence",
         F.format_string(texts["evidence"], fixed_text(sim_name, 2), F.lit(_plain(min_sim)))),
        ((intent == general_intent) & (confidence < general_min_confidence), "general",
         F.lit(texts["general"])),
    ]


def route(
    df: DataFrame, *, query: str = "customer_clean_text", intent: str = "predicted_intent",
    confidence: str = "confidence", top_sim: str = "top_retrieval_sim",
    risk_keywords: Sequence[str] = fv.RISK_KEYWORDS, whole_word: bool = False,
    sensitive_intents: Sequence[str] = fv.SENSITIVE_INTENTS, general_intent: str = fv.GENERAL_INTENT,
    min_confidence: float = fv.MIN_CONFIDENCE, min_sim: float = fv.MIN_RETRIEVAL_SIM,
    general_min_confidence: float = fv.GENERAL_MIN_CONFIDENCE,
) -> DataFrame:
    """Add routing_action, should_escalate, risk_score, reasons, primary_reason.

    Thresholds compare the unrounded confidence; a missing similarity counts as 0.
    """
    df = df.withColumn(top_sim, F.coalesce(F.col(top_sim), F.lit(0.0)))
    signals = _signals(
        F.col(query), F.col(intent), confidence, top_sim,
        risk_keywords=risk_keywords, whole_word=whole_word, sensitive_intents=sensitive_intents,
        general_intent=general_intent, min_confidence=min_confidence, min_sim=min_sim,
        general_min_confidence=general_min_confidence)
    flags = [f"_signal_{name}" for _, name, _ in signals]
    df = df.withColumns({
        flag: F.coalesce(fires, F.lit(False)) for flag, (fires, _, _) in zip(flags, signals)})
    # Weights are tenths; summing whole tenths keeps the score free of float noise.
    tenths = sum(
        (F.when(F.col(flag), F.lit(round(fv.RISK_WEIGHTS[name] * 10))).otherwise(F.lit(0))
         for flag, (_, name, _) in zip(flags, signals)), F.lit(0))
    df = df.withColumns({
        "_tenths": tenths,
        "reasons": F.array_compact(F.array(*[
            F.when(F.col(flag), text) for flag, (_, _, text) in zip(flags, signals)])),
    })
    escalate = (
        (F.col("_tenths") >= round(fv.ESCALATE_RISK * 10))
        | (F.size("reasons") >= 2) | F.col("_signal_keywords"))
    return df.withColumns({
        "should_escalate": escalate,
        "routing_action": F.when(escalate, F.lit(fv.ACTION_ESCALATE)).otherwise(F.lit(fv.ACTION_AUTO)),
        "risk_score": F.least(F.lit(10), F.col("_tenths")) / 10.0,
        "primary_reason": F.when(F.size("reasons") == 0, F.lit(fv.NO_REASON)).otherwise(
            F.array_join("reasons", SEPARATOR)),
        "routing_confidence": py_round(confidence, 4),
    }).drop(*flags, "_tenths")
