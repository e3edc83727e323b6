"""Lexical scores and the comparison of reply systems under one rubric."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from careweave import fixed_values as fv
from careweave.functions import lexical, text as tx
from careweave.functions.numbers import ratio, round_columns
from careweave.operators.replies import long_replies, reply_columns
from careweave.operators.rubric import judge_replies
from careweave.session import task_slots

_MEANS = ["overall_quality_score", *fv.RUBRIC_SCORES, "secondary_bleu_4", "secondary_rouge_l"]


def _with_tokens(df: DataFrame, reference: str, generated: str) -> DataFrame:
    return df.withColumns({"_ref": tx.tokens(F.lower(F.col(reference))),
                           "_gen": tx.tokens(F.lower(F.col(generated)))})


def unigram_scores(
    df: DataFrame, reference: str = "support_response", generated: str = "generated_reply"
) -> DataFrame:
    """Add ``bleu_4`` (unigram overlap) per row."""
    return _with_tokens(df, reference, generated).withColumn(
        "bleu_4", lexical.unigram_overlap(F.col("_ref"), F.col("_gen"))).drop("_ref", "_gen")


def lexical_scores(
    df: DataFrame, reference: str = "support_response", generated: str = "generated_reply"
) -> DataFrame:
    """Add ``bleu_4`` (unigram overlap) and ``rouge_l`` per row."""
    out = _with_tokens(df, reference, generated).withColumns({
        "bleu_4": lexical.unigram_overlap(F.col("_ref"), F.col("_gen")),
        "_lcs": lexical.lcs_length(F.col("_ref"), F.col("_gen"))})
    return out.withColumn("rouge_l", lexical.rouge_l_from(
        F.col("_lcs"), F.size("_ref"), F.size("_gen"))).drop("_ref", "_gen", "_lcs")


def lexical_means(
    df: DataFrame, reference: str = "support_response", generated: str = "generated_reply"
) -> DataFrame:
    """Corpus means of both scores; 0 without rows."""
    scored = lexical_scores(df.select(reference, generated), reference, generated)
    return round_columns(scored.agg(
        F.coalesce(F.avg("bleu_4"), F.lit(0.0)).alias("bleu_4"),
        F.coalesce(F.avg("rouge_l"), F.lit(0.0)).alias("rouge_l")), ["bleu_4", "rouge_l"])


def score_reply_systems(
    df: DataFrame, *, key: str = "pair_id", query: str = "customer_clean_text",
    intent: str = "gold_intent", reference: str = "support_response",
    top_response: str = "top_response", has_case: str = "has_case",
) -> DataFrame:
    """One scored row per (query, reply system)."""
    keep = [key, query, intent, reference, top_response, has_case]
    replies = reply_columns(F.col(intent), F.col(top_response), F.col(has_case))
    # Spread the rows: everything after this is CPU work per row. By a hash of the key: a frame that
    # is dealt by the key already would stay in the few tasks that its bytes make.
    wide = df.select(*keep).repartition(task_slots(df.sparkSession), F.xxhash64(key)).withColumns(replies)
    judged = judge_replies(
        long_replies(wide, keep), query=query, intent=intent, top_response=top_response)
    return lexical_scores(judged, reference)


def compare_reply_systems(scored: DataFrame) -> DataFrame:
    """Mean of all scores per system, 4 places (scores are summed exactly, then divided)."""
    n = F.count("*")
    out = scored.groupBy("system").agg(
        ratio(F.sum(F.col("overall_quality_score").cast("decimal(4,2)")), n)
        .alias("overall_quality_score"),
        *[ratio(F.sum(c), n).alias(c) for c in fv.RUBRIC_SCORES],
        F.avg("bleu_4").alias("secondary_bleu_4"), F.avg("rouge_l").alias("secondary_rouge_l"),
        n.alias("n"))
    return round_columns(out, _MEANS)


def unpivot_scores(comparison: DataFrame, dimensions: list[str] | None = None) -> DataFrame:
    """(system, dimension, score) rows of a comparison table."""
    dimensions = dimensions or fv.RUBRIC_SCORES[:-1]
    return comparison.select(
        "system", *[F.col(d).cast("double").alias(d) for d in dimensions]
    ).unpivot(["system"], dimensions, "dimension", "score")
