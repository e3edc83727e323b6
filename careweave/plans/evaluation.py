"""The full evaluation: train, retrieve, score, compare, and write the result tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from careweave import fixed_values as fv
from careweave.operators import agreement, classification, failures, models, retrieval, trust
from careweave.operators.curation import resolve_label
from careweave.operators.leakage import exclude_golden
from careweave.operators.reply_evaluation import compare_reply_systems, score_reply_systems
from careweave.operators.summary import long_metrics, union_all
from careweave.plans.scoring import attach_cases, score_messages, with_case_texts
from careweave.session import materialize
from careweave.sources import store
from careweave.sources.generators import golden_set

TRUST_METRICS = [
    "unsafe_auto_handle_rate", "automation_rate", "escalation_precision", "escalation_recall",
    "escalation_f1", "total_evaluated", "gold_escalations_total", "unsafe_auto_handles_count",
]
REPLY_METRICS = ["overall_quality_score", *fv.RUBRIC_SCORES, "secondary_bleu_4", "secondary_rouge_l"]
DATASET_METRICS = [
    "total_tweets_inspected", "customer_messages", "brand_replies", "usable_customer_support_pairs",
    "approximate_thread_count", "support_reply_ratio",
]


@dataclass
class Evaluation:
    predictions: DataFrame
    failures: DataFrame
    metrics: DataFrame


def training_fallback(train: DataFrame, golden: DataFrame) -> DataFrame:
    """For fewer than 10 training pairs: written items that are not golden, else one row per intent."""
    spark = train.sparkSession
    if train.limit(fv.MIN_TRAIN_ROWS).count() >= fv.MIN_TRAIN_ROWS:
        return train
    written = exclude_golden(golden_set(spark, len(fv.GOLDEN_LITERALS)), golden)
    if not written.isEmpty():
        return written
    return spark.createDataFrame([
        (f"sample_{i}", f"tw_sample_{i}", f"supp_sample_{i}",
         fv.SAMPLE_QUESTION.format(intent=intent, i=i), fv.SAMPLE_ANSWER.format(intent=intent), intent)
        for i, intent in enumerate(fv.INTENTS)
    ], "pair_id string, customer_tweet_id string, support_tweet_id string, "
       "customer_clean_text string, support_response string, intent string")


def training_rows(pairs: DataFrame, golden: DataFrame, *, fallback: bool = False) -> DataFrame:
    """Leak-free, labelled training pairs; with ``fallback`` written ones where they are few."""
    train = exclude_golden(pairs, golden)
    if fallback:
        train = training_fallback(train, golden)
    for column in ("customer_tweet_id", "support_tweet_id"):
        if column not in train.columns:
            train = train.withColumn(column, F.lit(""))
    return resolve_label(train)


def evaluate(pairs: DataFrame, golden: DataFrame, *, stop_words: tuple[str, ...] | None = None,
             max_iter: int = 100, vector: str | None = None, first_n: int | None = None,
             fallback: bool = False, statistics: DataFrame | None = None) -> Evaluation:
    """Run every evaluation step; training and retrieval never see a golden text.

    ``vector`` names an embedding column of both frames and adds the model over it. Agreement
    covers all rated rows, or the ``first_n`` of them. The document tells how many pairs there
    are for training and evaluation, and with ``statistics`` (``brand_statistics``) what they
    were made from.
    """
    from pyspark.ml.feature import StopWordsRemover

    stop = tuple(stop_words) if stop_words is not None else tuple(
        StopWordsRemover.loadDefaultStopWords("english"))
    train = materialize(training_rows(pairs, golden, fallback=fallback))
    tfidf = models.fit_tfidf(train, max_iter=max_iter, stop_words=stop)
    labelled = materialize(tfidf.predict(golden).drop("all_intent_probabilities"))

    index, terms = retrieval.build_text_index(train, stop_words=stop)
    index = materialize(index)
    cases = materialize(retrieval.retrieve(
        golden, index, terms, query_key="pair_id", query_text="customer_clean_text",
        query_id="customer_tweet_id"))
    predictions = materialize(score_messages(labelled, index, terms, cases=cases))

    compared = attach_cases(golden, with_case_texts(cases, index), "pair_id")
    systems = compare_reply_systems(score_reply_systems(compared))
    rated = predictions.select(
        F.col("pair_id").alias("id"),
        F.coalesce("human_quality_rating", F.lit(fv.DEFAULT_HUMAN_RATING)).alias("human"),
        F.col("overall_quality_score").alias("judge"))
    failed = failures.failure_cases(predictions)
    by_name = {"baseline_0_majority": models.majority_predict(train, golden),
               "baseline_1_tfidf": labelled}
    if vector is not None:
        by_name["main_model_embedding"] = models.fit_embedding(
            train, vector, max_iter=max_iter).predict(golden)
    by_model = models.compare_models(by_name)
    sizes = [long_metrics(df.agg(F.count("*").alias(name)), "dataset_info", [name])
             for name, df in (("training_pairs", train), ("golden_items", golden))]
    if statistics is not None:
        sizes.append(long_metrics(statistics, "dataset_info", DATASET_METRICS))
    metrics = union_all([
        *sizes,
        long_metrics(by_model, "intent_classification", classification.METRICS, "model"),
        long_metrics(trust.trust_metrics(predictions), "escalation_routing_trust", TRUST_METRICS),
        long_metrics(systems, "reply_generation_systems", REPLY_METRICS, "system"),
        long_metrics(agreement.rater_agreement(rated, first_n=first_n),
                     "human_vs_judge_agreement", [*agreement.MEASURES, "sample_size"]),
        long_metrics(failed.agg(F.count("*").alias("total_failures_identified")),
                     "failure_analysis_summary", ["total_failures_identified"]),
    ])
    return Evaluation(predictions, failed, metrics)


def write_evaluation(result: Evaluation, folder: str) -> None:
    store.write_predictions(result.predictions, f"{folder}/predictions")
    store.write_failures(result.failures, f"{folder}/failures")
    store.write_metrics(result.metrics, f"{folder}/results")
