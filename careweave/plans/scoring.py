"""Scoring a whole message table: classify, retrieve, route, reply, judge, as one plan."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from careweave import fixed_values as fv
from careweave.operators import models, retrieval
from careweave.operators.replies import template_reply
from careweave.operators.routing import route
from careweave.operators.rubric import judge_replies


def with_case_texts(cases: DataFrame, index: DataFrame, case_key: str = "pair_id") -> DataFrame:
    """Retrieved cases with the texts of the case."""
    texts = index.select(
        F.col(case_key).alias("case_id"),
        F.col("customer_clean_text").alias("case_text"),
        F.col("support_response").alias("case_response"))
    return cases.join(texts, "case_id")


def collect_cases(cases: DataFrame) -> DataFrame:
    """One row per query with its (at most k) cases, best first."""
    case = F.struct("rank", "case_id", "similarity_score", "case_text", "case_response")
    return cases.groupBy("query_id").agg(
        F.array_sort(F.collect_list(case)).alias("retrieved_cases"))


def attach_cases(queries: DataFrame, cases: DataFrame, query_key: str) -> DataFrame:
    """Queries with retrieved_cases, top_response, top_retrieval_sim and has_case."""
    found = collect_cases(cases)
    top = F.element_at("retrieved_cases", 1)
    return (
        queries.join(found, F.col(query_key) == F.col("query_id"), "left")
        .drop("query_id")
        .withColumns({
            "top_response": top["case_response"],
            "top_retrieval_sim": F.coalesce(top["similarity_score"], F.lit(0.0)),
            "has_case": F.col("retrieved_cases").isNotNull(),
        })
    )


def score_messages(
    queries: DataFrame, index: DataFrame | None, terms: DataFrame | None = None, *,
    query_key: str = "pair_id", query_id: str = "customer_tweet_id",
    text: str = "customer_clean_text", case_key: str = "pair_id", k: int = fv.TOP_K,
    cases: DataFrame | None = None, search: retrieval.TextIndex | None = None,
    rules: Mapping[str, Sequence[str]] = fv.KEYWORD_RULES, **routing,
) -> DataFrame:
    """Every query with its label, cases, routing decision, reply and reply scores.

    Labels already on the frame (``predicted_intent``, ``confidence``) are used as they are;
    otherwise the keyword rules decide. ``cases`` takes retrieval results computed before,
    ``search`` the search tables of the index.
    Without an index no case is found, as with an empty one.
    """
    if cases is None:
        cases = retrieval.empty_cases(queries.sparkSession) if index is None else (
            retrieval.retrieve(queries, index, terms, query_key=query_key, query_text=text,
                               query_id=query_id, case_key=case_key, k=k, search=search))
    labelled = queries if "predicted_intent" in queries.columns else (
        models.rule_predict(queries, text, rules))
    texts = with_case_texts(cases, index, case_key) if index is not None else (
        cases.withColumns({"case_text": F.lit(""), "case_response": F.lit("")}))
    df = attach_cases(labelled, texts, query_key)
    df = route(df, query=text, **routing)
    df = df.withColumns({
        "system_auto_handled": F.col("routing_action") == fv.ACTION_AUTO,
        "generated_reply": template_reply(F.col("predicted_intent"), F.col("has_case")),
    })
    return judge_replies(df, query=text)
