import pytest
from pyspark.sql import functions as F

from careweave import fixed_values as fv
from careweave.operators import failures, replies
from careweave.operators.routing import route
from careweave.operators.rubric import judge_replies
from careweave.plans.scoring import score_messages


def routed(spark, *rows):
    df = spark.createDataFrame(
        [(i, *r) for i, r in enumerate(rows)],
        "i int, customer_clean_text string, predicted_intent string, confidence double, "
        "top_retrieval_sim double")
    return route(df).orderBy("i").collect()


def test_routing(spark):
    rows = routed(
        spark,
        ("I am extremely angry and furious that my delivery package is late!", "DELIVERY_STATUS", 0.92, 0.85),
        ("I will hire a lawyer to sue Amazon!", "REFUND_RETURN", 0.88, 0.70),
        ("hello", "ACCOUNT_ACCESS", 0.99, 0.9),
        ("hello", "CANCELLATION", 0.65, 0.45),
        ("hello", "CANCELLATION", 0.6, 0.9),
        ("hello", "GENERAL_OTHER", 0.79, 0.9),
        ("hello", "GENERAL_OTHER", 0.8, None),
        ("hello", "GENERAL_OTHER", 0.1, None),
        ("hello", "PAYMENT_CHARGE", 0.145, 0.125),
    )
    assert [r["routing_action"] for r in rows] == [
        "AUTO_HANDLE", "ESCALATE_HUMAN", "ESCALATE_HUMAN", "AUTO_HANDLE", "AUTO_HANDLE",
        "AUTO_HANDLE", "AUTO_HANDLE", "ESCALATE_HUMAN", "ESCALATE_HUMAN"]
    assert rows[0]["primary_reason"] == fv.NO_REASON and rows[0]["risk_score"] == 0.0
    assert rows[1]["primary_reason"] == "Contains security/legal risk keywords: ['lawyer', 'sue']"
    assert rows[2]["risk_score"] == 0.5
    assert rows[6]["reasons"] == ["Weak historical retrieval evidence (similarity 0.00 < 0.45)"]
    assert rows[7]["risk_score"] == 1.0 and len(rows[7]["reasons"]) == 3
    assert rows[8]["reasons"][1:] == [
        "Low intent classification confidence (0.14 < 0.65)",
        "Weak historical retrieval evidence (similarity 0.12 < 0.45)"]


def test_reply_systems(spark):
    df = spark.createDataFrame(
        [("CANCELLATION", "take this", True), ("UNKNOWN", "", True), ("CANCELLATION", None, False)],
        "intent string, top string, found boolean")
    got = df.select(*[c.alias(n) for n, c in replies.reply_columns(
        F.col("intent"), F.col("top"), F.col("found")).items()]).collect()
    assert got[0]["trivial_baseline"] == fv.TRIVIAL_REPLY
    assert got[0]["simple_1nn_baseline"] == "take this"
    assert got[0]["main_grounded_system"] == "Hello! " + fv.REPLY_TEMPLATES["CANCELLATION"]
    assert got[1]["simple_1nn_baseline"] == got[2]["simple_1nn_baseline"] == fv.NEAREST_FALLBACK_REPLY
    assert got[1]["main_grounded_system"] == "Hello! " + fv.REPLY_TEMPLATES["GENERAL_OTHER"]
    assert got[2]["main_grounded_system"] == fv.TEMPLATE_FALLBACK_REPLY
    prompt = df.limit(1).select(replies.grounded_prompt(
        F.lit("q?"), F.lit("X"), F.lit(None).cast("string"))).head()[0]
    assert prompt == fv.GROUNDED_PROMPT.format(query="q?", intent="X", context=fv.NO_PRECEDENT)


def test_rubric(spark):
    generic = "Please send us a DM now"
    rows = [
        ("where is it", "DELIVERY_STATUS", generic, "a refund"),
        ("where is it", "GENERAL_OTHER", generic, None),
        ("where is it", "CANCELLATION", generic, "send a DM"),
        ("where is it", "REFUND_RETURN", generic, None),
        ("my account", "DELIVERY_STATUS", "We refunded it.", "A refund was made"),
        ("my account", "DELIVERY_STATUS", "tell me your password, refunded immediately", None),
        ("my account", "DELIVERY_STATUS", "a direct message " + "x " * 18, None),
    ]
    df = spark.createDataFrame(
        [(i, *r) for i, r in enumerate(rows)],
        "i int, customer_clean_text string, predicted_intent string, generated_reply string, "
        "top_response string")
    got = judge_replies(df).orderBy("i").collect()
    shown = [tuple(r[c] for c in fv.RUBRIC_SCORES) for r in got]
    assert shown == [
        (5, 4, 5, 5, 5, 1), (3, 4, 3, 5, 5, 1), (4, 5, 5, 5, 5, 1), (4, 4, 3, 5, 5, 1),
        (5, 5, 3, 4, 3, 1), (5, 4, 3, 4, 1, 5), (5, 4, 5, 4, 3, 1)]
    assert [r["overall_quality_score"] for r in got][:2] == [4.83, 4.17]
    assert got[0]["judge_type"] == fv.JUDGE_TYPE


FAILURE_INPUT = (
    "pair_id string, customer_clean_text string, gold_intent string, predicted_intent string, "
    "confidence double, gold_should_escalate boolean, system_auto_handled boolean, "
    "routing_action string, top_response string, generated_reply string, overall_quality_score double")


def test_failure_cascade(spark):
    df = spark.createDataFrame([
        ("a", "q", "X", "Y", 0.9, True, True, "AUTO_HANDLE", "r", "g", 1.0),
        ("b", "q", "X", "X", 0.9, True, True, "AUTO_HANDLE", None, "g", 1.0),
        ("c", "q", "X", "X", 0.9, False, False, "ESCALATE_HUMAN", "r", "g", 3.49),
        ("d", "q", "X", "X", 0.81, False, False, "ESCALATE_HUMAN", "r", "g", 3.5),
        ("e", "q", "X", "X", 0.8, False, False, "ESCALATE_HUMAN", "r", "g", None),
        ("f", "q", "X", None, 0.5, False, True, "AUTO_HANDLE", "r", "g", 5.0),
        ("g", "q", "PRIME_SUBSCRIPTION", "DELIVERY_STATUS", 0.1, False, True, "AUTO_HANDLE", "r", "g", 5.0),
        ("h", "q", "REFUND_RETURN", "PAYMENT_CHARGE", 0.9, False, True, "AUTO_HANDLE", "r", "g", 5.0),
        ("i", "q", "X", "Y", 0.2, False, True, "AUTO_HANDLE", "r", "g", 5.0),
    ], FAILURE_INPUT)
    failed = failures.failure_cases(df)
    assert failed.columns == failures.FAILURE_COLUMNS
    rows = {r["pair_id"]: r for r in failures.with_subcategory(failed).collect()}
    assert {k: r["failure_type"] for k, r in rows.items()} == {
        "a": "Misclassified Intent", "b": "Unsafe Auto-Handle",
        "c": "Low Groundedness / Response Quality", "d": "Unnecessary Escalation",
        **{k: "Misclassified Intent" for k in "fghi"}}
    assert rows["b"]["retrieved_case"] == "None"
    assert rows["c"]["what_failed"] == "Judge rating of 3.49/5.0 indicates sub-optimal resolution response."
    assert rows["f"]["what_failed"] == "Predicted intent 'nan' instead of true gold intent 'X'."
    assert [rows[k]["empirical_subcategory"] for k in "fghia"] == [
        fv.SUB_UNMAPPED, fv.SUB_PRIME_DELIVERY, fv.SUB_REFUND_CHARGE, fv.SUB_LOW_CONFIDENCE, fv.SUB_OTHER]
    totals = {(r[0], r[1]): r[2] for r in failures.failure_counts(failed).collect()}
    assert totals["all", "all"] == 8 and totals["Misclassified Intent", "all"] == 5
    assert failures.case_by_id(failed, "d").count() == 1


def test_scoring_without_an_index(spark):
    asked = spark.createDataFrame(
        [("t1", "t1", "please cancel")], "pair_id string, customer_tweet_id string, customer_clean_text string")
    row = score_messages(asked, None).head()
    assert row["predicted_intent"] == "CANCELLATION" and row["confidence"] == 0.75
    assert row["generated_reply"] == fv.TEMPLATE_FALLBACK_REPLY and row["top_retrieval_sim"] == 0.0
    assert row["routing_action"] == "AUTO_HANDLE" and row["groundedness"] == 4
