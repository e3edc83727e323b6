import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from careweave import fixed_values as fv
from careweave.operators import agreement, classification, trust
from careweave.operators.models import majority_predict
from careweave.operators.reply_evaluation import lexical_means
from careweave.operators.rubric import judge_replies
from careweave.plans import catalog, checks
from careweave.sources import generators


def labels(spark, rows):
    return spark.createDataFrame(rows, "gold_intent string, predicted_intent string")


def test_published_majority_baseline(spark):
    """The majority numbers published for the 200 evaluation items."""
    train = generators.golden_set(spark, 5).withColumn("intent", F.col("gold_intent"))
    predicted = majority_predict(train, generators.golden_set(spark))
    row = classification.classification_metrics(predicted).head()
    assert tuple(row) == (0.155, 0.0194, 0.125, 0.0335, 0.0416)


def test_published_trivial_reply(spark):
    """The trivial reply's published scores that depend on the items alone."""
    df = generators.golden_set(spark).withColumns({
        "generated_reply": F.lit(fv.TRIVIAL_REPLY), "predicted_intent": F.col("gold_intent"),
        "top_response": F.lit(None).cast("string")})
    lexical = lexical_means(df).head()
    assert (lexical["bleu_4"], lexical["rouge_l"]) == (0.6256, 0.5738)
    row = judge_replies(df).agg(*[F.avg(c).alias(c) for c in fv.RUBRIC_SCORES]).head()
    assert (row["relevance"], row["helpfulness"], row["tone"]) == (5.0, 5.0, 5.0)
    assert round(row["safety"], 2) == 4.61 and row["hallucination_risk"] == 1.0


def test_classification_by_hand(spark):
    df = labels(spark, [("a", "a"), ("a", "b"), ("b", "b"), ("b", "c"), ("d", None)])
    row = classification.classification_metrics(df.fillna("z", ["predicted_intent"])).head()
    # a: 1, .5, 2/3; b: .5, .5, .5; c, d, z: 0
    assert row["accuracy"] == 0.4
    assert row["macro_precision"] == round(1.5 / 5, 4) and row["macro_recall"] == round(1 / 5, 4)
    assert row["macro_f1"] == round((2 / 3 + 0.5) / 5, 4)
    assert row["weighted_f1"] == round((2 * 2 / 3 + 2 * 0.5) / 5, 4)
    matrix = classification.confusion_matrix(df)
    assert matrix.where("predicted = 'GENERAL_OTHER'").head()["n"] == 1
    dense = classification.dense_confusion(matrix, ["a", "b"]).orderBy("gold").collect()
    assert [tuple(r) for r in dense][:2] == [("a", 1, 1), ("b", 0, 1)]
    report = {r["label"]: r for r in classification.per_class_report(df, ["a", "x"]).collect()}
    assert report["a"]["f1"] == 0.6667 and report["x"]["f1"] == 0.0 and report["x"]["support"] == 0
    by = classification.classification_metrics(df.withColumn("m", F.lit("k")), by=["m"])
    assert by.columns[0] == "m" and by.count() == 1


def test_label_operators(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), ("c",)], "intent string")
    assert tuple(classification.majority_label(df, "intent").head()) == ("a", 2)
    weights = {r["label"]: r["weight"] for r in classification.class_weights(df, "intent").collect()}
    assert weights == pytest.approx({"a": 5 / 6, "b": 5 / 6, "c": 5 / 3})
    p = majority_predict(df, df, probabilities=True).head()
    assert "all_intent_probabilities" not in majority_predict(df, df).columns
    assert p["predicted_intent"] == "a" and p["all_intent_probabilities"] == {"a": 1.0, "b": 0.0, "c": 0.0}


def test_trust_metrics(spark):
    df = spark.createDataFrame(
        [(True, True), (True, False), (True, False), (False, False), (False, True)],
        "gold_should_escalate boolean, system_auto_handled boolean")
    row = trust.trust_metrics(df).head()
    assert row["unsafe_auto_handle_rate"] == 0.3333 and row["automation_rate"] == 0.4
    assert row["escalation_precision"] == row["escalation_recall"] == row["escalation_f1"] == 0.6667
    assert trust.trust_metrics(df.where("false")).count() == 0
    none = trust.trust_metrics(df.where("not gold_should_escalate")).head()
    assert none["unsafe_auto_handle_rate"] == 0.0 and none["escalation_f1"] == 0.0
    got = {r["outcome"]: r["n"] for r in trust.routing_outcomes(df).collect()}
    assert got == {"correct_auto_handle": 1, "correct_escalation": 2, "unsafe_auto_handle": 1,
                   "unnecessary_escalation": 1}


def test_published_routing_numbers(spark):
    """52 gold escalations, all found, and 28 escalations too many give the published rates."""
    rows = [(True, False)] * 52 + [(False, False)] * 28 + [(False, True)] * 120
    row = trust.trust_metrics(spark.createDataFrame(
        rows, "gold_should_escalate boolean, system_auto_handled boolean")).head()
    assert (row["automation_rate"], row["escalation_precision"], row["escalation_recall"],
            row["escalation_f1"], row["unsafe_auto_handle_rate"]) == (0.6, 0.65, 1.0, 0.7879, 0.0)


def average_rank(x):
    order = np.sort(x)
    return (np.searchsorted(order, x, "left") + 1 + np.searchsorted(order, x, "right")) / 2


def agreement_by_hand(h, j):
    hb, jb = (np.clip(np.round(x), 1, 5).astype(int) for x in (h, j))
    names = sorted(set(hb) | set(jb))
    o = np.zeros((len(names), len(names)))
    for a, b in zip(hb, jb):
        o[names.index(a), names.index(b)] += 1
    e = np.outer(o.sum(1), o.sum(0)) / o.sum()
    w = np.subtract.outer(np.arange(len(names)), np.arange(len(names))) ** 2.0
    kappa = 1 - (w * o).sum() / (w * e).sum() if (w * e).sum() else 0.0

    def corr(a, b):
        return 0.0 if np.ptp(a) == 0 or np.ptp(b) == 0 else float(np.corrcoef(a, b)[0, 1])

    return [corr(average_rank(h), average_rank(j)), kappa, np.mean(hb == jb),
            np.mean(np.abs(hb - jb) <= 1), corr(h, j), np.mean(np.abs(h - j)), len(h)]


@pytest.mark.parametrize("case", ["many", "ties", "gaps", "constant", "identical"])
def test_rater_agreement(spark, case):
    rng = np.random.default_rng(11)
    h, j = {
        "many": lambda: (rng.uniform(1, 5, 1500), rng.uniform(1, 5, 1500)),
        "ties": lambda: (rng.integers(2, 10, 200) / 2, rng.integers(2, 10, 200) / 2),
        "gaps": lambda: (rng.choice([3.0, 5.0], 80), rng.choice([3.0, 5.0], 80)),
        "constant": lambda: (np.full(30, 4.0), rng.uniform(1, 5, 30)),
        "identical": lambda: (np.arange(1, 6.0), np.arange(1, 6.0)),
    }[case]()
    df = spark.createDataFrame(
        [(i, float(a), float(b)) for i, (a, b) in enumerate(zip(h, j))], "id int, human double, judge double")
    got = list(agreement.rater_agreement(df).head())
    assert got == pytest.approx(agreement_by_hand(h, j), abs=6e-5)


def test_agreement_of_few_rows(spark):
    df = spark.createDataFrame([(1, 4.0, 5.0), (2, 3.0, None)], "id int, human double, judge double")
    assert list(agreement.rater_agreement(df).head()) == [0.0] * 6 + [1]
    assert list(agreement.rater_agreement(df.where("false")).head()) == [0.0] * 6 + [0]
    more = df.unionByName(df.withColumn("judge", F.lit(2.0)))
    assert agreement.rater_agreement(more, first_n=2).head()["sample_size"] == 2
    bins = {r["rating"]: (r["human"], r["judge"]) for r in agreement.rating_histogram(df.dropna()).collect()}
    assert bins == {1: (0, 0), 2: (0, 0), 3: (0, 0), 4: (1, 0), 5: (0, 1)}


def test_ranks_of_many_distinct_values(spark):
    """Ranges put together give the ranks of one sort, ties averaged, whatever the number of ranges."""
    rng = np.random.default_rng(7)
    values = {"h": rng.integers(0, 15_000, 40_000) / 7.0, "j": rng.standard_normal(30_000)}
    parts = [spark.createDataFrame([(float(x),) for x in v], "v double").withColumn("side", F.lit(s))
             for s, v in values.items()]
    big = spark.range(1_000_000).select(F.lit("k").alias("side"), (F.col("id") * 7919 % 1_000_003 / 3.0).alias("v"))
    rows = parts[0].unionByName(parts[1]).unionByName(big).groupBy("side", "v").agg(F.count("*").alias("n"))
    ranks = agreement.average_ranks(rows.repartition(7)).cache()
    for side, v in values.items():
        found, counts = np.unique(v, return_counts=True)
        want = np.cumsum(counts) - counts + (counts + 1) / 2
        got = {r["v"]: r["rank"] for r in ranks.where(F.col("side") == side).collect()}
        assert got == dict(zip(found.tolist(), want.tolist()))
    wrong = ranks.where("side = 'k'").selectExpr("v", "rank", "rank() over (partition by side order by v) as r")
    assert wrong.where("rank <> r").isEmpty() and wrong.count() == 1_000_000


def test_quartiles_by_action(spark):
    rng = random.Random(2)
    rows = [(rng.choice("xy"), rng.random()) for _ in range(101)]
    df = spark.createDataFrame(rows, "routing_action string, confidence double")
    for r in trust.confidence_quartiles(df).collect():
        mine = [round(v, 4) for a, v in rows if a == r["action"]]
        assert [r["minimum"], r["q1"], r["median"], r["q3"], r["maximum"]] == pytest.approx(
            list(np.percentile(mine, [0, 25, 50, 75, 100])), abs=6e-5)


def test_every_query_and_check_is_named_alike():
    assert set(checks.oracle_sql()) <= set(catalog.queries())
    without = set(catalog.queries()) - set(checks.oracle_sql())
    assert without == {"tfidf_lr", "embedding_lr", "model_comparison"}


def test_reply_scoring_keeps_its_task_slots(spark):
    """A frame that is dealt by its key already is still scored in more than the few tasks its bytes make."""
    from careweave.operators.reply_evaluation import score_reply_systems

    rows = [(f"p{i}", f"where is parcel {i}", "DELIVERY_STATUS", f"we will look into parcel {i}", "it is on its way", True)
            for i in range(64)]
    names = ["pair_id", "customer_clean_text", "gold_intent", "support_response", "top_response", "has_case"]
    df = spark.createDataFrame(rows, names).groupBy("pair_id").agg(*[F.max(c).alias(c) for c in names[1:]])
    scored = score_reply_systems(df)
    assert scored.count() == 3 * 64
    assert scored.select(F.spark_partition_id().alias("task")).distinct().count() > 1
