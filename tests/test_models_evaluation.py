import json
import pathlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from careweave import fixed_values as fv
from careweave.operators import features, models
from careweave.operators.leakage import leaked_golden
from careweave.operators.summary import long_metrics
from careweave.plans import evaluation
from careweave.sources import generators, store

TRAIN = [
    ("where is my delivery package", "DELIVERY_STATUS"),
    ("cancel my order immediately", "CANCELLATION"),
    ("want a refund for return", "REFUND_RETURN"),
]


@pytest.fixture(scope="module")
def train(spark):
    return spark.createDataFrame(TRAIN, "customer_clean_text string, intent string")


def test_tfidf_model(spark, train, tmp_path):
    fitted = models.fit_tfidf(train, max_iter=20)
    asked = spark.createDataFrame(
        [("cancel my subscription order",), ("package delivery status",)], "customer_clean_text string")
    rows = fitted.predict(asked).collect()
    assert [r["predicted_intent"] for r in rows] == ["CANCELLATION", "DELIVERY_STATUS"]
    for r in rows:
        assert 0 <= r["confidence"] <= 1 and sum(r["all_intent_probabilities"].values()) == pytest.approx(1)
        assert r["confidence"] == max(r["all_intent_probabilities"].values())
    fitted.save(str(tmp_path / "model"))
    again = models.FittedClassifier.load(str(tmp_path / "model")).predict(asked).collect()
    assert again == rows


def test_embedding_model(spark, tmp_path):
    df = spark.createDataFrame(
        [(i, [float(i % 3 == j) for j in range(3)], "abc"[i % 3], f"f{i}", i / 2) for i in range(12)],
        "id int, v array<float>, intent string, features string, probability double")
    fitted = models.fit_embedding(df, "v", max_iter=20)
    rows = fitted.predict(df).orderBy("id").collect()
    assert all(r["predicted_intent"] == r["intent"] for r in rows)
    # A caller's columns pass through, whatever their names.
    assert [(r["features"], r["probability"]) for r in rows] == [(f"f{i}", i / 2) for i in range(12)]
    fitted.save(str(tmp_path / "model"))
    again = models.FittedClassifier.load(str(tmp_path / "model"))
    assert again.labels == ["a", "b", "c"] and again.predict(df).orderBy("id").collect() == rows
    asked = df.select("id", "v").where("id < 3")
    assert [r["predicted_intent"] for r in again.predict(asked).orderBy("id").collect()] == ["a", "b", "c"]


def test_ngram_vocabulary(spark):
    df = spark.createDataFrame([("bb aa the bb",), ("aa bb",), ("",), (None,)], "text string")
    rows = features.vocabulary(df, "text", stop_words=("the",), ngrams=2).collect()
    assert [(r["term"], r["df"], r["total"]) for r in rows] == [
        ("bb", 2, 3), ("aa", 2, 2), ("aa bb", 2, 2), ("bb aa", 1, 1)]
    assert models.fit_tfidf(spark.createDataFrame(TRAIN, "t string, intent string"), "t", max_features=3,
                            max_iter=2).pipeline.stages[4].vocabulary == ["cancel", "cancel order", "delivery"]


def _shuffled_rows(plan):
    """Rows that the exchanges of an executed plan wrote."""
    kind = plan.getClass().getSimpleName()
    if kind == "AdaptiveSparkPlanExec":
        return _shuffled_rows(plan.executedPlan())
    if kind.endswith("QueryStageExec"):
        return _shuffled_rows(plan.plan())
    own = plan.metrics().apply("shuffleRecordsWritten").value() if kind == "ShuffleExchangeExec" else 0
    return own + sum(_shuffled_rows(plan.children().apply(i)) for i in range(plan.children().size()))


def test_ngram_vocabulary_counts_pairs_of_frequent_words_only(spark):
    # Every text has words that occur nowhere else, hence pairs that occur nowhere else.
    texts = [f"w{i % 7} w{i % 5} the x{i}a x{i}b w{i % 3}" for i in range(2000)]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    found = features.vocabulary(df, "text", stop_words=("the",), max_features=6, ngrams=2)
    assert _rows(found) == _plain_ngrams(texts, ("the",), 6)
    assert _shuffled_rows(found._jdf.queryExecution().executedPlan()) < 500  # of over 10,000 pairs


def _rows(found):
    return [(r["term"], r["df"], r["total"]) for r in found.collect()]


def _plain_ngrams(texts, stop, k):
    total, documents = Counter(), Counter()
    for text in texts:
        words = [w for w in (text or "").lower().split() if len(w) > 1 and w not in stop]
        terms = words + [f"{a} {b}" for a, b in zip(words, words[1:])]
        total.update(terms)
        documents.update(set(terms))
    return [(t, documents[t], n) for t, n in sorted(total.items(), key=lambda x: (-x[1], x[0].encode()))[:k]]


def test_ngram_vocabulary_equals_plain_count(spark):
    texts = ["b1 a1 the b1 a1", "B1 the a1 ÄÖ", None, "", "the", "a", "a1 z9 a1 z9 ÄÖ z8", "y1 y2 y3 y4 y5 y6"] * 2
    df = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    # Also where words tie at the last place (one, two or all), and where there are fewer than asked for.
    for k in (0, 1, 2, 3, 4, 5, 6, 9, 100):
        for stop in ((), ("the",)):
            assert _rows(features.vocabulary(
                df, "text", stop_words=stop, max_features=k, ngrams=2)) == _plain_ngrams(texts, stop, k)
    # The second word of the pair in place ties with words in front of it.
    texts = ["aa zz", "aa zz", "bb", "bb", "aa"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    assert _rows(features.vocabulary(df, "text", max_features=2, ngrams=2)) == [("aa", 3, 3), ("aa zz", 2, 2)]
    assert features.vocabulary(df.limit(0), "text", ngrams=2).count() == 0


def test_rule_prediction(train):
    rows = models.rule_predict(train).collect()
    assert [r["predicted_intent"] for r in rows] == [label for _, label in TRAIN]
    assert rows[0]["all_intent_probabilities"] == {"DELIVERY_STATUS": fv.UNTRAINED_CONFIDENCE}


def test_training_fallback(spark):
    golden = generators.golden_set(spark, 30)
    few = generators.training_corpus(spark, 3).withColumn("intent", F.lit(None).cast("string"))
    assert evaluation.training_rows(few, golden).count() == 3
    rows = evaluation.training_rows(few, golden, fallback=True)
    assert rows.count() == len(fv.INTENTS)  # every written item is golden here
    other = evaluation.training_rows(few, golden.where("pair_id like 'pair_gold%'"), fallback=True)
    assert other.count() == len(fv.GOLDEN_LITERALS)
    assert other.where("intent is null").count() == 0


@pytest.fixture(scope="module")
def evaluated(spark):
    pairs = generators.training_corpus(spark, 200).unionByName(
        generators.golden_set(spark, 5).select("pair_id", "customer_clean_text", "support_response"),
        allowMissingColumns=True)
    golden = generators.golden_set(spark, 60)
    spelled = F.transform(F.sequence(F.lit(97), F.lit(122)), lambda c: F.regexp_count(
        F.lower("customer_clean_text"), F.char(c)).cast("double"))
    return golden, evaluation.evaluate(
        pairs.withColumn("letters", spelled), golden.withColumn("letters", spelled), max_iter=15,
        vector="letters", first_n=fv.RATED_SAMPLE)


def test_evaluation(evaluated):
    golden, result = evaluated
    predictions = result.predictions.collect()
    assert len(predictions) == 60
    assert all(len(r["retrieved_cases"]) == fv.TOP_K for r in predictions)
    golden_texts = {r["customer_clean_text"].lower() for r in golden.collect()}
    assert not any(c["case_text"].lower() in golden_texts
                   for r in predictions for c in r["retrieved_cases"])
    value = {(r["component"], r["system"], r["metric"]): r["value"] for r in result.metrics.collect()}
    assert value["escalation_routing_trust", "all", "total_evaluated"] == 60
    assert value["intent_classification", "baseline_1_tfidf", "accuracy"] > 0.6
    assert (value["intent_classification", "baseline_0_majority", "accuracy"]
            < value["intent_classification", "baseline_1_tfidf", "accuracy"])
    assert (value["intent_classification", "baseline_0_majority", "accuracy"]
            < value["intent_classification", "main_model_embedding", "accuracy"])
    assert value["human_vs_judge_agreement", "all", "sample_size"] == fv.RATED_SAMPLE
    assert value["failure_analysis_summary", "all", "total_failures_identified"] == result.failures.count()
    systems = {s for c, s, _ in value if c == "reply_generation_systems"}
    assert systems == set(fv.REPLY_SYSTEMS)


def test_evaluation_output(spark, evaluated, tmp_path):
    _, result = evaluated
    evaluation.write_evaluation(result, str(tmp_path))
    assert spark.read.parquet(str(tmp_path / "predictions")).count() == 60
    text = "".join(p.read_text() for p in pathlib.Path(tmp_path / "results").glob("part-*"))
    document = json.loads(text)
    assert document["escalation_routing_trust"]["all"]["total_evaluated"] == 60.0
    assert set(document["reply_generation_systems"]) == set(fv.REPLY_SYSTEMS)
    failed = store.read_or_empty(spark, str(tmp_path / "failures"), result.failures.schema, "csv")
    assert failed.count() == result.failures.count()


def test_stores(spark, tmp_path):
    golden = generators.golden_set(spark, 20)
    store.write_golden(golden, str(tmp_path / "golden"))
    assert store.read_golden(spark, str(tmp_path / "golden/json")).exceptAll(golden).count() == 0
    array = tmp_path / "golden.json"
    array.write_text(json.dumps([r.asDict() for r in golden.collect()]))
    assert store.read_golden(spark, str(array), array_file=True).exceptAll(golden).count() == 0
    assert store.read_or_empty(spark, str(tmp_path / "none"), store.METRIC_SCHEMA).count() == 0
    corpus = store.index_corpus(spark, str(tmp_path / "none"), str(tmp_path / "golden/json"))
    assert corpus.count() == 20
    assert leaked_golden(corpus, golden).count() == 20


def test_long_metrics(spark):
    df = spark.createDataFrame([("a", 1, 2.5), ("b", 3, 4.5)], "s string, x int, y double")
    rows = {tuple(r) for r in long_metrics(df, "c", ["x", "y"], "s").collect()}
    assert rows == {("c", "a", "x", 1.0), ("c", "a", "y", 2.5), ("c", "b", "x", 3.0), ("c", "b", "y", 4.5)}


def test_hashed_vectors_are_written_once(spark):
    """Fitting reads them several times; the long form of the unit vectors has the same values."""
    from careweave.functions import vectors as vec
    from careweave.plans import catalog

    df = spark.createDataFrame([(1, "one two two"), (2, ""), (3, None)], "doc_id int, customer_clean_text string")
    got = catalog._hashed(df)
    assert got.inputFiles() and got.count() == 3
    assert all(sum(x * x for x in r["embedding"]) == pytest.approx(float(r["doc_id"] == 1)) for r in got.collect())
    rows = spark.createDataFrame([([3.0, 4.0],), ([0.0, 0.0],), ([0.1, 0.7, 0.3],), ([],), (None,), ([1.0, None],)], "v array<double>")
    both = rows.select(vec.l2_normalize(F.col("v")).alias("a"), vec.l2_normalize_long(F.col("v")).alias("b")).collect()
    assert [r["a"] for r in both] == [r["b"] for r in both]
