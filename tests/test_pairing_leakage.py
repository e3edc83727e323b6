import pytest
from pyspark.sql import functions as F

from careweave import fixed_values as fv
from careweave.operators import curation, leakage, pairing
from careweave.plans import prepare
from careweave.sources import generators, store


def test_flags_and_blank_rows(messages):
    rows = {r["tweet_id"]: r for r in curation.preprocess_messages(messages, "Shop").collect()}
    assert set(rows) == {"1", "2", "3", "4", "5", "7", "8", "9", "10", "11", "13"}
    assert rows["1"]["clean_text"] == "my parcel is late, see [URL]"
    assert rows["1"]["raw_text"].startswith("@Shop")
    assert rows["9"]["is_brand"] and rows["11"]["is_brand"] and rows["1"]["is_customer"]


def test_pairs(messages):
    rows = {r["pair_id"]: r for r in pairing.reconstruct_pairs(messages, "Shop").collect()}
    # 10_11 repeats both clean texts of no other pair: its question differs in case.
    assert set(rows) == {"1_2", "1_3", "10_11"}
    assert rows["1_2"]["support_clean_text"] == "sorry to hear that"
    assert rows["1_2"]["created_at"] == "02"


def test_duplicate_ids_and_duplicate_pairs(spark, messages):
    more = spark.createDataFrame([
        ("1", "zed", "", "90", "a later row with the same id"),
        ("20", "ana", "", "91", "@Shop my parcel is late, see http://z.z"),
        ("21", "Shop", "20", "92", "sorry to hear that"),
    ], messages.schema)
    rows = {r["pair_id"] for r in pairing.reconstruct_pairs(messages.unionByName(more), "Shop").collect()}
    assert rows == {"1_2", "1_3", "10_11"}
    with pytest.raises(ValueError):
        pairing.assert_unique_ids(messages.unionByName(more))
    pairing.assert_unique_ids(messages)


@pytest.mark.parametrize("hot", [1, 5, 1000])
def test_hot_question_and_hot_text(spark, hot):
    """A third of all replies answer one question; a third of all texts are copies."""
    rows = [("q", "ana", "", "0", "why is it late")]
    rows += [(f"q{i}", "bo", "", "0", f"question number {i} here") for i in range(40)]
    rows += [(f"a{i}", "Shop", "q" if i % 3 == 0 else f"q{i % 40}", "1", f"answer with number {i}")
             for i in range(60)]
    messages = spark.createDataFrame(
        rows, "tweet_id string, author_id string, in_reply_to_tweet_id string, created_at string, text string"
    ).repartition(8)
    want = {f"{r[2]}_{r[0]}" for r in rows if r[1] == "Shop"}
    got = [r["pair_id"] for r in pairing.reconstruct_pairs(messages, "Shop", hot_replies=hot).collect()]
    assert len(got) == len(want) and set(got) == want

    train = spark.createDataFrame(
        [(i, "Copied Text" if i % 3 == 0 else f"text {i}") for i in range(60)],
        "i int, customer_clean_text string").repartition(8)
    golden = spark.createDataFrame([("copied text",), ("text 7",), ("x",)], "customer_clean_text string")
    kept = {r["i"] for r in leakage.exclude_golden(train, golden).collect()}
    assert kept == {i for i in range(60) if i % 3 and i != 7}
    leaked = leakage.leaked_golden(train, golden, hot_rows=hot)
    assert sorted(r[0] for r in leaked.collect()) == ["copied text", "text 7"]
    assert leakage.leaked_golden(golden, train, hot_rows=hot).count() == 21


def test_pairs_keep_their_schema_when_empty(messages):
    empty = pairing.reconstruct_pairs(messages.where("false"), "Shop")
    assert empty.columns == store.PAIR_COLUMNS and empty.count() == 0
    row = pairing.brand_statistics(messages.where("false"), "Shop").head()
    assert row["support_reply_ratio"] == 0.0 and row["total_tweets_inspected"] == 0


def test_brand_statistics(messages):
    row = pairing.brand_statistics(messages, "Shop").head().asDict()
    assert row == {
        "brand": "Shop", "total_tweets_inspected": 11, "customer_messages": 3, "brand_replies": 8,
        "usable_customer_support_pairs": 3, "approximate_thread_count": 2,
        "support_reply_ratio": 1.0}


def test_supplement(messages):
    pairs = pairing.reconstruct_pairs(messages, "Shop")
    assert pairing.supplement_small(pairs).count() == 3 + fv.SUPPLEMENT_ROWS
    kept = pairing.supplement_small(pairs, min_pairs=3)
    assert kept.count() == 3 and "intent" in kept.columns


def test_exclusion_and_leak_check(spark):
    train = spark.createDataFrame(
        [("where is my order",), (" How to RETURN item",), ("cancel",)], "customer_clean_text string")
    golden = spark.createDataFrame([("Where is my order ",), ("new",)], "customer_clean_text string")
    left = leakage.exclude_golden(train, golden)
    assert left.count() == 2
    assert leakage.leaked_golden(train, golden).count() == 1
    with pytest.raises(ValueError, match="DATA LEAKAGE ERROR"):
        leakage.assert_no_leak(train, golden)
    assert leakage.assert_no_leak(left, golden)
    # anti join and semi join split the input
    both = leakage.leaked_golden(golden, train).count() + left.count()
    assert both == train.count()


def test_self_mask(spark):
    cases = spark.createDataFrame([
        ("tw_101", "My package is lost", "tw_101", "My package is lost", "p1"),
        ("tw_101", "My package is lost", "tw_999", "Item tracking delayed", "p2"),
        ("tw_101", "My package is lost", "tw_5", " my PACKAGE is lost ", "p3"),
        ("1", "abc", "7", "x", "10_11"), ("11", "abc", "7", "x", "10_11"), ("", "abc", "", "y", "10_11"),
    ], "q string, qt string, c string, ct string, p string")
    options = dict(query_id="q", query_text="qt", case_customer_id="c", case_text="ct", case_pair_id="p")
    kept = [(r["q"], r["p"]) for r in leakage.mask_self(cases, **options).collect()]
    assert kept == [("tw_101", "p2"), ("1", "10_11"), ("", "10_11")]
    loose = [(r["q"], r["p"]) for r in leakage.mask_self(cases, **options, substring=True).collect()]
    assert loose == [("tw_101", "p2"), ("", "10_11")]


def test_reply_leakage(spark):
    df = spark.createDataFrame([("Please DM us", "please dm us "), ("a", "b"), ("", "")], "a string, b string")
    safe = [r[0] for r in df.select(leakage.reply_is_safe(F.col("a"), F.col("b"))).collect()]
    assert safe == [False, True, True]


def test_generators(spark):
    rows = generators.training_corpus(spark, 500).orderBy("pair_id").collect()
    assert len(rows) == 500 and rows[15]["intent"] == "DELIVERY_STATUS"
    assert rows[0]["customer_query"] == (
        "Where is my package tracking #40100-800000? It says in transit for 2 days.")
    assert rows[5]["customer_query"].startswith("Charged twice $70.99 on my Visa for order #40105-800025.")
    golden = generators.golden_set(spark).cache()
    assert golden.count() == 200 and golden.where("gold_should_escalate").count() == 52
    first = golden.where("pair_id = 'pair_gold_019'").head()
    assert first["customer_clean_text"] == (
        "Tracking for order #4019-900057 has not updated for 6 days. Is it lost in transit?")
    assert golden.agg(F.countDistinct("pair_id")).head()[0] == 200


def test_prepare_writes_pairs(spark, tmp_path):
    source = tmp_path / "raw.csv"
    source.write_text(
        "tweet_id,author_id,in_reply_to_tweet_id,created_at,text,response_tweet_id\n"
        "10,user123,,Wed Oct 11,My package tracking has no update,11\n"
        f"11,{fv.DEFAULT_BRAND},10,Wed Oct 11,Please DM us your order ID!,\n")
    prepare.run(spark, str(source), str(tmp_path / "plain"))
    assert store.read_pairs(spark, str(tmp_path / "plain")).count() == 1
    stats = prepare.run(spark, str(source), str(tmp_path / "pairs"), supplement=True).head()
    assert stats["usable_customer_support_pairs"] == 1
    pairs = store.read_pairs(spark, str(tmp_path / "pairs"))
    assert pairs.count() == 1 + fv.SUPPLEMENT_ROWS and pairs.where("pair_id = '10_11'").count() == 1
    store.write_pairs(pairs, str(tmp_path / "csv"), "csv")
    assert store.read_pairs(spark, str(tmp_path / "csv"), "csv").count() == pairs.count()


def test_sketches_of_days_add_up(spark):
    """Merged sketches equal the sketch of all pairs and stay within four standard errors."""
    pairs = spark.range(60_000).select(
        F.concat(F.lit("q"), F.col("id") % 20_011).alias("customer_tweet_id"),
        (F.col("id") % 30).alias("day"), F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("brand"))
    stored = pairing.thread_sketches(pairs, ("day", "brand")).cache()
    assert stored.count() == pairs.select("day", "brand").distinct().count()
    whole = pairing.distinct_threads(pairing.thread_sketches(pairs, ())).head()
    assert pairing.distinct_threads(stored).head() == whole and whole["pairs"] == 60_000
    assert abs(whole["threads"] - 20_011) <= 4 * 1.04 / 64 * 20_011
    by_brand = {r["brand"]: r["threads"] for r in pairing.distinct_threads(stored, ("brand",)).collect()}
    exact = {r["brand"]: r["n"] for r in pairs.groupBy("brand").agg(F.count_distinct("customer_tweet_id").alias("n")).collect()}
    assert all(abs(by_brand[b] - n) <= 4 * 1.04 / 64 * n for b, n in exact.items())
    sizes = stored.agg(F.max(F.octet_length("sketch"))).head()[0]
    assert sizes < 2 ** 12 + 100
