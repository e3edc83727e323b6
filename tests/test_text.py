import random

from pyspark.sql import functions as F

from careweave import fixed_values as fv
from careweave.functions import lexical, numbers, text as tx, vectors as vec
from careweave.operators import curation
from careweave.operators.reply_evaluation import lexical_means, lexical_scores
from careweave.sources import messages as msg


def values(spark, rows, expression, kind="string"):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], f"i int, x {kind}")
    return [r[0] for r in df.select("i", expression.alias("v")).orderBy("i").select("v").collect()]


def test_clean_text(spark):
    rows = [
        "Hey @ShopHelp my package at https://t.co/xyz123 was delayed!",
        "see www.a.com now", "a@b.com", None, "", "  x \ty\n\nz\x1f ", "@only",
        "http://a.b?q=@me done",
    ]
    assert values(spark, rows, tx.clean_text(F.col("x"))) == [
        "Hey my package at [URL] was delayed!", "see [URL] now", "a.com", "", "", "x y z", "",
        "[URL] done"]


def test_missing_words_and_keys(spark):
    rows = [None, " nan ", "None", "nano", "  Hi There\n"]
    assert values(spark, rows, tx.normalize_missing(F.col("x"))) == ["", "", "", "nano", "Hi There"]
    assert values(spark, rows, tx.text_key(F.col("x")))[-1] == "hi there"


def test_tokens_agree_with_python(spark):
    rows = ["", "  ", "a", " a  b\tc d ", "\x85x　y"]
    assert values(spark, rows, tx.tokens(F.col("x"))) == [r.split() for r in rows]
    cleaned = ["", "one", "two words", "now three words"]
    assert values(spark, cleaned, tx.clean_token_count(F.col("x"))) == [0, 1, 2, 3]


def test_keyword_rules(spark):
    rows = ["Refund my DELIVERY", "I want a refund", "an issue", "nothing", None]
    assert values(spark, rows, tx.keyword_label(F.col("x"))) == [
        "DELIVERY_STATUS", "REFUND_RETURN", fv.GENERAL_INTENT, fv.GENERAL_INTENT, fv.GENERAL_INTENT]
    hits = tx.keyword_hits(F.col("x"), ["sue", "legal"])
    assert values(spark, ["this issue is illegal", "we sue"], hits) == [["sue", "legal"], ["sue"]]
    whole = tx.keyword_hits(F.col("x"), ["sue", "legal"], whole_word=True)
    assert values(spark, ["this issue is illegal", "we sue"], whole) == [[], ["sue"]]
    rules = {"A": ["x"], "B": ["y", "z"]}
    assert values(spark, ["x y z", "y z", "q"], tx.keyword_vote_share(F.col("x"), rules)) == [
        1 / 3, 1.0, fv.UNTRAINED_CONFIDENCE]


def test_rounding_is_python_rounding(spark):
    rng = random.Random(7)
    rows = [0.145, 0.125, 0.375, 2.675, 0.15625, 1.00005, 0.0, -0.125, 0.285, 1.005]
    rows += [round(rng.random(), 3) for _ in range(300)] + [rng.random() * 5 for _ in range(300)]
    assert values(spark, rows, numbers.py_round("x", 2), "double") == [round(x, 2) for x in rows]
    assert values(spark, rows, numbers.py_round("x", 4), "double") == [round(x, 4) for x in rows]
    positive = [abs(x) for x in rows]
    assert values(spark, positive, numbers.fixed_text("x", 2), "double") == [
        f"{x:.2f}" for x in positive]
    assert values(spark, [0.12, 1.0, 0.0001, 0.5], numbers.shortest_text(F.col("x")), "double") == [
        "0.12", "1.0", "0.0001", "0.5"]


def test_rating_bins_round_half_to_even(spark):
    rows = [0.2, 2.5, 4.5, 3.5, 9.0]
    assert values(spark, rows, numbers.rating_bin(F.col("x")), "double") == [1, 2, 4, 4, 5]


def test_vectors(spark):
    rows = [[3.0, 4.0], [0.0, 0.0]]
    assert values(spark, rows, vec.l2_normalize(F.col("x")), "array<double>") == [
        [0.6, 0.8], [0.0, 0.0]]
    assert values(spark, [[0.1, 0.7, 0.7]], vec.argmax(F.col("x")), "array<double>") == [1]


def brute_lcs(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = (
                table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j]))
    return table[-1][-1]


def test_longest_common_subsequence(spark):
    rng = random.Random(3)
    rows = [([rng.choice("abcd") for _ in range(rng.randrange(90))],
             [rng.choice("abcd") for _ in range(rng.randrange(90))]) for _ in range(60)]
    df = spark.createDataFrame(
        [(i, a, b) for i, (a, b) in enumerate(rows)], "i int, a array<string>, b array<string>")
    got = df.select("i", lexical.lcs_length(F.col("a"), F.col("b")).alias("n")).orderBy("i").collect()
    assert [r["n"] for r in got] == [brute_lcs(a, b) for a, b in rows]


def test_lexical_scores(spark):
    df = spark.createDataFrame([
        ("the cat sat", "The cat cat ran"), ("", "something"), ("something", ""),
    ], "support_response string, generated_reply string")
    rows = lexical_scores(df).collect()
    assert rows[0]["bleu_4"] == 0.75
    assert abs(rows[0]["rouge_l"] - 2 * (2 / 4) * (2 / 3) / (2 / 4 + 2 / 3)) < 1e-12
    assert (rows[1]["bleu_4"], rows[1]["rouge_l"], rows[2]["bleu_4"]) == (0.0, 0.0, 0.0)
    empty = lexical_means(df.where("false")).head()
    assert (empty["bleu_4"], empty["rouge_l"]) == (0.0, 0.0)


def test_message_scan(spark, tmp_path):
    path = tmp_path / "raw.csv"
    path.write_text(
        "tweet_id,extra,author_id,in_reply_to_tweet_id,created_at,text,response_tweet_id\n"
        '1,zz,ana,,Wed Oct 11 10:00:00 +0000 2017,"two\nlines, ""quoted""",2\n'
        "2,zz,Shop,1,Wed Oct 11 10:05:00 +0000 2017, nan ,\n")
    df = msg.scan_messages(spark, str(path))
    assert df.columns == fv.MESSAGE_COLUMNS
    rows = df.orderBy("tweet_id").collect()
    assert rows[0]["text"] == 'two\nlines, "quoted"' and rows[0]["in_reply_to_tweet_id"] == ""
    assert rows[1]["text"] == "" and rows[1]["response_tweet_id"] == ""
    stamped = msg.with_timestamp(df).orderBy("tweet_id").head()
    assert str(stamped["created_ts"]) == "2017-10-11 10:00:00"
    missing = str(tmp_path / "no.csv")
    assert msg.scan_messages(spark, missing, fallback=str(path), max_rows=1).count() == 1
    try:
        msg.scan_messages(spark, missing)
        raise AssertionError("expected FileNotFoundError")
    except FileNotFoundError:
        pass


def test_label_resolution_is_per_row(spark):
    df = spark.createDataFrame(
        [("a refund", None, "X"), ("a refund", "Y", None), ("a refund", " ", None)],
        "customer_clean_text string, intent string, gold_intent string")
    assert [r["intent"] for r in curation.resolve_label(df).collect()] == ["X", "Y", "REFUND_RETURN"]


def test_taxonomy(spark):
    rows = curation.taxonomy_frame(spark).orderBy("priority").collect()
    assert [r["label"] for r in rows] == fv.INTENTS and rows[-1]["keywords"] == []


def test_samples_do_not_depend_on_partitioning(spark):
    df = spark.range(200).withColumn("g", F.col("id") % 3)
    a = {r["id"] for r in curation.sample_rows(df.repartition(7), 20, key="id").collect()}
    b = {r["id"] for r in curation.sample_rows(df.coalesce(1), 20, key="id").collect()}
    assert a == b and len(a) == 20
    assert curation.sample_rows(df, 500, key="id").count() == 200
    per = curation.sample_per_stratum(df, ["g"], 5, key="id").groupBy("g").count().collect()
    assert sorted(r["count"] for r in per) == [5, 5, 5]
