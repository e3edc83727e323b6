from pyspark.sql import functions as F

from careweave.operators import pairing, retrieval
from careweave.plans import scoring
from careweave.streaming import pairing as stream_pairing, scoring as stream_scoring

COLUMNS = "tweet_id string, author_id string, in_reply_to_tweet_id string, created_at string, text string, minute int"


def message_files(spark, folder, *batches):
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, COLUMNS).coalesce(1).write.mode("append").parquet(str(folder))


def as_stream(spark, folder, **options):
    source = spark.readStream.schema(COLUMNS).options(**options).parquet(str(folder))
    return source.withColumn("created_ts", F.timestamp_seconds(1_700_000_000 + F.col("minute") * 60))


FIRST = [("1", "ana", "", "1", "@Shop where is my parcel", 0),
         ("2", "Shop", "1", "2", "@ana we are looking into it", 3),
         ("4", "Shop", "3", "4", "this answers a question that comes later in the files", 6)]
SECOND = [("3", "bo", "", "3", "my parcel is broken again", 5),
          ("5", "Shop", "3", "5", "far too late to count here", 500)]


def run_pairs(spark, tmp_path, name, **options):
    stream = stream_pairing.stream_pairs(as_stream(spark, tmp_path / "in", **options), "Shop")
    query = stream_pairing.write_pairs_stream(
        stream, target=str(tmp_path / f"{name}-out"), checkpoint=str(tmp_path / f"{name}-state"))
    query.awaitTermination()
    return spark.read.parquet(str(tmp_path / f"{name}-out"))


def test_stream_pairs_match_batch_within_the_wait(spark, tmp_path):
    message_files(spark, tmp_path / "in", FIRST, SECOND)
    batch = pairing.reconstruct_pairs(
        spark.createDataFrame(FIRST + SECOND, COLUMNS).where("minute < 60"), "Shop")
    for name, options in (("all", {}), ("one", {"maxFilesPerTrigger": 1})):
        got = run_pairs(spark, tmp_path, name, **options)
        assert {r["pair_id"] for r in got.collect()} == {"1_2", "3_4"}
        assert got.exceptAll(batch.select(got.columns)).count() == 0


def test_stream_pairs_resume_without_repeating(spark, tmp_path):
    message_files(spark, tmp_path / "in", FIRST)
    assert run_pairs(spark, tmp_path, "run").count() == 1
    message_files(spark, tmp_path / "in", SECOND)
    assert sorted(r["pair_id"] for r in run_pairs(spark, tmp_path, "run").collect()) == ["1_2", "3_4"]


def test_duplicate_ids_and_pairs_give_the_batch_rows(spark, tmp_path):
    """An id that comes twice keeps its earliest row; equal pairs are passed on once, also after a restart."""
    batches = [
        [("1", "ana", "", "01", "@Shop where is my parcel", 0), ("1", "eve", "", "09", "another text for this id", 9),
         ("7", "cy", "", "02", "no", 1), ("7", "cy", "", "08", "a longer question that comes later", 8)],
        [("2", "Shop", "1", "10", "@ana we are looking into it", 10), ("8", "Shop", "7", "11", "reply to a short one", 11),
         ("5", "Shop", "4", "12", "we are looking into it", 12)],
        [("4", "bob", "", "03", "where is my parcel", 3), ("3", "Shop", "1", "13", "we are looking into it", 13),
         ("6", "Shop", "4", "14", "a different answer to it", 14)],
    ]
    everything = [r for rows in batches for r in rows]
    batch = pairing.reconstruct_pairs(spark.createDataFrame(everything, COLUMNS), "Shop")
    want = sorted(batch.collect())
    assert [r["pair_id"] for r in want] == ["1_2", "4_6"]
    message_files(spark, tmp_path / "in", *batches)
    for name, options in (("all", {}), ("one", {"maxFilesPerTrigger": 1})):
        assert sorted(run_pairs(spark, tmp_path, name, **options).select(batch.columns).collect()) == want
    # The same files one run at a time, from the checkpoint.
    for i, rows in enumerate(batches):
        message_files(spark, tmp_path / "in2", rows)
        stream = stream_pairing.stream_pairs(as_stream(spark, tmp_path / "in2"), "Shop")
        stream_pairing.write_pairs_stream(stream, target=str(tmp_path / "out2"),
                                          checkpoint=str(tmp_path / "state2")).awaitTermination()
    assert sorted(spark.read.parquet(str(tmp_path / "out2")).select(batch.columns).collect()) == want


def test_old_state_is_dropped(spark, tmp_path):
    """A reply long after its question finds nothing, and the state of old threads goes."""
    first = [("1", "ana", "", "01", "where is my parcel now", 0), ("2", "Shop", "1", "02", "we are looking into it", 2)]
    later = [("9", "bo", "", "90", "a question on the next day", 1500)]
    last = [("3", "Shop", "1", "91", "an answer that is too late", 1501), ("10", "Shop", "9", "92", "an answer in good time", 1502)]
    message_files(spark, tmp_path / "in", first, later, later[:0] + last)
    got = run_pairs(spark, tmp_path, "one", maxFilesPerTrigger=1)
    assert sorted(r["pair_id"] for r in got.collect()) == ["1_2", "9_10"]


def test_stream_scores_match_batch(spark, tmp_path):
    pairs = spark.createDataFrame(
        [("p1", "a", "b", "package tracking delayed", "DM us"), ("p2", "c", "d", "refund to my card", "ok")],
        "pair_id string, customer_tweet_id string, support_tweet_id string, "
        "customer_clean_text string, support_response string")
    index, terms = retrieval.build_text_index(pairs)
    message_files(spark, tmp_path / "in", FIRST, SECOND)

    def asked(df):
        return df.where("author_id <> 'Shop'").select(
            F.col("tweet_id").alias("customer_tweet_id"), F.col("text").alias("customer_clean_text"))

    source = as_stream(spark, tmp_path / "in", maxFilesPerTrigger=1)
    target = str(tmp_path / "out")
    stream_scoring.stream_scores(
        asked(source), index, terms, target=target, checkpoint=str(tmp_path / "state")).awaitTermination()
    got = stream_scoring.read_scores(spark, target).drop("batch_id")
    want = scoring.score_messages(
        asked(spark.createDataFrame(FIRST + SECOND, COLUMNS)), index, terms, query_key="customer_tweet_id")
    key = ["customer_tweet_id", "predicted_intent", "primary_reason", "overall_quality_score"]
    assert sorted(got.select(key).collect()) == sorted(want.select(key).collect())
    # Replaying a batch rewrites its own folder.
    stream_scoring.stream_scores(
        asked(source), index, terms, target=target, checkpoint=str(tmp_path / "state2")).awaitTermination()
    assert stream_scoring.read_scores(spark, target).count() == 2


def test_stream_queries_read_a_folder_of_part_files(spark, tmp_path, sf):
    """A table may be one file or a folder; streams read the same messages from both."""
    from careweave.plans import catalog

    given = spark.read.parquet(f"{sf}/conversations.parquet")
    given.repartition(3).write.parquet(str(tmp_path / "conversations.parquet"))
    for name in ("stream_pairs", "stream_scores"):
        whole = catalog.queries()[name](spark, sf)
        parts = catalog.queries()[name](spark, str(tmp_path))
        assert whole.count() > 0
        assert sorted(parts.collect()) == sorted(whole.collect())
