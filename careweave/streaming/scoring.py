"""Message scoring on a stream, batch by batch, against a fixed index."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from careweave.operators import retrieval
from careweave.plans.scoring import score_messages


def stream_scores(
    messages: DataFrame, index: DataFrame, terms: DataFrame, *, target: str, checkpoint: str,
    query_key: str = "customer_tweet_id", trigger: dict | None = None,
    search: retrieval.TextIndex | None = None, **scoring,
) -> StreamingQuery:
    """Score each micro-batch with the batch plan and write it under its batch number.

    A batch that is replayed after a failure overwrites its own folder, so every message is
    stored once. All batches read the same search tables: those of a stored index
    (``retrieval.load_search``), or some that are written before the stream starts.
    """
    search = search or retrieval.search_tables(index)

    def write(batch: DataFrame, batch_id: int) -> None:
        # One scan of the source per batch: scoring reads its input several times.
        batch = batch.persist()
        try:
            scored = score_messages(batch, index, terms, query_key=query_key, search=search, **scoring)
            scored.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").parquet(
                f"{target}/batch={batch_id}")
        finally:
            batch.unpersist()

    writer = messages.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def read_scores(spark, target: str) -> DataFrame:
    return spark.read.parquet(f"{target}/batch=*")
