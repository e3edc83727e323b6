"""Question/answer pairing while both sides are still arriving."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from careweave import fixed_values as fv
from careweave.functions import text as tx
from careweave.operators.curation import preprocess_messages
from careweave.sources.store import PAIR_COLUMNS

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_SIDE = "created_at string, author_id string, raw_text string, clean_text string, enough boolean, at long"
_PAIR = ", ".join(f"{c} string" for c in PAIR_COLUMNS)


class _Timed(StatefulProcessor):
    """State of one key, kept until the watermark is past the last row it can still meet."""

    def __init__(self, wait_ms: int):
        self.wait_ms = wait_ms

    def keep_until(self, handle: StatefulProcessorHandle, at_ms: int) -> None:
        expiry, timers = at_ms + self.wait_ms, list(handle.listTimers())
        if not timers or max(timers) < expiry:
            for timer in timers:
                handle.deleteTimer(timer)
            handle.registerTimer(expiry)

    def close(self) -> None:
        pass


class _Threads(_Timed):
    """The question of a message id and the replies to it; each reply is paired once.

    Of the rows that arrive with one id up to the first pair, the earliest by creation stands for
    it, whether it is long enough or not.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.question = handle.getValueState("question", _SIDE)
        self.waiting = handle.getListState("waiting", "tweet_id string, " + _SIDE)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        frame = pd.concat(list(rows), ignore_index=True)
        names = [c.split()[0] for c in _SIDE.split(", ")]
        known = self.question.get() if self.question.exists() else None
        asked = frame[~frame["is_brand"]].sort_values(["created_at", "author_id", "raw_text"])
        if len(asked) and known is None:
            known = next(asked[names].itertuples(index=False, name=None))
            self.question.update(known)
        replies = [tuple(x) for x in frame.loc[frame["is_brand"], ["tweet_id", *names]].itertuples(index=False, name=None)]
        if known is not None:
            replies += [tuple(x) for x in self.waiting.get()]
            self.waiting.clear()
        elif replies:
            self.waiting.appendList(replies)
        self.keep_until(self.handle, int(frame["at"].max()))
        out = []
        if known is not None and known[4]:
            for support_id, created, author, raw, clean, _, at in sorted(replies):
                if known[5] <= at <= known[5] + self.wait_ms:
                    out.append((f"{key[0]}_{support_id}", key[0], known[1], known[2], known[3], support_id,
                                author, raw, clean, created, pd.Timestamp(at, unit="ms", tz="UTC")))
        yield pd.DataFrame(out, columns=[*PAIR_COLUMNS, "paired_at"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.question.clear()
        self.waiting.clear()
        return iter(())


class _Once(_Timed):
    """Of pairs with one question and one answer text the first, within the wait."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getValueState("seen", "pair_id string")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        frame = pd.concat(list(rows), ignore_index=True).sort_values(["created_at", "support_tweet_id"])
        fresh = not self.seen.exists()
        if fresh:
            self.seen.update((frame["pair_id"].iloc[0],))
        self.keep_until(self.handle, int(frame["paired_at"].max().timestamp() * 1000))
        yield frame.head(int(fresh))[PAIR_COLUMNS]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.seen.clear()
        return iter(())


def _milliseconds(wait: str) -> int:
    return int(pd.Timedelta(wait).total_seconds() * 1000)


def stream_pairs(
    messages: DataFrame, brand: str = fv.DEFAULT_BRAND, *, event_time: str = "created_ts",
    max_wait: str = "1 hour", min_tokens: int = fv.MIN_TOKENS,
) -> DataFrame:
    """The pairs of the batch form, as far as rows within ``max_wait`` of each other decide them.

    Keyed state joins replies to their question in either order of arrival. An id that comes
    again keeps its earliest row (by creation, among those that came before its first pair), and
    of pairs with equal texts only the first is passed on. An answer counts up to ``max_wait``
    after its question. Watermark and timers of ``max_wait`` drop what is older, so state is
    bounded by the messages of that time. ``messages`` needs a timestamp column; the state store
    must be RocksDB (``write_pairs_stream`` sees to that). All replies to one message are one key.
    """
    wait_ms = _milliseconds(max_wait)
    enough = tx.token_count(F.col("clean_text")) >= min_tokens
    usable = preprocess_messages(messages, brand).withColumn("enough", enough).where(
        ~F.col("is_brand") | (F.col("enough") & (F.coalesce("in_reply_to_tweet_id", F.lit("")) != "")))
    rows = usable.select(
        F.when(F.col("is_brand"), F.col("in_reply_to_tweet_id")).otherwise(F.col("tweet_id")).alias("thread"),
        "tweet_id", "created_at", "author_id", "raw_text", "clean_text", "is_brand", "enough",
        F.unix_millis(event_time).alias("at"), F.col(event_time).alias("_time"),
    ).withWatermark("_time", max_wait)
    pairs = rows.groupBy("thread").transformWithStateInPandas(
        _Threads(wait_ms), f"{_PAIR}, paired_at timestamp", "Append", "EventTime", eventTimeColumnName="paired_at")
    text = F.struct("customer_clean_text", "support_clean_text")
    keyed = pairs.withColumn("texts", F.sha2(F.to_json(text), 256))
    return keyed.groupBy("texts").transformWithStateInPandas(_Once(wait_ms), _PAIR, "Append", "EventTime")


def write_pairs_stream(
    pairs: DataFrame, *, target: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Append pairs as Parquet; the file sink commits each batch exactly once."""
    spark = pairs.sparkSession
    before = spark.conf.get(STATE_STORE)
    spark.conf.set(STATE_STORE, ROCKSDB)  # read when the query starts
    try:
        return (
            pairs.writeStream.format("parquet").option("path", target)
            .option("checkpointLocation", checkpoint).outputMode("append")
            .trigger(**(trigger or {"availableNow": True})).start()
        )
    finally:
        spark.conf.set(STATE_STORE, before)
