"""Question/answer pairs from a reply graph, and the counts that describe a brand."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from careweave import fixed_values as fv
from careweave.functions import text as tx
from careweave.functions.numbers import round_columns
from careweave.operators.curation import keep_first, preprocess_messages
from careweave.operators.skew import HOT_ROWS, split_join
from careweave.sources.generators import training_corpus

_ORDER = ("created_at", "support_tweet_id")


def prepared(messages: DataFrame, brand: str = fv.DEFAULT_BRAND) -> DataFrame:
    return messages if "is_brand" in messages.columns else preprocess_messages(messages, brand)


def assert_unique_ids(messages: DataFrame) -> None:
    """Action: raise when a message id occurs twice."""
    twice = messages.groupBy("tweet_id").count().where("count > 1").head()
    if twice is not None:
        raise ValueError(f"message id {twice['tweet_id']!r} occurs {twice['count']} times")


def reconstruct_pairs(
    messages: DataFrame, brand: str = fv.DEFAULT_BRAND, *, min_tokens: int = fv.MIN_TOKENS,
    hot_replies: int = HOT_ROWS,
) -> DataFrame:
    """Brand replies joined to the customer message they answer, identical pairs kept once.

    Brand flag and token counts are filtered on each side before the join, so each message is
    cleaned once and only usable messages shuffle. A customer message id that occurs twice
    counts with its earliest row.
    """
    messages = prepared(messages, brand)
    enough = tx.clean_token_count(F.col("clean_text")) >= min_tokens
    replies = messages.where(
        F.col("is_brand") & (F.coalesce("in_reply_to_tweet_id", F.lit("")) != "") & enough
    ).select(
        F.col("in_reply_to_tweet_id").alias("customer_tweet_id"),
        F.col("tweet_id").alias("support_tweet_id"),
        F.col("author_id").alias("support_author_id"),
        F.col("raw_text").alias("support_response"),
        F.col("clean_text").alias("support_clean_text"),
        "created_at",
    )
    # Which row an id stands for is settled before short messages are dropped.
    parents = (
        keep_first(messages.where(~F.col("is_brand")), ["tweet_id"],
                   ["created_at", "author_id", "raw_text"])
        .where(enough)
        .select(
            F.col("tweet_id").alias("customer_tweet_id"),
            F.col("author_id").alias("customer_author_id"),
            F.col("raw_text").alias("customer_query"),
            F.col("clean_text").alias("customer_clean_text"),
        )
    )
    # One question may draw a large share of all replies; counting them needs two narrow columns.
    reply_ids = messages.where(F.col("is_brand")).select(
        F.nullif("in_reply_to_tweet_id", F.lit("")).alias("customer_tweet_id"))
    pairs = split_join(
        replies, parents, "customer_tweet_id", hot_source=reply_ids, min_rows=hot_replies,
    ).select(
        F.concat_ws("_", "customer_tweet_id", "support_tweet_id").alias("pair_id"),
        "customer_tweet_id", "customer_author_id", "customer_query", "customer_clean_text",
        "support_tweet_id", "support_author_id", "support_response", "support_clean_text",
        "created_at",
    )
    return dedup_pairs(pairs)


def dedup_pairs(
    pairs: DataFrame,
    keys: tuple[str, ...] = ("customer_clean_text", "support_clean_text"),
    order: tuple[str, ...] = _ORDER,
) -> DataFrame:
    return keep_first(pairs, list(keys), list(order), hashed=True)


def brand_statistics(
    messages: DataFrame, brand: str = fv.DEFAULT_BRAND, *, pairs: DataFrame | None = None
) -> DataFrame:
    """One row of message, reply, pair and thread counts for a brand."""
    clean = prepared(messages, brand)
    counts = clean.agg(
        F.count("*").alias("total_tweets_inspected"),
        F.count_if(~F.col("is_brand")).alias("customer_messages"),
        F.count_if(F.col("is_brand")).alias("brand_replies"),
    )
    pairs = reconstruct_pairs(clean, brand) if pairs is None else pairs
    usable = pairs.agg(
        F.count("*").alias("usable_customer_support_pairs"),
        F.count_distinct("customer_tweet_id").alias("approximate_thread_count"),
    )
    # Two one-row frames become one row: each column is filled in exactly one of them.
    both = counts.unionByName(usable, allowMissingColumns=True)
    one = both.agg(*[F.max(c).alias(c) for c in both.columns]).select(F.lit(brand).alias("brand"), "*")
    return round_columns(one.withColumn(
        "support_reply_ratio",
        F.col("usable_customer_support_pairs") / F.greatest(F.lit(1), F.col("customer_messages")),
    ), ["support_reply_ratio"])


def thread_sketches(pairs: DataFrame, by: tuple[str, ...], *, lg_k: int = 12) -> DataFrame:
    """``by``, sketch, pairs: a mergeable sketch of the distinct questions of every group.

    Stored per day and brand, sketches answer for any span of days without reading the pairs
    again. A sketch has at most 2**lg_k bytes; its relative standard error is 1.04 / sqrt(2**lg_k),
    1.6 % by default. ``brand_statistics`` has the exact count.
    """
    return pairs.groupBy(*by).agg(
        F.hll_sketch_agg("customer_tweet_id", F.lit(lg_k)).alias("sketch"), F.count("*").alias("pairs"))


def distinct_threads(sketches: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """``by``, threads, pairs from stored sketches; the sketch of a union is the union of sketches."""
    return sketches.groupBy(*by).agg(
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("threads"), F.sum("pairs").alias("pairs"))


def supplement_small(
    pairs: DataFrame, *, min_pairs: int = fv.MIN_PAIRS, rows: int = fv.SUPPLEMENT_ROWS
) -> DataFrame:
    """Append synthetic pairs when there are fewer than ``min_pairs``; otherwise append none."""
    n_pairs = pairs.agg(F.count("*").alias("n"))
    extra = training_corpus(pairs.sparkSession, rows).where(n_pairs.scalar() < min_pairs)
    return pairs.unionByName(extra, allowMissingColumns=True)
