"""Synthetic pairs and evaluation items, written from templates by position.

Both take a frame of positions, so the same rule runs over ``spark.range(n)`` or over the
row numbers of a table; every row depends on its own position only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from careweave import fixed_values as fv
from careweave.functions.text import pick

GOLDEN_SCHEMA = T.StructType([
    T.StructField("pair_id", T.StringType()),
    T.StructField("customer_tweet_id", T.StringType()),
    T.StructField("customer_clean_text", T.StringType()),
    T.StructField("support_response", T.StringType()),
    T.StructField("gold_intent", T.StringType()),
    T.StructField("gold_should_escalate", T.BooleanType()),
    T.StructField("human_quality_rating", T.DoubleType()),
])


def _fill(template: Column, order_id: Column, days: Column, amount: Column) -> Column:
    out = F.replace(template, F.lit("{id}"), order_id)
    out = F.replace(out, F.lit("{days}"), days.cast("string"))
    return F.replace(out, F.lit("{amt}"), F.format_string("%d.99", amount))


def training_pairs(positions: DataFrame, position: str = "id") -> DataFrame:
    """One synthetic support pair with its intent per position (from 0)."""
    i = F.col(position).cast("bigint")
    which = i % len(fv.TRAINING_TEMPLATES)
    question = _fill(
        pick([t[1] for t in fv.TRAINING_TEMPLATES], which),
        F.format_string("40%03d-8%05d", i + 100, i * 5), (i % 4) + 2, (i * 11) % 70 + 15)
    answer = pick([t[2] for t in fv.TRAINING_TEMPLATES], which)
    return positions.select(
        F.format_string("train_hist_%04d", i).alias("pair_id"),
        F.format_string("tw_tr_%04d", i).alias("customer_tweet_id"),
        F.format_string("user_tr_%04d", i).alias("customer_author_id"),
        question.alias("customer_query"),
        question.alias("customer_clean_text"),
        F.format_string("tw_supp_%04d", i).alias("support_tweet_id"),
        F.lit(fv.DEFAULT_BRAND).alias("support_author_id"),
        answer.alias("support_response"),
        answer.alias("support_clean_text"),
        F.lit(fv.TRAINING_CREATED_AT).alias("created_at"),
        pick([t[0] for t in fv.TRAINING_TEMPLATES], which).alias("intent"),
    )


def golden_items(positions: DataFrame, position: str = "id") -> DataFrame:
    """Evaluation items per position (from 1): written rows first, template rows after them."""
    spark = positions.sparkSession
    n_written = len(fv.GOLDEN_LITERALS)
    written = spark.createDataFrame(
        [(i + 1, *row) for i, row in enumerate(fv.GOLDEN_LITERALS)],
        T.StructType([T.StructField("_position", T.LongType()), *GOLDEN_SCHEMA.fields]))
    literal_rows = positions.join(
        F.broadcast(written), F.col(position) == F.col("_position")).select(*GOLDEN_SCHEMA.names)

    i = F.col(position).cast("bigint")
    which = (i - n_written - 1) % len(fv.GOLDEN_TEMPLATES)
    question = _fill(
        pick([t[1] for t in fv.GOLDEN_TEMPLATES], which),
        F.format_string("40%d-9%05d", i, i * 3), (i % 5) + 2, (i * 7) % 80 + 19)
    template_rows = positions.where(F.col(position) > n_written).select(
        F.format_string("pair_gold_%03d", i).alias("pair_id"),
        F.format_string("tw_gold_%03d", i).alias("customer_tweet_id"),
        question.alias("customer_clean_text"),
        F.lit(fv.GOLDEN_TEMPLATE_REPLY).alias("support_response"),
        pick([t[0] for t in fv.GOLDEN_TEMPLATES], which).alias("gold_intent"),
        pick([t[2] for t in fv.GOLDEN_TEMPLATES], which).alias("gold_should_escalate"),
        pick([t[3] for t in fv.GOLDEN_TEMPLATES], which).alias("human_quality_rating"),
    )
    return literal_rows.unionByName(template_rows)


def training_corpus(spark: SparkSession, count: int = fv.SUPPLEMENT_ROWS) -> DataFrame:
    return training_pairs(spark.range(count))


def golden_set(spark: SparkSession, count: int = fv.GOLDEN_ROWS) -> DataFrame:
    return golden_items(spark.range(1, count + 1))
