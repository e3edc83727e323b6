"""Message curation: flags, cleaning, filters, labels, dedup, samples."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from careweave import fixed_values as fv
from careweave.functions import text as tx


def preprocess_messages(messages: DataFrame, brand: str = fv.DEFAULT_BRAND) -> DataFrame:
    """Keep the original next to the cleaned text, flag the brand, drop what cleans to nothing.

    A blank message cleans to nothing too, so one filter covers both.
    """
    is_brand = F.coalesce(F.lower(F.col("author_id")) == brand.lower(), F.lit(False))
    flagged = messages.withColumns({
        "raw_text": F.col("text"), "is_brand": is_brand, "is_customer": ~is_brand})
    return tx.computed_once(flagged, clean_text=tx.clean_text(F.col("text"))).where(
        "clean_text <> ''")


def min_tokens(df: DataFrame, columns: Sequence[str], n: int = fv.MIN_TOKENS) -> DataFrame:
    for column in columns:
        df = df.where(tx.token_count(F.col(column)) >= n)
    return df


def keep_first(
    df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], *, hashed: bool = False
) -> DataFrame:
    """One row per key, the first in a stated order.

    The rank filter becomes a per-task group limit before the shuffle, so a key that holds a
    large share of the rows sends at most one row per task. ``hashed`` is for long text keys:
    a leading hash makes the sort compare 8 bytes first; equal hashes still compare the keys.
    """
    leading = [F.xxhash64(*keys)] if hashed else []
    window = Window.partitionBy(*leading, *keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(window)).where("_rn = 1").drop("_rn")


def resolve_label(
    df: DataFrame,
    text_column: str = "customer_clean_text",
    *,
    known: Sequence[str] = ("intent", "gold_intent"),
    rules: Mapping[str, Sequence[str]] = fv.KEYWORD_RULES,
    default: str = fv.GENERAL_INTENT,
    output: str = "intent",
) -> DataFrame:
    """Per row: the first label present among ``known``, else the keyword label."""
    present = [F.nullif(F.trim(F.col(c)), F.lit("")) for c in known if c in df.columns]
    return df.withColumn(
        output, F.coalesce(*present, tx.keyword_label(F.col(text_column), rules, default)))


def taxonomy_frame(spark, rules: Mapping[str, Sequence[str]] = fv.KEYWORD_RULES) -> DataFrame:
    """The labels as a dimension table (label, priority, description, keywords)."""
    return spark.createDataFrame(
        [(label, i, text, list(rules.get(label, [])))
         for i, (label, text) in enumerate(fv.INTENT_DESCRIPTIONS.items())],
        "label string, priority int, description string, keywords array<string>")


def sample_rows(
    df: DataFrame, n: int = fv.SAMPLE_ROWS, *, key: str, seed: int = fv.SEED,
    order: Column | None = None,
) -> DataFrame:
    """``n`` rows in hash order: the same rows however the table is partitioned."""
    order = F.xxhash64(F.col(key), F.lit(seed)) if order is None else order
    return df.orderBy(order, F.col(key)).limit(n)


def sample_per_stratum(
    df: DataFrame, strata: Sequence[str], n: int, *, key: str, seed: int = fv.SEED,
    order: Column | None = None,
) -> DataFrame:
    """Up to ``n`` rows per stratum in hash order (limited per task before the shuffle)."""
    order = F.xxhash64(F.col(key), F.lit(seed)) if order is None else order
    window = Window.partitionBy(*strata).orderBy(order, F.col(key))
    return df.withColumn("_rn", F.row_number().over(window)).where(F.col("_rn") <= n).drop("_rn")
