"""Keeping evaluation texts out of training and retrieval."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from careweave import fixed_values as fv
from careweave.functions import text as tx
from careweave.operators.skew import HOT_ROWS, salted_join, split_join

_KEY = "_text_key"


def hex_digest(column: str) -> Column:
    """64 characters that stand for a text: two texts have the same where their text keys are."""
    return F.sha2(tx.text_key(F.col(column)), 256)


def _digest(column: str) -> Column:
    """32 bytes that stand for a text key in a shuffle; null where the text is."""
    return F.unhex(hex_digest(column))


def _keyed(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(_KEY, _digest(column))


def _keys(df: DataFrame, column: str) -> DataFrame:
    return df.select(_digest(column).alias(_KEY)).distinct()


def exclude_golden(
    train: DataFrame, golden: DataFrame, *, train_text: str = "customer_clean_text",
    golden_text: str = "customer_clean_text",
) -> DataFrame:
    """Training rows whose text is not an evaluation text.

    A text may have very many copies in training, and the evaluation set is the small side, so
    its keys are repeated for every part rather than counting the training texts first.
    """
    return salted_join(
        _keyed(train, train_text), _keys(golden, golden_text), _KEY, "left_anti").drop(_KEY)


def leaked_golden(
    train: DataFrame, golden: DataFrame, *, train_text: str = "customer_clean_text",
    golden_text: str = "customer_clean_text", hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Evaluation rows whose text also occurs in training."""
    return split_join(
        _keyed(golden, golden_text), _keys(train, train_text), _KEY, "left_semi",
        min_rows=hot_rows).drop(_KEY)


def assert_no_leak(train: DataFrame, golden: DataFrame, **columns: str) -> bool:
    """Action: raise with the count and one example when an evaluation text is in training."""
    text = columns.get("golden_text", "customer_clean_text")
    found = leaked_golden(train, golden, **columns).agg(
        F.count("*").alias("n"), F.min(text).alias("example")).head()
    if found["n"]:
        raise ValueError(fv.LEAK_ERROR.format(n=found["n"], example=found["example"]))
    return True


def self_match(
    query_id: Column, query_text: Column, case_customer_id: Column, case_text: Column,
    case_pair_id: Column | None = None, *, substring: bool = False,
) -> Column:
    """True where a retrieved case is the query itself: same id, or the same text key.

    By default the id must equal one of the two ids in the pair id; with ``substring`` any
    occurrence inside the pair id counts.
    """
    has_id = F.coalesce(query_id, F.lit("")) != ""
    same_id = query_id.eqNullSafe(case_customer_id)
    if case_pair_id is not None:
        pair = F.coalesce(case_pair_id, F.lit(""))
        same_id = same_id | (
            pair.contains(query_id) if substring
            else (pair.startswith(F.concat(query_id, F.lit("_")))
                  | pair.endswith(F.concat(F.lit("_"), query_id)) | (pair == query_id)))
    key = tx.text_key(query_text)
    return F.coalesce(has_id & same_id, F.lit(False)) | ((key != "") & (key == tx.text_key(case_text)))


def mask_self(
    cases: DataFrame, *, query_id: str, query_text: str, case_customer_id: str, case_text: str,
    case_pair_id: str | None = None, substring: bool = False,
) -> DataFrame:
    """Drop the rows of a (query, case) frame where the case is the query itself."""
    return cases.where(~self_match(
        F.col(query_id), F.col(query_text), F.col(case_customer_id), F.col(case_text),
        None if case_pair_id is None else F.col(case_pair_id), substring=substring))


def reply_is_safe(true_reply: Column, retrieved_reply: Column) -> Column:
    """False when a retrieved reply equals the true reply (both non-empty)."""
    a, b = tx.text_key(true_reply), tx.text_key(retrieved_reply)
    return ~((a != "") & (b != "") & (a == b))
