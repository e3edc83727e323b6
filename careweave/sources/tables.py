"""The given parquet tables, mapped to the frames the operators work on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from careweave import fixed_values as fv
from careweave.functions import text as tx
from careweave.functions.numbers import py_round
from careweave.session import spread

BRAND = "BrandHelp"

# Function words per language, named by the intent that stands for the language, so that
# routing, replies and the rubric meet every kind of intent on the given texts.
LANGUAGE_INTENTS = {
    "fr": "DELIVERY_STATUS", "de": "REFUND_RETURN", "es": "PAYMENT_CHARGE", "en": fv.GENERAL_INTENT,
}
LANGUAGE_RULES = {
    "REFUND_RETURN": [" der ", " die ", " und ", " ein"],
    "DELIVERY_STATUS": [" que ", " le ", " une ", "ç"],
    "PAYMENT_CHARGE": [" el ", " los ", " por ", "ñ"],
}


# Tables with costly work per row, which should not hang on the number of files.
_WORK_TABLES = ("documents", "conversations", "pages", "embeddings")


def table(spark: SparkSession, folder: str, name: str, *, dealt: bool = True) -> DataFrame:
    """Without ``dealt`` as it lies in its files, for readers that deal the rows out themselves."""
    df = spark.read.parquet(f"{folder}/{name}.parquet")
    return spread(df) if dealt and name in _WORK_TABLES else df


def messages(conversations: DataFrame, brand: str = BRAND) -> DataFrame:
    """Each turn as a message that answers the turn before it."""
    def turn_id(turn):
        return F.concat_ws("-", F.col("conv_id").cast("string"), turn.cast("string"))

    return conversations.select(
        turn_id(F.col("turn")).alias("tweet_id"),
        F.when(F.col("role") == "assistant", F.lit(brand)).otherwise(
            F.concat_ws("_", "role", F.col("conv_id").cast("string"))).alias("author_id"),
        F.when(F.col("turn") > 0, turn_id(F.col("turn") - 1)).otherwise(F.lit(""))
        .alias("in_reply_to_tweet_id"),
        F.format_string("%06d", "turn").alias("created_at"),
        tx.normalize_missing(F.col("text")).alias("text"),
    )


def split_documents(documents: DataFrame, labels: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(train, golden): the documents people labelled are the golden set, the rest is training."""
    rated = labels.select("doc_id").distinct()
    return documents.join(rated, "doc_id", "left_anti"), documents.join(rated, "doc_id", "left_semi")


def gold_intent():
    return tx.mapped(F.col("lang"), LANGUAGE_INTENTS, fv.GENERAL_INTENT)


def labelled_texts(documents: DataFrame, *keep: str) -> DataFrame:
    """Documents with their gold label, rule label and rule confidence."""
    text = F.col("text")
    labelled = tx.computed_once(
        documents, customer_clean_text=tx.clean_text(text),
        predicted_intent=tx.keyword_label(text, LANGUAGE_RULES),
        confidence=tx.keyword_vote_share(text, LANGUAGE_RULES))
    return labelled.select(
        "doc_id", "customer_clean_text", gold_intent().alias("gold_intent"), "predicted_intent",
        "confidence", *keep, py_round("least(1D, n_chars / 1000D)", 4).alias("top_retrieval_sim"))


def golden_documents(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Labelled documents with the gold escalation flag (low quality or toxic)."""
    flags = labels.select(
        "doc_id", ((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("gold_should_escalate"))
    return labelled_texts(documents.join(flags, "doc_id"), "gold_should_escalate")


def ratings(events: DataFrame) -> DataFrame:
    """Rated pairs: human rating from ``props.k``, judge rating from ``value``."""
    k = F.get_json_object("props", "$.k").cast("double")
    return events.select(
        F.col("event_id").alias("id"),
        (F.lit(1.0) + k / 25.0).alias("human"),
        F.least(F.lit(5.0), F.greatest(F.lit(1.0), F.lit(1.0) + F.col("value") / 100.0)).alias("judge"),
    )
