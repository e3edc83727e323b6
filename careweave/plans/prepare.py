"""From raw messages to the processed pair table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from careweave import fixed_values as fv
from careweave.operators.curation import preprocess_messages
from careweave.operators.pairing import brand_statistics, reconstruct_pairs, supplement_small
from careweave.session import materialize
from careweave.sources.messages import scan_messages
from careweave.sources.store import write_pairs


def prepare_pairs(messages: DataFrame, brand: str = fv.DEFAULT_BRAND, *,
                  supplement: bool = False) -> tuple[DataFrame, DataFrame]:
    """(pairs, statistics); pairs are computed once and feed both.

    With ``supplement`` written pairs are added where there are few.
    """
    clean = preprocess_messages(messages, brand)
    pairs = materialize(reconstruct_pairs(clean, brand))
    statistics = brand_statistics(clean, brand, pairs=pairs)
    return supplement_small(pairs) if supplement else pairs, statistics


def run(spark: SparkSession, source: str, target: str, *, brand: str = fv.DEFAULT_BRAND,
        fallback: str | None = None, max_rows: int | None = None,
        supplement: bool = False) -> DataFrame:
    """Scan, pair, supplement on request, write; returns the brand statistics."""
    pairs, statistics = prepare_pairs(
        scan_messages(spark, source, fallback=fallback, max_rows=max_rows), brand,
        supplement=supplement)
    write_pairs(pairs, target)
    return statistics
