"""Message scan: typed read, column pruning, missing-value rules, row cap."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.errors import AnalysisException

from careweave import fixed_values as fv
from careweave.functions import text as tx

MESSAGE_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in fv.MESSAGE_COLUMNS])
_TIME_FORMAT = "EEE MMM dd HH:mm:ss Z yyyy"


def normalize_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: tx.normalize_missing(F.col(c)) for c in columns if c in df.columns})


def row_cap(df: DataFrame, n: int, *order: Column | str) -> DataFrame:
    """First ``n`` rows in a stated order (a top-n, so no full sort)."""
    return df.orderBy(*order).limit(n)


def _read_csv(spark: SparkSession, path: str) -> DataFrame:
    header = spark.read.option("header", True).csv(path).columns if _exists(spark, path) else []
    known = {f.name: f for f in MESSAGE_SCHEMA}
    # CSV columns are matched by position, so the schema follows the file's own header.
    schema = T.StructType([known.get(name, T.StructField(name, T.StringType())) for name in header])
    return (
        spark.read.schema(schema)
        .option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    )


def _exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.text(path).schema
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return False
    return True


def scan_messages(
    spark: SparkSession,
    path: str,
    *,
    fallback: str | None = None,
    source_format: str = "csv",
    max_rows: int | None = None,
    cap_order: Sequence[str] = ("created_at", "tweet_id"),
) -> DataFrame:
    """Read raw messages as strings; use ``fallback`` where ``path`` is absent, else raise."""
    target = path
    if not _exists(spark, target):
        if fallback is None or not _exists(spark, fallback):
            raise FileNotFoundError(f"no message table at {path}")
        target = fallback
    raw = _read_csv(spark, target) if source_format == "csv" else (
        spark.read.format(source_format).load(target))
    present = [c for c in fv.MESSAGE_COLUMNS if c in raw.columns]
    out = normalize_columns(raw.select(*present), present)
    return out if max_rows is None else row_cap(out, max_rows, *cap_order)


def with_timestamp(df: DataFrame, fmt: str = _TIME_FORMAT) -> DataFrame:
    """Parsed ``created_ts`` next to the text; null where the text does not parse."""
    spelled = F.expr("substring(created_at, 5)")
    return df.withColumn("created_ts", F.try_to_timestamp(
        spelled, F.lit(fmt.replace("EEE ", ""))))
