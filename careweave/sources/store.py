"""Readers and writers for the tables a run leaves behind."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from careweave.sources.generators import GOLDEN_SCHEMA

PAIR_COLUMNS = [
    "pair_id", "customer_tweet_id", "customer_author_id", "customer_query", "customer_clean_text",
    "support_tweet_id", "support_author_id", "support_response", "support_clean_text", "created_at",
]
PAIR_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in PAIR_COLUMNS])
METRIC_SCHEMA = T.StructType([
    T.StructField("component", T.StringType()), T.StructField("system", T.StringType()),
    T.StructField("metric", T.StringType()), T.StructField("value", T.DoubleType()),
])
_CSV = {"header": True, "multiLine": True, "escape": '"'}


def write_pairs(pairs: DataFrame, path: str, fmt: str = "parquet") -> None:
    writer = pairs.write.mode("overwrite")
    writer.options(**_CSV).csv(path) if fmt == "csv" else writer.format(fmt).save(path)


def read_pairs(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    if fmt != "csv":
        return spark.read.format(fmt).load(path)
    columns = spark.read.option("header", True).csv(path).columns
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return spark.read.schema(schema).options(**_CSV).csv(path).fillna("", subset=PAIR_COLUMNS)


def write_golden(golden: DataFrame, path: str) -> None:
    """JSON lines and CSV side by side, as ``<path>/json`` and ``<path>/csv``."""
    golden.write.mode("overwrite").json(f"{path}/json")
    golden.write.mode("overwrite").options(**_CSV).csv(f"{path}/csv")


def read_golden(spark: SparkSession, path: str, *, array_file: bool = False) -> DataFrame:
    """JSON lines, or one JSON array per file with ``array_file``."""
    return spark.read.schema(GOLDEN_SCHEMA).option("multiLine", array_file).json(path)


def index_corpus(spark: SparkSession, pairs_path: str, golden_path: str) -> DataFrame:
    """Processed pairs where they exist, else the evaluation items."""
    pairs = read_or_empty(spark, pairs_path, None)
    return pairs if pairs is not None else read_golden(spark, golden_path)


def write_predictions(predictions: DataFrame, path: str) -> None:
    predictions.write.mode("overwrite").parquet(path)


def write_failures(failures: DataFrame, path: str) -> None:
    failures.write.mode("overwrite").options(**_CSV).csv(path)


def write_metrics(metrics: DataFrame, path: str) -> None:
    """Long metric rows as one JSON document: {component: {system: {metric: value}}}."""
    by_system = metrics.groupBy("component", "system").agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("metric", "value")))).alias("m"))
    by_component = by_system.groupBy("component").agg(
        F.map_from_entries(F.collect_list(F.struct("system", "m"))).alias("s"))
    document = by_component.agg(
        F.to_json(F.map_from_entries(F.collect_list(F.struct("component", "s")))).alias("value"))
    document.coalesce(1).write.mode("overwrite").text(path)


def read_or_empty(
    spark: SparkSession, path: str, schema: T.StructType | None, fmt: str = "parquet"
) -> DataFrame | None:
    """The table at ``path``; an empty frame of ``schema`` (or None) where there is none."""
    try:
        reader = spark.read if schema is None or fmt == "parquet" else spark.read.schema(schema)
        return reader.options(**(_CSV if fmt == "csv" else {})).format(fmt).load(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
    return None if schema is None else spark.createDataFrame([], schema)
