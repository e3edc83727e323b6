"""All metrics as one long table."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F


def long_metrics(df: DataFrame, component: str, metrics: Sequence[str], system: str | None = None,
                 system_name: str = "all") -> DataFrame:
    """(component, system, metric, value) from a wide metric frame."""
    name = F.lit(system_name) if system is None else F.col(system)
    wide = df.select(name.alias("system"), *[F.col(m).cast("double").alias(m) for m in metrics])
    return wide.unpivot(["system"], list(metrics), "metric", "value").select(
        F.lit(component).alias("component"), "system", "metric", "value")


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
