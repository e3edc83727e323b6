"""Equi-joins whose larger side may hold a large share of its rows under one key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

HOT_KEYS = 1000
HOT_ROWS = 100_000
SALTS = 64
_SALT, _PARTS, _HASH = "_salt", "_parts", "_hash"


def hot_keys(df: DataFrame, key: str, *, keys: int = HOT_KEYS, rows: int = HOT_ROWS) -> DataFrame:
    """Hashes of the ``keys`` most frequent keys with at least ``rows`` rows each.

    Only 8-byte hashes are counted and shuffled, combined per task first. Any key that is not
    returned has fewer than ``rows`` rows, or at most a ``1/keys`` share of the table.
    """
    hashes = df.where(F.col(key).isNotNull()).select(F.xxhash64(key).alias(_HASH))
    counts = hashes.groupBy(_HASH).agg(F.count("*").alias("n")).where(F.col("n") >= rows)
    return counts.orderBy(F.desc("n"), _HASH).limit(keys).select(_HASH)


def _part(parts: Column) -> Column:
    """The part of a row: by its input partition, not by its order, so that a recomputed task
    sends the same rows to the same places."""
    return F.pmod(F.xxhash64(F.spark_partition_id()), parts).cast("int")


def split_join(
    rows: DataFrame, lookup: DataFrame, key: str, how: str = "inner", *,
    hot_source: DataFrame | None = None, salts: int = SALTS, min_rows: int = HOT_ROWS,
) -> DataFrame:
    """Join ``rows`` to ``lookup`` (one row per key), with each hot key cut into ``salts`` parts.

    Only the lookup rows of hot keys are repeated, at most ``HOT_KEYS * salts`` rows.
    ``hot_source`` may name a cheaper frame to count keys on.
    """
    # At most HOT_KEYS rows by the limit above, hence the broadcast.
    hot = F.broadcast(
        hot_keys(rows if hot_source is None else hot_source, key, rows=min_rows)
        .withColumn(_PARTS, F.lit(salts)))

    def marked(df: DataFrame) -> DataFrame:
        return df.withColumn(_HASH, F.xxhash64(key)).join(hot, _HASH, "left").drop(_HASH)

    parts = F.coalesce(F.col(_PARTS), F.lit(1))
    spread = marked(rows).withColumn(_SALT, _part(parts)).drop(_PARTS)
    repeated = marked(lookup).withColumn(
        _SALT, F.explode(F.sequence(F.lit(0), parts - 1))).drop(_PARTS)
    return spread.join(repeated, [key, _SALT], how).drop(_SALT)


def salted_join(
    rows: DataFrame, lookup: DataFrame, key: str, how: str = "inner", *, salts: int = 16
) -> DataFrame:
    """Join ``rows`` to a much smaller ``lookup`` whose every row is repeated ``salts`` times.

    Saves the pass that counts keys; for lookups that are small next to ``rows``.
    """
    spread = rows.withColumn(_SALT, _part(F.lit(salts)))
    repeated = lookup.withColumn(_SALT, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return spread.join(repeated, [key, _SALT], how).drop(_SALT)
