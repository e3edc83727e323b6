"""How well two raters agree on a 1-5 scale, from histograms instead of row-by-row ranks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from careweave.functions.numbers import rating_bin, ratio, round_columns
from careweave.session import materialize

MEASURES = [
    "spearman_correlation", "weighted_cohens_kappa", "exact_agreement",
    "agreement_within_1_point", "pearson_correlation", "mean_absolute_error",
]


def average_ranks(histogram: DataFrame) -> DataFrame:
    """(side, v, rank): average rank of each distinct value within its side, from (side, v, n).

    Values are dealt out by ranges, whose number follows the data; the ranges are written with
    their number, so that totals and rows mean the same ones. A range's ranks begin behind the
    totals of the ranges before it (one row per range and side), and inside a range they come
    from a window over that range alone.
    """
    ranged = materialize(histogram.repartitionByRange("side", "v").withColumn(
        "range", F.spark_partition_id()))
    before = Window.partitionBy("side").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranged.groupBy("side", "range").agg(F.sum("n").alias("t")).select(
        "side", "range", F.coalesce(F.sum("t").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy("side", "range").orderBy("v").rowsBetween(Window.unboundedPreceding, -1)
    return ranged.join(starts, ["side", "range"]).select(
        "side", "v",
        (F.col("start") + F.coalesce(F.sum("n").over(inside), F.lit(0)) + (F.col("n") + 1) / 2.0)
        .alias("rank"))


def _correlation(x: str, y: str) -> Column:
    """Correlation weighted by ``n``; 0 where a side is constant or there are fewer than 2 rows."""
    a, b, n = F.col(x), F.col(y), F.col("n")
    total = F.sum(n)
    covariance = F.sum(n * a * b) / total - (F.sum(n * a) / total) * (F.sum(n * b) / total)

    def spread(c: Column) -> Column:
        mean = F.sum(n * c) / total
        return F.sqrt(F.greatest(F.lit(0.0), F.sum(n * c * c) / total - mean * mean))

    constant = (F.min(a) == F.max(a)) | (F.min(b) == F.max(b)) | (total < 2)
    return F.when(constant, F.lit(0.0)).otherwise(ratio(covariance, spread(a) * spread(b)))


def rater_agreement(
    ratings: DataFrame, human: str = "human", judge: str = "judge", *,
    first_n: int | None = None, order: str = "id",
) -> DataFrame:
    """One row of agreement measures; all 0 for fewer than two rated rows."""
    rated = ratings.where(F.col(human).isNotNull() & F.col(judge).isNotNull())
    if first_n is not None:
        rated = rated.orderBy(order).limit(first_n)
    # Equal rating pairs collapse first; everything below reads the few that are left, several
    # times, so they are computed once.
    cells = materialize(rated.groupBy(F.col(human).alias("h"), F.col(judge).alias("j")).agg(
        F.count("*").alias("n")))
    sides = F.array(F.struct(F.lit("h").alias("side"), F.col("h").alias("v"), "n"),
                    F.struct(F.lit("j").alias("side"), F.col("j").alias("v"), "n"))
    histogram = cells.select(F.inline(sides)).groupBy("side", "v").agg(F.sum("n").alias("n"))
    ranks = average_ranks(histogram)

    def ranks_of(side: str) -> DataFrame:
        return ranks.where(F.col("side") == side).select(
            F.col("v").alias(side), F.col("rank").alias(f"r{side}"))

    facts = cells.agg(F.struct(
        F.sum("n").alias("rows"),
        F.sort_array(F.array_union(F.collect_set(rating_bin(F.col("h"))),
                                   F.collect_set(rating_bin(F.col("j"))))).alias("labels")))
    # Ranks are centred for the sums; quadratic weights use the position in the sorted union of
    # bins that occur.
    half = (F.col("facts.rows") + 1) / 2.0
    placed = (
        cells.join(ranks_of("h"), "h").join(ranks_of("j"), "j")
        .withColumn("facts", facts.scalar())
        .withColumns({"rh": F.col("rh") - half, "rj": F.col("rj") - half,
                      "bh": rating_bin(F.col("h")), "bj": rating_bin(F.col("j"))})
        .withColumns({"ih": F.array_position("facts.labels", F.col("bh")).cast("double"),
                      "ij": F.array_position("facts.labels", F.col("bj")).cast("double")}))
    n, ih, ij = F.col("n"), F.col("ih"), F.col("ij")
    total = F.sum(n)
    observed = F.sum(n * (ih - ij) * (ih - ij))
    # Sum of w * expected over all label pairs, written with moments: no label cross product.
    expected = F.sum(n * ih * ih) + F.sum(n * ij * ij) - 2.0 * F.sum(n * ih) * F.sum(n * ij) / total
    kappa = F.when(expected == 0, F.lit(0.0)).otherwise(1.0 - F.try_divide(observed, expected))
    gap = F.abs(F.col("bh") - F.col("bj"))
    out = placed.agg(
        _correlation("rh", "rj").alias("spearman_correlation"),
        kappa.alias("weighted_cohens_kappa"),
        ratio(F.sum(F.when(gap == 0, n).otherwise(0)), total).alias("exact_agreement"),
        ratio(F.sum(F.when(gap <= 1, n).otherwise(0)), total).alias("agreement_within_1_point"),
        _correlation("h", "j").alias("pearson_correlation"),
        ratio(F.sum(n * F.abs(F.col("h") - F.col("j"))), total).alias("mean_absolute_error"),
        F.coalesce(total, F.lit(0)).alias("sample_size"))
    enough = F.col("sample_size") >= 2
    out = out.withColumns({
        m: F.when(enough, F.coalesce(F.col(m), F.lit(0.0))).otherwise(F.lit(0.0)) for m in MEASURES})
    return round_columns(out, MEASURES)


def rating_histogram(ratings: DataFrame, human: str = "human", judge: str = "judge") -> DataFrame:
    """Rows per rating 1-5 for both raters, zero where a rating does not occur."""
    scale = ratings.sparkSession.createDataFrame([(r,) for r in range(1, 6)], "rating int")
    rater = ratings.select(
        rating_bin(F.col(human)).alias("human"), rating_bin(F.col(judge)).alias("judge"),
    ).unpivot([], ["human", "judge"], "rater", "rating")
    counts = rater.groupBy("rating").agg(
        F.count_if(F.col("rater") == "human").alias("human"),
        F.count_if(F.col("rater") == "judge").alias("judge"))
    return scale.join(counts, "rating", "left").fillna(0, ["human", "judge"])
