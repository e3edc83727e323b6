"""Mix sources to target weights: Sainte-Lague block quotas, then seeded runs of blocks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from careweave.session import materialize

WORD = r"[^\x20\x09-\x0D]+"


def targets(sources: DataFrame, weights: tuple[int, ...], cap: float) -> DataFrame:
    """source, source_size -> with rank and target: weights repeat by code point, null last.

    A target stops at ``cap`` times its size; the rest is shared again by weight. Sources whose
    size per weight is smallest stop first, so running sums over that order give the level.
    One row per source goes through each window.
    """
    names = Window.partitionBy(F.lit(0)).orderBy(F.asc_nulls_last("source"))
    level = Window.partitionBy(F.lit(0)).orderBy("ratio", "rank")
    full = level.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(F.lit(0))
    listed = F.array(*[F.lit(w) for w in weights])
    out = sources.withColumn("rank", F.row_number().over(names) - 1)
    out = out.withColumn("weight", F.get(listed, F.col("rank") % len(weights)))
    out = out.withColumn("most", F.col("source_size") * cap)
    out = out.withColumn("ratio", F.col("most") / F.col("weight"))
    rest = F.sum("source_size").over(whole) - F.coalesce(F.sum("most").over(full), F.lit(0))
    shared = F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(full), F.lit(0))
    out = out.withColumn("share", rest / shared)
    out = out.withColumn("water", F.max(F.when(F.col("share") <= F.col("ratio"),
                                               F.col("share"))).over(whole))
    return out.select("source", "rank", "source_size", "n_docs", F.least(
        F.col("most").cast("double"),
        F.coalesce(F.col("water") * F.col("weight"), F.col("most").cast("double"))).alias("target"))


def apportion(parts: DataFrame, group: str, key: str, votes: str, seats: str) -> DataFrame:
    """``parts`` with ``quota``: the ``seats`` of a group go to its highest votes / (2 s - 1).

    Seats below a threshold that can't exceed the total are given at once; only about two more
    per row are ranked.
    """
    by = Window.partitionBy(group)
    rows, total = F.count("*").over(by), F.sum(votes).over(by)
    exact = F.when(total > 0, F.col(votes) / total * F.col(seats)).otherwise(0.0)
    part = F.when(F.col(seats) > 0, rows / 2 / F.col(seats)).otherwise(0.0)
    out = parts.withColumn("_exact", exact).withColumn("_part", part)
    out = out.withColumn("_sure", F.floor(F.col("_exact") * F.greatest(
        1 - F.col("_part"), F.lit(0.0)) + 0.5))
    out = out.withColumn("_upto", F.floor(F.col("_exact") * (1 + F.col("_part")) + 0.5) + 1)
    open_seats = F.col(seats) - F.sum("_sure").over(by)
    out = out.withColumn("_open", open_seats)
    ranked = out.select(group, key, votes, "_open", F.explode(
        F.sequence(F.col("_sure") + 1, F.col("_upto"))).alias("_seat"))
    order = Window.partitionBy(group).orderBy(F.desc(F.col(votes) / (2 * F.col("_seat") - 1)), key)
    won = ranked.withColumn("_place", F.row_number().over(order)).where("_place <= _open")
    won = won.groupBy(group, key).agg(F.count("*").alias("_won"))
    return out.join(won, [group, key], "left").withColumn(
        "quota", F.col("_sure") + F.coalesce("_won", F.lit(0))).drop(
        "_exact", "_part", "_sure", "_upto", "_open", "_won")


def mix(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), cap: float = 3.0,
        block_words: int = 16, shard_rows: int = 20_000, seed: int = 7,
        carried: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, source, size, source_size, target, taken, first_word of every document.

    A shard orders its documents by a seeded hash and cuts their words into equal blocks; its
    quota of blocks is whole passes and one run of blocks from a seeded start, so at most two
    documents of a shard are cut. Null text has size 0 and takes 0; a null source is a source;
    rows with equal or null ids keep their own row; an empty table gives no rows; other columns
    are ignored, but for ``carried`` ones, which order equal ids. ``first_word`` is where the words of the last pass begin in the document.
    """
    rows = materialize(docs.select(*carried, "doc_id", "source", F.coalesce(
        F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size")))
    sources = targets(rows.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count("*").alias("n_docs")), weights, cap)
    sources = sources.withColumn("all_seats", F.round(
        F.sum("target").over(Window.partitionBy(F.lit(0))) / block_words).cast("long"))
    sources = materialize(apportion(sources.withColumn("all", F.lit(0)), "all", "rank",
                                    "target", "all_seats").withColumnRenamed("quota", "blocks"))
    placed = rows.join(sources.withColumnRenamed("source", "_source"),
                       F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    placed = placed.withColumn("at", F.xxhash64(F.lit(seed), "doc_id", "size"))
    placed = placed.withColumn("shard", F.pmod(
        "at", F.ceil(F.col("n_docs") / shard_rows)).cast("long"))
    shards = placed.groupBy("rank", "shard", "blocks", "target", "source_size").agg(
        F.sum("size").alias("shard_size"))
    shards = apportion(shards, "rank", "shard", "shard_size", "blocks").withColumn(
        "n_blocks", F.ceil(F.col("shard_size") / block_words))
    shards = shards.withColumn("quota", F.when(
        F.col("target") >= F.col("source_size") * cap, F.floor(F.col("n_blocks") * cap))
        .otherwise(F.least("quota", F.floor(F.col("n_blocks") * cap))))
    n = F.greatest("n_blocks", F.lit(1))
    shards = materialize(shards.select(
        "rank", "shard", "shard_size", F.floor(F.col("quota") / n).alias("passes"),
        (F.pmod("quota", n) * block_words).alias("run"),
        (F.pmod(F.xxhash64(F.lit(seed), "rank", "shard"), n) * block_words).alias("start")))
    upto = Window.partitionBy("rank", "shard").orderBy("at", "doc_id", "size", *carried).rowsBetween(
        Window.unboundedPreceding, 0)
    spots = placed.withColumn("end", F.sum("size").over(upto)).join(shards, ["rank", "shard"])
    begin = F.col("end") - F.col("size")
    last = F.col("start") + F.col("run")
    over = last - F.ceil(F.col("shard_size") / block_words) * block_words
    a = F.greatest(F.least("end", last) - F.greatest(begin, F.col("start")), F.lit(0))
    b = F.greatest(F.least(F.col("end"), over) - begin, F.lit(0))
    return spots.select(
        *carried, "doc_id", "source", "size", "source_size", "target", "passes", (a + b).alias("part"),
        (F.col("passes") * F.col("size") + a + b).cast("long").alias("taken"),
        F.when(b > 0, F.lit(0)).otherwise(F.greatest(F.col("start") - begin, F.lit(0)))
        .cast("long").alias("first_word"))
