"""What the similarity joins share: their two sides, masks, blocks and the merge of partial lists."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from careweave.functions import text as tx
from careweave.session import task_slots

BLOCK_ROWS = 65536
_MIN_BLOCK_ROWS = 64
GROUP = "_grp"


def side(df: DataFrame, key: str, vector: str, ids: str | None, prefix: str,
         masks: list[Column], group: Column | None = None) -> DataFrame:
    """One side of a join: ``query_id`` or ``case_id``, vec, ids (sparse vectors), m1..m3."""
    empty = F.lit(None).cast("string")
    columns = [F.col(key).alias(f"{prefix}_id"), F.col(vector).alias("vec")]
    if group is not None:
        columns.insert(0, group.alias(GROUP))
    if ids is not None:
        columns.append(F.col(ids).alias("ids"))
    columns += [(masks[i] if i < len(masks) else empty).alias(f"m{i + 1}") for i in range(3)]
    return df.select(*columns)


def masks(df: DataFrame, ids: list[str], text: str | None) -> list[Column]:
    """Mask values m1..m3: two ids and the digest of the text key, prefixed to keep them apart.

    Every row is copied to many blocks; a digest travels lighter than the text.
    """
    none = F.lit(None).cast("string")
    values = [F.when(F.col(c).cast("string") != "", F.concat(F.lit("i:"), F.col(c).cast("string")))
              for c in ids[:2]]
    values += [none] * (2 - len(values))
    if text is None:
        return [*values, none]
    key = tx.text_key(F.col(text))
    return [*values, F.when(key != "", F.concat(F.lit("t:"), F.md5(key)))]


def block_count(n: Column, block_rows: int, slots: int) -> Column:
    """Blocks for ``n`` rows: enough to bound their size, and some more to occupy the tasks."""
    wanted = F.least(F.lit(slots), F.ceil(n / float(_MIN_BLOCK_ROWS)))
    return F.greatest(F.lit(1), F.ceil(n / float(block_rows)), wanted).cast("int")


def block_join(queries: DataFrame, cases: DataFrame, kernel: Callable, block_rows: int,
               counts: tuple[int, int] | None = None) -> DataFrame:
    """The lists of every query for every block of cases: the full scan.

    Both sides are cut by a hash of their id into blocks of at most about ``block_rows`` rows, and
    every query block meets every case block in one task. ``counts`` of both sides, where known.
    """
    slots = task_slots(queries.sparkSession)
    n_query, n_case = counts or (queries.count(), cases.count())
    queries, cases = (df.withColumns({"_nq": block_count(F.lit(n_query), block_rows, slots),
                                      "_nc": block_count(F.lit(n_case), block_rows, 1)})
                      for df in (queries, cases))

    def spread(df: DataFrame, own: str, own_count: str, other: str, other_count: str, key: str):
        return (
            df.withColumn(own, F.pmod(F.xxhash64(key), F.col(own_count)).cast("int"))
            .withColumn(other, F.explode(F.sequence(F.lit(0), F.col(other_count) - 1)))
            .drop("_nq", "_nc")
            .repartition(slots, "_q", "_c")
        )

    left = spread(queries, "_q", "_nq", "_c", "_nc", "query_id").groupBy("_q", "_c")
    right = spread(cases, "_c", "_nc", "_q", "_nq", "case_id").groupBy("_q", "_c")
    return left.cogroup(right).applyInArrow(kernel, list_schema(queries, cases))


def list_schema(queries: DataFrame, cases: DataFrame, *more: T.StructField) -> T.StructType:
    return T.StructType([T.StructField("query_id", queries.schema["query_id"].dataType),
                         T.StructField("case_id", cases.schema["case_id"].dataType),
                         T.StructField("similarity_score", T.DoubleType()), *more])


def ranked(partial: DataFrame, k: int) -> DataFrame:
    window = Window.partitionBy("query_id").orderBy(F.desc("similarity_score"), F.asc("case_id"))
    return (
        partial.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= k)
        .select("query_id", "rank", "case_id", "similarity_score")
    )


def once(partial: DataFrame) -> DataFrame:
    """Lists in which the same case may come twice for a query."""
    return partial.groupBy("query_id", "case_id").agg(
        F.max("similarity_score").alias("similarity_score"))
