"""Exact deduplication by distributed MSD radix partitioning; equality needs no digest."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from careweave.operators.skew import salted_join
from careweave.session import materialize

#: What counts as the same letter.
CAPITALS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SMALL = b"abcdefghijklmnopqrstuvwxyz"
_FOLD = bytes.maketrans(CAPITALS, SMALL)

SALTS = 4


def normalised(text: str | None) -> bytes:
    """A-Z lower-cased, nothing else; null counts as empty."""
    return (text or "").encode().translate(_FOLD)


def _first(docs: DataFrame, width: int, bodies: bool) -> DataFrame:
    """Every row with its first radix key: the byte length (8 bytes) and the first digit; with
    ``bodies`` also the bytes behind the digit."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [normalised(x) for x in batch.column("text").to_pylist()]
            columns = {"doc_id": batch.column("doc_id"),
                       "key": pa.array([len(x).to_bytes(8) + x[:width] for x in texts], pa.binary()),
                       "left_over": pa.array([max(0, len(x) - width) for x in texts], pa.int64()),
                       "text_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in texts], pa.string())}
            if bodies:
                columns["body"] = pa.array([x[width:] for x in texts], pa.binary())
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {id_type}, key binary, left_over long, text_sha256 string" + ", body binary" * bodies)


def exact_groups(docs: DataFrame, first: int = 64, factor: int = 16) -> DataFrame:
    """doc_id, keep_id, group_size, text_sha256 of every row; equal texts keep the largest doc_id.

    The radix key is the byte length followed by the bytes, read in digits of ``first``,
    ``first * factor``, ... bytes. Rows whose group is a singleton leave; a group ends when its
    length is used up. The first level counts keys of ``8 + first`` bytes without any body; only
    then the rows of larger groups get the rest of their bytes, by one join on the key, and later
    levels move what is left of those. The table of groups grows with the documents, so it is
    merged, not broadcast, and its rows are repeated for ``SALTS`` parts of a hot key. Null ids
    count as the smallest; rows that share an id share its decision; empty texts equal each other;
    an empty table gives no rows; other columns are ignored.
    """
    narrow = materialize(_first(docs, first, False))
    live, done, width = _first(docs, first, True), [], first
    while True:
        groups = materialize(narrow.groupBy("key").agg(
            F.count("*").alias("n"), F.max("doc_id").alias("top"), F.max("left_over").alias("open"),
        ).where("n > 1").withColumn("g", F.monotonically_increasing_id()))
        placed = salted_join(narrow, groups.select("key", "n", "top").hint("merge"), "key", "left", salts=SALTS)
        done.append(placed.where("n is null or left_over = 0").select(
            "doc_id", F.when(F.col("n").isNull(), F.col("doc_id")).otherwise(F.col("top")).alias("keep_id"),
            F.coalesce("n", F.lit(1)).cast("long").alias("group_size"), "text_sha256"))
        further = groups.where("open > 0").select("key", "g")
        if further.isEmpty():
            break
        rest = salted_join(live.where("left_over > 0"), further.hint("merge"), "key", salts=SALTS)
        width *= factor
        live = materialize(rest.select(
            "doc_id", F.concat(F.unhex(F.lpad(F.hex("g"), 16, "0")), F.substring("body", 1, width)).alias("key"),
            F.greatest(F.col("left_over") - width, F.lit(0)).cast("long").alias("left_over"),
            "text_sha256", F.expr(f"substring(body, {width + 1})").alias("body")))
        narrow = live.drop("body")
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out
