"""Threshold-scaled sketches at the share 1: every shingle hash, so short texts keep theirs and
likeness is exact. The sketch of a union is the union of sketches."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, functions as F

from careweave.llm.minhash import Shingles

FLUSH = 8_000_000


def compare(a: np.ndarray, b: np.ndarray) -> tuple[float, float]:
    """Jaccard likeness, and the share of ``a`` that ``b`` contains; no hashes at all: 1."""
    same = len(np.intersect1d(a, b, assume_unique=True))
    whole = len(a) + len(b) - same
    return same / whole if whole else 1.0, same / len(a) if len(a) else 1.0


def text_of(s: np.ndarray) -> str:
    return s.astype(">u8").tobytes().hex(",", -8)


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprint of each text and of the text edited with the head of the next document.

    Documents go to ranges of doc_id; the first of a range also goes to the range before it, so
    text moves once and no range grows with the table. Null text is empty; null ids come last;
    rows with equal ids are ordered by text; an empty table gives no rows; other columns are
    ignored.
    """
    parts = 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"),
                       F.coalesce("doc_id", F.lit(-2**63)).alias("at"))
    rows = rows.withColumn("place", -F.col("at").cast("double"))
    cuts = sorted({*rows.approxQuantile("place", [i / parts for i in range(1, parts)], 0.2 / parts),
                   -math.inf, 0.0, math.inf})
    ranged = Bucketizer(splits=cuts, inputCol="place", outputCol="part").transform(rows).withColumn(
        "part", F.col("part").cast("int")).drop("place")
    heads = ranged.groupBy("part").agg(F.max("at").alias("first"), F.min(F.struct(
        F.bitwise_not("at").alias("k"), "text")).getField("text").alias("t")).orderBy("part")
    firsts = [(r.part, r.first, r.t) for r in heads.collect()]  # one row per range
    spark = docs.sparkSession
    copies = spark.createDataFrame(
        [(None, t, at, firsts[i - 1][0], True) for i, (_, at, t) in enumerate(firsts)],
        "doc_id long, text string, at long, part int, copied boolean")
    dealt = ranged.withColumn("copied", F.lit(False)).unionByName(copies).repartitionById(
        parts, "part").sortWithinPartitions("part", "copied", F.desc("at"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flushed() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in out],
                                              schema=schema)

        shingles, held, out, size = Shingles(), None, [], 0
        for batch in batches:
            for doc_id, text, part, copied in zip(*(batch.column(c).to_pylist() for c in (
                    "doc_id", "text", "part", "copied")), strict=True):
                own = shingles.of(text)
                if held is not None and held[2] == part:
                    n = len(held[1])
                    third = n // 3
                    edited = held[1][:n - third] + text[:third]
                    cut = shingles.of(edited)
                    (a, b), (c, d) = compare(held[3], cut), compare(held[3], own)
                    out.append((held[0], n, hashlib.sha256(edited.encode()).hexdigest(),
                                text_of(held[3]), text_of(cut), a, c, b, d))
                    size += len(out[-1][3]) + len(out[-1][4])
                    if size > FLUSH:  # fingerprints are longer than their texts
                        yield flushed()
                        out, size = [], 0
                held = None if copied else (doc_id, text, part, own)
        yield flushed()

    schema = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
                        ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()),
                        ("near_edited", pa.float64()), ("near_next", pa.float64()),
                        ("held_by_edited", pa.float64()), ("held_by_next", pa.float64())])
    return dealt.mapInArrow(
        run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint "
             "string, near_edited double, near_next double, held_by_edited double, held_by_next double")
