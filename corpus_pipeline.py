"""Prepare a training corpus: five stages, each written before the next reads it.

A stage decides by narrow rows under a key of the row and applies its decision to the documents in
one join. Its own tables are deleted when the next stage begins: by then its result is written.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from careweave.llm import bpe, exact, minhash, mixture, queries
from careweave.llm.quality import keep
from careweave.session import discard, materialize, recorded_tables

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
_left_over: list[str] = []


def _stage(function: Stage) -> Stage:
    """Delete what the stage before has left, and remember what this one leaves."""
    @wraps(function)
    def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        discard(spark, _left_over)
        _left_over.clear()
        with recorded_tables() as paths:
            kept = function(spark, docs, sf_dir)
        _left_over.extend(paths)
        return kept
    return stage


def _keyed(docs: DataFrame) -> DataFrame:
    """Every row as ``doc`` under a key of its own: 16 bytes from its place in the files it is read
    from; rows that come from elsewhere are written first, so that their key stays."""
    doc = F.struct(*[docs[c] for c in docs.columns]).alias("doc")
    place = F.concat_ws(":", F.col("_metadata.file_path"), F.col("_metadata.row_index"))
    try:
        return docs.select(F.unhex(F.md5(place)).alias("row_key"), doc)
    except AnalysisException:
        return materialize(docs.select(F.monotonically_increasing_id().alias("row_key"), doc))


def _fields(keyed: DataFrame) -> list[Column]:
    return [F.col("doc").getField(c).alias(c) for c in keyed.schema["doc"].dataType.names]


def _by_key(keyed: DataFrame) -> DataFrame:
    return keyed.select(F.col("row_key").alias("doc_id"), F.col("doc.text").alias("text"))


def _one_each(keyed: DataFrame, groups: DataFrame, best: Column) -> DataFrame:
    """Of every group (row_key, g) of rows the row that ``best``, an aggregate of (id, row_key),
    names; rows in no group stay. What goes grows with the documents, so nothing is broadcast."""
    ids = keyed.select("row_key", F.col("doc.doc_id").alias("id"))
    groups = groups.join(ids.hint("merge"), "row_key")
    chosen = groups.groupBy("g").agg(best.getField("row_key").alias("best"))
    out = materialize(groups.join(chosen.hint("merge"), "g").where("row_key <> best").select("row_key"))
    return keyed.join(out.hint("merge"), "row_key", "left_anti").select(_fields(keyed))


@_stage
def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.5 or more."""
    return keep(docs, queries.quality_model(spark, sf_dir), 0.5)


@_stage
def exact_once(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts one row: one with the largest doc_id; null ids count as the smallest."""
    keyed = _keyed(docs)
    groups = exact.exact_groups(_by_key(keyed)).where("group_size > 1").select(
        F.col("doc_id").alias("row_key"), F.col("keep_id").alias("g"))
    return _one_each(keyed, groups, F.max(F.struct("id", "row_key")))


@_stage
def near_once(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked at 0.8 Jaccard or more one row: one with the smallest doc_id, null ids
    last.

    42 bands of 6 minima miss about 3e-6 of the pairs at 0.8, with as many hashes as 36 of 7.
    """
    keyed = _keyed(docs)
    found = minhash.near_duplicates(_by_key(keyed), percent=80, bands=42, rows=6).select(
        F.col("doc_id").alias("row_key"), F.col("component_id").alias("g"))
    sizes = found.groupBy("g").agg(F.count("*").alias("n")).where("n > 1").drop("n")
    return _one_each(keyed, found.join(sizes.hint("merge"), "g"), F.min(
        F.struct(F.col("id").isNull().alias("no_id"), "id", "row_key")))


@_stage
def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole copies for whole passes, and the taken part of a document that a run cuts.

    A cut text is the part of the document from the first taken word to the last, as it stands.
    """
    keyed = _keyed(docs)
    plan = materialize(mixture.mix(keyed.select(
        "row_key", *[F.col("doc").getField(c).alias(c) for c in ("doc_id", "source", "text")]),
        carried=("row_key",)).where("taken > 0").select(
        "row_key", F.struct("size", "passes", "part", "first_word").alias("plan")))
    rows = keyed.join(plan.hint("merge"), "row_key")
    # Every word with the white space before it: joined again, they are the text.
    space = r"[\x20\x09-\x0D]"
    words = F.regexp_extract_all("doc.text", F.lit(f"({space}*{mixture.WORD})"), F.lit(1))
    part = F.array_join(F.slice(words, F.col("plan.first_word").cast("int") + 1,
                                F.col("plan.part").cast("int")), "")
    text = F.when(F.col("plan.part") == F.col("plan.size"), F.col("doc.text")).otherwise(
        F.regexp_replace(part, f"^{space}+", ""))
    none = F.array().cast("array<string>")
    whole = F.when(F.col("plan.passes") > 0, F.array_repeat(
        F.col("doc.text"), F.col("plan.passes").cast("int"))).otherwise(none)
    cut = F.when(F.col("plan.part") > 0, F.array(text)).otherwise(none)
    taken = rows.select("doc", F.explode(F.concat(whole, cut)).alias("taken"))
    changed = {"text": F.col("taken").alias("text"), "n_chars": F.when(
        F.col("taken") == F.col("doc.text"), F.col("doc.n_chars")).otherwise(
        F.length("taken")).cast("long").alias("n_chars")}
    return taken.select([changed.get(name, field) for name, field in zip(docs.columns, _fields(keyed), strict=True)])


@_stage
def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of every document."""
    import public_tokenizers

    return bpe.encode_digests(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("quality", good_quality), ("exact", exact_once), ("near", near_once),
          ("mixture", mixed), ("bpe", encoded)]

ORACLE_SQL = None  # the classifier and the tokenizer have no SQL form


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before: list[str] = []
    for _, stage in STAGES[:-1]:
        kept = stage(spark, docs, sf_dir)
        with recorded_tables() as paths:
            docs = materialize(kept)
        discard(spark, before)
        before = paths
    return STAGES[-1][1](spark, docs, sf_dir)
