"""Filter interactions: every document as a word of the filter subsets that it survives."""

from __future__ import annotations

import hashlib
import itertools
import json
from collections import defaultdict
from collections.abc import Callable, Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from careweave.operators.skew import split_join
from careweave.session import materialize

#: The limits and the character sets of the filters.
MIN_WORDS = 200
DISTINCT_PERCENT = 50
CAPITAL_PERCENT = 2
CAPITALS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
MARKS = b"#$%&*|"

PENDING_WORDS = 1 << 20
PENDING_GROUPS = 4096


class Text:
    """A text with its bytes and words (split at the ASCII white space), made once."""

    def __init__(self, text: str | None):
        self.text = text or ""
        self.data = self.text.encode()
        self.words = self.data.split()

    def count(self, characters: bytes) -> int:
        return len(self.data) - len(self.data.translate(None, characters))


TextFilter = Callable[[Text], bool]
#: By letter, true for a text that fails.
TEXT_FILTERS: dict[str, TextFilter] = {
    "A": lambda t: len(t.words) < MIN_WORDS,
    "B": lambda t: 100 * len(set(t.words)) < DISTINCT_PERCENT * len(t.words),
    "C": lambda t: 100 * t.count(CAPITALS) > CAPITAL_PERCENT * len(t.text),
    "D": lambda t: t.count(MARKS) > 0,
}


def survival_words(fails: Column, filters: int) -> Column:
    """The truth table of "survives subset S" for a bit mask of failed filters, bit S of a word."""
    table = [sum(1 << s for s in range(1 << filters) if not s & f) for f in range(1 << filters)]
    return F.get(F.array(*[F.lit(x).cast("long") for x in table]), fails)


def positional_popcount(words: np.ndarray, bits: int) -> np.ndarray:
    """How many words have bit 0, 1, ... set.

    Carry-save adders turn three words of one weight into a sum of that weight and a carry of
    twice the weight, bit by bit in parallel, until at most two words of each weight are left.
    """
    counts, weight, places = np.zeros(bits, np.int64), 1, np.arange(bits, dtype=np.uint32)
    while len(words):
        carries = []
        while len(words) > 2:
            n = len(words) // 3
            a, b, c = words[:n], words[n:2 * n], words[2 * n:3 * n]
            half = a ^ b
            carries.append((a & b) | (half & c))
            words = np.concatenate([half ^ c, words[3 * n:]])
        counts += weight * ((words[:, None] >> places) & np.uint32(1)).sum(axis=0, dtype=np.int64)
        words = np.concatenate(carries) if carries else words[:0]
        weight *= 2
    return counts


def document_words(docs: DataFrame, labels: DataFrame,
                   filters: Mapping[str, TextFilter] = TEXT_FILTERS) -> DataFrame:
    """doc_id, part, good, toxic, word of every row; the last filter fails repeated texts.

    A text is repeated where a smaller doc_id has the same one (by SHA-256 and length). A null
    text is empty, a null source the part ``''``. A null id is neither smaller nor larger than
    another, and has no labels; rows that repeat an id are rows of their own. A document is good
    or toxic if any of its label rows says so. Other columns are ignored; an empty table gives
    no rows.
    """
    tests, of_id = list(filters.values()), docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fails, digests = [], []
            for text in map(Text, batch.column("text").to_pylist()):
                fails.append(sum(1 << k for k, test in enumerate(tests) if test(text)))
                digests.append(hashlib.sha256(text.data).digest() + len(text.data).to_bytes(8))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("part"), pa.array(digests, pa.binary()),
                 pa.array(fails, pa.int32())], names=["doc_id", "part", "digest", "fails"])

    rows = materialize(docs.select(
        "doc_id", F.coalesce("source", F.lit("")).alias("part"), "text").mapInArrow(
        run, f"doc_id {of_id}, part string, digest binary, fails int"))
    repeated = rows.groupBy("digest").agg(
        F.min("doc_id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    rows = split_join(rows, repeated, "digest", "left").select("doc_id", "part", (F.col("fails") + F.when(
        F.col("doc_id") > F.col("first"), 1 << len(tests)).otherwise(0)).alias("fails"))
    marked = labels.where("doc_id is not null").groupBy("doc_id").agg(
        F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"),
        F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic"))
    # Null ids have no labels, and would all meet in one task of the join.
    named = rows.where("doc_id is not null").join(marked, "doc_id", "left")
    unnamed = rows.where("doc_id is null").withColumns({"good": F.lit(False), "toxic": F.lit(False)})
    no = F.lit(False)
    return named.unionByName(unnamed).select(
        "doc_id", "part", F.coalesce("good", no).alias("good"), F.coalesce("toxic", no).alias("toxic"),
        survival_words(F.col("fails"), len(tests) + 1).alias("word"))


def subset_survivors(words: DataFrame, filters: int) -> DataFrame:
    """part, good, toxic, survivors: of each group how many words survive subset 0, 1, ...

    One row per task and group, to be added up; a task holds a bounded number of words and groups.
    """
    bits = 1 << filters

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, held = defaultdict(list), 0
        counts = defaultdict(lambda: np.zeros(bits, np.int64))

        def add():
            for key, parts in waiting.items():
                counts[key] += positional_popcount(np.concatenate(parts), bits)
            waiting.clear()

        def rows():
            keys = list(counts)
            columns = [pa.array([k[0] for k in keys], pa.string()),
                       *(pa.array([k[i] for k in keys], pa.bool_()) for i in (1, 2)),
                       pa.array([counts[k] for k in keys], pa.list_(pa.int64()))]
            counts.clear()
            return pa.RecordBatch.from_arrays(columns, names=["part", "good", "toxic", "survivors"])

        for batch in batches:
            parts = batch.column("part").dictionary_encode()
            label = (batch.column("good").cast(pa.int8()).to_numpy(zero_copy_only=False)
                     + 2 * batch.column("toxic").cast(pa.int8()).to_numpy(zero_copy_only=False))
            code = 4 * parts.indices.to_numpy(zero_copy_only=False).astype(np.int64) + label
            order = np.argsort(code, kind="stable")
            values = batch.column("word").to_numpy(zero_copy_only=False).astype(np.uint32)[order]
            found, starts = np.unique(code[order], return_index=True)
            for c, chunk in zip(found.tolist(), np.split(values, starts[1:]), strict=bool(len(found))):
                waiting[parts.dictionary[c // 4].as_py(), bool(c & 1), bool(c & 2)].append(chunk)
            held += len(values)
            if held >= PENDING_WORDS or len(waiting) + len(counts) >= PENDING_GROUPS:
                add()
                held = 0
                if len(counts) >= PENDING_GROUPS:
                    yield rows()
        add()
        if counts:
            yield rows()

    return words.select("part", "good", "toxic", "word").mapInArrow(
        run, "part string, good boolean, toxic boolean, survivors array<long>")


def filter_orders(letters: str) -> list[dict]:
    """Every order of the filters, a row a step: subsets applied before it and after it."""
    rows = []
    for order in itertools.permutations(letters):
        before = 0
        for step, letter in enumerate(order, 1):
            bit = 1 << letters.index(letter)
            rows.append({"filter_order": "".join(order), "step": step, "bit": bit,
                         "before": before, "after": before | bit})
            before |= bit
    return rows


def audit(docs: DataFrame, labels: DataFrame, filters: Mapping[str, TextFilter] = TEXT_FILTERS,
          repeated: str = "E") -> DataFrame:
    """part, filter_order, step and the counts of every step of every order of the filters.

    All counts of a part follow from the survivors of its subsets; ``shapley`` adds up what a
    filter removes over all orders. Odd rows count as ``document_words`` says.
    """
    letters = "".join(filters) + repeated
    full = (1 << len(letters)) - 1
    counted = subset_survivors(document_words(docs, labels, filters), len(letters))

    def summed(only: Column | None) -> Column:
        values = [F.col("survivors")[i] for i in range(full + 1)]
        return F.array(*[F.sum(v if only is None else F.when(only, v).otherwise(0)) for v in values])

    parts = counted.groupBy("part").agg(
        summed(None).alias("n"), summed(F.col("good")).alias("g"), summed(F.col("toxic")).alias("t"))
    orders = F.from_json(F.lit(json.dumps(filter_orders(letters))), "array<struct<"
                         "filter_order:string,step:int,bit:int,before:int,after:int>>")
    steps = parts.select("*", F.inline(orders))

    def lost(column: str) -> Column:
        return F.get(column, F.col("before")) - F.get(column, F.col("after"))

    failing = F.get("n", F.lit(0)) - F.get("n", F.col("bit"))
    alone = F.get("n", F.lit(full) - F.col("bit")) - F.get("n", F.lit(full))
    return steps.withColumn("removed", lost("n")).select(
        "part", "filter_order", "step", F.get("n", F.col("after")).alias("kept"), "removed",
        (failing - F.col("removed")).alias("redundant"), alone.alias("unique_fails"),
        lost("g").alias("good_lost"), lost("t").alias("toxic_lost"),
        F.sum("removed").over(Window.partitionBy("part", "bit")).alias("shapley"))
