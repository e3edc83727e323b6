"""Toxicity: a weighted lexicon matched by Aho-Corasick on folded text."""

from __future__ import annotations

import math
import unicodedata
from collections import Counter
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

# Letters that look like a Latin letter, and digits or signs used for one.
LOOKALIKES = str.maketrans("аеорсухіј013457@$", "aeopcyxijoieasta" + "s")


def fold(text: str | None) -> str:
    """Lower case, compatibility forms, look-alikes and digit substitutions to Latin letters;
    everything that is no letter becomes a space."""
    plain = unicodedata.normalize("NFKC", text or "").lower().translate(LOOKALIKES)
    return "".join(c if c.isalpha() else " " for c in plain)


def learn(docs: DataFrame, labels: DataFrame, rows_per_class: int = 4000,
          shortest: int = 4, longest: int = 12, least: int = 5, margin: float = 3.0):
    """Lexicon of word beginnings, exception phrases: entry -> log odds, from at most
    ``rows_per_class`` rows of each label chosen by hash of the id."""
    def chosen(y: int) -> DataFrame:
        ids = labels.where(F.col("toxic") == y).select("doc_id", "toxic").distinct().orderBy(
            F.xxhash64("doc_id"), "doc_id").limit(rows_per_class)
        return docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")  # so many rows at most

    sample = [chosen(y) for y in (1, 0)]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: dict[int, Counter] = {0: Counter(), 1: Counter()}
            for text, y in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(),
                               strict=True):
                words = set(fold(text).split())
                seen[y].update({w[:n] for w in words for n in range(shortest, longest + 1)
                                if len(w) >= n})
            both = [(w, y, n) for y, c in seen.items() for w, n in c.items()]
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(
                zip(*both, strict=True) if both else ([], [], []),
                (pa.string(), pa.int32(), pa.int64()), strict=True)], names=["w", "y", "n"])

    sizes = [x.count() for x in sample]
    rows = sample[0].unionByName(sample[1]).select("text", F.col("toxic").cast("int").alias("toxic"))
    counts = rows.mapInArrow(count, "w string, y int, n long").groupBy("w").agg(
        F.sum(F.when(F.col("y") == 1, F.col("n")).otherwise(0)).alias("bad"),
        F.sum(F.when(F.col("y") == 0, F.col("n")).otherwise(0)).alias("good"))
    odds = F.log((F.col("bad") + 0.5) / (sizes[0] + 1)) - F.log((F.col("good") + 0.5) / (sizes[1] + 1))
    found = {r.w: (r.bad, r.odds) for r in counts.withColumn("odds", odds).where(
        (F.col("bad") >= least) & (F.col("odds") >= margin)).collect()}
    longer = {}
    for w, (n, _) in found.items():
        longer[w[:-1]] = max(longer.get(w[:-1], 0), n)
    best: dict[str, float] = {}
    for w in sorted(found, key=len):  # the longest beginning that keeps its documents
        if longer.get(w, 0) < 0.9 * found[w][0] and not any(w[:n] in best for n in range(1, len(w))):
            best[w] = found[w][1]
    return best


def scores(docs: DataFrame, lexicon: dict[str, float], exceptions: tuple[str, ...] = (),
           middle: float = 2.0) -> DataFrame:
    """doc_id, score, hits: summed weights at word beginnings outside exception phrases, over
    the square root of the logarithm of the length, through a logistic curve.

    Null and empty texts have no hits; ids pass through; an empty table gives no rows.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = ahocorasick.Automaton()
        for w, weight in lexicon.items():
            machine.add_word(" " + w, (len(w), weight))
        for phrase in exceptions:
            machine.add_word(" " + fold(phrase), (len(fold(phrase)), None))
        if len(machine):
            machine.make_automaton()
        for batch in batches:
            values, hits = [], []
            for text in batch.column("text").to_pylist():
                folded = " " + " ".join(fold(text).split())
                found = list(machine.iter(folded)) if len(machine) else []
                spared = [(end - n, end) for end, (n, weight) in found if weight is None]
                weights = [w for end, (n, w) in found if w is not None and not any(
                    a <= end - n and end <= b for a, b in spared)]
                x = sum(weights) / math.sqrt(1 + math.log1p(folded.count(" ") / 100))
                hits.append(len(weights))
                values.append(1 / (1 + math.exp(-min(30.0, x - middle))))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(values, pa.float64()),
                                              pa.array(hits, pa.int64())],
                                             names=["doc_id", "score", "hits"])
    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double, hits long")
