"""Quality classifier: texts compressed with a dictionary of good and one of bad text."""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, functions as F

from careweave.session import materialize

PIECE, SNIPPET = 4096, 128


class Model:
    """Two dictionaries and the line that turns a size difference into a probability."""

    def __init__(self, good: bytes, bad: bytes, line: tuple[float, float, float]):
        self.good, self.bad, self.line, self.ready = good, bad, line, None

    def features(self, text: str | None) -> tuple[float, float]:
        """Difference of sizes and size under the good one, a byte, over the whole text."""
        if self.ready is None:
            self.ready = [zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(
                x, dict_type=zstandard.DICT_TYPE_RAWCONTENT), write_content_size=False,
                write_checksum=False) for x in (self.good, self.bad)]
        data = (text or "").encode()
        if not data:
            return 0.0, 0.5
        good, bad = (sum(len(c.compress(data[i:i + PIECE])) for i in range(0, len(data), PIECE))
                     for c in self.ready)
        return (bad - good) / len(data), good / len(data)

    def score(self, text: str | None) -> float:
        d, r = self.features(text)
        a, b, c = self.line
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, a * d + b * r + c))))

    def __getstate__(self):
        return {"good": self.good, "bad": self.bad, "line": self.line, "ready": None}


def fit(docs: DataFrame, labels: DataFrame, rows_per_class: int = 1500,
        dictionary_bytes: int = 110_000) -> Model:
    """A model from at most ``rows_per_class`` rows of each label, chosen by hash of the id.

    Rows with null text, id or label are left out. One half of the rows fills the dictionaries with
    distinct snippets from all positions of whole texts, the other half fits the line on whole
    texts, each class weighing the same. The driver gets numbers and the chosen snippets only.
    """
    ids = [labels.where(F.col("quality") == y).select("doc_id", F.lit(y).alias("y")).distinct().orderBy(
        F.xxhash64("doc_id"), "doc_id").limit(rows_per_class) for y in (1, 0)]
    found = materialize(docs.select("doc_id", "text").join(  # bounded by rows_per_class
        F.broadcast(ids[0].unionByName(ids[1])), "doc_id").where("text is not null").withColumn(
        "row", F.monotonically_increasing_id()))
    narrow = found.select("y", "row", "doc_id", F.xxhash64("text").alias("h"))
    rows = {y: [r.row for r in narrow.where(F.col("y") == y).orderBy(
        F.xxhash64("doc_id"), "doc_id", "h", "row").limit(rows_per_class).collect()] for y in (1, 0)}

    def half(y: int, first: int) -> DataFrame:
        chosen = docs.sparkSession.createDataFrame([(r,) for r in rows[y][first::2]], "row long")
        return found.where(F.col("y") == y).join(F.broadcast(chosen), "row")

    def snippets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(),
                                    batch.column("text").to_pylist(), strict=True):
                # Round n holds the n-th snippet by hash of its place, of every text.
                order = sorted((xxhash.xxh3_64_intdigest(f"{doc_id} {i}") >> 1, i)
                               for i in range(0, len(text), SNIPPET))
                yield pa.RecordBatch.from_arrays([
                    pa.array(range(len(order)), pa.int64()), pa.array([h for h, _ in order], pa.int64()),
                    pa.array([text[i:i + SNIPPET] for _, i in order], pa.string())],
                    names=["round", "h", "snippet"])

    def dictionary(y: int) -> bytes:
        cut = half(y, 0).select("doc_id", "text").mapInArrow(
            snippets, "round long, h long, snippet string")
        first = cut.groupBy("snippet").agg(F.min(F.struct("round", "h")).alias("at"))
        picked = first.orderBy("at", "snippet").limit(dictionary_bytes // SNIPPET * 2).collect()
        return "".join(r.snippet for r in picked).encode()[:dictionary_bytes] or b"\n" * 8

    model = Model(dictionary(1), dictionary(0), (0.0, 0.0, 0.0))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = [model.features(x) for x in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs], pa.float64())
                                              for k in (0, 1)], names=["d", "r"])

    points = [((r.d, r.r), y) for y in (1, 0) for r in half(y, 1).select("text").mapInArrow(
        features, "d double, r double").orderBy("d", "r").collect()]
    model.line = _logistic(points)
    return model


def _logistic(points: list) -> tuple[float, float, float]:
    import numpy as np

    if len({y for _, y in points}) < 2:
        return 0.0, 0.0, 2.0 if points and points[0][1] else 0.0
    x = np.array([[d, r, 1.0] for (d, r), _ in points])
    y = np.array([float(v) for _, v in points])
    w = np.zeros(3)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (y - p) - 1e-3 * w
        w = w + np.linalg.solve((x.T * (p * (1 - p))) @ x + 1e-3 * np.eye(3), slope)
    return tuple(float(v) for v in w)


def scores(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score of every whole text; null counts as empty, which scores by the line alone.

    Ids pass through; other columns are ignored; an empty table gives no rows.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(
                [model.score(x) for x in batch.column("text").to_pylist()], pa.float64())],
                names=["doc_id", "score"])
    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double")


def keep(docs: DataFrame, model: Model, least: float) -> DataFrame:
    """The whole rows whose text scores ``least`` or more; ids play no part."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array([model.score(x) >= least for x in
                                         batch.column("text").to_pylist()], pa.bool_()))
    return docs.mapInArrow(run, docs.schema)
