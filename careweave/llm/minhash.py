"""Near-duplicates: banded MinHash, odd sketches as a filter, exact sets as the proof.

Two parity bitmaps filter candidates. One folds the MinHash samples: its XOR population count
estimates the similarity, and five sigmas are allowed for. The other folds the whole set: an
element of both sets cancels out, so its count never exceeds the symmetric difference, and a pair
that differs in more bits than the threshold allows elements is none, without any error.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from careweave.operators.skew import split_join
from careweave.session import discard, materialize, recorded_tables

WORDS, BANDS, ROWS, BITS, SET_BITS = 5, 36, 7, 1024, 2048
STAR_ROUNDS = 2
HUB_PAIRS = 5000
_ODD = np.uint64(0x9E3779B97F4A7C15)


class Shingles:
    """Sorted distinct 64-bit hashes of word shingles; remembers a bounded number of words."""

    def __init__(self, remembered: int = 200_000):
        self.known, self.remembered = {}, remembered

    def words(self, data: bytes) -> np.ndarray:
        known, words = self.known, data.lower().split()
        if len(known) > self.remembered:
            known.clear()
        for w in words:
            if w not in known:
                known[w] = xxhash.xxh3_64_intdigest(w)
        return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))

    def of(self, text: str | None, size: int = WORDS) -> np.ndarray:
        w = self.words((text or "").encode())
        if not len(w):
            return w
        size = min(size, len(w))
        mixed = np.full(len(w) - size + 1, size, np.uint64)
        for j in range(size):
            mixed = (mixed ^ w[j:len(w) - size + 1 + j]) * _ODD
            mixed ^= mixed >> np.uint64(29)
        return np.unique(mixed)


class Sketcher:
    """Band keys and odd sketch of a shingle set."""

    def __init__(self, bands: int, rows: int, seed: int = 11):
        random = np.random.default_rng(seed)
        self.bands, self.rows, k = bands, rows, bands * rows
        self.a = random.integers(0, 2**31, k, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
        self.b = random.integers(0, 2**32, k, dtype=np.uint32)
        self.salt = random.integers(1, 2**63, k, dtype=np.uint64) | np.uint64(1)

    def minima(self, hashes: np.ndarray) -> np.ndarray:
        short = (hashes >> np.uint64(32)).astype(np.uint32)
        low = np.full(len(self.a), 2**32 - 1, np.uint32)
        for i in range(0, len(short), 256):
            np.minimum(low, (short[i:i + 256, None] * self.a + self.b).min(axis=0), out=low)
        return low.astype(np.uint64)

    def __call__(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        low = self.minima(hashes)
        keys = np.arange(self.bands, dtype=np.uint64)
        for part in low.reshape(self.bands, self.rows).T:
            keys = (keys ^ part) * _ODD
            keys ^= keys >> np.uint64(31)
        spots = ((low + self.salt) * _ODD >> np.uint64(40)).astype(np.int64) % BITS
        return keys.view(np.int64), parity(spots, BITS)


def parity(spots: np.ndarray, bits: int) -> np.ndarray:
    """A bitmap of which spots occur an odd number of times, as 64-bit words."""
    return np.packbits((np.bincount(spots, minlength=bits) & 1).astype(np.uint8)).view(np.int64)


def features(docs: DataFrame, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, n_shingles, digest of the set, band keys, odd sketches of samples and set."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, sketch = Shingles(), Sketcher(bands, rows)
        for batch in batches:
            out = [[], [], [], [], []]
            for text in batch.column("text").to_pylist():
                h = shingles.of(text)
                keys, odd = sketch(h) if len(h) else (None, None)
                whole = parity((h >> np.uint64(53)).astype(np.int64), SET_BITS) if len(h) else None
                for column, x in zip(out, (len(h), set_digest(h) if len(h) else None, keys, odd, whole), strict=True):
                    column.append(x)
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array(out[0], pa.int64()), pa.array(out[1], pa.binary()),
                *(pa.array(x, pa.list_(pa.int64())) for x in out[2:])],
                names=["doc_id", "n_shingles", "digest", "bands", "odd", "whole"])
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {id_type}, n_shingles long, digest binary, bands array<long>, odd array<long>, "
             "whole array<long>")


def set_digest(hashes: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(hashes.tobytes())


def parity_limit(percent: int, samples: int, sigmas: float = 5.0) -> int:
    """Most differing sketch bits of a pair worth proving: ``sigmas`` below the threshold."""
    j = percent / 100
    low = max(0.0, j - sigmas * math.sqrt(j * (1 - j) / samples))
    return math.ceil(BITS / 2 * (1 - math.exp(-4 * samples * (1 - low) / BITS)))


def _differing(name: str, bits: int) -> Column:
    return sum((F.bit_count(F.col(f"a.{name}")[i].bitwiseXOR(F.col(f"b.{name}")[i]))
                for i in range(bits // 64)), F.lit(0))


def _alike(percent: int, limit: int) -> Column:
    sizes = 100 * F.least("a.n", "b.n") >= percent * F.greatest("a.n", "b.n")
    apart = (100 + percent) * _differing("whole", SET_BITS) <= (100 - percent) * (F.col("a.n") + F.col("b.n"))
    return sizes & (_differing("odd", BITS) <= limit) & apart


def _settled(build: Callable[[], DataFrame]) -> DataFrame:
    """The table that ``build`` ends with; those that it wrote on the way are deleted."""
    with recorded_tables() as paths:
        out = build()
    discard(out.sparkSession, paths[:-1])
    return out


def _proved(docs: DataFrame, classes: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """Pairs of classes whose full sets reach the threshold; each candidate text is read once.

    Texts are found by the id of a class and known by the digest of their set, since several
    texts may share an id.
    """
    ends = materialize(pairs.select(F.col("a").alias("g")).unionByName(pairs.select(F.col("b").alias("g")))
                       .distinct().join(classes.select("g", "digest", "doc_id"), "g"))
    ids = ends.select(F.col("doc_id").alias("_id")).distinct()

    def sets(batches):
        shingles = Shingles()
        for batch in batches:
            found = [shingles.of(x) for x in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([set_digest(h) for h in found], pa.binary()),
                 pa.array([h.tobytes() for h in found], pa.binary())], names=["digest", "hashes"])

    read = docs.select("doc_id", "text").join(ids, F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi")
    found = materialize(read.mapInArrow(sets, "digest binary, hashes binary").join(
        ends.select("g", "digest"), "digest").dropDuplicates(["g"]).select("g", "hashes"))
    # The middle of a star stands in all of its pairs.
    both = split_join(pairs, found.toDF("a", "ha"), "a", min_rows=HUB_PAIRS).join(found.toDF("b", "hb"), "b")

    def prove(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("ha"), batch.column("hb"), strict=True):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                same = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * same >= percent * (len(x) + len(y) - same))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return materialize(both.select("a", "b", "ha", "hb").mapInArrow(prove, "a long, b long").distinct())


def components(edges: DataFrame) -> DataFrame:
    """node, component (smallest node reachable) by large-star and small-star rounds."""
    with recorded_tables() as paths:
        links = materialize(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                            .where("u <> v").distinct())
    seen = None
    while True:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.unionByName(low.where("m < u").select("u", F.col("m").alias("v"))).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(
            F.col("v").alias("u"), F.col("m").alias("v"))
        before = paths
        with recorded_tables() as paths:
            links = materialize(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        discard(links.sparkSession, before)
        now = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if now == seen:
            return links.select(F.col("u").alias("node"), F.col("v").alias("component"))
        seen = now


def near_duplicates(docs: DataFrame, percent: int = 85, bands: int = BANDS,
                    rows: int = ROWS) -> DataFrame:
    """doc_id, n_shingles, component_id of every row: documents linked at ``percent`` Jaccard.

    Equal sets form one class. In every band bucket each class is held against the smallest one;
    then buckets that still hold several components take a class outside the largest one as the
    next middle, a few times over, so that groups without a common middle come together; at last
    the classes outside the largest component of a bucket are held against those of all other
    components. Pairs pass both sketches before their full sets are compared.

    No words: no links. Rows are told apart by their sets, so rows with one id keep their own
    links; a component is named by its smallest id, null ids last (null where all are). Other
    columns are ignored; an empty table gives no rows.
    """
    limit = parity_limit(percent, bands * rows)
    table = materialize(features(docs, bands, rows))
    classes = materialize(table.where("n_shingles > 0").groupBy("digest").agg(
        F.min("doc_id").alias("doc_id"), F.count("*").alias("copies")).withColumn(
        "g", F.monotonically_increasing_id()))
    first = classes.select(F.col("digest").alias("_digest"), F.col("doc_id").alias("_id"), "g")
    one = materialize(table.join(first, (F.col("digest") == F.col("_digest")) & F.col("doc_id").eqNullSafe(
        F.col("_id"))).select("g", F.col("n_shingles").alias("n"), "odd", "whole", "bands").dropDuplicates(["g"]))
    spread = one.select("g", F.explode("bands").alias("key"))
    buckets = spread.groupBy("key").agg(F.min("g").alias("center"), F.count("*").alias("m"))
    members = materialize(spread.join(buckets.where("m > 1"), "key").drop("m"))
    sketches = one.drop("bands")

    def proved(pairs: DataFrame) -> DataFrame:
        a, b = sketches.alias("a"), sketches.alias("b")
        kept = pairs.distinct().alias("p").join(a, F.col("p.a") == F.col("a.g")).join(
            b, F.col("p.b") == F.col("b.g")).where(_alike(percent, limit)).select("p.a", "p.b")
        return _settled(lambda: _proved(docs, classes, materialize(kept), percent))

    def mixed() -> DataFrame:
        """Members of the buckets that hold several components, with the largest one of these."""
        known = members.join(labels, F.col("g") == F.col("node"), "left").select(
            "key", "g", F.coalesce("component", "g").alias("c"))
        counted = known.groupBy("key", "c").agg(F.count("*").alias("n"))
        main = counted.groupBy("key").agg(F.max_by("c", F.struct("n", "c")).alias("main"),
                                          F.count("*").alias("k")).where("k > 1").drop("k")
        return materialize(known.join(main, "key"))

    edges = proved(members.where("g <> center").select(F.col("center").alias("a"), F.col("g").alias("b")))
    labels = components(edges)
    for turn in range(1, STAR_ROUNDS):
        open_ = mixed()
        middles = open_.where("c <> main").groupBy("key").agg(
            F.min_by(F.struct("g", "c"), F.xxhash64("g", F.lit(turn))).alias("middle"))
        more = proved(open_.join(middles, "key").where("c <> middle.c").select(
            F.least("g", "middle.g").alias("a"), F.greatest("g", "middle.g").alias("b")))
        if more.isEmpty():
            break
        edges = edges.unionByName(more)
        labels = components(edges)

    open_ = mixed().join(sketches, "g")
    a, b = open_.where("c <> main").alias("a"), open_.alias("b")
    rest = a.join(b, (F.col("a.key") == F.col("b.key")) & (F.col("a.c") != F.col("b.c"))
                  & ((F.col("b.c") == F.col("b.main")) | (F.col("a.g") < F.col("b.g")))
                  & _alike(percent, limit))
    rest = rest.select(F.least("a.g", "b.g").alias("a"), F.greatest("a.g", "b.g").alias("b")).distinct()
    more = _settled(lambda: _proved(docs, classes, materialize(rest), percent))
    if not more.isEmpty():
        labels = components(edges.unionByName(more))

    # The smallest class of a component is no node of ``labels``.
    named = classes.join(labels, F.col("g") == F.col("node"), "left").select(
        "digest", "doc_id", "copies", F.coalesce("component", "g").alias("c"))
    least = named.groupBy("c").agg(F.min("doc_id").alias("component_id"), F.sum("copies").alias("n")).where("n > 1")
    linked = materialize(named.select("digest", "c").join(least, "c").select("digest", "component_id"))
    out = table.select("doc_id", "n_shingles", "digest").join(linked.withColumn("linked", F.lit(True)), "digest", "left")
    return out.select("doc_id", "n_shingles", F.when(F.col("linked"), F.col("component_id")).otherwise(
        F.col("doc_id")).alias("component_id"))
