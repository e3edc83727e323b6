"""Top-k over dense unit vectors: full scan, clusters with radii (exact), hashing (approximate)."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
from pyspark.sql import DataFrame, functions as F, types as T

from careweave import fixed_values as fv
from careweave.functions import vectors as vec
from careweave.operators.blocks import BLOCK_ROWS, GROUP, block_join, list_schema, once, ranked
from careweave.session import materialize

MAX_CLUSTERS = 1024
FIT_ROWS = 20_000
TRIED_QUERIES = 256
# Clusters pay when a query can leave out this share of the cases.
LEAST_SKIPPED = 0.5
_MARGIN = 1e-4


def kernel(k: int) -> Callable:
    """Arrow function over one query block and one case block; nested so it ships by value.

    Products in single precision decide which cases can be among the best k; only those get their
    score in double precision.
    """
    rounding = _MARGIN

    def run(left, right):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        out_schema = pa.schema([left.schema.field("query_id"), right.schema.field("case_id"),
                                pa.field("similarity_score", pa.float64())])
        # A list without a value would shift all later rows of the flattened column.
        left, right = (x.filter(pc.is_valid(x["vec"])) for x in (left, right))
        if left.num_rows == 0 or right.num_rows == 0:
            return out_schema.empty_table()
        # Cases in id order, so that among equal scores the smaller id comes first.
        right = right.sort_by("case_id")
        n, dim = right.num_rows, len(right["vec"][0])

        def matrix(column):
            column = column.combine_chunks()
            lengths = np.diff(column.offsets.to_numpy())
            if (lengths != dim).any():
                raise ValueError(f"vectors of {dim} and of {lengths[lengths != dim][0]} values")
            return column.flatten().to_numpy().reshape(len(lengths), dim)

        q_matrix, c_matrix = matrix(left["vec"]), matrix(right["vec"])
        by_key = {}
        for column in ("m1", "m2", "m3"):
            for i, value in enumerate(right[column].to_pylist()):
                if value:
                    by_key.setdefault(value, []).append(i)
        by_key = {value: np.array(found) for value, found in by_key.items()}
        masks = list(zip(*(left[c].to_pylist() for c in ("m1", "m3"))))
        q_single, c_single = q_matrix.astype(np.float32), np.ascontiguousarray(c_matrix.T, np.float32)
        # What rounding to 4 places and single precision can make of two scores.
        longest = [np.linalg.norm(x, axis=1).max(initial=1.0) for x in (q_matrix, c_matrix)]
        margin = np.float32(rounding + 4e-7 * (dim + 1) * longest[0] * longest[1])
        found_q, found_c, found_s = [], [], []
        step = max(1, (1 << 21) // n)
        for start in range(0, len(masks), step):
            near = np.maximum(q_single[start:start + step] @ c_single, np.float32(0))
            for i, values in enumerate(masks[start:start + step]):
                for value in values:
                    if value and value in by_key:
                        near[i, by_key[value]] = -1.0
            # The k-th best score: fewer than k cases lie above it, ties come in id order.
            kth = np.partition(near, n - k, axis=1)[:, n - k] if n > k else np.zeros(len(near), np.float32)
            q, c = np.divmod(np.flatnonzero(near >= np.maximum(kth - margin, np.float32(0))[:, None]), n)
            score = np.empty(len(q))
            for part in np.array_split(np.arange(len(q)), -(-len(q) * dim // (1 << 21)) or 1):
                score[part] = np.einsum("ij,ij->i", q_matrix[start + q[part]], c_matrix[c[part]])
            score = np.round(np.maximum(score, 0.0), 4)
            best = np.lexsort((c, -score, q))
            q, c, score = q[best], c[best], score[best]
            keep = np.arange(len(q)) - np.searchsorted(q, q, "left") < k
            found_q.append(start + q[keep])
            found_c.append(c[keep])
            found_s.append(score[keep])
        return pa.table([left["query_id"].take(pa.array(np.concatenate(found_q))),
                         right["case_id"].take(pa.array(np.concatenate(found_c))),
                         np.concatenate(found_s)], schema=out_schema)

    return run


def full_scan(queries: DataFrame, cases: DataFrame, k: int, block_rows: int = BLOCK_ROWS) -> DataFrame:
    return ranked(block_join(queries, cases, kernel(k), block_rows), k)


def grouped_lists(queries: DataFrame, cases: DataFrame, k: int, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The lists of every query for the cases of its groups; both sides carry ``GROUP``.

    A group of many rows is cut into blocks by a hash of the ids, like a full scan; how many is
    joined to the rows of both sides, which the planner does by the size of that table.
    """
    def blocks(df, name):
        return df.groupBy(GROUP).agg(F.ceil(F.count("*") / float(block_rows)).cast("int").alias(name))

    counts = materialize(blocks(queries, "_nq").join(blocks(cases, "_nc"), GROUP))

    def cut(df, own, own_count, other, other_count, key):
        return df.join(counts, GROUP).withColumn(
            own, F.pmod(F.xxhash64(key), F.col(own_count)).cast("int")).withColumn(
            other, F.explode(F.sequence(F.lit(0), F.col(other_count) - 1))).drop("_nq", "_nc")

    left, right = cut(queries, "_q", "_nq", "_c", "_nc", "query_id"), cut(cases, "_c", "_nc", "_q", "_nq", "case_id")
    return left.groupBy(GROUP, "_q", "_c").cogroup(right.groupBy(GROUP, "_q", "_c")).applyInArrow(
        kernel(k), list_schema(queries, cases))


# --- clusters ----------------------------------------------------------------------

@dataclass(frozen=True)
class VectorIndex:
    """``cases`` with the cluster of each as ``GROUP``; ``centers`` are unit rows, ``radii`` the
    largest angle of a case to its center, ``sizes`` the cases of each cluster."""

    cases: DataFrame
    centers: np.ndarray
    radii: np.ndarray
    sizes: np.ndarray


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), fv.ZERO_NORM)


def fit_centers(sample: np.ndarray, n: int, rounds: int = 5, seed: int = fv.SEED) -> np.ndarray:
    """Spherical k-means on a sample; any centers give exact results, good ones skip more."""
    centers = sample[np.random.default_rng(seed).permutation(len(sample))[:n]]
    for _ in range(rounds):
        of = np.argmax(sample @ centers.T, axis=1)
        sums = np.zeros_like(centers)
        np.add.at(sums, of, sample)
        centers = np.where(np.linalg.norm(sums, axis=1, keepdims=True) > 1e-9, _unit(sums), centers)
    return centers


def _angles(rows: np.ndarray, centers: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(rows @ centers.T, -1.0, 1.0))


def _stack(column) -> np.ndarray:
    """Rows of a list column without nulls; zero and odd rows are the kernel's to judge."""
    rows = [np.asarray(x, float) for x in column.to_pylist()]
    return np.stack(rows) if rows and len({len(x) for x in rows}) == 1 else np.empty((0, 0))


def prepare(cases: DataFrame, *, clusters: int | None = None, fit_rows: int = FIT_ROWS,
            seed: int = fv.SEED) -> VectorIndex:
    """Assign every case to its nearest center and measure the clusters.

    Centers are fitted on at most ``fit_rows`` cases in hash order; there are about as many as
    the root of the cases, at most MAX_CLUSTERS. Cases without a vector are left out, and a zero
    vector, which is like nothing, has the largest possible angle to its center.
    """
    cases = cases.where("vec is not null")
    n = cases.count()
    sample = cases.orderBy(F.xxhash64(F.lit(seed), "case_id"), "case_id").limit(fit_rows).select("vec").collect()
    wanted = clusters or min(MAX_CLUSTERS, max(1, math.isqrt(n)))
    rows = [r.vec for r in sample]
    if len({len(r) for r in rows}) > 1:
        lengths = sorted({len(r) for r in rows})
        raise ValueError(f"vectors of {lengths[0]} and of {lengths[1]} values")
    centers = fit_centers(_unit(np.array(rows)), wanted, seed=seed) if rows else np.zeros((1, 1))

    def assign(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            rows = _stack(batch.column("vec"))
            if len(rows) != batch.num_rows or batch.num_rows and rows.shape[1] != centers.shape[1]:
                raise ValueError(f"vectors of {centers.shape[1]} and of other numbers of values")
            angle = _angles(rows, centers) if len(rows) else np.empty((0, 1))
            if len(rows):
                angle[np.linalg.norm(rows, axis=1) < 0.5] = math.pi
            of = np.argmin(angle, axis=1) if len(rows) else np.empty(0, int)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(of.astype(np.int32)), pa.array(angle[np.arange(len(of)), of])],
                names=[*batch.schema.names, GROUP, "_angle"])

    schema = T.StructType([*cases.schema.fields, T.StructField(GROUP, T.IntegerType()),
                           T.StructField("_angle", T.DoubleType())])
    placed = materialize(cases.mapInArrow(assign, schema))
    radii, sizes = np.zeros(len(centers)), np.zeros(len(centers), np.int64)
    for r in placed.groupBy(GROUP).agg(F.max("_angle").alias("r"), F.count("*").alias("n")).collect():
        radii[r[GROUP]], sizes[r[GROUP]] = r["r"], r["n"]
    return VectorIndex(placed.drop("_angle"), centers, radii, sizes)


def _routed(queries: DataFrame, index: VectorIndex, first: bool) -> DataFrame:
    """Queries once per cluster: the nearest one only, or all others that their ``floor`` leaves.

    A case at angle r from its center is at least at the query's angle to the center less r.
    """
    centers, radii, sizes = index.centers, index.radii, index.sizes
    filled = np.flatnonzero(sizes > 0)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            if not batch.num_rows:
                continue
            rows = _stack(batch.column("vec"))
            if len(rows) != batch.num_rows or rows.shape[1] != centers.shape[1]:
                raise ValueError(f"vectors of {centers.shape[1]} and of other numbers of values")
            angle = _angles(rows, centers[filled])
            nearest = np.argmin(angle, axis=1)
            if first:
                q, c = np.arange(len(rows)), nearest
            else:
                most = np.cos(np.maximum(0.0, angle - radii[filled]))
                floor = batch.column("floor").to_numpy(zero_copy_only=False)[:, None]
                # A zero query is like nothing, wherever its angles point.
                open_ = (most >= floor - _MARGIN) | (floor <= 0) | (np.linalg.norm(rows, axis=1) < 0.5)[:, None]
                open_[np.arange(len(rows)), nearest] = False
                q, c = np.nonzero(open_)
            taken = pa.RecordBatch.from_arrays(batch.columns, names=batch.schema.names).take(pa.array(q))
            yield pa.RecordBatch.from_arrays(
                [*taken.columns, pa.array(filled[c].astype(np.int32))], names=[*batch.schema.names, GROUP])

    return queries.mapInArrow(run, T.StructType(
        [*queries.schema.fields, T.StructField(GROUP, T.IntegerType())]))


def _with_floor(queries: DataFrame, lists: DataFrame, k: int) -> DataFrame:
    """Queries with the k-th score of their nearest cluster; 0 where it has fewer than k."""
    kth = lists.where(F.col("rank") == k).select("query_id", F.col("similarity_score").alias("floor"))
    return queries.join(kth, "query_id", "left").withColumn("floor", F.coalesce("floor", F.lit(0.0)))


def skipped_share(queries: DataFrame, index: VectorIndex, k: int, tried: int = TRIED_QUERIES) -> float:
    """The share of the cases that ``tried`` queries, in hash order, can leave out on average."""
    some = materialize(queries.orderBy(F.xxhash64("query_id"), "query_id").limit(tried))
    near = ranked(grouped_lists(_routed(some, index, True), index.cases, k), k)
    sizes = {i: int(n) for i, n in enumerate(index.sizes) if n}
    sent = _routed(_with_floor(some, near, k), index, False).groupBy(GROUP).count().collect()
    n = some.count()
    seen = sum(r["count"] * sizes[r[GROUP]] for r in sent)
    return 1 - seen / max(1, n * sum(sizes.values()))


def cluster_scan(queries: DataFrame, index: VectorIndex, k: int, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Exact lists: the nearest cluster first, then those that its k-th score can't rule out."""
    queries = queries.where("vec is not null")
    near = materialize(ranked(grouped_lists(_routed(queries, index, True), index.cases, k, block_rows), k))
    rest = _routed(_with_floor(queries, near, k), index, False).drop("floor")
    more = grouped_lists(rest, index.cases, k, block_rows)
    return ranked(near.drop("rank").unionByName(more), k)


def search(queries: DataFrame, cases: DataFrame | VectorIndex, k: int, *, block_rows: int = BLOCK_ROWS,
           least_skipped: float = LEAST_SKIPPED) -> DataFrame:
    """Exact lists by clusters where a sample of the queries skips enough, else by the full scan.

    Cases that fit one block have nothing to skip.
    """
    if not isinstance(cases, VectorIndex) and cases.limit(block_rows + 1).count() <= block_rows:
        return full_scan(queries, cases, k, block_rows)
    index = cases if isinstance(cases, VectorIndex) else prepare(cases)
    queries = queries.where("vec is not null")
    if not index.sizes.sum() or skipped_share(queries, index, k) < least_skipped:
        return full_scan(queries, index.cases.drop(GROUP), k, block_rows)
    return cluster_scan(queries, index, k, block_rows)


# --- hashing -----------------------------------------------------------------------

def probe_masks(bits: int, radius: int) -> list[int]:
    """All ways to flip at most ``radius`` of ``bits`` bits."""
    return [sum(1 << b for b in flipped) for r in range(radius + 1) for flipped in combinations(range(bits), r)]


def coded(df: DataFrame, dim: int, tables: int, bits: int, seed: int, radius: int = 0) -> DataFrame:
    """Rows once per table and code; with ``radius`` also at the codes that differ so little."""
    codes = vec.hyperplane_codes(F.col("vec"), dim, tables, bits, seed)
    flips = F.array(*[F.lit(m) for m in probe_masks(bits, radius)])
    return df.where("vec is not null").withColumn("_codes", codes).withColumn(GROUP, F.explode(
        F.flatten(F.transform("_codes", lambda c: F.transform(flips, lambda m: c.bitwiseXOR(m)))))).drop("_codes")


def hashed_scan(queries: DataFrame, cases: DataFrame, k: int, *, dim: int, tables: int, bits: int,
                radius: int, seed: int = fv.SEED, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Lists among the cases whose code differs in at most ``radius`` bits in at least one table."""
    left = coded(queries, dim, tables, bits, seed, radius)
    right = coded(cases, dim, tables, bits, seed)
    return ranked(once(grouped_lists(left, right, k, block_rows)), k)


def recall(found: DataFrame, exact: DataFrame) -> float:
    """Which share of the exact lists was found."""
    both = exact.select("query_id", "case_id").join(
        found.select("query_id", "case_id").distinct(), ["query_id", "case_id"], "left_semi")
    return both.count() / max(1, exact.count())


def choose_radius(queries: DataFrame, cases: DataFrame, k: int, *, dim: int, tables: int, bits: int,
                  wanted: float = 0.95, tried: int = TRIED_QUERIES, seed: int = fv.SEED) -> tuple[int, float]:
    """(radius, recall): the smallest radius whose recall on ``tried`` queries is high enough.

    The sample's exact lists come from the full scan; what a radius finds follows from how many
    bits a query and its neighbours differ in, so one scan serves all radii.
    """
    some = materialize(queries.where("vec is not null").orderBy(F.xxhash64("query_id"), "query_id").limit(tried))
    exact = full_scan(some, cases, k).select("query_id", "case_id")
    codes = vec.hyperplane_codes(F.col("vec"), dim, tables, bits, seed)
    pairs = exact.join(some.select("query_id", codes.alias("a")), "query_id").join(
        cases.select("case_id", codes.alias("b")), "case_id")
    apart = F.array_min(F.zip_with("a", "b", lambda a, b: F.bit_count(a.bitwiseXOR(b))))
    counts = {r["d"]: r["n"] for r in pairs.groupBy(apart.alias("d")).agg(F.count("*").alias("n")).collect()}
    total, got = max(1, sum(counts.values())), 0
    for radius in range(bits + 1):
        got += counts.get(radius, 0)
        if got >= wanted * total:
            break
    return radius, got / total
