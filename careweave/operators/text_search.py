"""Exact top-k over sparse text vectors through an inverted index that is read only where it matters.

Cases lie in slices of like lengths. A directory has the largest weight of every term in every
slice, and a list of champions the cases with the largest weights of every term. A query first
gets a lower bound of its k-th score from the champions of its heaviest terms. Its lightest terms
together can't reach that bound, so a case without one of the others (the essential ones) is out:
the query goes only to slices whose largest weights of essential terms can reach the bound. There
scores in single precision tell which cases are near the bound and the k-th score of the slice,
and only those get their full score. Terms that many pairs share go through a matrix product, the
others by their postings; no term is ever left out of a score.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from careweave.operators.blocks import block_join, list_schema, once, ranked
from careweave.session import materialize, task_slots

SLICE_ROWS = 65_536
SLICE_ENTRIES = 2_000_000
QUERY_ROWS = 16_384
# Fewer queries than this do not pay for a copy of a slice.
LEAST_QUERY_ROWS = 4_096
CHAMPIONS = 16
ANCHORS = 4
POOL_ROWS = 4096
# Two scores that differ by less can be equal after rounding to 4 places.
ROUNDING = 1e-4


@dataclass(frozen=True)
class TextIndex:
    """``cases``: slice, case_id, ids, vec, m1..m3, pid; ``directory``: term, slice, top;
    ``champions``: term, weight and masks of the cases with the largest weights of a term;
    ``bucketed``: the cases are a stored table in buckets by slice."""

    cases: DataFrame
    directory: DataFrame
    champions: DataFrame
    n_cases: int
    bucketed: bool = False


def entries(ids: Column, weights: Column) -> Column:
    """Terms and weights of a vector as structs, lightest first."""
    return F.array_sort(F.zip_with(weights, ids, lambda w, t: F.struct(w.alias("w"), t.alias("term"))))


def with_slices(cases: DataFrame, slice_rows: int = SLICE_ROWS,
                slice_entries: int = SLICE_ENTRIES) -> tuple[DataFrame, int]:
    """Cases with their ``slice``, and their number; cases without a vector are left out.

    A slice has cases of one class of lengths (powers of two, so at most 32 classes), a bounded
    number of rows and of entries; ids are hashed, so copies of a text spread over the slices.
    """
    cases = cases.where("vec is not null").withColumn(
        "_class", F.floor(F.log2(F.size("ids") + 1.0)).cast("int"))
    counts = cases.groupBy("_class").agg(
        F.count("*").alias("n"), F.sum(F.size("ids").cast("long")).alias("entries")).collect()
    parts = F.lit(1)
    for r in counts:
        wanted = max(-(-r["n"] // slice_rows), -(-r["entries"] // slice_entries), 1)
        parts = F.when(F.col("_class") == r["_class"], F.lit(wanted)).otherwise(parts)
    placed = cases.withColumn("slice", F.col("_class").cast("long") * 2**32 + F.pmod(
        F.xxhash64("case_id"), parts)).drop("_class")
    return placed, sum(r["n"] for r in counts)


def prepare(cases: DataFrame, *, champions: int = CHAMPIONS, slice_rows: int = SLICE_ROWS,
            slice_entries: int = SLICE_ENTRIES, once: bool = False) -> TextIndex:
    """The index tables of one side of cases. Cases are written; directory and champions too, but
    for a single search (``once``), which reads each of them one time."""
    placed, n = with_slices(cases, slice_rows, slice_entries)
    placed = materialize(placed)
    tables = term_tables(placed, champions)
    return TextIndex(placed, *(tables if once else map(materialize, tables)), n)


def term_tables(cases: DataFrame, champions: int = CHAMPIONS) -> tuple[DataFrame, DataFrame]:
    """(directory, champions) of cases that have their slice."""
    postings = cases.select("slice", "case_id", "m1", "m2", "m3", "pid",
                            F.explode(entries(F.col("ids"), F.col("vec"))).alias("e")).select(
        "*", "e.term", "e.w").drop("e")
    directory = postings.groupBy("term", "slice").agg(F.max("w").alias("top"))
    best = Window.partitionBy("term").orderBy(F.desc("w"), "case_id")
    return directory, postings.withColumn("place", F.row_number().over(best)).where(
        F.col("place") <= champions).drop("place", "slice")


def masked(substring: bool) -> Column:
    """True where a champion is masked for a query (columns of both)."""
    parts = [F.col("q1") == F.col("m1"), F.col("q1") == F.col("m2"), F.col("q3") == F.col("m3")]
    if substring:
        parts.append((F.col("qid") != "") & F.contains("pid", "qid"))
    out = F.lit(False)
    for part in parts:
        out = out | F.coalesce(part, F.lit(False))
    return out


def with_floors(queries: DataFrame, index: TextIndex, k: int, substring: bool = False) -> DataFrame:
    """Queries with ``floor``, a lower bound of their k-th score, ``skip``, how many of their
    lightest terms can't reach it together, and ``rest``, what those can add at most.

    Partial sums over the champions of the ANCHORS heaviest terms never exceed a case's score.
    Vectors are unit rows, so terms add at most the norm of the query's part.
    """
    found = F.col("e")
    anchors = queries.select("query_id", F.col("m1").alias("q1"), F.col("m3").alias("q3"), "qid", F.explode(
        F.slice(F.reverse("entries"), 1, ANCHORS)).alias("e")).select(
        "query_id", "q1", "q3", "qid", found["term"].alias("term"), found["w"].alias("qw"))
    sums = anchors.join(index.champions, "term").where(~masked(substring)).groupBy("query_id", "case_id").agg(
        F.sum(F.col("qw") * F.col("w")).alias("s"))
    kth = F.get(F.sort_array(F.collect_list("s"), asc=False), F.lit(k - 1)) - ROUNDING
    floors = sums.groupBy("query_id").agg(F.greatest(kth, F.lit(0.0)).alias("floor"))
    out = queries.join(floors, "query_id", "left").withColumn("floor", F.coalesce("floor", F.lit(0.0)))

    def lighter(state: Column, e: Column) -> Column:
        mass = state["mass"] + e["w"] * e["w"]
        return F.when(F.sqrt(mass) < F.col("floor"), F.struct(
            mass.alias("mass"), (state["n"] + 1).alias("n"))).otherwise(state)

    start = F.struct(F.lit(0.0).alias("mass"), F.lit(0).alias("n"))
    out = out.withColumn("_skip", F.aggregate("entries", start, lighter))
    return out.withColumns({"skip": F.col("_skip.n"), "rest": F.sqrt("_skip.mass")}).drop("_skip")


def routes(queries: DataFrame, index: TextIndex) -> DataFrame:
    """(query_id, slice) of every slice that can hold a case above the query's floor."""
    essential = queries.select("query_id", "floor", "rest", F.explode(F.slice(
        "entries", F.col("skip") + 1, F.size("entries"))).alias("e")).select(
        "query_id", "floor", "rest", "e.term", F.col("e.w").alias("qw"))
    bound = F.sum(F.col("qw") * F.col("top")) + F.col("rest")
    return essential.join(index.directory, "term").groupBy("query_id", "slice", "floor", "rest").agg(
        bound.alias("bound")).where("bound >= floor").select("query_id", "slice")


def kernel(k: int, *, pruned: bool, substring: bool = False, cells: int = 1 << 21,
           budget: int = 1 << 20, dense_share: float = 0.012, dense_terms: int = 256) -> Callable:
    """Arrow function over queries and cases of one slice; nested so that it ships by value.

    Queries go through in batches whose posting entries and cells stay within bounds. Terms that
    more than ``dense_share`` of all pairs have in common (at most ``dense_terms``) are one matrix
    product for a batch; the others are added to the query's row of it, one posting list after
    another, while that row lies in the cache. Both are in single precision, which decides for which
    cases the score is computed again in full: the k-th is looked for among those near the floor
    only. ``pruned`` lists hold cases with a score above 0 only, and ``scored``, how many cases of
    the slice got their full score; others hold every case.
    """
    rounding = ROUNDING

    def run(left, right):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        fields = [left.schema.field("query_id"), right.schema.field("case_id"),
                  pa.field("similarity_score", pa.float64())]
        out_schema = pa.schema(fields + [pa.field("scored", pa.int64())] * pruned)
        left, right = (x.filter(pc.is_valid(x["vec"])) for x in (left, right))
        n_query, n = left.num_rows, right.num_rows
        if not n_query or not n:
            return out_schema.empty_table()
        # Cases in id order, so that among equal scores the smaller id comes first.
        right = right.sort_by("case_id")

        def rows(column):
            column = column.combine_chunks()
            return np.diff(column.offsets.to_numpy()).astype(np.int64), column.flatten().to_numpy()

        def spans(starts, lengths):
            """All positions of the given runs, one after another."""
            ends = np.cumsum(lengths)
            return np.repeat(starts - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)

        case_len, case_term = rows(right["ids"])
        case_weight = rows(right["vec"])[1]
        case_start = np.cumsum(case_len) - case_len
        # Terms are numbered as the slice has them; what only the queries have adds nothing.
        known, case_term = np.unique(case_term, return_inverse=True)
        width = len(known)
        q_len, q_term = rows(left["ids"])
        q_weight = rows(left["vec"])[1]
        q_row = np.repeat(np.arange(n_query), q_len)
        at = np.minimum(np.searchsorted(known, q_term), max(width - 1, 0))
        has = known[at] == q_term if width else np.zeros(len(q_term), bool)
        q_row, q_term, q_weight = q_row[has], at[has], q_weight[has]
        q_start = np.searchsorted(q_row, np.arange(n_query + 1))

        common = np.bincount(case_term, minlength=width) * np.bincount(q_term, minlength=width).astype(float)
        dense = np.flatnonzero(common > dense_share * n * n_query) if pruned else np.empty(0, np.int64)
        dense = dense[np.argsort(-common[dense], kind="stable")[:dense_terms]]
        place = np.full(width, -1)
        place[dense] = np.arange(len(dense))
        case_matrix = np.zeros((len(dense), n), np.float32)
        case_row = np.repeat(np.arange(n), case_len)
        heavy = place[case_term] >= 0
        case_matrix[place[case_term[heavy]], case_row[heavy]] = case_weight[heavy]
        order = np.flatnonzero(~heavy)
        order = order[np.argsort(case_term[order], kind="stable")]
        post_case, post_weight = case_row[order], case_weight[order]
        post_end = np.cumsum(np.bincount(case_term[order], minlength=width))
        post_count = np.diff(post_end, prepend=0)
        post_single = post_weight.astype(np.float32)

        by_key = {}
        for column in ("m1", "m2", "m3"):
            for i, value in enumerate(right[column].to_pylist()):
                if value:
                    by_key.setdefault(value, []).append(i)
        own_masks = list(zip(*(left[c].to_pylist() for c in ("m1", "m3"))))
        q_ids = left["qid"].to_pylist() if substring else None
        pair_ids = [x or "" for x in right["pid"].to_pylist()] if substring else None

        floor = left["floor"].to_numpy() if pruned else np.zeros(n_query)
        # What single precision can be off by, on both sides of a comparison.
        margin = rounding + 4e-7 * (q_len + 1)
        e_count = post_count[q_term] * (place[q_term] < 0)
        cost = np.concatenate([[0], np.cumsum(e_count)])[q_start]
        found_q, found_c, found_s, found_n = [], [], [], []
        buffer = np.empty(0, np.float32)
        start = 0
        while start < n_query:
            end = min(start + max(1, cells // max(n, width)),
                      int(np.searchsorted(cost, cost[start] + budget, "right")) - 1)
            end = min(max(end, start + 1), n_query)
            a, b = q_start[start], q_start[end]
            row, term, weight = q_row[a:b] - start, q_term[a:b], q_weight[a:b]
            count = e_count[a:b]
            if pruned:
                heavy = place[term] >= 0
                query_matrix = np.zeros((end - start, len(dense)), np.float32)
                query_matrix[row[heavy], place[term[heavy]]] = weight[heavy]
                if len(buffer) < (end - start) * n:
                    buffer = np.empty((end - start) * n, np.float32)
                total = buffer[:(end - start) * n].reshape(end - start, n)
                np.matmul(query_matrix, case_matrix, out=total)
                light = np.flatnonzero(count)
                until = post_end[term[light]].tolist()
                lists = list(zip((post_end[term[light]] - count[light]).tolist(), until,
                                 weight[light].astype(np.float32)))
                edges = np.searchsorted(row[light], np.arange(end - start + 1)).tolist()
                # The comparison stays in single precision; the margin covers the rounding of the bound.
                low = np.maximum(floor[start:end] - margin[start:end], 1e-30).astype(np.float32)
                near = []
                for i in range(start, end):
                    line = total[i - start]
                    for first, last, w in lists[edges[i - start]:edges[i - start + 1]]:
                        line[post_case[first:last]] += w * post_single[first:last]
                    for value in own_masks[i]:
                        if value and value in by_key:
                            line[by_key[value]] = -1.0
                    hit = np.flatnonzero(line >= low[i - start])
                    if substring and q_ids[i]:
                        hit = hit[[q_ids[i] not in pair_ids[j] for j in hit]] if len(hit) else hit
                    if len(hit) > k:
                        value = line[hit]
                        kth = np.partition(value, len(hit) - k)[len(hit) - k]
                        hit = hit[value >= kth - np.float32(margin[i])]
                    near.append(hit)
                q = np.repeat(np.arange(end - start), [len(hit) for hit in near])
                c = np.concatenate(near)
            else:
                at = spans(post_end[term] - post_count[term], count)
                cell = np.repeat(row * n, count) + post_case[at]
                add = np.repeat(weight, count) * post_weight[at]
                total = np.bincount(cell, add, (end - start) * n).reshape(end - start, n)
                for i in range(start, end):
                    for value in own_masks[i]:
                        if value and value in by_key:
                            total[i - start, by_key[value]] = -1.0
                    if substring and q_ids[i]:
                        total[i - start, [j for j in range(n) if q_ids[i] in pair_ids[j]]] = -1.0
            if pruned:
                score = np.empty(len(q))
                full = np.zeros((end - start, width))
                full[row, term] = weight
                for part in np.array_split(np.arange(len(q)), -(-int(case_len[c].sum()) // budget) or 1):
                    lengths = case_len[c[part]]
                    at = spans(case_start[c[part]], lengths)
                    add = full[np.repeat(q[part], lengths), case_term[at]] * case_weight[at]
                    score[part] = np.bincount(np.repeat(np.arange(len(part)), lengths), add, len(part))
                number = np.bincount(q, minlength=end - start)
                score = np.round(score, 4)
                q, c, score = (x[score > 0] for x in (q, c, score))
            else:
                score = np.where(total < 0, -1.0, np.round(total, 4))
                kth = np.partition(score, n - k, axis=1)[:, n - k] if n > k else np.zeros(end - start)
                q, c = np.nonzero(score >= np.maximum(kth, 0.0)[:, None])
                score = score[q, c]
            best = np.lexsort((c, -score, q))
            q, c, score = q[best], c[best], score[best]
            keep = np.arange(len(q)) - np.searchsorted(q, q, "left") < k
            q, c, score = q[keep], c[keep], score[keep]
            found_q.append(start + q)
            found_c.append(c)
            found_s.append(score)
            if pruned:
                found_n.append(number[q])
            start = end
        columns = [left["query_id"].take(pa.array(np.concatenate(found_q))),
                   right["case_id"].take(pa.array(np.concatenate(found_c))), np.concatenate(found_s)]
        return pa.table(columns + ([np.concatenate(found_n)] if pruned else []), schema=out_schema)

    return run


def pruned_lists(queries: DataFrame, index: TextIndex, k: int, substring: bool = False,
                 query_rows: int = QUERY_ROWS) -> DataFrame:
    """(query_id, case_id, similarity_score, scored) from every slice a query was sent to.

    A slice that many queries ask for is copied for every ``query_rows`` of them, or for fewer where
    that is what it takes to occupy the tasks. Where no slice is copied and the layout of a stored
    index can serve the join, only queries move: cases are grouped by their slice, as the index is
    bucketed. Else both sides are dealt out by slice and chunk; the layout would leave all chunks
    of a slice to one task.
    """
    spark = index.cases.sparkSession
    sent, slots = materialize(routes(queries, index)), task_slots(spark)
    query_rows = min(query_rows, max(LEAST_QUERY_ROWS, sent.count() // (2 * slots)))
    chunks = sent.groupBy("slice").agg(F.ceil(F.count("*") / query_rows).cast("int").alias("chunks"))
    left = sent.join(chunks, "slice").withColumn(
        "chunk", F.pmod(F.xxhash64("query_id"), F.col("chunks")).cast("int")).drop("chunks").join(
        queries.drop("entries"), "query_id")
    right = index.cases.join(chunks, "slice").withColumn(
        "chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).drop("chunks")
    groups, most = chunks.agg(F.coalesce(F.sum("chunks"), F.lit(0)), F.coalesce(F.max("chunks"), F.lit(0))).head()
    in_place = index.bucketed and spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition") == "false"
    if not (in_place and most <= 1):
        # Costly per row: tasks by their number, not by their bytes.
        left, right = (df.repartition(min(max(groups, slots), 8 * slots), "slice", "chunk") for df in (left, right))
    schema = list_schema(queries, index.cases, T.StructField("scored", T.LongType()))
    return left.groupBy("slice", "chunk").cogroup(right.groupBy("slice", "chunk")).applyInArrow(
        kernel(k, pruned=True, substring=substring), schema)


def search(queries: DataFrame, index: TextIndex, k: int, *, substring: bool = False,
           block_rows: int = QUERY_ROWS, pool_rows: int = POOL_ROWS) -> DataFrame:
    """(query_id, rank, case_id, similarity_score): min(k, cases left) rows per query.

    ``queries``: query_id (unique), ids, vec, m1, m3, qid. A query with fewer than k scores above 0
    is filled up by the smallest unmasked ids: from the first ``pool_rows`` ids, and where masks
    leave too few of those, by the full scan.
    """
    asked = materialize(with_floors(
        queries.where("vec is not null").withColumn("entries", entries(F.col("ids"), F.col("vec"))),
        index, k, substring))
    found = materialize(ranked(pruned_lists(asked, index, k, substring), k))
    everything = kernel(k, pruned=False, substring=substring)
    for pool in (pool_rows, None):
        had = found.groupBy("query_id").agg(F.count("*").alias("_had"))
        short = materialize(asked.join(had, "query_id", "left").where(
            F.coalesce("_had", F.lit(0)) < min(k, index.n_cases)).drop("_had", "entries"))
        n_short = short.count()
        if not n_short:
            break
        cases = index.cases if pool is None else index.cases.orderBy("case_id").limit(pool)
        n_cases = index.n_cases if pool is None else min(pool, index.n_cases)
        more = block_join(short, cases, everything, block_rows, (n_short, n_cases))
        found = materialize(ranked(once(found.drop("rank").unionByName(more)), k))
        if pool is not None and index.n_cases <= pool:
            break
    return found
