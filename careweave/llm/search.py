"""Ranked lexical search: item bundles pass the owners of the terms one after another."""

from __future__ import annotations

import secrets
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from careweave.session import materialize

#: Characters of terms, and the constants of the score.
TERM_CHARACTERS = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"  # and all non-ASCII
LEVEL, LEVEL_AT_MEAN, SCALE = 100, 50, 1_000_000_000

STAGES = 4
BUNDLE_ITEMS = 256
SLICE_DOCS, SLICE_POSTINGS = 1 << 14, 1 << 21
VOCABULARY_TERMS = 500_000

_FOLD = bytes(c if c > 127 else ord(chr(c).lower()) if chr(c) in TERM_CHARACTERS else 32
              for c in range(256))


def terms(text: str | None) -> list[bytes]:
    """Runs of letters, digits and non-ASCII characters; only A-Z is lower-cased."""
    return (text or "").encode().translate(_FOLD).split()


class _Slice:
    """Documents in the order they come, with the postings of the known terms."""

    def __init__(self, vocabulary: Iterable[bytes] | None):
        self.closed = vocabulary is not None
        self.known = {t: i for i, t in enumerate(vocabulary or ())}
        self.ids, self.lengths = [], []
        self.term, self.spot, self.tf = [], [], []

    def add(self, doc_id, text: str | None) -> None:
        words, known = terms(text), self.known
        found = Counter(words)
        if not self.closed:
            for t in found:
                known.setdefault(t, len(known))
        hits = [(known[t], n) for t, n in found.items() if t in known]
        self.term += [t for t, _ in hits]
        self.tf += [n for _, n in hits]
        self.spot += [len(self.ids)] * len(hits)
        self.ids.append(doc_id)
        self.lengths.append(len(words))

    def full(self) -> bool:
        return len(self.ids) >= SLICE_DOCS or len(self.term) >= SLICE_POSTINGS

    def rows(self, id_type: pa.DataType) -> pa.RecordBatch:
        """One row per term, and a last one with the ids and totals of the slice."""
        term, lengths = np.array(self.term, np.int32), np.array(self.lengths, np.int64)
        order = np.argsort(term, kind="stable")
        found, starts = np.unique(term[order], return_index=True)
        ends = np.append(starts, [len(term), len(term)]).astype(np.int32)
        names = {i: t.decode() for t, i in self.known.items()}

        def lists(values):
            return pa.ListArray.from_arrays(ends, pa.array(values[order].astype(np.int32), pa.int32()))

        n, spots = len(found), np.array(self.spot, np.int32)
        totals = [[None] * n + [int(x)] for x in ((lengths > 0).sum(), lengths.sum())]
        return pa.RecordBatch.from_arrays(
            [pa.array([secrets.randbits(62)] * (n + 1), pa.int64()),
             pa.array([names[i] for i in found.tolist()] + [None], pa.string()),
             lists(spots), lists(np.array(self.tf, np.int32)), lists(lengths[spots]),
             pa.array([None] * n + [self.ids], pa.list_(id_type)),
             *(pa.array(x, pa.int64()) for x in totals)],
            names=["slice", "term", "spots", "tfs", "lengths", "ids", "n_docs", "n_terms"])


def build_index(docs: DataFrame, vocabulary: list[bytes] | None = None) -> DataFrame:
    """Postings by slice and term, written once: a slice holds at most 16,384 documents.

    A row has the documents of a slice that hold a term (as places in the slice), with the
    occurrences and the lengths of these documents; one row per slice, without a term, has its
    ids, its documents with a term and all its terms. ``vocabulary`` leaves out other terms.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = _Slice(vocabulary)
        for batch in batches:
            ids = batch.column("doc_id")
            for doc_id, text in zip(ids.to_pylist(), batch.column("text").to_pylist(), strict=True):
                part.add(doc_id, text)
                if part.full():
                    yield part.rows(ids.type)
                    part = _Slice(vocabulary)
        if part.ids:
            yield part.rows(ids.type)

    return materialize(docs.select("doc_id", "text").mapInArrow(
        run, "slice long, term string, spots array<int>, tfs array<int>, lengths array<int>, "
             f"ids array<{id_type}>, n_docs long, n_terms long"))


def item_terms(items: DataFrame) -> DataFrame:
    """(item, term) once each; rows that share an id are one item with the terms of all."""
    id_type = items.schema["item_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted(set(terms(x))) for x in batch.column("text").to_pylist()]
            rows = np.repeat(np.arange(len(found)), [len(x) for x in found])
            yield pa.RecordBatch.from_arrays(
                [batch.column("item_id").take(pa.array(rows)),
                 pa.array([t.decode() for x in found for t in x], pa.string())], names=["item", "term"])

    return items.select("item_id", "text").mapInArrow(run, f"item {id_type}, term string").distinct()


def impacts(tfs: np.ndarray, lengths: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """What a term of weight 1 adds to the documents, in whole numbers."""
    tfs, lengths = tfs.astype(np.int64), lengths.astype(np.int64)
    if len(lengths) and int(lengths.max()) * LEVEL_AT_MEAN * n_docs >= 2**63:
        scaled = np.array([LEVEL_AT_MEAN * n * n_docs // n_terms for n in lengths.tolist()], np.int64)
    else:
        scaled = LEVEL_AT_MEAN * lengths * n_docs // n_terms
    return SCALE * tfs // (1000 * tfs + 20 * (LEVEL - LEVEL_AT_MEAN + scaled))


def _lists(column) -> tuple[np.ndarray, np.ndarray]:
    """Where each list of a column begins and ends, and all values."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)


def term_statistics(index: DataFrame, n_docs: int, n_terms: int) -> DataFrame:
    """term, df, w, top: documents that hold a term, its weight, its largest impact."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends, tfs = _lists(batch.column("tfs"))
            _, lengths = _lists(batch.column("lengths"))
            part = impacts(tfs[ends[0]:ends[-1]], lengths[ends[0]:ends[-1]], n_docs, n_terms)
            yield pa.RecordBatch.from_arrays(
                [batch.column("term"), pa.array(np.diff(ends).astype(np.int64)),
                 pa.array(np.maximum.reduceat(part, ends[:-1] - ends[0]) if len(part) else [], pa.int64())],
                names=["term", "n", "top"])

    counted = index.where("term is not null").select("term", "tfs", "lengths").mapInArrow(
        run, "term string, n long, top long")
    found = counted.groupBy("term").agg(F.sum("n").alias("df"), F.max("top").alias("top"))
    weight = F.floor(1000 * F.log(F.lit(2.0 * n_docs + 2) / (2 * F.col("df") + 1))).cast("long")
    return found.withColumn("w", weight).where("w > 0")


def owner_limits(statistics: DataFrame, stages: int) -> list[int]:
    """Smallest weight of each owner: owners hold like numbers of postings, rare terms first.

    Weights are whole numbers below 1000 ln(2**64), so their histogram has at most 45,000 rows.
    """
    volume = statistics.groupBy("w").agg(F.sum("df").alias("n")).orderBy(F.desc("w")).collect()
    limits, held, total = [], 0, sum(r.n for r in volume)
    for r in volume:
        held += r.n
        if held * stages >= total * (len(limits) + 1) and len(limits) < stages - 1:
            limits.append(r.w)
    return limits


def _stage(k: int, last: bool, best: int, n_docs: int, n_terms: int, of_item: pa.DataType):
    """Add the postings of owner ``k`` to the accumulators of one bundle and slice."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        schema = left.schema
        head = left.filter(pc.is_valid(left["ids"]))
        held = left.filter(pc.is_valid(left["floor"]))
        ids = head["ids"].combine_chunks().values
        spot_ends, spots = _lists(held["spots"])
        _, scores = _lists(held["scores"])
        before = {item: (slice(a, b), floor) for item, a, b, floor in zip(
            held["item"].to_pylist(), spot_ends[:-1], spot_ends[1:], held["floor"].to_pylist(), strict=True)}

        ends, where = _lists(right["spots"])
        _, tfs = _lists(right["tfs"])
        _, lengths = _lists(right["lengths"])
        part = impacts(tfs, lengths, n_docs, n_terms)
        weights, of = right["w"].to_pylist(), defaultdict(list)
        for row, items in enumerate(right["items"].to_pylist()):
            for item in items:
                of[item].append(row)

        out = [[], [], [], []]  # item, spots, scores, floor
        total = np.zeros(len(ids), np.int64)
        for plan in head["plan"][0].as_py() if head.num_rows else ():
            item, rests = plan["item"], plan["rests"]
            own, floor = before.get(item, (slice(0, 0), 0))
            total[:] = 0
            total[spots[own]] = scores[own]
            for row in of.get(item, ()):
                hit = slice(ends[row], ends[row + 1])
                total[where[hit]] += weights[row] * part[hit]
            # A document without an entry can gain no more than what the owners had left.
            seen = spots[own] if k and rests[k - 1] < floor else np.flatnonzero(total)
            gained = total[seen]
            if len(gained) > best:
                floor = max(floor, int(np.partition(gained, len(gained) - best)[len(gained) - best]))
            stay = gained + rests[k] >= max(floor, 1)
            if stay.any():
                for column, x in zip(out, (item, seen[stay].astype(np.int32), gained[stay], floor), strict=True):
                    column.append(x)
        if not last:
            n = len(out[0])
            rows = {"bundle": [left["bundle"][0].as_py()] * n, "slice": [left["slice"][0].as_py()] * n,
                    "item": out[0], "spots": out[1], "scores": out[2], "floor": out[3]}
            found = pa.table([pa.array(rows.get(f.name, [None] * n), f.type) for f in schema], schema=schema)
            return pa.concat_tables([head, found])
        found = [pa.table([pa.array([item] * len(s), of_item), ids.take(pa.array(s)), pa.array(v, pa.int64())],
                          names=["item_id", "doc_id", "score"])
                 .sort_by([("score", "descending"), ("doc_id", "ascending")]).slice(0, best)
                 for item, s, v, _ in zip(*out, strict=True)]
        empty = pa.schema([("item_id", of_item), ("doc_id", ids.type), ("score", pa.int64())]).empty_table()
        return pa.concat_tables([empty, *found])

    return run


def search(docs: DataFrame, items: DataFrame, best: int = 50, stages: int = STAGES,
           bundle_items: int = BUNDLE_ITEMS) -> DataFrame:
    """item_id, rank, doc_id, score: the ``best`` documents of every item with a score above 0.

    Terms belong to ``stages`` owners by falling weight. A bundle of items visits them in turn
    with its accumulators, one row per item and slice of documents, and leaves each stage with
    the entries that can still be among the best of the slice, by the largest impacts of the
    terms to come; so a common term seldom opens new entries. Nothing is cut that could be in
    the result, and no row holds more than one slice.

    Null and empty texts have no terms: such items get no rows, such documents are in none and
    do not count. Equal scores go by doc_id, null ids last; repeated rows are documents of their
    own; items that share an id are one item, null ids too. Other columns are ignored; an empty
    table gives no rows.
    """
    of_item = items.schema["item_id"].dataType.simpleString()
    of_doc = docs.schema["doc_id"].dataType.simpleString()
    arrow_item = to_arrow_type(items.schema["item_id"].dataType)
    asked = materialize(item_terms(items))
    n_items = asked.select("item").distinct().count()
    words = [r.term.encode() for r in asked.select("term").distinct().limit(VOCABULARY_TERMS + 1).collect()]
    # The filter only saves postings: with more terms the join below leaves out the others.
    index = build_index(docs, words if len(words) <= VOCABULARY_TERMS else None)
    totals = index.where("term is null").agg(F.sum("n_docs").alias("n"), F.sum("n_terms").alias("all")).first()
    n_docs, n_terms = totals["n"] or 0, totals["all"] or 0
    if not n_docs or not n_items:
        return docs.sparkSession.createDataFrame(
            [], f"item_id {of_item}, rank int, doc_id {of_doc}, score long")

    statistics = materialize(term_statistics(index, n_docs, n_terms).join(
        asked.select("term").distinct(), "term", "left_semi"))
    owner = F.lit(0)
    for k, limit in enumerate(owner_limits(statistics, stages), 1):
        owner = F.when(F.col("w") < limit, k).otherwise(owner)
    bundle = F.pmod(F.xxhash64("item"), F.lit(-(-n_items // bundle_items))).cast("int")
    weighed = materialize(asked.withColumn("bundle", bundle).join(
        statistics.withColumn("owner", owner), "term"))
    rests = [F.coalesce(F.sum(F.when(F.col("owner") > k, F.col("w") * F.col("top"))), F.lit(0)).cast("long")
             for k in range(stages)]
    # Read back from a table every field may be null, as in the rows that the stages return.
    plans = materialize(weighed.groupBy("bundle", "item").agg(F.array(*rests).alias("rests")).groupBy(
        "bundle").agg(F.collect_list(F.struct("item", "rests")).alias("plan")))
    # Inside a struct, a null item is not left out.
    listed = F.transform(F.collect_list(F.struct("item")), lambda x: x["item"])
    owned = materialize(weighed.groupBy("bundle", "owner", "term", "w").agg(listed.alias("items")))

    none = F.lit(None)
    state = index.where("term is null").select(
        F.explode(F.sequence(F.lit(0), F.lit(-(-n_items // bundle_items) - 1))).alias("bundle"), "slice", "ids",
    ).join(plans, "bundle").select(
        "bundle", "slice", none.cast(of_item).alias("item"), "ids", "plan",
        none.cast("array<int>").alias("spots"), none.cast("array<long>").alias("scores"),
        none.cast("long").alias("floor"))
    for k in range(stages):
        postings = index.where("term is not null").join(
            owned.where(F.col("owner") == k).drop("owner"), "term").select(
            "bundle", F.col("slice").alias("slice"), "w", "items", "spots", "tfs", "lengths")
        last = k == stages - 1
        state = state.groupBy("bundle", "slice").cogroup(postings.groupBy("bundle", "slice")).applyInArrow(
            _stage(k, last, best, n_docs, n_terms, arrow_item),
            f"item_id {of_item}, doc_id {of_doc}, score long" if last else
            f"bundle int, slice long, item {of_item}, ids array<{of_doc}>, plan array<struct<item:{of_item},"
            "rests:array<long>>>, spots array<int>, scores array<long>, floor long")
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return state.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best).select(
        "item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
