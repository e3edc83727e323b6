"""Pruned text search against a plain double loop, and how much of the work it leaves out."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from careweave.operators import features, retrieval, text_search
from careweave.plans import catalog

COLUMNS = "pair_id string, customer_tweet_id string, support_tweet_id string, customer_clean_text string"


def zipf_pairs(seed, n):
    """Zipf-like words, texts of very different lengths; a third of the rows are copies of one."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    weights = [1 / (i + 1) for i in range(400)]
    texts = [" ".join(rng.choices(words, weights, k=rng.choice([1, 4, 12, 60]))) for _ in range(n)]
    texts[::3] = [texts[0]] * len(texts[::3])
    return [(f"p{i:04d}", f"c{i % (n - n // 10)}", f"s{i}", t) for i, t in enumerate(texts)]


def brute(rows, k, masked=False, substring=False):
    """query -> [(case, score)] by full dot products of the stored vectors."""
    out = {}
    for q in rows:
        own, text = q["customer_tweet_id"], q["customer_clean_text"].strip().lower()
        weights = dict(zip(q["term_ids"], q["weights"]))
        scored = []
        for c in rows:
            if masked and (own in (c["customer_tweet_id"], c["support_tweet_id"])
                           or substring and own in c["pair_id"]
                           or text and text == c["customer_clean_text"].strip().lower()):
                continue
            s = sum(weights.get(t, 0.0) * w for t, w in zip(c["term_ids"], c["weights"]))
            scored.append((-round(s, 4) + 0.0, c["pair_id"]))
        out[q["pair_id"]] = [(i, -s) for s, i in sorted(scored)[:k]]
    return out


def as_lists(cases):
    out = {}
    for r in cases.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["case_id"], r["similarity_score"]))
    return out


def same(got, want):
    assert got.keys() == {q for q, cases in want.items() if cases}
    for q, cases in want.items():
        assert [s for _, s in got.get(q, [])] == pytest.approx([s for _, s in cases], abs=1.01e-4), q
        # Sums in another order may round the other way; ids must agree where scores do.
        if [s for _, s in got.get(q, [])] == [s for _, s in cases]:
            assert got.get(q, []) == cases, q


@pytest.fixture(scope="module")
def index(spark):
    pairs = spark.createDataFrame(zipf_pairs(1, 330), COLUMNS)
    index, terms = retrieval.build_text_index(pairs)
    return index.cache(), terms


def retrieve(index, terms, **options):
    return retrieval.retrieve(index, index, terms, query_key="pair_id", query_text="customer_clean_text",
                              query_id="customer_tweet_id", **options)


@pytest.mark.parametrize("masked, substring", [(False, False), (True, False), (True, True)])
def test_equals_brute_force(index, masked, substring):
    index, terms = index
    got = retrieve(index, terms, k=4, masked=masked, substring=substring)
    same(as_lists(got), brute(index.collect(), 4, masked, substring))


def test_many_slices_parts_and_batches(spark, index, monkeypatch):
    """Slices of at most 20 rows, query parts of 7, pools too small for the masks."""
    index, terms = index
    cases = retrieval._text_cases(index, "pair_id", "weights", "term_ids",
                                  ("customer_tweet_id", "support_tweet_id"), "customer_clean_text")
    tables = text_search.prepare(cases, slice_rows=20, slice_entries=300, champions=2)
    assert tables.cases.select("slice").distinct().count() > 15
    kernel = text_search.kernel
    monkeypatch.setattr(text_search, "kernel", lambda *a, **o: kernel(*a, **o, cells=100, budget=50))
    lists = text_search.pruned_lists
    monkeypatch.setattr(text_search, "pruned_lists", lambda *a: lists(*a, query_rows=7))
    left = retrieval.side(index, "pair_id", "weights", "term_ids", "query", retrieval.masks(
        index, ["customer_tweet_id"], "customer_clean_text")).withColumn("qid", F.lit(None).cast("string"))
    got = text_search.search(left, tables, 5, pool_rows=8)
    same(as_lists(got), brute(index.collect(), 5, masked=True))


def test_few_pairs_are_scored(spark):
    """Of N x N pairs only a small part gets a full score, and few queries meet all slices."""
    _, index, _ = catalog._index(spark, "/root/testdata/sf0.1")
    n = index.count()
    cases = retrieval._text_cases(index, "pair_id", "weights", "term_ids", (), None)
    tables = text_search.prepare(cases, slice_rows=300)
    left = retrieval.side(index, "pair_id", "weights", "term_ids", "query", []).withColumns({
        "qid": F.lit(None).cast("string"), "entries": text_search.entries(F.col("ids"), F.col("vec"))})
    asked = text_search.with_floors(left, tables, 3).cache()
    lists = text_search.pruned_lists(asked, tables, 3)
    slices = tables.cases.select("slice").distinct().count()
    sent = text_search.routes(asked, tables).count()
    part = lists.join(tables.cases.select("case_id", "slice"), "case_id")
    scored = part.groupBy("query_id", "slice").agg(F.max("scored").alias("n")).agg(F.sum("n")).head()[0]
    assert n > 2000 and scored < 0.1 * n * n
    assert slices > 5 and sent < 0.9 * n * slices
    assert asked.where("skip > 0").count() > 0.2 * n


def test_a_slice_is_dealt_to_many_tasks(spark, index, monkeypatch):
    """The lists of few slices come from as many tasks as there are parts, however few bytes they have."""
    index, terms = index
    monkeypatch.setattr(text_search, "LEAST_QUERY_ROWS", 8, raising=False)
    cases = retrieval._text_cases(index, "pair_id", "weights", "term_ids", (), None)
    tables = text_search.prepare(cases)
    left = retrieval.side(index, "pair_id", "weights", "term_ids", "query", []).withColumns({
        "qid": F.lit(None).cast("string"), "entries": text_search.entries(F.col("ids"), F.col("vec"))})
    asked = text_search.with_floors(left, tables, 3).cache()
    lists = text_search.pruned_lists(asked, tables, 3)
    assert lists.select(F.spark_partition_id().alias("task")).distinct().count() > 2
    scored = lists.groupBy("query_id").agg(F.max("scored").alias("n")).agg(F.sum("n")).head()[0]
    assert scored < 0.5 * index.count() ** 2


def test_a_stored_slice_is_dealt_to_many_tasks(spark, index, tmp_path, monkeypatch):
    """Many queries of a stored index do not wait for one task per slice; the lists stay the same."""
    index, terms = index
    retrieval.save_index(index, str(tmp_path / "index"), terms, buckets=2)
    tables = retrieval.load_search(spark, str(tmp_path / "index"))
    want = as_lists(retrieve(index, terms, k=3, search=tables))
    monkeypatch.setattr(text_search, "LEAST_QUERY_ROWS", 8)
    left = retrieval.side(index, "pair_id", "weights", "term_ids", "query", []).withColumns({
        "qid": F.lit(None).cast("string"), "entries": text_search.entries(F.col("ids"), F.col("vec"))})
    lists = text_search.pruned_lists(text_search.with_floors(left, tables, 3), tables, 3)
    placed = lists.withColumn("task", F.spark_partition_id()).join(tables.cases.select("case_id", "slice"), "case_id")
    assert placed.groupBy("slice").agg(F.count_distinct("task").alias("n")).agg(F.max("n")).head()[0] > 2
    assert as_lists(retrieve(index, terms, k=3, search=tables)) == want


def test_floor_never_exceeds_the_kth_score(index):
    index, terms = index
    cases = retrieval._text_cases(index, "pair_id", "weights", "term_ids",
                                  ("customer_tweet_id", "support_tweet_id"), "customer_clean_text")
    tables = text_search.prepare(cases)
    left = retrieval.side(index, "pair_id", "weights", "term_ids", "query", retrieval.masks(
        index, ["customer_tweet_id"], "customer_clean_text")).withColumns({
        "qid": F.lit(None).cast("string"), "entries": text_search.entries(F.col("ids"), F.col("vec"))})
    want = brute(index.collect(), 3, masked=True)
    for r in text_search.with_floors(left, tables, 3).collect():
        assert r.floor <= want[r.query_id][2][1] + 1e-9
        light = np.sort(np.array(r.vec))[:r.skip]
        assert r.rest == pytest.approx(float(np.sqrt((light ** 2).sum())), abs=1e-12) and r.rest <= r.floor


def test_substring_masks_leave_k_rows(spark):
    """Cases whose pair id contains the query's id are out before the cut to k."""
    rows = [(f"{i}_{100 + i}", str(i), str(100 + i), "same words here") for i in range(1, 40)]
    rows += [("x_y", "x", "y", "same words"), ("z", "z", "q", "other"), ("e_", "", "", "same words too")]
    index, terms = retrieval.build_text_index(spark.createDataFrame(rows, COLUMNS))
    index = index.cache()
    asked = spark.createDataFrame([("q1", "1", "same words"), ("q2", "", "same words here now"), ("q3", "_", "same"),
                                   ("q4", "39", "words")], "pair_id string, customer_tweet_id string, customer_clean_text string")
    got = as_lists(retrieval.retrieve(
        asked, index, terms, query_key="pair_id", query_text="customer_clean_text", query_id="customer_tweet_id",
        k=3, substring=True))
    for q, own in (("q1", "1"), ("q3", "_"), ("q4", "39")):
        text = {"q1": "same words", "q3": "same", "q4": "words"}[q]
        left = [r[0] for r in rows if own not in r[0] and r[3] != text]
        assert len(got[q]) == min(3, len(left)) and all(c in left for c, _ in got[q]), q
    assert len(got["q2"]) == 3


def test_stored_index_is_read_where_it_lies(spark, index, tmp_path):
    """A second batch of queries moves queries only: no exchange stands above the index scan."""
    index, terms = index
    path = str(tmp_path / "index")
    assert retrieval.save_index(index, path, terms, buckets=4) == 1
    assert retrieval.save_index(index, path, terms, buckets=4) == 2
    tables = retrieval.load_search(spark, path)
    stored, terms = retrieval.load_index(spark, path)
    got = retrieve(stored, terms, k=3, search=tables)
    same(as_lists(got), brute(index.collect(), 3, masked=True))
    first = retrieval.load_search(spark, path, 1)
    assert first.n_cases == tables.n_cases == 330
    spark.sql(f"DROP TABLE {retrieval._table_name(path, 2)}")  # as in a new session
    again = retrieval.load_search(spark, path)
    assert again.n_cases == 330 and again.cases.count() == 330

    asked = text_search.with_floors(retrieval.side(
        stored, "pair_id", "weights", "term_ids", "query", []).withColumn("qid", F.lit(None).cast("string")).withColumn(
        "entries", text_search.entries(F.col("ids"), F.col("vec"))), again, 3)
    plan = text_search.pruned_lists(asked, again, 3)._jdf.queryExecution().executedPlan().toString()
    lines = plan.split("\n")
    scan = next(i for i, line in enumerate(lines) if "Scan parquet" in line and "slices" in line.lower()
                or "Scan parquet" in line and "careweave_" in line)
    depth = len(lines[scan]) - len(lines[scan].lstrip(" :+-*()0123456789"))
    above = []
    for line in reversed(lines[:scan]):
        d = len(line) - len(line.lstrip(" :+-*()0123456789"))
        if d < depth:
            above.append(line.strip())
            depth = d
    assert "Bucketed: true" in lines[scan] and not any("Exchange hashpartitioning" in x for x in above), plan
    with pytest.raises(FileNotFoundError):
        retrieval.load_search(spark, path, 9)


def test_empty_index_and_queries(spark, index):
    index, terms = index
    assert retrieve(index.where("false"), terms).count() == 0
    none = retrieval.retrieve(index.where("false"), index, terms, query_key="pair_id",
                              query_text="customer_clean_text", query_id="customer_tweet_id")
    assert none.count() == 0
    assert features.sparse_vectors(index.where("false"), "pair_id", "customer_clean_text", terms).count() == 0
