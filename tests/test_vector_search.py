"""Cluster pruning and multi-probe hashing of dense vectors against a plain double loop."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from careweave.operators import retrieval, vector_search
from careweave.operators.blocks import GROUP, masks, side
from careweave.plans import catalog


def frame(spark, rows):
    data = [(i, [float(x) for x in row], f"t{i % 50}") for i, row in enumerate(rows)]
    df = spark.createDataFrame(data, "id long, v array<double>, text string")
    return retrieval.build_vector_index(df, "v").cache()


@pytest.fixture(scope="module")
def clustered(spark):
    """30 tight groups, copies of one vector, zero vectors, a null one."""
    rng = np.random.default_rng(3)
    centers = rng.standard_normal((30, 16))
    rows = centers[rng.integers(0, 30, 700)] + 0.05 * rng.standard_normal((700, 16))
    rows[::4] = rows[0]
    rows[[5, 9]] = 0
    return frame(spark, rows)


@pytest.fixture(scope="module")
def uniform(spark):
    return frame(spark, np.random.default_rng(4).standard_normal((300, 16)))


def sides(df):
    return (side(df, "id", "v", None, "query", masks(df, ["id"], "text")),
            side(df, "id", "v", None, "case", masks(df, ["id"], "text")))


def brute(df, k):
    rows = df.orderBy("id").collect()
    sims = np.round(np.maximum(np.array([r.v for r in rows]) @ np.array([r.v for r in rows]).T, 0), 4)
    out = {}
    for i, q in enumerate(rows):
        scored = [(-sims[i, j], c.id) for j, c in enumerate(rows) if c.id != q.id and c.text != q.text]
        out[q.id] = [(c, -s + 0.0) for s, c in sorted(scored)[:k]]
    return out


def as_lists(cases):
    out = {}
    for r in cases.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["case_id"], r["similarity_score"]))
    return out


@pytest.mark.parametrize("name", ["clustered", "uniform"])
@pytest.mark.parametrize("block_rows", [40, 100_000])
def test_cluster_scan_is_exact(name, block_rows, request):
    df = request.getfixturevalue(name)
    left, right = sides(df)
    index = vector_search.prepare(right, clusters=25)
    assert as_lists(vector_search.cluster_scan(left, index, 4, block_rows)) == brute(df, 4)


def test_search_picks_the_full_scan_where_nothing_is_skipped(clustered, uniform):
    shares = {}
    for name, df in (("clustered", clustered), ("uniform", uniform)):
        left, right = sides(df)
        index = vector_search.prepare(right, clusters=25)
        shares[name] = vector_search.skipped_share(left, index, 4)
        assert as_lists(vector_search.search(left, index, 4)) == brute(df, 4)
        assert as_lists(vector_search.search(left, right, 4, block_rows=64)) == brute(df, 4)
    print(shares)
    assert shares["clustered"] > 0.8 and 0 <= shares["uniform"] < 0.5


def test_skipped_pairs_are_never_met(clustered):
    """Queries go to few clusters in the second round."""
    left, right = sides(clustered)
    index = vector_search.prepare(right, clusters=25)
    near = vector_search.ranked(vector_search.grouped_lists(
        vector_search._routed(left, index, True), index.cases, 4), 4)
    sent = vector_search._routed(vector_search._with_floor(left, near, 4), index, False)
    assert sent.count() < 0.2 * 700 * (index.sizes > 0).sum()
    assert index.cases.groupBy(GROUP).count().agg(F.sum("count")).head()[0] == 700


def test_odd_tables(spark, clustered):
    left, right = sides(clustered)
    empty = vector_search.prepare(right.where("false"))
    assert vector_search.search(left, empty, 3).count() == 0
    assert vector_search.cluster_scan(left.where("false"), vector_search.prepare(right, clusters=3), 3).count() == 0
    odd = spark.createDataFrame([(1, [1.0, 0.0]), (2, None), (3, [1.0, 0.0, 0.0])], "id long, v array<double>")
    with pytest.raises(Exception, match="vectors of"):
        vector_search.prepare(side(odd, "id", "v", None, "case", []))


def test_probe_masks():
    assert vector_search.probe_masks(3, 1) == [0, 1, 2, 4]
    assert len(vector_search.probe_masks(5, 2)) == 16 and len(set(vector_search.probe_masks(5, 2))) == 16


def test_radius_from_a_sample(uniform):
    left, right = sides(uniform)
    radius, share = vector_search.choose_radius(left, right, 3, dim=16, tables=4, bits=8)
    found = vector_search.hashed_scan(left, right, 3, dim=16, tables=4, bits=8, radius=radius)
    exact = vector_search.full_scan(left, right, 3)
    assert share >= 0.95 and vector_search.recall(found, exact) >= 0.9
    less = vector_search.hashed_scan(left, right, 3, dim=16, tables=4, bits=8, radius=radius - 1)
    assert vector_search.recall(less, exact) < vector_search.recall(found, exact)


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_recall_of_the_registered_query(spark, sf):
    folder = f"/root/testdata/{sf}"
    vectors = catalog._vectors(spark, folder)
    exact = retrieval.top_k(vectors, vectors, query_key="vec_id", case_key="vec_id", vector="embedding",
                            query_id="vec_id", case_ids=("vec_id",))
    share = vector_search.recall(catalog.knn_lsh(spark, folder), exact)
    print(sf, share)
    assert share >= 0.9
