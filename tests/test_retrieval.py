import numpy as np
import pytest
from pyspark.sql import functions as F

from careweave.operators import features, retrieval
from careweave.operators.replies import grounding_context


@pytest.fixture(scope="module")
def vectors(spark):
    """Random vectors, a third of them copies of one, plus a zero vector."""
    rng = np.random.default_rng(5)
    rows = rng.standard_normal((150, 8))
    rows[::3] = rows[0]
    rows[149] = 0
    data = [(i, [float(x) for x in row], f"t{i % 40}") for i, row in enumerate(rows)]
    df = spark.createDataFrame(data, "id long, v array<double>, text string")
    return retrieval.build_vector_index(df, "v").cache()


def brute(rows, k, masked):
    out = {}
    for q in rows:
        scored = []
        for c in rows:
            if masked and (q["id"] == c["id"] or q["text"] == c["text"]):
                continue
            sim = round(max(0.0, float(np.dot(q["v"], c["v"]))), 4)
            scored.append((-sim, c["id"]))
        out[q["id"]] = [(i, -s) for s, i in sorted(scored)[:k]]
    return out


def as_lists(cases):
    out = {}
    for r in cases.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["case_id"], r["similarity_score"]))
    return out


@pytest.mark.parametrize("block_rows", [7, 10_000])
@pytest.mark.parametrize("masked", [False, True])
def test_exact_top_k(vectors, block_rows, masked):
    options = dict(query_id="id", case_ids=("id",), query_text="text", case_text="text")
    got = as_lists(retrieval.top_k(
        vectors, vectors, query_key="id", case_key="id", vector="v", k=4, block_rows=block_rows,
        **(options if masked else {})))
    want = brute(vectors.collect(), 4, masked)
    assert got.keys() == want.keys()
    for query, cases in want.items():
        assert got[query] == cases, query


def test_fewer_cases_than_k_and_none(spark, vectors):
    two = vectors.where("id < 2")
    options = dict(query_key="id", case_key="id", vector="v", k=3)
    assert retrieval.top_k(vectors, two, **options).groupBy("query_id").count().agg(
        F.min("count"), F.max("count")).head() == (2, 2)
    assert retrieval.top_k(vectors, vectors.where("false"), **options).count() == 0
    own = retrieval.top_k(two, two.where("id = 0"), **options, query_id="id", case_ids=("id",))
    assert [r["query_id"] for r in own.collect()] == [1]


def test_approximate_finds_copies(vectors):
    got = as_lists(retrieval.approximate_top_k(
        vectors.where("id < 149"), vectors.where("id < 149"), query_key="id", case_key="id",
        vector="v", dim=8, k=3, block_rows=9, query_id="id", case_ids=("id",)))
    exact = as_lists(retrieval.top_k(
        vectors.where("id < 149"), vectors.where("id < 149"), query_key="id", case_key="id",
        vector="v", k=3, query_id="id", case_ids=("id",)))
    # Copies share every code, so their lists are exact.
    assert all(got[i] == exact[i] for i in range(0, 149, 3))
    found = sum(len({c for c, _ in got.get(i, [])} & {c for c, _ in cases}) for i, cases in exact.items())
    assert found / sum(map(len, exact.values())) > 0.6


TEXTS = [
    ("p1", "c1", "s1", "package tracking delayed today"),
    ("p2", "c2", "s2", "refund not credited to card"),
    ("p3", "c3", "s3", "package not delivered, tracking says delayed"),
    ("p4", "c4", "s4", "Refund not credited to card"),
    ("p5", "c5", "s5", "!!"),
]


@pytest.fixture(scope="module")
def pairs(spark):
    return spark.createDataFrame(
        [(*t, f"answer {i}") for i, t in enumerate(TEXTS)],
        "pair_id string, customer_tweet_id string, support_tweet_id string, "
        "customer_clean_text string, support_response string")


def test_text_vectors(spark, pairs):
    terms = features.fit_terms(pairs, "customer_clean_text", stop_words=("to",))
    names = {r["term"]: r for r in terms.collect()}
    assert "to" not in names and sorted(r["term_id"] for r in names.values()) == list(range(len(names)))
    assert names["package"]["idf"] == pytest.approx(np.log(6 / 3) + 1)
    rows = {r["pair_id"]: r for r in features.sparse_vectors(
        pairs, "pair_id", "customer_clean_text", terms).collect()}
    assert rows["p5"]["term_ids"] == []
    assert sum(w * w for w in rows["p3"]["weights"]) == pytest.approx(1.0)
    few = features.fit_terms(pairs, "customer_clean_text", max_features=3)
    assert [r["term"] for r in few.orderBy("term").collect()] == ["card", "credited", "not"]


def test_text_retrieval(spark, pairs, tmp_path):
    index, terms = retrieval.build_text_index(pairs)
    retrieval.save_index(index, str(tmp_path / "index"), terms)
    index, terms = retrieval.load_index(spark, str(tmp_path / "index"))
    asked = spark.createDataFrame(
        [("q1", "c9", "tracking is late"), ("q2", "c1", "package tracking"), ("q3", "", "zzz")],
        "query string, tweet string, text string")
    got = as_lists(retrieval.retrieve(
        asked, index, terms, query_key="query", query_text="text", query_id="tweet", k=2))
    assert got["q1"][0][0] == "p1" and got["q1"][0][1] > got["q1"][1][1] > 0
    assert [c for c, _ in got["q2"]] == ["p3", "p2"]  # its own message p1 is masked
    assert got["q3"] == [("p1", 0.0), ("p2", 0.0)]    # nothing known: ties by id
    own = as_lists(retrieval.retrieve(
        index, index, terms, query_key="pair_id", query_text="customer_clean_text",
        query_id="customer_tweet_id", k=5))
    assert "p4" not in [c for c, _ in own["p2"]] and len(own["p2"]) == 3
    with pytest.raises(FileNotFoundError):
        retrieval.load_index(spark, str(tmp_path / "none"))
    with pytest.raises(ValueError):
        retrieval.build_text_index(pairs.where("false"))


def test_block_join_moves_no_pairs(vectors):
    plan = retrieval.top_k(
        vectors, vectors, query_key="id", case_key="id", vector="v"
    )._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert "FlatMapCoGroupsInArrow" in plan


def test_grounding_context(spark):
    cases = spark.createDataFrame(
        [("q", 2, 0.1, "c2", "r2"), ("q", 1, 1.0, "c1", "r1")],
        "query_id string, rank int, similarity_score double, case_text string, case_response string")
    assert grounding_context(cases).head()["context"] == (
        "Precedent 1 (Similarity: 1.0):\n  Customer: c1\n  Support Resolution: r1\n\n"
        "Precedent 2 (Similarity: 0.1):\n  Customer: c2\n  Support Resolution: r2")


def test_null_and_odd_vectors(spark):
    schema = "id long, vec array<double>"
    cases = spark.createDataFrame([(1, [1.0, 0.0]), (2, None), (3, [0.0, 1.0]), (4, [1.0, 0.0])], schema)
    queries = spark.createDataFrame([(1, [1.0, 0.0]), (2, None), (3, [0.0, 1.0])], schema)
    got = retrieval.top_k(queries, cases, query_key="id", case_key="id", vector="vec", k=2)
    assert sorted((r.query_id, r.rank, r.case_id, r.similarity_score) for r in got.collect()) == [
        (1, 1, 1, 1.0), (1, 2, 4, 1.0), (3, 1, 3, 1.0), (3, 2, 1, 0.0)]
    longer = spark.createDataFrame([(5, [1.0, 0.0, 0.0])], schema)
    with pytest.raises(Exception, match="vectors of"):
        retrieval.top_k(longer, cases, query_key="id", case_key="id", vector="vec", k=2).collect()
