"""Lexical search against a plain loop over items and documents."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from careweave.llm import search

DOCS = "doc_id long, text string, term string, score long, item string"
ITEMS = "item_id long, text string, doc_id long, slice string"


def words(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower)


def plain(docs, items, best=50):
    """item -> [(rank, doc_id, score)]"""
    texts = [(i, words(x)) for i, x, *_ in docs]
    texts = [(i, Counter(w)) for i, w in texts if w]
    n_docs, n_terms = len(texts), sum(w.total() for _, w in texts)
    df = {}
    for _, w in texts:
        for t in w:
            df[t] = df.get(t, 0) + 1
    asked = {}
    for i, x, *_ in items:
        asked.setdefault(i, set()).update(words(x))
    out = {}
    for item, found in asked.items():
        scored = []
        for i, w in texts:
            m = 100 - 50 + 50 * w.total() * n_docs // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                        * (10**9 * w[t] // (1000 * w[t] + 20 * m)) for t in found if t in w)
            if score > 0:
                scored.append((-score, i is None, i, score))
        scored.sort(key=lambda x: x[:3])
        if scored:
            out[item] = [(k, i, s) for k, (_, _, i, s) in enumerate(scored[:best], 1)]
    return out


def as_lists(frame):
    out = {}
    for r in sorted(frame.collect(), key=lambda r: (r.item_id is None, r.item_id or 0, r["rank"])):
        out.setdefault(r.item_id, []).append((r["rank"], r.doc_id, r.score))
    return out


def corpus(seed, n):
    """Zipf-like words; a third of the documents are copies of one."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    weights = [1 / (i + 1) for i in range(300)]
    docs = [" ".join(rng.choices(vocabulary, weights, k=rng.choice([1, 5, 40, 200]))) for _ in range(n)]
    docs[::3] = [docs[0]] * len(docs[::3])
    items = [" ".join(rng.choices(vocabulary, k=rng.choice([1, 3, 12]))) for _ in range(25)] + [docs[0], docs[1]]
    return list(enumerate(docs)), list(enumerate(items))


@pytest.mark.parametrize("best, stages, bundle, slice_docs", [(5, 4, 256, 64), (50, 3, 4, 1 << 14), (3, 1, 7, 10)])
def test_equals_plain_loop(spark, monkeypatch, best, stages, bundle, slice_docs):
    monkeypatch.setattr(search, "SLICE_DOCS", slice_docs)
    docs, items = corpus(best, 600)
    got = search.search(spark.createDataFrame(docs, "doc_id long, text string"),
                        spark.createDataFrame(items, "item_id long, text string"), best, stages, bundle)
    assert as_lists(got) == plain(docs, items, best)


def test_odd_rows(spark):
    long = " ".join(f"w{i % 7000}" for i in range(60_000))
    texts = [None, "", " ,.;", "Über a-b A_B", "über a b", "ÜBER", long, "x " * 4000, "a", "a", "a b"]
    docs = [(i, x, "clash", 1, "clash") for i, x in enumerate(texts)]
    docs += [docs[8], (None, "a", "", 0, ""), (None, "über", "", 0, ""), (-5, "a", "", 0, "")]
    items = [(1, "A über", 5, "s"), (2, None, 5, "s"), (3, "", 5, "s"), (4, "zzz nothing", 5, "s"), (5, long, 5, "s"),
             (6, "x", 5, "s"), (6, "b", 5, "s"), (None, "a", 5, "s"), (None, "ÜBER", 5, "s"), (7, "w1 w1 x", 5, "s")]
    frames = spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)
    got = as_lists(search.search(*frames))
    assert got == plain(docs, items)
    assert set(got) == {1, 5, 6, 7, None}


def test_empty_tables(spark):
    docs, items = spark.createDataFrame([(1, "a", "", 0, "")], DOCS), spark.createDataFrame([(1, "a", 0, "")], ITEMS)
    assert search.search(docs, items.limit(0)).count() == 0
    assert search.search(docs.limit(0), items).count() == 0
    assert search.search(docs, items).count() == 0 or plain([(1, "a")], [(1, "a")])


def test_more_terms_than_the_filter_holds(spark, monkeypatch):
    monkeypatch.setattr(search, "VOCABULARY_TERMS", 10)
    docs, items = corpus(9, 100)
    got = search.search(spark.createDataFrame(docs, "doc_id long, text string"),
                        spark.createDataFrame(items, "item_id long, text string"))
    assert as_lists(got) == plain(docs, items)


def test_later_owners_open_few_entries(spark):
    """A common term of a later owner adds to open entries only, where it can't decide."""
    ids = pa.array([list(range(100))], pa.list_(pa.int64()))
    left = pa.table({"bundle": pa.array([0], pa.int32()), "slice": pa.array([0], pa.int64()),
                     "item": pa.array([None], pa.int64()), "ids": ids,
                     "plan": pa.array([[{"item": 1, "rests": [1000, 0]}]]),
                     "spots": pa.array([None], pa.list_(pa.int32())), "scores": pa.array([None], pa.list_(pa.int64())),
                     "floor": pa.array([None], pa.int64())})

    def postings(w, spots):
        return pa.table({"w": pa.array([w]), "items": pa.array([[1]]), "spots": pa.array([spots], pa.list_(pa.int32())),
                         "tfs": pa.array([[1] * len(spots)], pa.list_(pa.int32())),
                         "lengths": pa.array([[10] * len(spots)], pa.list_(pa.int32()))})

    first = search._stage(0, False, 2, 100, 1000, pa.int64())(left, postings(9000, [3, 5, 7]))
    assert first.num_rows == 2 and first["spots"][1].as_py() == [3, 5, 7]
    part = int(search.impacts(np.array([1]), np.array([10]), 100, 1000)[0])
    last = search._stage(1, True, 2, 100, 1000, pa.int64())(first, postings(1, list(range(100))))
    assert last.to_pylist() == [{"item_id": 1, "doc_id": d, "score": 9001 * part} for d in (3, 5)]


def test_impacts_of_very_long_texts():
    got = search.impacts(np.array([3]), np.array([10**9]), 10**9, 10**12)
    assert got.tolist() == [10**9 * 3 // (3000 + 20 * (50 + 50 * 10**9 * 10**9 // 10**12))]
