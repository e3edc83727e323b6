"""Filter audit against a plain loop over documents, filters and orders."""

import itertools
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from careweave.llm import audit

DOCS = "doc_id long, text string, source string, part string, fails int, digest string"
LABELS = "doc_id long, quality int, toxic int, note string"
LONG = " ".join(f"w{i}" for i in range(60_000))


def plain(rows, labels):
    """part, order, step -> counts, document by document."""
    words = [re.findall(r"[^\x20\x09-\x0D]+", r[1] or "") for r in rows]
    fails = []
    for (i, x, *_), w in zip(rows, words, strict=True):
        x = x or ""
        fails.append({"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w),
                      "C": 100 * len(re.findall("[A-Z]", x)) > 2 * len(x),
                      "D": bool(re.search(r"[#$%&*|]", x)),
                      "E": i is not None and any(o[0] is not None and o[0] < i and (o[1] or "") == x
                                                 for o in rows)})
    good = {i for i, q, *_ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t, *_ in labels if t == 1 and i is not None}
    out, shapley = defaultdict(Counter), Counter()
    for r, f in zip(rows, fails, strict=True):
        part = r[2] or ""
        for order in map("".join, itertools.permutations("ABCDE")):
            gone = False
            for step, c in enumerate(order, 1):
                n = out[part, order, step]
                n["removed"] += (lost := f[c] and not gone)
                n["redundant"] += f[c] and gone
                n["unique_fails"] += f[c] and sum(f.values()) == 1
                n["good_lost"] += lost and r[0] in good
                n["toxic_lost"] += lost and r[0] in toxic
                shapley[part, c] += lost
                gone = gone or f[c]
                n["kept"] += not gone
    for (part, order, step), n in out.items():
        n["shapley"] = shapley[part, order[step - 1]]
    return out


COUNTS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def test_odd_rows_equal_plain_loop(spark):
    texts = [None, "", "A b", "a b", "A b", LONG, LONG + " #", "x " * 300, "x " * 300, "É" * 40 + "A",
             LONG, "A b", "A\x0bb\x1fc", "é" * 99 + "AB", "é" * 100 + "AB"]
    rows = [(i, t, ["s", None, "", "t"][i % 4], "clash", 7, "clash") for i, t in enumerate(texts)]
    rows += [rows[2], rows[10], (None, "A b", "s", "", 0, ""), (None, "A b", "u", "", 0, "")]
    labels = [(2, 1, 0, "a"), (2, 0, 1, "b"), (10, 1, None, "c"), (None, 1, 1, "d"), (4, None, 1, "e"), (99, 1, 1, "f")]
    docs, marked = spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, LABELS)
    want = plain(rows, labels)
    got = {(r.part, r.filter_order, r.step): r for r in audit.audit(docs, marked).collect()}
    assert got.keys() == want.keys() and len(got) == 4 * 600  # the parts are s, t, u and ''
    for key, counts in want.items():
        assert [got[key][c] for c in COUNTS] == [counts[c] for c in COUNTS], key
    words = audit.document_words(docs, marked)
    assert words.count() == len(rows) and words.columns == ["doc_id", "part", "good", "toxic", "word"]
    assert audit.audit(docs, marked.limit(0)).agg({"good_lost": "sum"}).head()[0] == 0


def test_empty_tables(spark):
    docs, marked = spark.createDataFrame([], DOCS), spark.createDataFrame([], LABELS)
    assert audit.audit(docs, marked).count() == 0


@pytest.mark.parametrize("n", [0, 1, 2, 3, 4, 1000, 4097])
def test_positional_popcount(n):
    words = np.random.default_rng(n).integers(0, 2**32, n, dtype=np.uint32)
    want = [int(((words >> np.uint32(b)) & np.uint32(1)).sum()) for b in range(32)]
    assert audit.positional_popcount(words, 32).tolist() == want


def test_many_groups_leave_a_task_in_parts(spark, monkeypatch):
    monkeypatch.setattr(audit, "PENDING_GROUPS", 3)
    words = spark.range(1000).selectExpr(
        "cast(id % 50 as string) part", "id % 2 = 0 good", "id % 3 = 0 toxic", "1L << (id % 32) word")
    got = audit.subset_survivors(words, 5).collect()
    assert sum(sum(r.survivors) for r in got) == 1000
    assert sum(r.survivors[7] for r in got) == len([i for i in range(1000) if i % 32 == 7])


def test_other_filters(spark):
    docs = spark.createDataFrame([(1, "ab", "s"), (2, "ab", "s"), (3, "b", "s")], "doc_id long, text string, source string")
    marked = spark.createDataFrame([(1, 1, 1)], "doc_id long, quality int, toxic int")
    got = audit.audit(docs, marked, {"X": lambda t: "a" in t.text}, "Y")
    assert sorted((r.filter_order, r.step, r.kept, r.removed, r.good_lost) for r in got.collect()) == [
        ("XY", 1, 1, 2, 1), ("XY", 2, 1, 0, 0), ("YX", 1, 2, 1, 0), ("YX", 2, 1, 1, 1)]
