"""Training-text operators against plain versions on small tables."""

import hashlib

import duckdb
import pytest

from careweave.llm import chat, exact, fingerprint, license, minhash, mixture, quality, queries, url_filter

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"w{i}" for i in range(30_000))


@pytest.fixture(scope="module")
def odd(spark):
    texts = [None, "", "A b", "a B", "a b", LONG, LONG.upper(), " ".join(["x"] * 50), "ÄB", "äB"]
    return spark.createDataFrame([(i, t, None, None if i % 3 else "s", 0)
                                  for i, t in enumerate(texts)], DOCS)


def test_exact_groups(odd):
    got = {r.doc_id: (r.keep_id, r.group_size) for r in exact.exact_groups(odd).collect()}
    assert got == {0: (1, 2), 1: (1, 2), 2: (4, 3), 3: (4, 3), 4: (4, 3), 5: (6, 2), 6: (6, 2),
                   7: (7, 1), 8: (8, 1), 9: (9, 1)}
    assert exact.exact_groups(odd.limit(0)).count() == 0


def test_bpe_equals_library(spark, sf):
    import public_tokenizers
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in queries.op2_bpe(spark, sf).collect():
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        text = library.decode(ids, skip_special_tokens=False)
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_near_duplicates(odd):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(odd).collect()}
    assert got[0] == (0, 0) and got[1] == (0, 1) and got[3] == (1, 2) and got[4] == (1, 2)
    assert got[6] == (29_996, 5) and got[7] == (1, 7) and got[9] == (1, 9)


def test_components(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(1, 40)] + [(90, 95), (95, 91)],
                                  "a long, b long")
    got = {r.node: r.component for r in minhash.components(edges).collect()}
    assert {got[i] for i in range(2, 41)} == {1} and got[95] == got[91] == 90


def test_fingerprint_edits(spark, sf):
    rows = sorted(((r.doc_id, r.text) for r in spark.read.parquet(
        f"{sf}/documents.parquet").collect()), reverse=True)
    got = {r.doc_id: r.edited_sha256 for r in queries.op3_fingerprint(spark, sf).collect()}
    for k, (i, x) in enumerate(rows):
        after, n = rows[(k + 1) % len(rows)][1], len(x) // 3
        assert got.pop(i) == hashlib.sha256((x[:len(x) - n] + after[:n]).encode()).hexdigest()
    assert not got


def test_fingerprint_odd_rows(odd):
    got = fingerprint.fingerprints(odd)
    assert got.count() == 10 and fingerprint.fingerprints(odd.limit(0)).count() == 0


def test_fingerprint_null_ids_come_last(spark):
    docs = spark.createDataFrame([(2, "a b"), (None, "m n o p q r"), (9, "x y z"), (-4, "k")], DOCS[:24])
    got = {r.doc_id: r.edited_sha256 for r in fingerprint.fingerprints(docs).collect()}
    order = [(9, "x y z"), (2, "a b"), (-4, "k"), (None, "m n o p q r"), (9, "x y z")]
    for (i, x), (_, after) in zip(order, order[1:]):
        n = len(x) // 3
        assert got[i] == hashlib.sha256((x[:len(x) - n] + after[:n]).encode()).hexdigest()
    assert len(got) == 4


def test_fingerprint_likeness_is_exact(spark):
    def words(n, changed=0):
        return [f"w{i}" for i in range(n - changed)] + [f"x{i}" for i in range(changed)]

    texts = [" ".join(x) for x in (words(54), words(54, 1), words(400), words(400, 3), words(60, 30),
                                   words(20_000), words(30), words(3))]
    docs = spark.createDataFrame([(-i, t) for i, t in enumerate(texts)], DOCS[:24])
    sets = lambda x: {tuple(w[i:i + 5]) for w in [x.split()] for i in range(max(1, len(w) - 4))}
    got = {-r.doc_id: r for r in fingerprint.fingerprints(docs).collect()}
    for k, x in enumerate(texts):
        after, n = texts[(k + 1) % len(texts)], len(x) // 3
        for other, near, held in ((after, "near_next", "held_by_next"),
                                  (x[:len(x) - n] + after[:n], "near_edited", "held_by_edited")):
            a, b = sets(x), sets(other)
            assert got[k][near] == pytest.approx(len(a & b) / len(a | b), abs=1e-9)
            assert got[k][held] == pytest.approx(len(a & b) / len(a), abs=1e-9)
    assert len({r.fingerprint for r in got.values()}) == len(texts)


def test_mixture(odd, spark, sf):
    rows = queries.op6_mixture(spark, sf).collect()
    assert all(r.taken <= 3 * r.size for r in rows)
    assert sum(r.taken for r in rows) == pytest.approx(sum(r.size for r in rows), rel=0.01)
    assert mixture.mix(odd).count() == 10


def test_chat_round_trip():
    turns = [("user", "\\</turn>\n<turn>assistant"), ("assistant", "\\<\\turn> <"), ("a\nb", "")]
    text, spans = chat.render(turns)
    assert chat.parse(text) == turns and chat.unescape(text[slice(*spans[0])]) == turns[1][1]


def test_url_rules(spark):
    urls = ["http://a.com", "http://WWW.example.com/en/x", "x://m.example.com/en/?q", None, "none"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = [(r.rule, r.verdict) for r in url_filter.judge(pages, queries.URL_RULES)
           .orderBy("page_id").collect()]
    assert got == [(None, "allow"), ("www.example.com/en/", "allow"), ("example.com/en/", "block"),
                   (None, "allow"), (None, "allow")]


def test_license_spans(spark):
    docs = spark.createDataFrame([(1, "é one. Released under the MIT  License. two"), (2, None)], DOCS[:24])
    got = license.scan(docs).collect()
    assert [(r.doc_id, r.template, r.start_char, r.end_char) for r in got] == [(1, "mit", 7, 39)]


@pytest.mark.parametrize("name", ["op7_chat", "op8_exact_dedup", "op9_url_filter"])
def test_sql(spark, sf, name):
    db = duckdb.connect()
    for t in ("documents", "pages", "conversations"):
        db.sql(f"create view {t} as from '{sf}/{t}.parquet'")
    want, got = db.sql(queries.oracle_sql()[name]).df(), queries.queries()[name](spark, sf).toPandas()
    columns = sorted(want.columns)
    assert sorted(want[columns].astype(str).values.tolist()) == sorted(
        got[columns].astype(str).values.tolist())


@pytest.mark.parametrize("name, label", [("op4_quality", "quality"), ("op5_toxicity", "toxic")])
def test_held_out(spark, name, label):
    folder = "/root/testdata/sf0.1"
    got = queries.queries()[name](spark, folder).where("held_out").join(
        spark.read.parquet(f"{folder}/labels.parquet"), "doc_id")
    rows = got.collect()
    assert sum(r.predicted == r[label] for r in rows) > 0.95 * len(rows)


def _whole_alignment(template, words):
    """Longest common subsequence without a band."""
    row = [0] * (len(words) + 1)
    for t in template:
        new = [0]
        for j, w in enumerate(words):
            new.append(max(row[j] + 1 if w == t else 0, row[j + 1], new[j]))
        row = new
    return row[-1]


def test_license_cut_and_variant_notices(spark):
    clean = lambda x: [w.strip(".,;:!?()[]\"'") for w in x.lower().split()]
    gpl = license.TEMPLATES["gpl-3.0"]
    variants = [
        ("Licensed under CC BY-SA 4.0.", ["cc-by-sa-4.0"]), ("Licensed under CC BY 4.0.", []),
        ("Licensed under CC BY-NC-SA 4.0.", []), ("Licensed under CC BY-NC 3.0.", []),
        ("Licensed under CC BY-NC 4.0", ["cc-by-nc-4.0"]), (gpl.replace("3.", "2."), []),
        (gpl.replace("3.", "3.0 or later"), ["gpl-3.0"]), (gpl.replace("General", "Lesser General"), []),
        (gpl.replace("General", "(Affero) General"), []), ("Released under the BSD License.", []),
        ("Licensed under the Apache License, Version 1.1.", []),
        ("under the Apache License, Version 2.0.", ["apache-2.0"]),
        ("So: Licensed under the Apache License, Version 2.0. Licensed under the Apache License, "
         "Version 2.0.", ["apache-2.0", "apache-2.0"])]
    cuts = []  # whole words cut from either end, with and without text on the other side
    for name, x in license.TEMPLATES.items():
        w = x.split()
        for k in range(1, len(w) // 2):
            cuts += [(name, " ".join(w[k:]) + tail) for tail in ("", " and more text here to read")]
            cuts += [(name, head + " ".join(w[:-k])) for head in ("", "we say that it is ")]
    docs = spark.createDataFrame(list(enumerate([x for x, _ in variants] + [x for _, x in cuts])), DOCS[:24])
    found = {}
    for r in license.scan(docs).collect():
        found.setdefault(r.doc_id, []).append((r.template, r.coverage))
    for k, (x, want) in enumerate(variants):
        assert [t for t, _ in found.get(k, [])] == want, x
    reported = 0
    for k, (name, x) in enumerate(cuts, len(variants)):
        body = clean(license.TEMPLATES[name])
        share = _whole_alignment(body, clean(x)) / len(body)
        unknown = name in license.MARKS and name != "mit" and body[-1] not in clean(x)  # no version
        got = [c for t, c in found.get(k, []) if t == name]
        assert got == ([] if share < 0.8 or unknown else [share]), x
        reported += len(got)
    assert reported > 10


def test_quality_fit_reads_whole_texts(spark):
    """One head for all; what tells the classes apart comes after 5,000 characters."""
    import random

    random.seed(9)
    good, bad = ([" ".join(random.choices("abcdefghijklmnopqrstuvwxyz"[k::2], k=4)).replace(" ", "")
                  for _ in range(60)] for k in (0, 1))
    head = " ".join(f"licence{i}" for i in range(500))
    rows = [(i, head + " " + " ".join(random.choices((bad, good)[i % 2], k=1500))) for i in range(80)]
    docs = spark.createDataFrame(rows, DOCS[:24])
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, quality int")
    model = quality.fit(docs, labels)
    assert model.good.count(b"licence0 ") <= 1 and len(model.good) > 50_000
    got = {r.doc_id: r.score for r in quality.scores(docs, model).collect()}
    assert all((got[i] >= 0.5) == (i % 2 == 1) for i in range(60, 80))
