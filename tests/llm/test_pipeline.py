"""The stages of the corpus pipeline, each on what the one before kept."""

import random

import corpus_pipeline
from careweave.llm import bpe, mixture
from careweave.session import materialize


def test_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES:
        kept = materialize(stage(spark, docs, sf))
        if name == "bpe":
            assert kept.count() == before
            break
        assert kept.columns == columns
        if name != "mixture":
            assert kept.join(docs, "doc_id", "left_anti").isEmpty()
            assert 0.5 * before < kept.count() <= before
        if name == "exact":
            texts = [(r.text or "").encode().lower() for r in kept.collect()]
            assert len(set(texts)) == len(texts)
            assert {(r.text or "").encode().lower() for r in docs.collect()} == set(texts)
        docs, before = kept, kept.count()


def test_rows_of_trees_equal_single_trees():
    import public_tokenizers

    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        codec = bpe.Codec(file.read())
    random.seed(3)
    for leaves in (1, 2, 4, 16, 64):
        pieces = [bytes(random.choice(b"the and of\xc3\xa9aab0") for _ in range(random.randint(1, leaves + 1)))
                  for _ in range(200)] + [b"a" * (leaves + 1)]
        assert codec.merge_rows(pieces, leaves) == [codec.merge(x) for x in pieces]
    assert codec.encode("") == [] and codec.decode([]) == ""


def test_near_stage_equals_brute_force(spark, sf):
    random.seed(5)
    texts = []
    for k in range(30):
        words = [f"{k}v{random.randrange(10**6)}" for _ in range(250)]
        texts.append(" ".join(words))
        for changed in (3, 5, 6, 8):
            copy = list(words)
            for i in random.sample(range(250), changed):
                copy[i] = f"c{random.randrange(10**6)}"
            texts.append(" ".join(copy))
    sets = [{tuple(w[i:i + 5]) for i in range(len(w) - 4)} for w in map(str.split, texts)]
    low = list(range(len(texts)))
    between = 0
    for _ in range(5):
        for i, a in enumerate(sets):
            for j in range(i // 5 * 5, i):
                same = len(a & sets[j])
                if 100 * same >= 80 * (len(a) + len(sets[j]) - same):
                    between += 100 * same < 85 * (len(a) + len(sets[j]) - same)
                    low[i] = low[j] = min(low[i], low[j])
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    kept = {r.doc_id for r in corpus_pipeline.near_once(spark, docs, sf).collect()}
    assert between and kept == {i for i, x in enumerate(low) if i == x}


def test_stages_on_repeated_rows_null_ids_and_extra_columns(spark, sf):
    """Columns named like the ones of the plan; equal rows, equal ids and null ids."""
    a, b = (" ".join(f"{x}{i}" for i in range(300)) for x in "ab")
    rows = [(1, a), (1, a), (1, a), (None, a), (2, b), (2, b), (None, b), (None, "c d"),
            (None, "e f"), (7, "g h"), (7, "i j"), (8, None), (None, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or ""), k, k, k, k) for k, (i, t) in
                                  enumerate(rows)], "doc_id long, text string, lang string, source string, "
                                 "n_chars long, size int, passes int, part int, row_key int")
    want = sorted([(1, a), (2, b), (None, "c d"), (None, "e f"), (7, "g h"), (7, "i j")], key=str)
    for stage, empty in ((corpus_pipeline.exact_once, 1), (corpus_pipeline.near_once, 2)):
        kept = stage(spark, docs, sf)
        got = sorted(((r.doc_id, r.text) for r in kept.collect()), key=str)
        assert kept.columns == docs.columns
        assert [x for x in got if x[1]] == want and len(got) == len(want) + empty
    plan = mixture.mix(docs.drop("size")).agg({"taken": "sum"}).first()[0]
    out = corpus_pipeline.mixed(spark, docs, sf)
    assert out.columns == docs.columns
    assert sum(len(r.text.split()) for r in out.collect()) == plan
    kept = corpus_pipeline.good_quality(spark, docs, sf)
    assert kept.columns == docs.columns and kept.count() <= len(rows)


def test_cut_texts_stand_as_they_are(spark, sf):
    """Line breaks, tabs and indentation inside a cut text stay; nothing is added."""
    rng = random.Random(8)
    seps = [" ", "\n", "\t", "  ", "\r\n    ", "\x0b"]
    rows = [(i, "".join(w for k in range(rng.randrange(1, 60)) for w in (f"w{i}_{k}é", rng.choice(seps))),
             "en", f"s{i % 3}", -7) for i in range(80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    texts, cut = {r[0]: r[1] for r in rows}, 0
    for r in corpus_pipeline.mixed(spark, docs, sf).collect():
        assert r.text in texts[r.doc_id]
        if r.text != texts[r.doc_id]:
            cut += 1
            assert r.n_chars == len(r.text) and r.text == r.text.strip(" \n\t\r\x0b") and r.text.split()
    assert cut


def test_stages_on_an_empty_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").where("false")
    for name, stage in corpus_pipeline.STAGES:
        assert materialize(stage(spark, docs, sf)).count() == 0, name
