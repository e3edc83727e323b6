"""What the model queries keep on disk on the way."""

import os
import random

import pytest
from pyspark.sql import DataFrame

from careweave.operators import models
from careweave.plans import catalog
from careweave.session import shared_dir

SETTING = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _shuffled_bytes(plan):
    """Bytes that the exchanges of an executed plan wrote."""
    kind = plan.getClass().getSimpleName()
    if kind == "AdaptiveSparkPlanExec":
        return _shuffled_bytes(plan.executedPlan())
    if kind.endswith("QueryStageExec"):
        return _shuffled_bytes(plan.plan())
    own = plan.metrics().apply("shuffleBytesWritten").value() if kind == "ShuffleExchangeExec" else 0
    return own + sum(_shuffled_bytes(plan.children().apply(i)) for i in range(plan.children().size()))


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Documents whose texts take nearly all of the room: copies of golden texts in other letters, ids
    that are null or come twice, null and blank texts."""
    rng = random.Random(5)
    long = [" ".join(f"{rng.getrandbits(48):x}" for _ in range(300)) for _ in range(120)]
    rows = [(i, t, ("de", "en", "es", "fr", None)[i % 5]) for i, t in enumerate(long)]
    rows += [(1000 + i, f"  {long[i].upper()} ", "en") for i in range(0, 40)]  # copies of golden and other texts
    rows += [(None, long[3], "de"), (None, long[4], "de"), (None, "no id at all", "fr"), (7, "other text of id 7", "en")]
    rows += [(8, long[8], "es"), (9, long[9], "en"), (9, long[9], "en"), (2000, None, "de"), (2001, "  ", "de")]
    labels = [(i, 1, 0) for i in [*range(0, 120, 3), 3, 2000, None]]
    top = str(tmp_path_factory.mktemp("split"))
    spark.createDataFrame(rows, "doc_id long, text string, lang string").coalesce(2).write.parquet(f"{top}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{top}/labels.parquet")
    return top, rows, {x for x, _, _ in labels if x is not None}


def test_split_moves_each_text_once(spark, folder, monkeypatch):
    top, rows, rated = folder
    moved, write = [], catalog.materialize

    def measured(df):
        df.collect()
        moved.append(_shuffled_bytes(df._jdf.queryExecution().executedPlan()))
        return write(df)

    monkeypatch.setattr(catalog, "materialize", measured)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as where tables are large
    try:
        train, golden = catalog._labelled_split(spark, top)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    written = sum(os.path.getsize(f"{top}/documents.parquet/{x}") for x in os.listdir(f"{top}/documents.parquet"))
    assert sum(moved) < 2 * written, (moved, written)
    key = lambda t: (t or "").strip().lower()
    golden_texts = {key(t) for i, t, _ in rows if i in rated}
    texts = {"golden": [(i, t) for i, t, _ in rows if i in rated],
             "train": [(i, t) for i, t, _ in rows if i not in rated and key(t) not in golden_texts]}
    for name, df in {"golden": golden, "train": train}.items():
        got = [(r["doc_id"], r["customer_clean_text"]) for r in df.collect()]
        want = [(i, " ".join((t or "").split())) for i, t in texts[name]]
        assert sorted(got, key=str) == sorted(want, key=str)
        assert df.columns == ["doc_id", "customer_clean_text", "intent", "gold_intent"]
        assert df.where("intent is null or intent <> gold_intent").isEmpty()
    assert any(i is None for i, _ in texts["train"])


def test_text_model_keeps_counts_only(spark, monkeypatch):
    kept, left = [], f"{shared_dir(spark)}/tables"
    train = spark.createDataFrame([("where is my parcel", "A"), ("refund the order", "B"), ("no label", None)],
                                  "customer_clean_text string, intent string")
    before = set(os.listdir(left.removeprefix("file:"))) if os.path.isdir(left.removeprefix("file:")) else set()
    write = getattr(models, "materialize", None)
    monkeypatch.setattr(DataFrame, "cache", lambda df, f=DataFrame.cache: kept.append(df.columns) or f(df))
    monkeypatch.setattr(models, "materialize", lambda df: kept.append(df.columns) or write(df), raising=False)
    fitted = models.fit_tfidf(train, max_iter=5)
    assert kept == [["intent", "_weight", "_tf"]]
    assert set(os.listdir(left.removeprefix("file:"))) == before  # its table is deleted
    assert fitted.predict(train).where("predicted_intent = intent").count() == 2
    assert spark.conf.get(SETTING) == "false"


def test_fits_take_no_shuffle_by_label(spark):
    """By label, texts would go to as many tasks as there are classes."""
    train = spark.range(64).selectExpr("concat('text ', id) as t", "concat('label ', id % 3) as intent")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        weighted, n = models._weighted(train, "intent")
        rows = weighted.collect()
        plan = weighted._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert n == len(rows) == 64 and "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert sum(r["_weight"] for r in rows) == pytest.approx(64)


def test_model_properties_delete_their_tables(spark, sf):
    tables = f"{shared_dir(spark)}/tables".removeprefix("file:")
    before = set(os.listdir(tables)) if os.path.isdir(tables) else set()
    rows = {r["model"]: r for r in catalog.model_properties(spark, sf).collect()}
    assert len(set(os.listdir(tables)) - before) == 1
    assert set(rows) == {"baseline_0_majority", "baseline_1_tfidf", "main_model_embedding"}
    for r in rows.values():
        assert (r["adds_up"], r["is_largest"], r["is_named"]) == (True, True, True)
    assert not rows["baseline_0_majority"]["beats_majority"]
    assert spark.conf.get(SETTING) == "false"
