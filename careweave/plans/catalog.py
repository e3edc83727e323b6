"""One entry per operator, each over the given tables in full."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from careweave import fixed_values as fv
from careweave.functions import text as tx, vectors as vec
from careweave.functions.numbers import py_round, round_columns
from careweave.operators import (
    agreement, classification, curation, failures, features, leakage, models, pairing, replies,
    reply_evaluation, retrieval, routing, rubric, summary, trust,
)
from careweave.plans import evaluation, scoring
from careweave.session import (
    discard, materialize, recorded_tables, shared_dir, short_lived_shuffles, spread,
)
from careweave.sources import generators, messages as msg, store, tables
from careweave.streaming import pairing as stream_pairing, scoring as stream_scoring

# Parameters of the text queries on the given (multilingual, invented) texts.
STOP_WORDS = (
    "the", "and", "of", "to", "in", "is", "that", "it", "for", "with", "as", "was", "on", "are",
    "be", "by", "this", "at", "from", "or", "an", "not", "but",
)
MIN_SIM = 0.15
SUPPLEMENT_BELOW = 1000
CAP_ROWS = 100
SAMPLE_ROWS = 50
STRATUM_ROWS = 10
TEXT_DIMS = 256
STREAM_START = 1704067200  # 2024-01-01 00:00:00 UTC

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    _QUERIES[function.__name__] = function
    return function


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


# --- shared frames -----------------------------------------------------------------

def _table(spark, d, name):
    return tables.table(spark, d, name)


def _messages(spark, d):
    return tables.messages(_table(spark, d, "conversations"))


def _clean(spark, d):
    return curation.preprocess_messages(_messages(spark, d), tables.BRAND)


def _pairs(spark, d):
    return pairing.reconstruct_pairs(_messages(spark, d), tables.BRAND)


def _documents(spark, d):
    return _table(spark, d, "documents")


def _split(spark, d):
    train, golden = tables.split_documents(_documents(spark, d), _table(spark, d, "labels"))
    return train.select("doc_id", "text", "lang"), golden.select("doc_id", "text", "lang")


def _index(spark, d):
    """(pairs, index, terms): the paired questions with their vectors, computed once."""
    pairs = materialize(_pairs(spark, d))
    index, terms = retrieval.build_text_index(pairs, stop_words=STOP_WORDS)
    return pairs, materialize(index), terms


def _retrieved(spark, d, *, k=fv.TOP_K, masked=True):
    """(pairs, index, cases): every question against all pairs."""
    pairs, index, terms = _index(spark, d)
    cases = retrieval.retrieve(
        index, index, terms, query_key="pair_id", query_text="customer_clean_text",
        query_id="customer_tweet_id", k=k, masked=masked)
    return pairs, index, cases


def _scored(spark, d):
    pairs, index, cases = _retrieved(spark, d)
    return scoring.score_messages(
        pairs, index, cases=cases, rules=tables.LANGUAGE_RULES, min_sim=MIN_SIM)


def _attached(spark, d):
    pairs, index, cases = _retrieved(spark, d)
    found = scoring.attach_cases(pairs, scoring.with_case_texts(cases, index), "pair_id")
    return found.withColumn("gold_intent", tx.keyword_label(
        F.col("customer_clean_text"), tables.LANGUAGE_RULES))


def _predictions(spark, d):
    """Labelled documents taken through rules, routing, reply and rubric."""
    gold = tables.golden_documents(_documents(spark, d), _table(spark, d, "labels"))
    routed = routing.route(gold).withColumns({
        "pair_id": F.col("doc_id").cast("string"),
        "system_auto_handled": F.col("routing_action") == fv.ACTION_AUTO,
        "top_response": F.lit(None).cast("string"),
        "generated_reply": replies.template_reply(F.col("predicted_intent"), F.lit(True)),
    })
    return rubric.judge_replies(routed)


def _ratings(spark, d):
    return tables.ratings(_table(spark, d, "events"))


def _vectors(spark, d):
    return retrieval.build_vector_index(_table(spark, d, "embeddings"))


# --- sources and generators -----------------------------------------------------------

@query
def scan_messages(spark, d):
    return _messages(spark, d)


@query
def normalize_missing(spark, d):
    columns = ["text", "lang", "source"]
    return msg.normalize_columns(_documents(spark, d).select("doc_id", *columns), columns)


@query
def row_cap(spark, d):
    return msg.row_cap(_messages(spark, d), CAP_ROWS, "created_at", "tweet_id")


@query
def gen_corpus(spark, d):
    return generators.training_pairs(_documents(spark, d), "doc_id")


@query
def gen_golden(spark, d):
    return generators.golden_items(_documents(spark, d).select((F.col("doc_id") + 1).alias("id")))


# --- written and read back ---------------------------------------------------------------

def _folder(spark, name):
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


@query
def store_pairs(spark, d):
    """The pairs as Parquet and as CSV, read back; every pair must come back from both."""
    pairs, folder = materialize(_pairs(spark, d)), _folder(spark, "pairs")
    frames = []
    for fmt in ("parquet", "csv"):
        store.write_pairs(pairs, f"{folder}/{fmt}", fmt)
        frames.append(store.read_pairs(spark, f"{folder}/{fmt}", fmt).withColumn("format", F.lit(fmt)))
    return frames[0].unionByName(frames[1])


@query
def store_golden(spark, d):
    """The evaluation items as JSON and as CSV, read back."""
    items, folder = materialize(gen_golden(spark, d)), _folder(spark, "golden")
    store.write_golden(items, folder)
    written = store.read_or_empty(spark, f"{folder}/csv", items.schema, "csv")
    return store.read_golden(spark, f"{folder}/json").withColumn("format", F.lit("json")).unionByName(
        written.withColumn("format", F.lit("csv")))


@query
def store_index(spark, d):
    """A second version of the index, loaded; vectors and search tables must agree."""
    _, index, terms = _index(spark, d)
    folder = _folder(spark, "index")
    for _ in range(2):
        retrieval.save_index(index, folder, terms)
    stored, _ = retrieval.load_index(spark, folder)
    found = retrieval.load_search(spark, folder).cases.select(
        F.col("case_id").alias("pair_id"), F.size("ids").alias("searched_terms"))
    total = "aggregate(weights, 0D, (acc, x) -> acc + x)"
    return stored.join(found, "pair_id").select(
        "pair_id", F.size("term_ids").alias("n_terms"), "searched_terms", py_round(total, 4).alias("weight_sum"))


@query
def stored_search(spark, d):
    """Retrieval through a stored index, with the tables it was saved with."""
    pairs, index, terms = _index(spark, d)
    folder = _folder(spark, "index")
    retrieval.save_index(index, folder, terms)
    return retrieval.retrieve(
        index, index, terms, query_key="pair_id", query_text="customer_clean_text",
        query_id="customer_tweet_id", search=retrieval.load_search(spark, folder))


@query
def store_predictions(spark, d):
    """Prediction records with their nested cases, written and read back."""
    folder = _folder(spark, "predictions")
    store.write_predictions(_scored(spark, d), folder)
    top = F.element_at("retrieved_cases", 1)
    return spark.read.parquet(folder).select(
        "pair_id", F.coalesce(F.size("retrieved_cases"), F.lit(0)).alias("n_cases"),
        top["case_id"].alias("top_case"), "routing_action", "overall_quality_score")


@query
def store_failures(spark, d):
    """The failure table as CSV, read back."""
    failed, folder = materialize(failure_cases(spark, d)), _folder(spark, "failures")
    store.write_failures(failed, folder)
    return store.read_or_empty(spark, folder, failed.schema, "csv")


@query
def result_document(spark, d):
    """The result document: all metrics as one JSON text, parsed again."""
    folder = _folder(spark, "results")
    store.write_metrics(metric_summary(spark, d), folder)
    kind = "map<string,map<string,map<string,double>>>"
    parsed = spark.read.text(folder).select(F.explode(F.from_json("value", kind)).alias("component", "systems"))
    by_system = parsed.select("component", F.explode("systems").alias("system", "metrics"))
    return by_system.select("component", "system", F.explode("metrics").alias("metric", "value"))


@query
def read_or_empty(spark, d):
    """Report tables where some are absent: the stored pairs and no rows from the others."""
    pairs, folder = materialize(_pairs(spark, d)), _folder(spark, "reports")
    store.write_pairs(pairs, f"{folder}/pairs")
    frames = [store.read_or_empty(spark, f"{folder}/{name}", store.PAIR_SCHEMA) for name in ("pairs", "older", "newer")]
    return frames[0].unionByName(frames[1]).unionByName(frames[2]).select("pair_id", "created_at")


@query
def index_corpus(spark, d):
    """What an index is built on: the stored pairs, and the evaluation items where there are none."""
    pairs, folder = materialize(_pairs(spark, d)), _folder(spark, "corpus")
    store.write_pairs(pairs, f"{folder}/pairs")
    store.write_golden(gen_golden(spark, d), f"{folder}/golden")
    both = [store.index_corpus(spark, f"{folder}/{name}", f"{folder}/golden/json") for name in ("pairs", "none")]
    return both[0].select("pair_id", "support_response").unionByName(both[1].select("pair_id", "support_response"))


@query
def case_lookup(spark, d):
    """For every kind of failure the case with the smallest id, looked up by that id."""
    failed = materialize(failure_cases(spark, d))
    ids = failed.groupBy("failure_type").agg(F.min("pair_id").alias("pair_id")).select("pair_id")
    return failures.cases_by_id(failed, ids).select("pair_id", "failure_type", "gold_intent", "predicted_intent")


@query
def training_fallback(spark, d):
    """Training rows by language; a language with too few texts gets the written items instead."""
    train, golden = _split(spark, d)
    named = train.select(F.col("doc_id").cast("string").alias("pair_id"), "lang", F.col("text").alias("customer_clean_text"),
                         F.lit("").alias("support_response"))
    asked = golden.select(F.col("text").alias("customer_clean_text"))
    frames = [evaluation.training_rows(named.where(F.col("lang") == lang).drop("lang"), asked, fallback=True).select(
        F.lit(lang).alias("lang"), "pair_id", "intent") for lang in ("de", "none")]
    return frames[0].unionByName(frames[1])


# --- cleaning, filters, labels ----------------------------------------------------------

@query
def clean_text(spark, d):
    parts = [
        _documents(spark, d).select(
            F.lit("documents").alias("origin"), F.col("doc_id").alias("row_id"), "text"),
        _table(spark, d, "conversations").select(
            F.lit("conversations"), F.col("conv_id") * 1000 + F.col("turn"), "text"),
        _table(spark, d, "pages").select(F.lit("pages"), "page_id", "url"),
    ]
    both = parts[0].union(parts[1]).union(parts[2])
    return both.select("origin", "row_id", tx.clean_text(F.col("text")).alias("clean_text"))


@query
def preprocess_messages(spark, d):
    return _clean(spark, d).select("tweet_id", "raw_text", "clean_text", "is_brand", "is_customer")


@query
def min_token_filter(spark, d):
    return curation.min_tokens(_documents(spark, d), ["text"]).select(
        "doc_id", tx.token_count(F.col("text")).alias("n_tokens"))


@query
def keyword_label(spark, d):
    text = F.col("text")
    return round_columns(_documents(spark, d).select(
        "doc_id", tx.keyword_label(text).alias("default_label"),
        tx.keyword_label(text, tables.LANGUAGE_RULES).alias("language_label"),
        tx.keyword_vote_share(text, tables.LANGUAGE_RULES).alias("vote_share")), ["vote_share"])


@query
def resolve_label(spark, d):
    mixed = _pairs(spark, d).unionByName(
        generators.training_pairs(_documents(spark, d), "doc_id"), allowMissingColumns=True)
    return curation.resolve_label(mixed, rules=tables.LANGUAGE_RULES).select("pair_id", "intent")


@query
def json_field(spark, d):
    return _table(spark, d, "events").select("event_id", F.coalesce(
        F.get_json_object("props", "$.k").try_cast("double"), F.lit(fv.DEFAULT_OVERALL)).alias("k"))


@query
def risk_keywords(spark, d):
    hits = F.array_join(tx.keyword_hits(F.col("text"), fv.RISK_KEYWORDS), ",")
    both = _documents(spark, d).select(
        F.lit("documents").alias("origin"), F.col("doc_id").cast("string").alias("row_id"), "text",
    ).union(_messages(spark, d).select(F.lit("messages"), "tweet_id", "text"))
    return both.select("origin", "row_id", hits.alias("hits")).where("hits <> ''")


@query
def dedup_pairs(spark, d):
    docs = _documents(spark, d).select(
        "doc_id", tx.text_key(tx.clean_text(F.col("text"))).alias("question"), "lang")
    return pairing.dedup_pairs(docs, ("question", "lang"), ("doc_id",)).select("doc_id", "lang")


@query
def sample_n(spark, d):
    return curation.sample_rows(
        _documents(spark, d), SAMPLE_ROWS, key="doc_id", order=_sql_hash()).select("doc_id", "lang")


@query
def sample_stratified(spark, d):
    return curation.sample_per_stratum(
        _documents(spark, d), ["lang"], STRATUM_ROWS, key="doc_id", order=_sql_hash(),
    ).select("doc_id", "lang")


def _sql_hash():
    """A multiplicative hash that any SQL engine computes the same way."""
    return F.pmod(F.pmod(F.col("doc_id"), F.lit(2 ** 31)) * 2654435761 + fv.SEED * 40503,
                  F.lit(2 ** 32))


# --- pairing and leakage ------------------------------------------------------------

@query
def reconstruct_pairs(spark, d):
    return _pairs(spark, d)


@query
def brand_stats(spark, d):
    return pairing.brand_statistics(_messages(spark, d), tables.BRAND)


@query
def thread_sketches(spark, d):
    """Distinct questions by turn and over all turns: exact, and whether the stored sketches come
    within four standard errors."""
    pairs = materialize(_pairs(spark, d))
    sketches = materialize(pairing.thread_sketches(pairs, ("created_at",)))
    whole = F.lit("all").alias("created_at")
    rough = pairing.distinct_threads(sketches, ("created_at",)).unionByName(
        pairing.distinct_threads(sketches).select(whole, "threads", "pairs"))
    exact = pairs.groupBy("created_at").agg(F.count_distinct("customer_tweet_id").alias("exact")).unionByName(
        pairs.agg(F.count_distinct("customer_tweet_id").alias("exact")).select(whole, "exact"))
    near = F.abs(F.col("threads") - F.col("exact")) <= F.greatest(F.lit(1.0), F.col("exact") * (4 * 1.04 / 64))
    return exact.join(rough, "created_at").select("created_at", "exact", "pairs", near.alias("near"))


@query
def supplement_union(spark, d):
    pairs = materialize(_pairs(spark, d))
    return pairing.supplement_small(pairs, min_pairs=SUPPLEMENT_BELOW).select(
        "pair_id", "customer_clean_text", "support_clean_text", "intent")


@query
def exclude_golden(spark, d):
    train, golden = _split(spark, d)
    return leakage.exclude_golden(train, golden, train_text="text", golden_text="text").select(
        "doc_id", "lang")


@query
def leak_check(spark, d):
    train, golden = _split(spark, d)
    return leakage.leaked_golden(train, golden, train_text="text", golden_text="text").select(
        "doc_id", "lang")


@query
def mask_pairs(spark, d):
    """Masked inside the join before the cut to k; the mask by row finds nothing more."""
    pairs, _, cases = _retrieved(spark, d)
    asked = pairs.select(F.col("pair_id").alias("query_id"),
                         F.col("customer_tweet_id").alias("asked_id"),
                         F.col("customer_clean_text").alias("asked_text"))
    found = pairs.select(F.col("pair_id").alias("case_id"), "customer_tweet_id",
                         "customer_clean_text")
    return leakage.mask_self(
        cases.join(asked, "query_id").join(found, "case_id"), query_id="asked_id",
        query_text="asked_text", case_customer_id="customer_tweet_id",
        case_text="customer_clean_text", case_pair_id="case_id",
    ).select("query_id", "case_id", "similarity_score")


@query
def reply_leakage(spark, d):
    pairs, index, cases = _retrieved(spark, d)
    truth = pairs.select(F.col("pair_id").alias("query_id"),
                         F.col("support_response").alias("true_reply"))
    return scoring.with_case_texts(cases, index).join(truth, "query_id").select(
        "query_id", "case_id",
        leakage.reply_is_safe(F.col("true_reply"), F.col("case_response")).alias("is_safe"))


# --- similarity -----------------------------------------------------------------------

@query
def l2_normalize(spark, d):
    unit = _vectors(spark, d).select("vec_id", F.posexplode("embedding").alias("position", "x"))
    return unit.select("vec_id", "position", py_round("x", 6).alias("x"))


@query
def knn_topk(spark, d):
    vectors = _vectors(spark, d)
    return retrieval.top_k(
        vectors, vectors, query_key="vec_id", case_key="vec_id", vector="embedding")


@query
def knn_masked(spark, d):
    vectors = _vectors(spark, d).withColumn("label", F.col("label").cast("string"))
    return retrieval.top_k(
        vectors, vectors, query_key="vec_id", case_key="vec_id", vector="embedding",
        query_id="vec_id", case_ids=("vec_id",), query_text="label", case_text="label")


@query
def knn_lsh(spark, d):
    vectors = _vectors(spark, d)
    return retrieval.approximate_top_k(
        vectors, vectors, query_key="vec_id", case_key="vec_id", vector="embedding", dim=64,
        query_id="vec_id", case_ids=("vec_id",))


@query
def tfidf_terms(spark, d):
    return round_columns(features.tfidf_terms(
        _documents(spark, d), "text", stop_words=STOP_WORDS), ["idf"])


@query
def ngram_terms(spark, d):
    return features.vocabulary(
        _documents(spark, d), "text", stop_words=STOP_WORDS, ngrams=2)


@query
def build_index(spark, d):
    _, index, _ = _index(spark, d)
    total = "aggregate(weights, 0D, (acc, x) -> acc + x)"
    return index.select("pair_id", F.size("term_ids").alias("n_terms"),
                        py_round(total, 4).alias("weight_sum"))


@query
def tfidf_topk(spark, d):
    return _retrieved(spark, d)[2]


@query
def grounding_context(spark, d):
    pairs, index, cases = _retrieved(spark, d)
    contexts = replies.grounding_context(scoring.with_case_texts(cases, index))
    label = tx.keyword_label(F.col("customer_clean_text"), tables.LANGUAGE_RULES)
    return pairs.join(contexts, F.col("pair_id") == F.col("query_id"), "left").select(
        "pair_id", replies.grounded_prompt(
            F.col("customer_clean_text"), label, F.col("context")).alias("prompt"))


# --- routing, replies, rubric, failures ---------------------------------------------------

@query
def route_messages(spark, d):
    return _scored(spark, d).select(
        "pair_id", "predicted_intent", "confidence", "top_retrieval_sim", "routing_action",
        "should_escalate", "risk_score", "primary_reason")


@query
def reply_systems(spark, d):
    found = _attached(spark, d)
    columns = replies.reply_columns(
        F.col("gold_intent"), F.col("top_response"), F.col("has_case"))
    return replies.long_replies(found.withColumns(columns), ["pair_id"])


@query
def judge_replies(spark, d):
    scored = reply_evaluation.score_reply_systems(_attached(spark, d))
    return scored.select("pair_id", "system", *fv.RUBRIC_SCORES, "overall_quality_score")


@query
def failure_cases(spark, d):
    return failures.failure_cases(_predictions(spark, d))


@query
def failure_subcategory(spark, d):
    return failures.with_subcategory(failures.failure_cases(_predictions(spark, d))).select(
        "pair_id", "failure_type", "empirical_subcategory")


@query
def failure_counts(spark, d):
    return failures.failure_counts(failures.failure_cases(_predictions(spark, d)))


@query
def score_messages(spark, d):
    cases = F.array_join(F.transform("retrieved_cases", lambda c: F.concat_ws(
        ":", c["case_id"], F.format_string("%.4f", c["similarity_score"]))), ",")
    return _scored(spark, d).select(
        "pair_id", "customer_clean_text", "predicted_intent", "confidence", "routing_action",
        "should_escalate", "risk_score", "primary_reason", "top_retrieval_sim",
        cases.alias("cases"), "generated_reply", *fv.RUBRIC_SCORES, "overall_quality_score")


# --- metrics -------------------------------------------------------------------------

@query
def majority_class(spark, d):
    docs = _documents(spark, d).select(tables.gold_intent().alias("intent"))
    return classification.majority_label(docs, "intent")


@query
def class_weights(spark, d):
    docs = _documents(spark, d).select(tables.gold_intent().alias("intent"))
    return round_columns(classification.class_weights(docs, "intent"), ["weight"])


@query
def label_distribution(spark, d):
    return classification.label_distribution(
        _documents(spark, d).withColumn("intent", tables.gold_intent()), "intent", "source")


@query
def argmax_label(spark, d):
    labels = [f"class_{i}" for i in range(64)]
    label, confidence, _ = classification.argmax_label(F.col("p"), labels)
    scored = _table(spark, d, "embeddings").select(
        "vec_id", F.col("embedding").cast("array<double>").alias("p")).select(
        "vec_id", label.alias("predicted"), confidence.alias("confidence"))
    return round_columns(scored, ["confidence"], 6)


@query
def confusion_matrix(spark, d):
    return classification.confusion_matrix(tables.labelled_texts(_documents(spark, d)))


@query
def classification_metrics(spark, d):
    return classification.classification_metrics(tables.labelled_texts(_documents(spark, d)))


@query
def per_class_report(spark, d):
    return classification.per_class_report(tables.labelled_texts(_documents(spark, d)))


@query
def trust_metrics(spark, d):
    return trust.trust_metrics(_predictions(spark, d))


@query
def routing_outcomes(spark, d):
    return trust.routing_outcomes(_predictions(spark, d))


@query
def confidence_quartiles(spark, d):
    return trust.confidence_quartiles(routing.route(tables.labelled_texts(_documents(spark, d))))


@query
def lexical_overlap(spark, d):
    scored = reply_evaluation.unigram_scores(_pairs(spark, d), "support_response", "customer_query")
    return round_columns(scored.select("pair_id", "bleu_4"), ["bleu_4"])


@query
def rouge_l(spark, d):
    pairs = _pairs(spark, d).select("pair_id", "support_response", "customer_query")
    scored = reply_evaluation.lexical_scores(pairs, "support_response", "customer_query")
    return round_columns(scored.select("pair_id", "rouge_l"), ["rouge_l"])


@query
def reply_system_comparison(spark, d):
    return reply_evaluation.compare_reply_systems(
        reply_evaluation.score_reply_systems(_attached(spark, d)))


@query
def unpivot_scores(spark, d):
    return reply_evaluation.unpivot_scores(reply_system_comparison(spark, d))


@query
def rater_agreement(spark, d):
    return agreement.rater_agreement(_ratings(spark, d))


@query
def rater_agreement_first(spark, d):
    """The measures over the first rated rows only."""
    return agreement.rater_agreement(_ratings(spark, d), first_n=fv.RATED_SAMPLE)


@query
def rating_histogram(spark, d):
    return agreement.rating_histogram(_ratings(spark, d))


@query
def metric_summary(spark, d):
    """Every component of the result document whose numbers do not rest on a trained model."""
    predictions = _predictions(spark, d)
    failed = failures.failure_cases(predictions).agg(F.count("*").alias("total_failures_identified"))
    docs = tables.labelled_texts(_documents(spark, d))
    majority = models.majority_predict(docs, docs, "gold_intent")
    return summary.union_all([
        summary.long_metrics(classification_metrics(spark, d), "intent_classification",
                             classification.METRICS, system_name="keyword_rules"),
        summary.long_metrics(classification.classification_metrics(majority), "intent_classification",
                             classification.METRICS, system_name="baseline_0_majority"),
        summary.long_metrics(trust.trust_metrics(predictions), "escalation_routing_trust",
                             evaluation.TRUST_METRICS),
        summary.long_metrics(reply_system_comparison(spark, d), "reply_generation_systems",
                             evaluation.REPLY_METRICS, "system"),
        summary.long_metrics(rater_agreement(spark, d), "human_vs_judge_agreement",
                             [*agreement.MEASURES, "sample_size"]),
        summary.long_metrics(brand_stats(spark, d), "dataset_info", evaluation.DATASET_METRICS),
        summary.long_metrics(failed, "failure_analysis_summary", ["total_failures_identified"]),
    ])


# --- models --------------------------------------------------------------------------

def _labelled(spark, d):
    """All rows of the split, marked ``golden`` or not, with cleaned texts and labels.

    The split looks at ids and digests of the texts only, and so is a function of them: it is made
    on narrow rows, and each text is dealt out once, to meet its part (the hashed side, as a sort
    would hold texts).
    """
    documents = tables.table(spark, d, "documents", dealt=False).select("doc_id", "text", "lang")
    keys = materialize(documents.select("doc_id", leakage.hex_digest("text").alias("digest")).distinct())
    train, golden = tables.split_documents(keys, _table(spark, d, "labels"))
    clean_train = leakage.exclude_golden(train, golden, train_text="digest", golden_text="digest")
    parts = summary.union_all([df.select(
        F.col("doc_id").alias("_id"), F.unhex("digest").alias("_digest"), F.lit(name == "golden").alias("golden"))
        for name, df in {"train": clean_train, "golden": golden}.items()])
    texts = documents.withColumn("_text_digest", F.unhex(leakage.hex_digest("text")))
    return texts.join(parts.hint("shuffle_hash"), (F.col("_text_digest") == F.col("_digest")) & F.col(
        "doc_id").eqNullSafe(F.col("_id"))).select(
        "doc_id", tx.clean_text(F.col("text")).alias("customer_clean_text"),
        tables.gold_intent().alias("intent"), tables.gold_intent().alias("gold_intent"), "golden")


def _parts(rows):
    """(train, golden) of a stored table that holds both."""
    return rows.where(~F.col("golden")).drop("golden"), rows.where("golden").drop("golden")


def _labelled_split(spark, d):
    with short_lived_shuffles(spark):
        return _parts(materialize(_labelled(spark, d)))


@query
def majority_baseline(spark, d):
    train, golden = _split(spark, d)
    named = leakage.exclude_golden(train, golden, train_text="text", golden_text="text").select(
        tables.gold_intent().alias("intent"))
    return models.majority_predict(named, golden.select("doc_id")).select(
        "doc_id", "predicted_intent", "confidence")


@query
def tfidf_lr(spark, d):
    train, golden = map(spread, _labelled_split(spark, d))
    return models.fit_tfidf(train, max_iter=50).predict(golden).select(
        "doc_id", "gold_intent", "predicted_intent", py_round("confidence", 4).alias("confidence"))


@query
def embedding_lr(spark, d):
    """Fitted on four fifths of the vectors; every vector is predicted."""
    df = _table(spark, d, "embeddings").withColumns({
        "intent": F.col("label").cast("string"), "held_out": F.pmod("vec_id", F.lit(5)) == 0})
    return models.fit_embedding(df.where(~F.col("held_out")), max_iter=50).predict(df).select(
        "vec_id", "held_out", "intent", "predicted_intent",
        py_round("confidence", 4).alias("confidence"))


def _hashed(df):
    """Unit vectors of the texts by feature hashing, where there is no sentence encoder.

    Written once, since fitting reads them several times: as counts, which take a fraction of the
    room and are scaled where they are read.
    """
    words = df.withColumn("_words", tx.words(F.col("customer_clean_text")))
    counted = HashingTF(numFeatures=TEXT_DIMS, inputCol="_words", outputCol="_tf").transform(words)
    stored = materialize(counted.withColumn(
        "_counts", vector_to_array("_tf").cast("array<int>")).drop("_words", "_tf"))
    counts = vec.l2_normalize_long(F.col("_counts").cast("array<double>"))
    return stored.withColumn("embedding", counts).drop("_counts")


def _hashed_split(spark, d):
    with short_lived_shuffles(spark):
        return _parts(_hashed(_labelled(spark, d)))


@query
def model_comparison(spark, d):
    """All models on all labelled documents."""
    train, golden = _hashed_split(spark, d)
    return models.compare_models({
        "baseline_0_majority": models.majority_predict(train, golden),
        "baseline_1_tfidf": models.fit_tfidf(train, max_iter=50, dealt=True).predict(golden),
        "main_model_embedding": models.fit_embedding(train, max_iter=50, dealt=True).predict(golden),
    })


@query
def model_properties(spark, d):
    """What must hold for every prediction of every model: one row each, probabilities of all labels
    that add up to 1, the label with the largest one and its value; trained models beat the majority."""
    with short_lived_shuffles(spark), recorded_tables() as paths:
        train, golden = _hashed_split(spark, d)
        frames = {"baseline_0_majority": models.majority_predict(train, golden, probabilities=True),
                  "baseline_1_tfidf": models.fit_tfidf(train, max_iter=50, dealt=True).predict(golden),
                  "main_model_embedding": models.fit_embedding(train, max_iter=50, dealt=True).predict(golden)}
        values = F.map_values("all_intent_probabilities")
        total = F.aggregate(values, F.lit(0.0), lambda a, x: a + x)
        rows = summary.union_all([df.select(
            F.lit(name).alias("model"), (F.col("gold_intent") == F.col("predicted_intent")).alias("right"),
            (F.abs(total - 1) < 1e-9).alias("one"), (F.array_max(values) == F.col("confidence")).alias("largest"),
            (F.element_at("all_intent_probabilities", F.col("predicted_intent")) == F.col("confidence")).alias("named"),
            F.size(values).alias("labels")) for name, df in frames.items()])
        found = materialize(rows.groupBy("model").agg(
            F.count("*").alias("n"), F.min("labels").alias("labels"), F.bool_and("one").alias("adds_up"),
            F.bool_and("largest").alias("is_largest"), F.bool_and("named").alias("is_named"),
            F.count_if("right").alias("right")))
    discard(spark, paths[:-1])
    base = found.where("model = 'baseline_0_majority'").select("right").scalar()
    return found.select("model", "n", "labels", "adds_up", "is_largest", "is_named",
                        (F.col("right") > base).alias("beats_majority"))


# --- streams -------------------------------------------------------------------------

def _message_stream(spark, d):
    # A pattern, which may name one file or a folder of part files; a filter on file names knows no folders.
    source = spark.readStream.schema(_table(spark, d, "conversations").schema).parquet(
        f"{d}/conversations.parque[t]")
    # One minute per turn from a fixed day (the given table has no clock).
    return tables.messages(source).withColumn("created_ts", F.timestamp_seconds(
        STREAM_START + F.col("created_at").cast("bigint") * 60))


@query
def stream_pairs(spark, d):
    folder = f"{shared_dir(spark)}/stream_pairs-{uuid.uuid4().hex}"
    pairs = stream_pairing.stream_pairs(_message_stream(spark, d), tables.BRAND)
    stream_pairing.write_pairs_stream(
        pairs, target=f"{folder}/out", checkpoint=f"{folder}/state").awaitTermination()
    return spark.read.schema(pairs.schema).parquet(f"{folder}/out")


@query
def stream_scores(spark, d):
    folder = f"{shared_dir(spark)}/stream_scores-{uuid.uuid4().hex}"
    _, index, terms = _index(spark, d)
    asked = _message_stream(spark, d).where(F.lower("author_id") != tables.BRAND.lower()).select(
        F.col("tweet_id").alias("customer_tweet_id"),
        tx.clean_text(F.col("text")).alias("customer_clean_text"))
    stream_scoring.stream_scores(
        asked, index, terms, target=f"{folder}/out", checkpoint=f"{folder}/state",
        rules=tables.LANGUAGE_RULES, min_sim=MIN_SIM).awaitTermination()
    return stream_scoring.read_scores(spark, f"{folder}/out").select(
        "customer_tweet_id", "predicted_intent", "routing_action", "risk_score",
        "top_retrieval_sim", "overall_quality_score")
