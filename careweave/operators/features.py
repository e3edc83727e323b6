"""Relational text features: vocabulary, smoothed idf, unit TF-IDF vectors."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from careweave import fixed_values as fv
from careweave.functions import text as tx
from careweave.session import task_slots


def word_counts(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, term, tf), one row per distinct term of a text."""
    terms = df.select(key, F.explode(tx.words(F.col(text))).alias("term"))
    return terms.groupBy(key, "term").agg(F.count("*").alias("tf"))


def _coded_words(batch, stop_words: Sequence[str]) -> tuple:
    """(distinct words, code of each word that is no stop word, its text) of a batch of word lists."""
    import pyarrow as pa
    import pyarrow.compute as pc

    lists = batch.column(0)
    coded = lists.flatten().dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    text = np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    stop = pc.is_in(coded.dictionary, pa.array(stop_words, pa.string()))
    kept = ~stop.to_numpy(zero_copy_only=False)[codes]
    return coded.dictionary, codes[kept], text[kept]


def _counted(terms, codes: np.ndarray, text: np.ndarray, name: str):
    """(term, df, total) of a batch, for the terms that occur in it."""
    import pyarrow as pa

    n = max(1, len(terms))
    total = np.bincount(codes, minlength=len(terms))
    both = np.sort(text * n + codes)  # np.unique hashes, at many times the price
    documents = np.bincount(both[np.flatnonzero(np.diff(both, prepend=-1))] % n, minlength=len(terms))
    found = np.flatnonzero(total)
    return pa.RecordBatch.from_arrays(
        [terms.take(pa.array(found)), pa.array(documents[found], pa.int64()),
         pa.array(total[found], pa.int64())], names=[name, "df", "total"])


def _frequent_ngrams(
    words: DataFrame, stop_words: Sequence[str], max_features: int,
) -> DataFrame | None:
    """Words and pairs of neighbours with the highest corpus count: (term, df, total).

    A pair occurs no more often than either of its words. So where ``max_features`` words reach
    some count, a pair that is to come before them joins two words that reach it too: words are
    counted first, then only pairs of such words, by number, no more than their square. Nothing is
    returned where so many words tie at that count that the driver would hold too many.
    """
    import pyarrow as pa

    spark, stop = words.sparkSession, list(stop_words)

    def count_words(batches: Iterator) -> Iterator:
        for batch in batches:
            yield _counted(*_coded_words(batch, stop), "term")

    order = [F.desc("total"), F.asc("term")]
    sums = [F.sum("df").alias("df"), F.sum("total").alias("total")]
    top = words.mapInArrow(count_words, "term string, df long, total long").groupBy("term").agg(
        *sums).orderBy(*order).limit(2 * max_features).toArrow()
    totals = top["total"].to_pylist()
    least = totals[max_features - 1] if len(totals) >= max_features > 0 else 0
    if len(totals) == 2 * max_features > 0 and totals[-1] == least:
        return None
    frequent = [t for t, n in zip(top["term"].to_pylist(), totals, strict=True) if n >= least]

    def count_pairs(batches: Iterator) -> Iterator:
        import pyarrow.compute as pc

        known = pa.array(frequent, pa.string())
        for batch in batches:
            terms, codes, text = _coded_words(batch, stop)
            number = pc.index_in(terms, known).fill_null(-1).to_numpy(
                zero_copy_only=False).astype(np.int64)[codes]
            a, b = number[:-1], number[1:]
            near = (text[:-1] == text[1:]) & (a >= 0) & (b >= 0)
            pairs = pa.array(a[near] * len(frequent) + b[near], pa.int64()).dictionary_encode()
            yield _counted(
                pairs.dictionary, pairs.indices.to_numpy(zero_copy_only=False).astype(np.int64),
                text[1:][near], "pair")

    pairs = words.mapInArrow(count_pairs, "pair long, df long, total long").groupBy("pair").agg(
        *sums).where(F.col("total") >= least)
    names = spark.createDataFrame(pa.table({
        "number": pa.array(range(len(frequent)), pa.int64()), "word": pa.array(frequent, pa.string())}))
    first, second = (F.broadcast(names.toDF(n, w)) for n, w in (("i", "a"), ("j", "b")))
    pairs = pairs.withColumns({
        "i": F.expr(f"pair div {len(frequent)}"), "j": F.col("pair") % len(frequent)})
    pairs = pairs.join(first, "i").join(second, "j").select(
        F.concat_ws(" ", "a", "b").alias("term"), "df", "total")
    return spark.createDataFrame(top).unionByName(pairs).orderBy(*order).limit(max_features)


def vocabulary(
    df: DataFrame, text: str, *, stop_words: Sequence[str] = (),
    max_features: int = fv.MAX_FEATURES, ngrams: int = 1,
) -> DataFrame:
    """The ``max_features`` terms with the highest corpus count: (term, df, total).

    Each text contributes its words (corpus count) and its distinct words (document count);
    both are summed per term inside the task first, so no (text, term) row is ever shuffled.
    With ``ngrams=2`` pairs of neighbours among the words that are no stop words count as well.
    """
    def counted(values: Column, total: int, documents: int) -> Column:
        return F.transform(values, lambda w: F.struct(
            w.alias("term"), F.lit(total).alias("total"), F.lit(documents).alias("df")))

    both = F.concat(counted(F.col("w"), 1, 0), counted(F.array_distinct("w"), 0, 1))
    words = df.select(tx.words(F.col(text)).alias("w"))
    if ngrams == 2:
        found = _frequent_ngrams(words, stop_words, max_features)
        if found is not None:
            return found
        if stop_words:
            words = words.select(F.filter("w", lambda w: ~w.isin(list(stop_words))).alias("w"))
        last = F.greatest(F.size("w") - 1, F.lit(0))
        words = words.select(F.concat("w", F.zip_with(
            F.slice("w", 1, last), F.slice("w", 2, last),
            lambda a, b: F.concat_ws(" ", a, b))).alias("w"))
    terms = words.select(F.inline(both))
    if stop_words and ngrams == 1:
        terms = terms.where(~F.col("term").isin(list(stop_words)))
    return (
        terms.groupBy("term")
        .agg(F.sum("df").alias("df"), F.sum("total").alias("total"))
        .orderBy(F.desc("total"), F.asc("term")).limit(max_features)
    )


def smoothed_idf(df_column: Column, n_documents: Column) -> Column:
    return F.log((1.0 + n_documents) / (1.0 + df_column)) + 1.0


def tfidf_terms(
    df: DataFrame, text: str, *, stop_words: Sequence[str] = (),
    max_features: int = fv.MAX_FEATURES,
) -> DataFrame:
    """Vocabulary with document frequency, corpus count and idf."""
    n = df.agg(F.count("*").alias("n"))
    known = vocabulary(df, text, stop_words=stop_words, max_features=max_features)
    return known.select(
        "term", "df", "total", smoothed_idf(F.col("df"), n.scalar()).alias("idf"))


def fit_terms(
    corpus: DataFrame, text: str, *, stop_words: Sequence[str] = (),
    max_features: int = fv.MAX_FEATURES,
) -> DataFrame:
    """The feature model as a table: (term, term_id, idf); at most ``max_features`` rows."""
    terms = tfidf_terms(corpus, text, stop_words=stop_words, max_features=max_features)
    # At most max_features rows are left here, so one ordered pass numbers them.
    ordered = terms.agg(F.array_sort(F.collect_list(F.struct("term", "idf"))).alias("t"))
    return ordered.select(F.posexplode("t").alias("term_id", "s")).select(
        "s.term", "term_id", "s.idf")


def sparse_vectors(df: DataFrame, key: str, text: str, terms: DataFrame) -> DataFrame:
    """(key, term_ids, weights): unit TF-IDF rows sorted by term id; empty where nothing is known.

    Texts shuffle once, by key; counting, packing and the final left join all run on that
    partitioning when the planner finds ``terms`` small enough to broadcast.
    """
    texts = df.select(key, text).repartition(task_slots(df.sparkSession), key)
    weighted = word_counts(texts, key, text).join(terms, "term").select(
        key, "term_id", (F.col("tf") * F.col("idf")).alias("w"))
    packed = weighted.groupBy(key).agg(
        F.array_sort(F.collect_list(F.struct("term_id", "w"))).alias("v"))
    length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda acc, x: acc + x["w"] * x["w"]))
    vectors = packed.withColumn("_len", length).select(
        key,
        F.transform("v", lambda x: x["term_id"]).alias("term_ids"),
        F.transform("v", lambda x: x["w"] / F.col("_len")).alias("weights"))
    empty = F.array()
    return texts.select(key).join(vectors, key, "left").select(
        key,
        F.coalesce("term_ids", empty.cast("array<int>")).alias("term_ids"),
        F.coalesce("weights", empty.cast("array<double>")).alias("weights"))
