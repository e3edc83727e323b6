"""Exact and approximate top-k similarity joins, and the index tables they read.

No pair of a query and a case ever becomes a row: a task gets queries and the cases of one slice,
cluster or block, multiplies them and returns at most k rows per query. Texts go through an
inverted index (``text_search``), vectors through clusters (``vector_search``); both leave out
what can't be among the best k, and both fall back to the full scan of all blocks.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, functions as F, types as T

from careweave import fixed_values as fv
from careweave.functions import vectors as vec
from careweave.operators import features, text_search, vector_search
from careweave.operators.blocks import BLOCK_ROWS, masks, side
from careweave.operators.text_search import TextIndex
from careweave.session import materialize, task_slots
from careweave.sources.store import read_or_empty


# --- index -----------------------------------------------------------------------

def build_text_index(
    pairs: DataFrame, *, key: str = "pair_id", stop_words: tuple[str, ...] = (),
    max_features: int = fv.MAX_FEATURES,
) -> tuple[DataFrame, DataFrame]:
    """(index, terms): pairs with unit TF-IDF vectors, and the feature model that made them.

    The indexed text is the cleaned question, or the raw one where there is no cleaned column.
    """
    text = "customer_clean_text" if "customer_clean_text" in pairs.columns else "customer_query"
    if pairs.isEmpty():
        raise ValueError("Cannot build index on empty pairs DataFrame.")
    terms = materialize(features.fit_terms(
        pairs, text, stop_words=stop_words, max_features=max_features))
    return pairs.join(features.sparse_vectors(pairs, key, text, terms), key), terms


def build_vector_index(df: DataFrame, vector: str = "embedding") -> DataFrame:
    """The frame with its vector column as unit ``array<double>``."""
    return df.withColumn(vector, vec.l2_normalize(F.col(vector).cast("array<double>")))


def search_tables(index: DataFrame, *, case_key: str = "pair_id") -> TextIndex:
    """The inverted index of a text index, written once; for several batches of queries."""
    return text_search.prepare(_text_cases(index, case_key, "weights", "term_ids", (
        "customer_tweet_id", "support_tweet_id"), "customer_clean_text"))


def _table_name(path: str, version: int) -> str:
    return f"careweave_{hashlib.md5(path.encode()).hexdigest()[:12]}_v{version}"


def _versions(spark, path: str) -> DataFrame | None:
    return read_or_empty(spark, f"{path}/versions", None)


def save_index(index: DataFrame, path: str, terms: DataFrame | None = None, *,
               buckets: int | None = None, case_key: str = "pair_id") -> int:
    """Write a new version of an index under ``path`` and return its number.

    Cases with their texts, the feature model and, for a text index, its search tables: cases
    bucketed by slice, so that a join by slice reads them where they lie, the directory and the
    champions. A version counts from when its row stands in ``versions``; older ones stay.
    """
    spark = index.sparkSession
    known = _versions(spark, path)
    version = 1 + (known.agg(F.max("version")).head()[0] or 0 if known is not None else 0)
    here = f"{path}/v{version}"
    index.write.parquet(f"{here}/cases")
    stored = spark.read.schema(index.schema).parquet(f"{here}/cases")
    buckets = buckets or task_slots(spark)
    n_cases = -1
    if terms is not None:
        terms.write.parquet(f"{here}/terms")
        cases, n_cases = text_search.with_slices(_text_cases(
            stored, case_key, "weights", "term_ids", ("customer_tweet_id", "support_tweet_id"),
            "customer_clean_text"))
        cases.repartition(buckets, "slice").write.bucketBy(buckets, "slice").sortBy("slice").option(
            "path", f"{here}/slices").saveAsTable(_table_name(path, version))
        placed = spark.table(_table_name(path, version))
        for name, table in zip(("directory", "champions"), text_search.term_tables(placed), strict=True):
            table.write.parquet(f"{here}/{name}")
    row = [(version, buckets, n_cases)]
    spark.createDataFrame(row, "version int, buckets int, n_cases long").write.mode("append").parquet(
        f"{path}/versions")
    return version


def _version(spark, path: str, version: int | None):
    known = _versions(spark, path)
    rows = [] if known is None else known.orderBy(F.desc("version")).collect()
    rows = [r for r in rows if version in (None, r["version"])]
    if not rows:
        raise FileNotFoundError(f"Index table not found at {path}")
    return rows[0]


def load_index(spark, path: str, version: int | None = None) -> tuple[DataFrame, DataFrame | None]:
    """(cases, feature model) of a version, the latest by default."""
    here = f"{path}/v{_version(spark, path, version)['version']}"
    return spark.read.parquet(f"{here}/cases"), read_or_empty(spark, f"{here}/terms", None)


def load_search(spark, path: str, version: int | None = None) -> TextIndex:
    """The search tables of a stored text index; batches of queries join them without moving them.

    The bucketed layout is known to the session's catalog, where a new session enters it again.
    """
    row = _version(spark, path, version)
    here, name = f"{path}/v{row['version']}", _table_name(path, row["version"])
    if row["n_cases"] < 0:
        raise FileNotFoundError(f"No search tables at {here}")
    if not spark.catalog.tableExists(name):
        place = f"{here}/slices".replace("'", "\\'")
        spark.sql(f"CREATE TABLE {name} ({spark.read.parquet(f'{here}/slices').schema.toDDL()}) USING parquet "
                  f"OPTIONS (path '{place}') CLUSTERED BY (slice) SORTED BY (slice) INTO {row['buckets']} BUCKETS")
    return TextIndex(spark.table(name), spark.read.parquet(f"{here}/directory"),
                     spark.read.parquet(f"{here}/champions"), row["n_cases"], bucketed=True)


# --- joins -----------------------------------------------------------------------

def _text_cases(cases: DataFrame, key: str, vector: str, term_ids: str, ids: tuple[str, ...],
                text: str | None) -> DataFrame:
    """Cases as the text search takes them; ``pid`` is the id that substring masks look into."""
    return side(cases, key, vector, term_ids, "case", masks(cases, list(ids), text)).withColumn(
        "pid", F.col("case_id").cast("string"))


def top_k(
    queries: DataFrame, cases: DataFrame | TextIndex, *, query_key: str, case_key: str, vector: str,
    term_ids: str | None = None, k: int = fv.TOP_K,
    query_id: str | None = None, case_ids: tuple[str, ...] = (),
    query_text: str | None = None, case_text: str | None = None, substring: bool = False,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Exact cosine top-k: (query_id, rank, case_id, similarity_score), k rows per query.

    Vectors are unit rows: dense ``array<double>``, or sparse with ``term_ids``. Scores are
    clamped at 0 and rounded to 4 places; ties go to the smaller case id. Cases are masked
    *before* the cut to k: where one of ``case_ids`` equals ``query_id`` or, with ``substring``
    (sparse vectors only), the case key contains it, or where the text keys are equal; so a query
    always gets min(k, cases left) rows.
    A null vector is like nothing: such a query gets no rows, such a case is in none. Dense
    vectors of different lengths are an error.
    """
    left = side(queries, query_key, vector, term_ids, "query",
                masks(queries, [query_id] if query_id else [], query_text))
    if term_ids is None:
        if substring:
            raise ValueError("substring masks need sparse vectors")
        right = side(cases, case_key, vector, None, "case", masks(cases, list(case_ids), case_text))
        return vector_search.search(left, right, k, block_rows=block_rows)
    # The raw id is only read by substring masks; it is the mask value without its prefix.
    left = left.withColumn("qid", F.substring("m1", 3, 2**31 - 1))
    index = cases if isinstance(cases, TextIndex) else text_search.prepare(
        _text_cases(cases, case_key, vector, term_ids, case_ids, case_text), once=True)
    return text_search.search(left, index, k, substring=substring, block_rows=block_rows)


def approximate_top_k(
    queries: DataFrame, cases: DataFrame, *, query_key: str, case_key: str, vector: str,
    dim: int, k: int = fv.TOP_K, tables: int = 7, bits: int = 5, radius: int | None = 1,
    seed: int = fv.SEED, query_id: str | None = None, case_ids: tuple[str, ...] = (),
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Multi-probe hyperplane hashing, then the exact block join inside each code.

    A query meets the cases whose code differs in at most ``radius`` of ``bits`` bits in at least
    one of ``tables`` tables. Two vectors at angle t agree in a bit with probability 1 - t/pi, so a
    true neighbour is found with 1 - (1 - P[at most radius of bits differ])**tables: the defaults
    find 0.96 of the neighbours at cosine 0.37 and meet 0.77 of all pairs, for vectors as spread as
    random ones; closer neighbours allow more bits. ``radius=None`` takes the smallest radius that
    finds 0.95 of the exact lists of a sample of 256 queries.
    """
    left = side(queries, query_key, vector, None, "query", masks(queries, [query_id] if query_id else [], None))
    right = side(cases, case_key, vector, None, "case", masks(cases, list(case_ids), None))
    if radius is None:
        radius, _ = vector_search.choose_radius(
            left, right, k, dim=dim, tables=tables, bits=bits, seed=seed)
    return vector_search.hashed_scan(left, right, k, dim=dim, tables=tables, bits=bits, radius=radius,
                                     seed=seed, block_rows=block_rows)


def retrieve(
    queries: DataFrame, index: DataFrame, terms: DataFrame, *, query_key: str, query_text: str,
    query_id: str | None = None, case_key: str = "pair_id", k: int = fv.TOP_K,
    masked: bool = True, substring: bool = False, block_rows: int = BLOCK_ROWS,
    search: TextIndex | None = None,
) -> DataFrame:
    """Text retrieval: exact top-k over the vectors of the index's feature model.

    Queries without vectors get them from that model; rows of the index bring their own.
    ``search`` takes the search tables of the index where they are there already. With
    ``substring`` a pair whose id contains the query's message id is masked, too.
    """
    left = queries
    if "term_ids" not in queries.columns:
        vectors = features.sparse_vectors(queries, query_key, query_text, terms)
        left = queries.join(vectors, query_key) if masked else vectors
    options = dict(
        query_id=query_id, case_ids=("customer_tweet_id", "support_tweet_id"),
        query_text=query_text, case_text="customer_clean_text", substring=substring) if masked else {}
    return top_k(
        left, search or index, query_key=query_key, case_key=case_key, vector="weights",
        term_ids="term_ids", k=k, block_rows=block_rows, **options)


def empty_cases(spark) -> DataFrame:
    """What retrieval returns without an index."""
    return spark.createDataFrame([], T.StructType([
        T.StructField("query_id", T.StringType()), T.StructField("rank", T.IntegerType()),
        T.StructField("case_id", T.StringType()), T.StructField("similarity_score", T.DoubleType()),
    ]))
