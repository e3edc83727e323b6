"""Intent classifiers as ``pyspark.ml`` pipelines, all with the same prediction columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import (
    CountVectorizerModel, ElementwiseProduct, IDF, IndexToString, NGram, Normalizer, RegexTokenizer,
    SQLTransformer, StopWordsRemover, StringIndexer,
)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, functions as F

from careweave import fixed_values as fv
from careweave.functions import text as tx
from careweave.session import (
    discard, materialize, recorded_tables, short_lived_shuffles, task_slots,
)
from careweave.operators.classification import (
    argmax_label, class_weights, classification_metrics, majority_label,
)
from careweave.operators.features import vocabulary

PREDICTION_COLUMNS = ["predicted_intent", "confidence", "all_intent_probabilities"]
# Columns of a fitted pipeline; a caller's columns of other names pass through untouched.
_FEATURES, _RAW, _PROBABILITY, _PREDICTION = "_features", "_raw_scores", "_probabilities", "_prediction"


class VectorColumn(Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """A column of numbers in arrays as an ML vector; a stage that saves and loads with a pipeline."""

    @keyword_only
    def __init__(self, *, inputCol: str = "embedding", outputCol: str = _FEATURES):
        super().__init__()
        self._set(**self._input_kwargs)
        self._setDefault(inputCol="embedding", outputCol=_FEATURES)

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumn(self.getOutputCol(), array_to_vector(
            F.col(self.getInputCol()).cast("array<double>")))


class FittedClassifier:
    """A feature pipeline and a model; ``predict`` adds label, confidence and all probabilities."""

    def __init__(self, pipeline: PipelineModel, labels: Sequence[str]):
        self.pipeline, self.labels = pipeline, list(labels)

    def predict(self, df: DataFrame) -> DataFrame:
        scored = self.pipeline.transform(df)
        label, confidence, all_probabilities = argmax_label(
            vector_to_array(_PROBABILITY), self.labels)
        return scored.select(
            *df.columns, label.alias("predicted_intent"), confidence.alias("confidence"),
            all_probabilities.alias("all_intent_probabilities"))

    def save(self, path: str) -> None:
        self.pipeline.write().overwrite().save(path)

    @classmethod
    def load(cls, path: str) -> "FittedClassifier":
        pipeline = PipelineModel.load(path)
        indexer = next(s for s in pipeline.stages if isinstance(s, IndexToString))
        return cls(pipeline, indexer.getLabels())


def majority_predict(train: DataFrame, df: DataFrame, label: str = "intent", *,
                     probabilities: bool = False) -> DataFrame:
    """Every row gets the most frequent training label with confidence 1.

    With ``probabilities`` also the map of all labels, which is as long as the label table.
    """
    top = F.coalesce(majority_label(train, label).select("label").scalar(), F.lit(fv.GENERAL_INTENT))
    out = df.withColumns({"predicted_intent": top, "confidence": F.lit(1.0)})
    if not probabilities:
        return out
    shares = train.where(F.col(label).isNotNull()).select(F.col(label).alias("l")).distinct().agg(F.map_from_entries(
        F.sort_array(F.collect_list(F.struct("l", F.when(F.col("l") == top, 1.0).otherwise(0.0))))))
    return out.withColumn("all_intent_probabilities", shares.scalar())


def _weighted(train: DataFrame, label: str) -> tuple[DataFrame, int]:
    """Training rows with balanced class weights, and their number.

    The weights have one row per class, and the driver holds all classes anyway, hence the
    broadcast: by label, texts would be dealt to as many tasks as there are classes.
    """
    train = train.where(F.col(label).isNotNull())
    n = train.count()
    if not n:
        raise ValueError(f"no labelled rows in {label!r}")
    weights = class_weights(train, label).select(
        F.col("label").alias(label), F.col("weight").alias("_weight"))
    return train.join(F.broadcast(weights), label), n


def _classifier(n: int, max_iter: int) -> LogisticRegression:
    # C = 1 in the sum-of-losses form is regParam = 1/n in Spark's mean-of-losses form
    # (balanced weights add up to n).
    return LogisticRegression(
        featuresCol=_FEATURES, labelCol="_label", weightCol="_weight", maxIter=max_iter,
        rawPredictionCol=_RAW, probabilityCol=_PROBABILITY, predictionCol=_PREDICTION, regParam=1.0 / n, elasticNetParam=0.0, standardization=False, tol=1e-4)


def _fit(train: DataFrame, label: str, feature_stages: list, features, max_iter: int,
         n: int) -> FittedClassifier:
    """Features once, then the model; the saved pipeline leaves the training-only stages out."""
    indexer = StringIndexer(
        inputCol=label, outputCol="_label", stringOrderType="alphabetAsc").fit(train)
    prepared = indexer.transform(features)
    model = _classifier(n, max_iter).fit(prepared)
    back = IndexToString(inputCol=_PREDICTION, outputCol="_predicted", labels=indexer.labels)
    return FittedClassifier(PipelineModel([*feature_stages, model, back]), indexer.labels)


def fit_tfidf(
    train: DataFrame, text: str = "customer_clean_text", label: str = "intent", *,
    max_features: int = fv.MAX_FEATURES, max_iter: int = 1000,
    stop_words: Sequence[str] | None = None, dealt: bool = False,
) -> FittedClassifier:
    """Unigrams and bigrams, smoothed idf, unit rows, balanced logistic regression.

    Ties at the cut of the vocabulary go by term, so every fit sees the same columns. Texts are
    dealt out to all task slots first, unless ``dealt`` says that they lie in many splits already.
    Term counts are written once, without the texts and words they come from.
    """
    spark = train.sparkSession
    stop = list(stop_words) if stop_words is not None else (
        StopWordsRemover.loadDefaultStopWords("english"))
    with short_lived_shuffles(spark), recorded_tables() as paths:
        try:
            return _fit_tfidf(train, text, label, max_features, max_iter, stop, dealt)
        finally:
            discard(spark, paths)


def _fit_tfidf(train: DataFrame, text: str, label: str, max_features: int, max_iter: int,
               stop: list[str], dealt: bool) -> FittedClassifier:
    weighted, n = _weighted(train.select(text, label), label)
    if not dealt:
        weighted = weighted.repartition(task_slots(train.sparkSession))
    known = [r["term"] for r in vocabulary(  # at most max_features rows
        train, text, stop_words=stop, max_features=max_features, ngrams=2).collect()]
    terms = PipelineModel([
        RegexTokenizer(inputCol=text, outputCol="_tokens", pattern=tx.WORD, gaps=False),
        StopWordsRemover(inputCol="_tokens", outputCol="_words", stopWords=stop),
        NGram(inputCol="_words", outputCol="_bigrams", n=2),
        SQLTransformer(statement="SELECT *, concat(_words, _bigrams) AS _terms FROM __THIS__"),
        CountVectorizerModel.from_vocabulary(known, inputCol="_terms", outputCol="_tf"),
    ])
    counted = materialize(terms.transform(weighted).select(label, "_weight", "_tf"))
    idf = IDF(inputCol="_tf", outputCol="_idf").fit(counted).idf
    scale = ElementwiseProduct(
        scalingVec=Vectors.dense(idf.toArray() + 1.0), inputCol="_tf", outputCol="_tfidf")
    unit = Normalizer(inputCol="_tfidf", outputCol=_FEATURES)
    features = unit.transform(scale.transform(counted))
    return _fit(train, label, [*terms.stages, scale, unit], features, max_iter, n)


def fit_embedding(
    train: DataFrame, vector: str = "embedding", label: str = "intent", *, max_iter: int = 1000,
    dealt: bool = False,
) -> FittedClassifier:
    """The same classifier over a given embedding column; ``dealt`` as for ``fit_tfidf``."""
    weighted, n = _weighted(train.select(vector, label), label)
    as_vector = VectorColumn(inputCol=vector)
    features = as_vector.transform(
        weighted if dealt else weighted.repartition(task_slots(train.sparkSession)))
    return _fit(train, label, [as_vector], features, max_iter, n)


def rule_predict(df: DataFrame, text: str = "customer_clean_text", rules=fv.KEYWORD_RULES,
                 default: str = fv.GENERAL_INTENT) -> DataFrame:
    """Prediction without a trained model: keyword label at a fixed confidence."""
    return df.withColumns({
        "predicted_intent": tx.keyword_label(F.col(text), rules, default),
        "confidence": F.lit(fv.UNTRAINED_CONFIDENCE)}).withColumn(
        "all_intent_probabilities", F.create_map("predicted_intent", "confidence"))


def compare_models(predictions: dict[str, DataFrame], gold: str = "gold_intent") -> DataFrame:
    """Classification metrics per model over prediction frames of one test set."""
    from careweave.operators.summary import union_all

    frames = [df.select(F.lit(name).alias("model"), F.col(gold).alias("gold_intent"),
                        "predicted_intent") for name, df in predictions.items()]
    return classification_metrics(union_all(frames), by=["model"])
