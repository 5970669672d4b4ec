"""Intent classifier: TF-IDF n-grams and multinomial logistic regression."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel, IDF, ElementwiseProduct, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from replyscope.constants import INTENTS
from replyscope.functions.labels import heuristic_label
from replyscope.functions.text import tokenize_word, word_ngrams
from replyscope.operators.features import term_vocab
from replyscope.operators.metrics import class_report, intent_metrics
from replyscope.operators.sampling import exact_split, hash_sample_n

GRAMS = "_grams"
ROWS_PER_TASK = 2_500


def weak_label_set(threads: DataFrame, n: int = 5_000, seed: int = 42, key: str = "tweet_id") -> DataFrame:
    sample = hash_sample_n(threads, key, n, seed)
    return sample.withColumn("weak_intent", heuristic_label(F.col("inbound_text")))


def _with_grams(df: DataFrame, text: str) -> DataFrame:
    tokens = df.withColumn("_tokens", tokenize_word(F.col(text)))
    return tokens.withColumn(GRAMS, word_ngrams(F.col("_tokens"), 1, 2)).drop("_tokens")


def train_intent(
    labelled: DataFrame, text: str = "inbound_text", label: str = "weak_intent", max_features: int = 10_000, max_iter: int = 1_000
) -> PipelineModel:
    """Fits on all rows. Class weights are n / (classes * rows of the class), so
    they sum to n and a regularisation of 1/n equals a penalty factor of one.
    Rows with a label outside the taxonomy are left out. The vocabulary (at most
    max_features terms) and per-class counts are the only data that reach the driver."""
    labelled = labelled.filter(F.col(label).isin(list(INTENTS)))
    index_of = F.create_map(*[F.lit(v) for i, name in enumerate(INTENTS) for v in (name, float(i))])
    grams = _with_grams(labelled.select(text, label), text).withColumn("label", index_of[F.col(label)])
    counts = {r["label"]: r["count"] for r in grams.groupBy("label").count().collect()}
    n = sum(counts.values())
    weights = F.create_map(*[F.lit(v) for k, c in counts.items() for v in (k, n / (len(counts) * c))])
    weighted = grams.withColumn("weight", weights[F.col("label")]).persist()
    terms = [r["term"] for r in term_vocab(labelled, text, max_features, (1, 2), one_pass=True).orderBy("term").select("term").collect()]
    vectorizer = CountVectorizerModel.from_vocabulary(terms, GRAMS, "_counts")
    vectorized = vectorizer.transform(weighted)
    idf = IDF(inputCol="_counts", outputCol="_idf").fit(vectorized)
    # Spark's idf is ln((1+N)/(1+df)); one is added here.
    shifted = ElementwiseProduct(
        inputCol="_counts", outputCol="_tfidf", scalingVec=Vectors.dense([float(v) + 1.0 for v in idf.idf.toArray()])
    )
    unit = Normalizer(inputCol="_tfidf", outputCol="features", p=2.0)
    regression = LogisticRegression(
        family="multinomial", weightCol="weight", standardization=False, regParam=1.0 / n, maxIter=max_iter, tol=1e-5
    )
    prepared = unit.transform(shifted.transform(vectorized)).select("features", "label", "weight")
    prepared = prepared.coalesce(-(-n // ROWS_PER_TASK))  # an iteration is short: few tasks, few messages
    try:
        model = regression.fit(prepared)
    finally:
        weighted.unpersist()
    return PipelineModel([vectorizer, shifted, unit, model])


def score_intent(df: DataFrame, model: PipelineModel | None, text: str = "inbound_text", fallback_confidence: float = 0.40) -> DataFrame:
    """Adds intent and intent_confidence. Without a model the keyword label is
    used with a fixed confidence (0.40 in batches, 0.45 for answering)."""
    if model is None:
        return df.withColumn("intent", heuristic_label(F.col(text))).withColumn("intent_confidence", F.lit(fallback_confidence))
    names = F.array(*[F.lit(i) for i in INTENTS])
    scored = model.transform(_with_grams(df, text))
    kept = [c for c in df.columns if c not in ("intent", "intent_confidence")]
    return scored.select(
        *kept,
        F.element_at(names, F.col("prediction").cast("int") + 1).alias("intent"),
        F.array_max(vector_to_array("probability")).alias("intent_confidence"),
    )


def holdout_report(labelled: DataFrame, text: str = "inbound_text", label: str = "weak_intent", key: str = "tweet_id", seed: int = 42):
    """(class report, overall metrics) of a second model: fitted on 80%,
    measured on the other 20% (rounded up)."""
    test_n = -(-labelled.count() // 5)
    train, test = exact_split(labelled, key, test_n, seed)
    model = train_intent(train, text, label)
    scored = score_intent(test.select(key, text, F.col(label).alias("gold_intent")), model, text)
    aligned = scored.withColumnRenamed("intent", "pred_intent")
    return class_report(aligned), intent_metrics(aligned)


def model_weights(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """(intent, term, idf, weight): what the model has learned, a row per intent and
    term of its vocabulary, and one with a null term for the intent's intercept."""
    vectorizer, shifted, _, regression = model.stages
    matrix, idf = regression.coefficientMatrix.toArray(), shifted.getScalingVec().toArray()
    rows = [(INTENTS[i], term, float(idf[j]), float(matrix[i, j])) for i in range(len(matrix)) for j, term in enumerate(vectorizer.vocabulary)]
    rows += [(INTENTS[i], None, None, float(w)) for i, w in enumerate(regression.interceptVector.toArray())]
    return spark.createDataFrame(rows, "intent string, term string, idf double, weight double")


def model_save(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def model_load(path: str) -> PipelineModel | None:
    """None if there is no readable model: callers then use keyword labels."""
    try:
        return PipelineModel.load(path)
    except Exception:
        return None
