"""Text classification with Spark ML: tokens, counts, weights, logistic regression."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import IDF, Bucketizer, CountVectorizerModel, RegexTokenizer, StopWordsRemover
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airtally.operators.rowops import keyed_sample, keyed_split
from airtally.session import written

# The parameters of the model.
TOKEN_GAPS = r'\s+|[,.()"]'
VOCABULARY = 200_000
ITERATIONS, REGULARISATION, ELASTIC_NET = 100, 0.02, 0.3
NEUTRAL, POSITIVE_FROM = 3, 4.0
SAMPLE_FRACTIONS, SAMPLE_SEED = {1.0: 0.1, 0.0: 1.0}, 36
SPLIT_WEIGHTS, SPLIT_SEED = [0.8, 0.2], 5043


def balanced(df: DataFrame, keys: list[str], label: str = "label") -> DataFrame:
    """Fewer rows of the frequent class, so that both weigh about the same."""
    return keyed_sample(df, label, SAMPLE_FRACTIONS, keys, SAMPLE_SEED)


def train_and_test(df: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """Training and test rows; a row's side depends on its keys only."""
    return keyed_split(df, SPLIT_WEIGHTS[0], keys, SPLIT_SEED)


def join_text(df: DataFrame, parts: list[str], dst: str, drop: list[str] | None = None) -> DataFrame:
    """Text columns as one, blanks between; null when a part is null."""
    pieces = [piece for part in parts for piece in (F.lit(" "), F.col(part))][1:]
    return df.withColumn(dst, F.concat(*pieces)).drop(*(drop or []))


def label_bucket(df: DataFrame, rating: str = "overall", label: str = "label") -> DataFrame:
    """Drop neutral ratings; label 1 from ``POSITIVE_FROM`` up, else 0."""
    splits = [float("-inf"), POSITIVE_FROM, float("inf")]
    rated = df.filter(F.col(rating) != NEUTRAL)
    return Bucketizer(splits=splits, inputCol=rating, outputCol=label).transform(rated)


def tokenizer(text: str, out: str) -> RegexTokenizer:
    """Lower-case tokens between blanks and some punctuation."""
    return RegexTokenizer(inputCol=text, outputCol=out, pattern=TOKEN_GAPS)


def token_counts(df: DataFrame, text: str) -> DataFrame:
    """How often each token occurs, over whole texts; the tokenizer's rule in
    built-in functions, so that no text leaves Spark's own row format."""
    tokens = df.select(F.explode(F.split(F.lower(text), TOKEN_GAPS)).alias("token"))
    return tokens.filter("token != ''").groupBy("token").agg(F.count(F.lit(1)).alias("count"))


def token_stages(text: str = "reviewTS") -> list:
    """Tokens without stop words."""
    return [tokenizer(text, "tokens_all"),
            StopWordsRemover(inputCol="tokens_all", outputCol="tokens",
                             stopWords=StopWordsRemover.loadDefaultStopWords("english"))]


def text_pipeline(terms: list[str], text: str = "reviewTS", label: str = "label", iterations: int = ITERATIONS) -> Pipeline:
    """Tokens, stop words, counts of the given terms, inverse document frequency, logistic regression."""
    return Pipeline(stages=[
        *token_stages(text),
        CountVectorizerModel.from_vocabulary(terms, inputCol="tokens", outputCol="counts"),
        IDF(inputCol="counts", outputCol="features"),
        LogisticRegression(labelCol=label, maxIter=iterations, regParam=REGULARISATION,
                           elasticNetParam=ELASTIC_NET)])


def frequent_terms(tokens: DataFrame, column: str, size: int) -> list[str]:
    """The ``size`` terms that occur most, the first by name where they occur alike, as the model's vocabulary.

    Only those reach the driver; ``CountVectorizer.fit`` sends it the terms of every task.
    """
    counts = tokens.select(F.explode(column).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    # Written, as tasks then take the first terms; collected at once, every task would send its own.
    found = written(counts.orderBy(F.col("n").desc(), "term").limit(size), "terms")
    return [term for _, term in sorted((-r.n, r.term) for r in found.toLocalIterator())]


def fit_text_model(train: DataFrame, text: str = "reviewTS", vocabulary: int = VOCABULARY, **params) -> PipelineModel:
    """Fit the pipeline; the training rows are kept while the fit passes over them."""
    kept = train.persist()
    try:
        words = PipelineModel(token_stages(text)).transform(kept)
        return text_pipeline(frequent_terms(words, "tokens", vocabulary), text=text, **params).fit(kept)
    finally:
        kept.unpersist()


def scores(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Predictions with the score of class 1 as a plain number."""
    return model.transform(df).withColumn("score", vector_to_array("rawPrediction")[1])


def area_under_roc(predictions: DataFrame, label: str = "label") -> float:
    return BinaryClassificationEvaluator(labelCol=label).evaluate(predictions)


def term_weights(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Vocabulary with coefficients; as long as the vocabulary, which is a parameter."""
    pairs = list(zip(model.stages[2].vocabulary, map(float, model.stages[-1].coefficients.toArray())))
    schema = T.StructType([T.StructField("term", T.StringType()), T.StructField("weight", T.DoubleType())])
    return df.sparkSession.createDataFrame(pairs, schema)


def top_weighted(weights: DataFrame, size: int = 5, largest: bool = True) -> DataFrame:
    """The terms that speak most for class 1, or least."""
    order = F.col("weight").desc() if largest else F.col("weight").asc()
    return weights.orderBy(order, "term").limit(size)


def top_scored(predictions: DataFrame, predicted: float, size: int = 5,
               tiebreak: list[str] | None = None) -> DataFrame:
    """The most certain rows of one predicted class; ``tiebreak`` orders equal scores."""
    sure = F.col("score").desc() if predicted == 1.0 else F.col("score").asc()
    return predictions.filter(F.col("prediction") == predicted).orderBy(sure, *(tiebreak or [])).limit(size)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
