"""Labels, tokens and the text model."""

from __future__ import annotations

from pyspark.sql import functions as F

from airtally.operators import textmodel
from airtally.operators.dashboards import classification_report
from airtally.operators.rowops import below
from airtally.plans.registry import query
from airtally.plans.views import Views
from airtally.session import new_folder


@query("label_bucket", ["reviews"], """
SELECT doc_id, overall, CAST(CASE WHEN overall < 4 THEN 0 ELSE 1 END AS DOUBLE) AS label
FROM reviews WHERE overall != 3""")
def label_bucket(v: Views):
    return textmodel.label_bucket(v.reviews().select("doc_id", "overall"))


@query("token_counts", sql=r"""
SELECT token, count(*) AS count FROM (
  SELECT unnest(regexp_split_to_array(lower(text), '[\s\x0B]+|[,.()"]')) AS token FROM documents)
WHERE token != '' GROUP BY token""")
def token_counts(v: Views):
    return textmodel.token_counts(v.table("documents"), "text")


def labelled(v: Views):
    joined = textmodel.join_text(v.reviews(), ["summary", "reviewText"], "reviewTS",
                                 drop=["toxic", "quality", "summary", "reviewText"])
    return textmodel.label_bucket(joined)


DRAWN = "substr(md5(doc_id || ':{seed}'), 1, 8) < '{below}'"
IN_SAMPLE = " OR ".join(
    f"(label = {value} AND {DRAWN.format(seed=textmodel.SAMPLE_SEED, below=below(share))})"
    for value, share in textmodel.SAMPLE_FRACTIONS.items())
LABELLED = "SELECT doc_id, CAST(CASE WHEN overall < 4 THEN 0 ELSE 1 END AS DOUBLE) AS label FROM reviews WHERE overall != 3"


@query("balanced_sample", ["reviews"], f"SELECT * FROM ({LABELLED}) AS t WHERE {IN_SAMPLE}")
def balanced_sample(v: Views):
    return textmodel.balanced(labelled(v), ["doc_id"]).select("doc_id", "label")


@query("train_test_rows", ["reviews"], f"""
SELECT doc_id, label, {DRAWN.format(seed=textmodel.SPLIT_SEED, below=below(textmodel.SPLIT_WEIGHTS[0]))} AS training
FROM ({LABELLED}) AS t WHERE {IN_SAMPLE}""")
def train_test_rows(v: Views):
    """The balanced rows and the side each is on."""
    train, test = sides(v)
    return (train.withColumn("training", F.lit(True)).unionByName(test.withColumn("training", F.lit(False)))
            .select("doc_id", "label", "training"))


def sides(v: Views):
    return textmodel.train_and_test(textmodel.balanced(labelled(v), ["doc_id"]), ["doc_id"])


_fitted: dict[tuple[str, str], str] = {}


def model(v: Views):
    """The model of the training rows. It is fitted once for a session and folder and stored; the queries load it."""
    key = (v.spark.sparkContext.applicationId, v.folder)
    if key not in _fitted:
        path = new_folder(v.spark, "text-model")
        textmodel.save_model(textmodel.fit_text_model(sides(v)[0]), path)
        _fitted[key] = path
    return textmodel.load_model(_fitted[key])


@query("text_model_scores")
def text_model_scores(v: Views):
    """Fit on four fifths of the balanced texts and score the rest."""
    return textmodel.scores(model(v), sides(v)[1]).select("doc_id", "label", "prediction", "score")


@query("text_top_terms")
def text_top_terms(v: Views):
    """The five terms that speak most for class 1 and the five that speak least."""
    weights = textmodel.term_weights(model(v), sides(v)[0])
    return textmodel.top_weighted(weights).unionByName(textmodel.top_weighted(weights, largest=False))


@query("text_model_quality")
def text_model_quality(v: Views):
    """Confusion matrix, precision, recall, accuracy and area under the ROC curve."""
    predicted = model(v).transform(sides(v)[1])
    area = textmodel.area_under_roc(predicted)
    return classification_report(predicted).withColumn("area_under_roc", F.lit(area))


@query("text_top_scored")
def text_top_scored(v: Views):
    """The five most certain texts of each predicted class."""
    scored = textmodel.scores(model(v), sides(v)[1])
    best = [textmodel.top_scored(scored, c, tiebreak=["doc_id"]) for c in (0.0, 1.0)]
    return best[0].unionByName(best[1]).select("doc_id", "overall", "prediction", "score")
