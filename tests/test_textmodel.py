"""The text model on a few sentences."""

from __future__ import annotations

from samples import rows

from airtally.operators import textmodel as tm


def reviews(spark):
    good, bad = "great ball, loved (it)", 'poor grip. broke "fast"'
    data = [(i, 5.0 if i % 2 else 1.0, "sum", good if i % 2 else bad) for i in range(40)]
    return spark.createDataFrame([*data, (99, 3.0, "sum", "fine")],
                                 "id int, overall double, summary string, reviewText string")


def test_labels_and_tokens(spark):
    labelled = tm.label_bucket(tm.join_text(reviews(spark), ["summary", "reviewText"], "reviewTS"))
    assert rows(labelled.groupBy("overall", "label").count()) == [(1.0, 0.0, 20), (5.0, 1.0, 20)]
    counts = dict(rows(tm.token_counts(labelled, "reviewTS")))
    assert counts["it"] == counts["fast"] == 20 and counts["sum"] == 40


def test_fit_score_save(spark, tmp_path):
    labelled = tm.label_bucket(tm.join_text(reviews(spark), ["summary", "reviewText"], "reviewTS",
                                            drop=["summary"]))
    model = tm.fit_text_model(labelled, iterations=20)
    scored = tm.scores(model, labelled)
    assert tm.area_under_roc(scored) == 1.0
    weights = tm.term_weights(model, labelled)
    good = {r.term for r in tm.top_weighted(weights, 3).collect()}
    bad = {r.term for r in tm.top_weighted(weights, 3, largest=False).collect()}
    assert good <= {"great", "ball", "loved"} and bad <= {"poor", "grip", "broke", "fast"}
    assert {r.label for r in tm.top_scored(scored, 1.0).collect()} == {1.0}
    tm.save_model(model, str(tmp_path / "m"))
    tm.save_model(model, str(tmp_path / "m"))
    again = tm.scores(tm.load_model(str(tmp_path / "m")), labelled)
    assert rows(again, "id", "prediction") == rows(scored, "id", "prediction")


def test_only_the_frequent_terms_reach_the_driver(spark):
    """The most frequent terms, by name where they occur alike; the results of tasks do not grow with all terms."""
    words = spark.range(30_000).selectExpr("array(concat('w', id % 10000), concat('x', id), 'often', 'often') AS tokens").repartition(16)
    group = "frequent terms"
    spark.sparkContext.setJobGroup(group, "terms")
    found = tm.frequent_terms(words, "tokens", 5)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert found == ["often", "w0", "w1", "w10", "w100"]
    assert tm.frequent_terms(words.limit(0), "tokens", 5) == []
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup(group)
    store = spark.sparkContext._jsc.sc().statusStore()
    sent = sum(store.lastStageAttempt(s).resultSize() for j in jobs for s in spark.sparkContext.statusTracker().getJobInfo(j).stageIds
               if store.lastStageAttempt(s).status().toString() == "COMPLETE")
    assert sent < 300_000
