import pytest
from conftest import rows
from pyspark.sql import functions as F

from voxmill.config import LABELS
from voxmill.functions import labels
from voxmill.operators import evaluation, models, sampling

# Published confusion matrices (rows: true negative, neutral, positive) and the metrics that
# belong to them: accuracy, weighted precision, weighted F1, macro F1, neutral F1.
GOLDEN = {
    ("TF-IDF+LR", "Electronics"): ([[2, 0, 6], [2, 1, 2], [0, 0, 53]],
                                   (0.8485, 0.8341, 0.8123, 0.5322, 0.3333)),
    ("DistilBERT", "Electronics"): ([[7, 0, 1], [3, 0, 2], [2, 0, 51]],
                                    (0.8788, 0.8291, 0.8504, 0.5511, 0.0)),
    ("RoBERTa", "Electronics"): ([[7, 0, 1], [4, 0, 1], [1, 1, 51]],
                                 (0.8788, 0.8434, 0.8576, 0.5541, 0.0)),
    ("TF-IDF+LR", "Fashion"): ([[0, 0, 3], [0, 0, 3], [0, 0, 34]],
                               (0.85, 0.7225, 0.7811, 0.3063, 0.0)),
    ("DistilBERT", "Fashion"): ([[1, 0, 2], [1, 0, 2], [1, 0, 33]],
                                (0.85, 0.7831, 0.8151, 0.421, 0.0)),
    ("RoBERTa", "Fashion"): ([[1, 2, 0], [1, 0, 2], [0, 1, 33]],
                             (0.85, 0.8389, 0.843, 0.4522, 0.0)),
    ("TF-IDF+LR", "Combined"): ([[5, 0, 6], [0, 1, 6], [0, 3, 85]],
                                (0.8585, 0.8478, 0.8397, 0.5752, 0.1818)),
    ("DistilBERT", "Combined"): ([[11, 0, 0], [5, 0, 2], [15, 0, 73]],
                                 (0.7925, 0.8449, 0.798, 0.4732, 0.0)),
    ("RoBERTa", "Combined"): ([[9, 2, 0], [1, 2, 4], [2, 3, 83]],
                              (0.8868, 0.8887, 0.8876, 0.6723, 0.2857)),
}


def golden_counts(spark):
    data = [(m, d, LABELS[i], LABELS[j], n) for (m, d), (matrix, _) in GOLDEN.items()
            for i, line in enumerate(matrix) for j, n in enumerate(line) if n]
    return spark.createDataFrame(
        data, "model string, domain string, y_true string, y_pred string, n long")


def test_published_metrics(spark):
    table = evaluation.comparison_table(golden_counts(spark))
    got = {(r.model, r.domain): (r.accuracy, r.precision, r.f1, r.macro_f1, r.neutral_f1)
           for r in table.collect()}
    for key, (_, expected) in GOLDEN.items():
        assert got[key] == pytest.approx(expected, abs=1e-9)
    assert evaluation.comparison_long(table).count() == 9 * 6


def predictions(spark, truth, predicted, domain="d", model="m"):
    data = [(model, domain, i, LABELS[t], LABELS[p])
            for i, (t, p) in enumerate(zip(truth, predicted))]
    return spark.createDataFrame(
        data, "model string, domain string, sample_id long, y_true string, y_pred string")


def test_six_rows(spark):
    df = predictions(spark, [0, 0, 1, 1, 2, 2], [0, 1, 1, 2, 2, 2])
    counts = evaluation.confusion_counts(df, ["model"])
    wide = evaluation.confusion_matrix_wide(counts, ["model"])
    got = {r.y_true: (r.pred_negative, r.pred_neutral, r.pred_positive) for r in wide.collect()}
    assert got == {"negative": (1, 1, 0), "neutral": (0, 1, 1), "positive": (0, 0, 2)}
    row = evaluation.overall_metrics(counts, ["model"]).first()
    assert (row.neutral_support, row.accuracy) == (2, 4 / 6)
    perfect = evaluation.overall_metrics(evaluation.confusion_counts(
        predictions(spark, [0, 1, 2], [0, 1, 2]), ["model"]), ["model"]).first()
    assert (perfect.accuracy, perfect.weighted_f1, perfect.macro_f1) == (1.0, 1.0, 1.0)


def test_combined_is_the_sum_of_domains(spark):
    df = predictions(spark, [0, 1], [0, 1], "a").union(predictions(spark, [2, 2], [2, 0], "b"))
    counts = evaluation.confusion_counts(df, ["domain"], with_combined=True)
    sums = dict(counts.groupBy("domain").agg(F.sum("n")).collect())
    assert sums == {"a": 2, "b": 2, "Combined": 4}


def test_macro_uses_labels_that_occur(spark):
    counts = evaluation.confusion_counts(predictions(spark, [0, 0], [0, 2]), ["model"])
    row = evaluation.overall_metrics(counts, ["model"]).first()
    assert row.macro_recall == 0.25 and row.neutral_f1 == 0.0


def test_class_weights(spark):
    df = spark.createDataFrame([("a",)] * 6 + [("b",)] * 3 + [("c",)], "sentiment string")
    got = {r.sentiment: r.weight for r in evaluation.class_weights(df, []).collect()}
    assert got == pytest.approx({"a": 10 / 18, "b": 10 / 9, "c": 10 / 3})


def test_error_kinds(spark):
    truth = [1, 0, 0, 2, 2, 0]
    by_model = {"base": [0, 1, 1, 2, 2, 0], "tuned": [2, 1, 0, 0, 2, 0], "other": [0, 1, 0, 2, 0, 0]}
    frames = [predictions(spark, truth, p, model=m) for m, p in by_model.items()]
    df = frames[0].union(frames[1]).union(frames[2])
    aligned = evaluation.aligned_predictions(df, list(by_model), ["sample_id"])
    got = {r.sample_id: r.error_categories
           for r in evaluation.error_analysis(aligned, "base", "tuned", "other").collect()}
    assert got == {
        0: "Neutral Misclassification, All Models Failed", 1: "All Models Failed",
        2: "tuned Succeeded, base Failed", 3: "other Succeeded, tuned Failed",
        4: "Single Model Error"}


def test_missing_baseline_counts_zero(spark):
    table = evaluation.comparison_table(golden_counts(spark))
    table = table.where("not (model = 'TF-IDF+LR' and domain = 'Fashion')")
    got = evaluation.against_baseline(table, "TF-IDF+LR")
    assert got.where("domain = 'Fashion' and base_accuracy = 0.0").count() == 2
    assert got.where("domain = 'Combined'").first().base_accuracy == 0.8585


def sentiment_rows(spark):
    kinds = [("positive", 5.0, "Great sound", "Excellent headphones with wonderful clear audio"),
             ("negative", 1.0, "Broken", "Terrible cable broke after one awful week"),
             ("neutral", 3.0, "Average", "Ordinary device works fine mediocre enough")]
    data = []
    for i in range(60):
        label, rating, title, text = kinds[0 if i < 30 else 1 if i < 45 else 2]
        domain = "Electronics" if i % 2 else "Fashion"
        data.append((i, domain, title, f"{text} number {i}", label, rating))
    return spark.createDataFrame(
        data, "row_id long, domain string, title string, text string, sentiment string, rating double")


def test_feature_text(spark):
    row = models.training_rows(sentiment_rows(spark)).orderBy("row_id").first()
    assert row.features_text.startswith("Great sound. Excellent headphones")
    assert row.label == 2


def test_unknown_label_is_refused(spark):
    df = sentiment_rows(spark).withColumn("sentiment", F.lit("odd"))
    with pytest.raises(models.UnknownLabel, match="odd"):
        models.check_labels(models.training_rows(df))


def test_train_evaluate_save_load(spark, tmp_path):
    reviews = sentiment_rows(spark)
    metrics = models.train_and_evaluate(
        reviews, ("Combined",), max_iter=30, folder=str(tmp_path)).collect()
    assert {r.split: (r.sample_count, r.train_samples) for r in metrics} == {
        "validation": (9, 42), "test": (9, 42)}
    assert all(r.accuracy == 1.0 for r in metrics)
    model = models.load_model(str(tmp_path), "combined")
    rows_ = models.training_rows(reviews)
    scored = models.score(model, rows_)
    assert scored.where("predicted_sentiment <> sentiment").isEmpty()
    low, high = scored.agg(F.min("predicted_confidence"), F.max("predicted_confidence")).first()
    assert 1 / 3 < low <= high <= 1.0


def test_pipeline_features_equal_tfidf_table(spark):
    """The Spark ML stages and the plain aggregation give the same weights."""
    prepared = models.training_rows(sentiment_rows(spark))
    model = models.fit_classifier(prepared.select("features_text", "label"), max_iter=1)
    names = model.stages[1].vocabulary
    vectors = model.transform(prepared).select("row_id", "_features").collect()
    got = {(r.row_id, names[i]): v for r in vectors
           for i, v in zip(r._features.indices, r._features.values)}
    table = {(r.row_id, r.term): r.weight for r in models.tfidf_weights(prepared).collect()}
    assert got.keys() == table.keys()
    assert all(abs(got[k] - table[k]) < 1e-9 for k in got)


def test_term_counts(spark):
    df = spark.createDataFrame([("b a b a b",), ("x",), ("",)], "t string")
    df = df.withColumn("t", F.regexp_replace("t", "([a-z])", "$1$1"))
    got = [{e.term: e.tf for e in (r[0] or [])} for r in df.select(
        models.term_counts(F.col("t"))).collect()]
    assert got == [{"bb": 3, "aa": 2, "bb aa": 2, "aa bb": 2}, {"xx": 1}, {}]


def test_labels_round_trip(spark):
    df = spark.createDataFrame([(x,) for x in LABELS], "s string")
    back = df.select("s", labels.decode_label(labels.encode_label(F.col("s"))).alias("b"))
    assert rows(back.where("s <> b")) == []
    assert sampling.seeded_order("s") is not None


@pytest.mark.parametrize("name", ["trained_model_metrics", "stored_model_scores", "scored_reviews"])
def test_queries_fit_until_the_optimiser_stops(spark, monkeypatch, name):
    import inspect

    from voxmill.plans import QUERIES

    class Reached(Exception):
        pass

    def fit(*args, _real=inspect.signature(models.fit_classifier), **named):
        bound = _real.bind(*args, **named)
        bound.apply_defaults()
        raise Reached(bound.arguments["max_iter"])

    monkeypatch.setattr(models, "fit_classifier", fit)
    with pytest.raises(Reached, match="^1000$"):
        QUERIES[name](spark, "/root/testdata/sf0.001")


def test_tied_terms_are_taken_by_name(spark):
    words = [f"w{(i * 37) % 101:03d}" for i in range(101)]
    train = spark.createDataFrame([(w, i % 3) for i, w in enumerate(words)], "features_text string, label int")
    model = models.fit_classifier(train.repartition(4), size=5, max_iter=1)
    assert model.stages[1].vocabulary == sorted(words)[:5]


def test_scores_are_those_of_the_stages(spark):
    from pyspark.ml.functions import vector_to_array

    prepared = models.training_rows(sentiment_rows(spark))
    odd = spark.createDataFrame([(100, "d", "", None, None), (101, "d", None, None, None), (102, "d", "x zz", None, None)],
                                "row_id long, domain string, features_text string, sentiment string, label int")
    model = models.fit_classifier(prepared.select("features_text", "label"), size=40, max_iter=5)
    rows_ = prepared.unionByName(odd)
    got = {r.row_id: (r.predicted_sentiment, r.predicted_confidence) for r in models.score(model, rows_).collect()}
    staged = model.transform(rows_.fillna("", "features_text")).select("row_id", "_prediction", vector_to_array("_probability").alias("p"))
    expected = {r.row_id: (LABELS[int(r["_prediction"])], pytest.approx(max(r.p), abs=6e-5)) for r in staged.collect()}
    assert got == expected and len(got) == 63


def test_one_class_alone_is_certain(spark):
    train = spark.createDataFrame([("good sound", 2), ("good", 2)], "features_text string, label int")
    model = models.fit_classifier(train, max_iter=3)
    got = models.score(model, train).select("predicted_sentiment", "predicted_confidence").distinct().collect()
    assert [tuple(r) for r in got] == [("positive", 1.0)]
