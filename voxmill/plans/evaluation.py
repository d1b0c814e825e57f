"""Queries: confusion counts, metrics, model comparison, splits, class weights, TF-IDF."""

from __future__ import annotations

from pyspark.sql import functions as F

from voxmill.config import LABELS
from voxmill.operators import evaluation, lowrank, models, sampling
from voxmill.plans import sql as S
from voxmill.plans.registry import query
from voxmill.session import cut, new_path
from voxmill.sources import views

_CELLS = S.with_(S.PRED, """cells AS (
  SELECT model, domain, y_true, y_pred, count(*) AS n FROM predictions GROUP BY ALL
  UNION ALL
  SELECT model, 'Combined', y_true, y_pred, count(*) FROM predictions GROUP BY ALL)""")

_CLASSES = _CELLS.rstrip() + """,
classes AS (
  SELECT model, domain, label, sum(t)::BIGINT AS support, sum(tp)::BIGINT AS tp,
    CASE WHEN sum(p) > 0 THEN sum(tp) / sum(p) ELSE 0.0 END AS precision,
    CASE WHEN sum(t) > 0 THEN sum(tp) / sum(t) ELSE 0.0 END AS recall,
    CASE WHEN sum(t) + sum(p) > 0 THEN 2 * sum(tp) / (sum(t) + sum(p)) ELSE 0.0 END AS f1
  FROM (
    SELECT model, domain, y_true AS label, n AS t, 0 AS p,
      CASE WHEN y_true = y_pred THEN n ELSE 0 END AS tp FROM cells
    UNION ALL SELECT model, domain, y_pred, 0, n, 0 FROM cells)
  GROUP BY ALL),
overall AS (
  SELECT model, domain, sum(support)::BIGINT AS sample_count, sum(tp) / sum(support) AS accuracy,
    sum(precision * support) / sum(support) AS weighted_precision,
    sum(recall * support) / sum(support) AS weighted_recall,
    sum(f1 * support) / sum(support) AS weighted_f1,
    avg(precision) AS macro_precision, avg(recall) AS macro_recall, avg(f1) AS macro_f1,
    max(precision) FILTER (label = 'neutral') AS neutral_precision,
    max(recall) FILTER (label = 'neutral') AS neutral_recall,
    max(f1) FILTER (label = 'neutral') AS neutral_f1,
    max(support) FILTER (label = 'neutral') AS neutral_support
  FROM classes GROUP BY ALL)
"""

_TABLE = """
SELECT model, domain, printf('%.4f', (accuracy)::DOUBLE)::DOUBLE AS accuracy,
  printf('%.4f', (weighted_precision)::DOUBLE)::DOUBLE AS precision, printf('%.4f', (weighted_recall)::DOUBLE)::DOUBLE AS recall,
  printf('%.4f', (weighted_f1)::DOUBLE)::DOUBLE AS f1, printf('%.4f', (macro_f1)::DOUBLE)::DOUBLE AS macro_f1,
  printf('%.4f', (neutral_f1)::DOUBLE)::DOUBLE AS neutral_f1 FROM overall"""

_GROUPS = ["model", "domain"]


def _counts(spark, sf):
    return evaluation.confusion_counts(
        views.line_predictions(spark, sf), _GROUPS, with_combined=True)


@query(_CELLS + "SELECT * FROM cells")
def confusion_counts(spark, sf):
    return _counts(spark, sf)


@query(_CELLS + """
SELECT model, domain, y_true, y_pred, coalesce(n, 0) AS n
FROM (SELECT * FROM (SELECT DISTINCT model, domain FROM cells) f,
  (SELECT unnest(['negative', 'neutral', 'positive']) AS y_true) a,
  (SELECT unnest(['negative', 'neutral', 'positive']) AS y_pred) b)
LEFT JOIN cells USING (model, domain, y_true, y_pred)""")
def confusion_matrix(spark, sf):
    return evaluation.confusion_matrix(_counts(spark, sf), _GROUPS)


@query(_CELLS + """
SELECT model, domain, y_true, coalesce(sum(n) FILTER (y_pred = 'negative'), 0)::BIGINT AS pred_negative,
  coalesce(sum(n) FILTER (y_pred = 'neutral'), 0)::BIGINT AS pred_neutral,
  coalesce(sum(n) FILTER (y_pred = 'positive'), 0)::BIGINT AS pred_positive
FROM cells GROUP BY ALL""")
def confusion_matrix_wide(spark, sf):
    return evaluation.confusion_matrix_wide(_counts(spark, sf), _GROUPS)


@query(_CLASSES + """
SELECT model, domain, label, round(precision, 6) AS precision, round(recall, 6) AS recall,
  round(f1, 6) AS f1, support FROM classes""")
def class_metrics(spark, sf):
    metrics = evaluation.class_metrics(_counts(spark, sf), _GROUPS)
    return metrics.select(*_GROUPS, "label", *[
        F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")], "support")


_MEASURES = ("accuracy", "weighted_precision", "weighted_recall", "weighted_f1",
             "macro_precision", "macro_recall", "macro_f1", "neutral_precision",
             "neutral_recall", "neutral_f1")


@query(_CLASSES + "SELECT model, domain, sample_count, neutral_support, "
       + ", ".join(f"round({m}, 6) AS {m}" for m in _MEASURES) + " FROM overall")
def overall_metrics(spark, sf):
    metrics = evaluation.overall_metrics(_counts(spark, sf), _GROUPS)
    return metrics.select(*_GROUPS, "sample_count", "neutral_support", *[
        F.round(m, 6).alias(m) for m in _MEASURES])


@query(_CLASSES + _TABLE)
def comparison_table(spark, sf):
    return evaluation.comparison_table(_counts(spark, sf))


@query(_CLASSES + f"""
SELECT model, domain, metric, score FROM ({_TABLE})
UNPIVOT (score FOR metric IN (accuracy, precision, recall, f1, macro_f1, neutral_f1))""")
def comparison_long(spark, sf):
    return evaluation.comparison_long(evaluation.comparison_table(_counts(spark, sf)))


@query(_CLASSES + """
SELECT model, domain, round(precision, 6) AS precision, round(recall, 6) AS recall,
  round(f1, 6) AS f1, support FROM classes WHERE label = 'neutral'""")
def neutral_table(spark, sf):
    return evaluation.neutral_table(_counts(spark, sf), _GROUPS)


@query(_CLASSES + f""",
t AS ({_TABLE})
SELECT o.*, coalesce(b.accuracy, 0.0) AS base_accuracy, coalesce(b.precision, 0.0)
  AS base_precision, coalesce(b.recall, 0.0) AS base_recall, coalesce(b.f1, 0.0) AS base_f1,
  coalesce(b.macro_f1, 0.0) AS base_macro_f1, coalesce(b.neutral_f1, 0.0) AS base_neutral_f1
FROM t o LEFT JOIN (SELECT * FROM t WHERE model = 'flag' AND domain <> 'Combined') b
  ON o.domain = b.domain
WHERE o.model <> 'flag'""")
def against_baseline(spark, sf):
    table = evaluation.comparison_table(_counts(spark, sf))
    known = table.where("model <> 'flag' or domain <> 'Combined'")
    return evaluation.against_baseline(known, "flag")


_WIDE = S.with_(S.PRED, """wide AS (
  SELECT domain, sample_id, y_true, min(y_pred) FILTER (model = 'flag') AS pred_flag,
    min(y_pred) FILTER (model = 'votes') AS pred_votes,
    min(y_pred) FILTER (model = 'near') AS pred_near FROM predictions GROUP BY 1, 2, 3)""")
_MODELS = ["flag", "votes", "near"]


def _aligned(spark, sf):
    return evaluation.aligned_predictions(
        views.line_predictions(spark, sf), _MODELS, ["domain", "sample_id"])


@query(_WIDE + "SELECT * FROM wide")
def aligned_predictions(spark, sf):
    return _aligned(spark, sf)


@query(_WIDE + """
SELECT *, CASE WHEN len(kinds) > 0 THEN array_to_string(kinds, ', ') ELSE 'Single Model Error' END
  AS error_categories
FROM (SELECT *, list_filter([
    CASE WHEN y_true = 'neutral' THEN 'Neutral Misclassification' END,
    CASE WHEN pred_flag <> y_true AND pred_votes <> y_true AND pred_near <> y_true
      THEN 'All Models Failed'
    WHEN pred_votes <> y_true AND pred_near = y_true THEN 'near Succeeded, votes Failed'
    WHEN pred_votes = y_true AND pred_flag <> y_true THEN 'votes Succeeded, flag Failed' END],
    lambda x: x IS NOT NULL) AS kinds
  FROM wide WHERE pred_flag <> y_true OR pred_votes <> y_true OR pred_near <> y_true)
""".replace("SELECT *, CASE WHEN len", "SELECT * EXCLUDE (kinds), CASE WHEN len"))
def error_analysis(spark, sf):
    return evaluation.error_analysis(_aligned(spark, sf), "flag", "votes", "near")


@query(_WIDE + """
SELECT domain, sample_id, CASE WHEN length(text) > 120 THEN left(text, 120) || '...' ELSE text END
  AS text_snippet
FROM wide JOIN (SELECT review_key AS sample_id, text FROM item_reviews) USING (sample_id)
WHERE pred_flag <> y_true OR pred_votes <> y_true OR pred_near <> y_true""")
def error_snippets(spark, sf):
    errors = evaluation.error_analysis(_aligned(spark, sf), "flag", "votes", "near")
    texts = views.item_reviews(spark, sf).select("domain", F.col("review_key").alias("sample_id"), "text")
    return evaluation.with_snippets(errors, texts, ["domain", "sample_id"]).select(
        "domain", "sample_id", "text_snippet")


@query(S.with_(S.DOC) + """
SELECT domain, sentiment, count(*) AS n, round(sum(count(*)) OVER (PARTITION BY domain)
  / (count(*) OVER (PARTITION BY domain) * count(*)), 6) AS weight
FROM doc_reviews GROUP BY 1, 2""")
def class_weights(spark, sf):
    weights = evaluation.class_weights(views.doc_reviews(spark, sf), ["domain"])
    return weights.withColumn("weight", F.round("weight", 6))


@query(S.with_(S.DOC) + """
SELECT domain, (total - ceil(round(total * 0.3, 6)))::BIGINT AS train,
  (ceil(round(total * 0.3, 6)) - ceil(ceil(round(total * 0.3, 6)) * 0.5))::BIGINT AS validation,
  ceil(ceil(round(total * 0.3, 6)) * 0.5)::BIGINT AS test, total
FROM (SELECT domain, count(*) AS total FROM doc_reviews GROUP BY 1
      UNION ALL SELECT 'Combined', count(*) FROM doc_reviews)""")
def split_summary(spark, sf):
    docs = views.doc_reviews(spark, sf).select("row_id", "domain", "sentiment")
    both = docs.withColumn("domain", F.explode(F.array(F.col("domain"), F.lit("Combined"))))
    return sampling.split_summary(sampling.stratified_split(both, ["domain"]), ["domain"])


_TFIDF = S.with_(S.DOC, f"""toks AS (
  SELECT row_id, regexp_extract_all(lower({S.clean(S.full_text())}), '[\\p{{L}}\\p{{N}}_]{{2,}}')
    AS t FROM doc_reviews),
grams AS (
  SELECT row_id, unnest(list_concat(t, list_transform(list_zip(t[1:len(t) - 1], t[2:]),
    lambda p: p[1] || ' ' || p[2]))) AS term FROM toks WHERE len(t) > 0),
tf AS (SELECT row_id, term, count(*) AS tf FROM grams GROUP BY 1, 2),
vocab AS (SELECT term, sum(tf)::BIGINT AS total, count(*) AS df FROM tf GROUP BY 1
          ORDER BY total DESC, term LIMIT 5000)""")


def _rows(spark, sf):
    return models.training_rows(views.doc_reviews(spark, sf), None)


@query(_TFIDF + "SELECT term, total, df FROM vocab")
def vocabulary(spark, sf):
    return models.vocabulary(cut(_rows(spark, sf).select("features_text")))


@query(_TFIDF + """,
raw AS (SELECT row_id, term, (1 + ln(tf)) *
    (ln((1.0 + (SELECT count(*) FROM doc_reviews))::DOUBLE / (1.0 + df)::DOUBLE) + 1) AS w
  FROM tf JOIN vocab USING (term))
SELECT row_id, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY row_id)), 6) AS weight FROM raw""")
def tfidf_weights(spark, sf):
    return models.tfidf_weights(_rows(spark, sf)).withColumn("weight", F.round("weight", 6))


@query(_TFIDF.replace("WITH ", "WITH RECURSIVE ", 1) + """,
raw AS (SELECT row_id, term, (1 + ln(tf)) *
    (ln((1.0 + (SELECT count(*) FROM doc_reviews))::DOUBLE / (1.0 + df)::DOUBLE) + 1) AS w
  FROM tf JOIN vocab USING (term)),
weights AS MATERIALIZED (SELECT row_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY row_id)) AS w FROM raw),
powers AS (
  SELECT 0 AS k, term, 1.0::DOUBLE AS x FROM vocab
  UNION ALL
  SELECT y.k + 1, w.term, sum(w.w * y.y) / 100.0 FROM (
    SELECT p.k, w.row_id, sum(w.w * p.x) AS y FROM powers p JOIN weights w USING (term) WHERE p.k < 80
    GROUP BY p.k, w.row_id) y JOIN weights w USING (row_id) GROUP BY y.k, w.term),
direction AS (SELECT term, x / sqrt(sum(x * x) OVER ()) AS v FROM powers WHERE k = 80)
SELECT row_id, round(sum(w * v), 4) AS loading FROM weights JOIN direction USING (term) GROUP BY row_id""")
def leading_factor(spark, sf):
    """How far each text goes along the strongest direction of all texts (checked by power iteration)."""
    rows = cut(_rows(spark, sf))
    factors, weights = lowrank.factor_rows(rows, rank=16, passes=8)
    along = lowrank.projected(weights, factors, unit=False)
    return along.join(weights.where("size(indices) > 0").select("row_id"), "row_id").select(
        "row_id", F.round(F.get("vec", F.lit(0)), 4).alias("loading"))


@query()
def trained_model_metrics(spark, sf):
    """TF-IDF and logistic regression per domain: split, fit, evaluate."""
    reviews = views.doc_reviews(spark, sf)
    return models.train_and_evaluate(reviews, max_chars=None)


@query(S.with_(S.DOC) + """
SELECT row_id, domain, true AS label_known, true AS confident, true AS as_before FROM doc_reviews
WHERE sentiment IS NOT NULL""")
def stored_model_scores(spark, sf):
    """A model is stored, loaded and used: labels and confidences are in range and as before."""
    rows = cut(_rows(spark, sf).where("sentiment is not null"))
    model = models.fit_classifier(rows.select("features_text", "label"))
    folder = new_path(spark, "models")
    models.save_model(model, folder, "Fashion")
    before = models.score(model, rows).select("row_id", F.col("predicted_sentiment").alias("_before"))
    scored = models.score(models.load_model(folder, "Fashion"), rows).join(before, "row_id")
    return scored.select(
        "row_id", "domain", F.col("predicted_sentiment").isin(*LABELS).alias("label_known"),
        F.col("predicted_confidence").between(0.333, 1.0).alias("confident"),
        (F.col("predicted_sentiment") == F.col("_before")).alias("as_before"))


@query()
def scored_reviews(spark, sf):
    """Every review scored by a classifier fitted to the training split."""
    split = cut(sampling.stratified_split(_rows(spark, sf), ["domain"]))
    model = models.fit_classifier(
        split.where("split = 'train'").select("features_text", "label"))
    return models.score(model, split).select(
        "row_id", "domain", "split", "sentiment", "predicted_sentiment", "predicted_confidence")
