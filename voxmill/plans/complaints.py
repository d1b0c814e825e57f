"""Queries: aspect tagging, frequencies, breakdowns, annotations, multi-label evaluation."""

from __future__ import annotations

from pyspark.sql import functions as F

from voxmill.functions import aspects as asp, labels, lexicons as L, numbers, text as tx
from voxmill.operators import complaints, insights, scoring
from voxmill.plans import sql as S
from voxmill.plans.registry import query
from voxmill.sources import views

_JOINED = "; "


def _joined(name: str):
    return F.array_join(name, _JOINED).alias(name)


def _docs(spark, sf):
    return views.doc_reviews(spark, sf)


def _tagged_docs(spark, sf):
    return insights.enrich_reviews(_docs(spark, sf), only_negative=False)


def _tagged_items(spark, sf):
    return insights.enrich_reviews(views.item_reviews(spark, sf, for_text=True), only_negative=False)


_DOC_TAGS = S.with_(S.DOC, f"""full_docs AS (SELECT *, {S.full_text()} AS body FROM doc_reviews),
tagged AS (SELECT *, {S.tags('body', 'domain')} AS aspects FROM full_docs)""")
# The text of an order line repeats per part: tag each distinct text once.
_ITEM_TAGS = S.with_(S.ITEM, f"""bodies AS (
  SELECT DISTINCT title, text, domain, {S.full_text()} AS body FROM item_reviews),
body_tags AS (SELECT title, text, domain, {S.tags('body', 'domain')} AS aspects FROM bodies),
tagged AS (SELECT r.*, b.aspects FROM item_reviews r JOIN body_tags b USING (title, text, domain))""")


@query(_DOC_TAGS + "SELECT row_id, array_to_string(aspects, '; ') AS aspects FROM tagged")
def aspect_tags(spark, sf):
    return _tagged_docs(spark, sf).select("row_id", _joined("aspects"))


@query(_ITEM_TAGS + """
SELECT review_key, CASE WHEN sentiment = 'negative' OR predicted_sentiment = 'negative'
  THEN array_to_string(aspects, '; ') ELSE '' END AS aspects FROM tagged""")
def complaint_tags(spark, sf):
    return insights.enrich_reviews(views.item_reviews(spark, sf, for_text=True)).select(
        "review_key", _joined("aspects"))


@query(S.with_(S.DOC) + f"""
SELECT row_id, array_to_string({S.annotated('text', 'domain')}, '; ') AS aspects
FROM doc_reviews""")
def annotation_tags(spark, sf):
    tagged = asp.annotate_aspects(F.col("text"), F.col("domain"))
    return _docs(spark, sf).select("row_id", F.array_join(tagged, _JOINED).alias("aspects"))


@query("""
SELECT p_partkey, p_name || ' ; ' || upper(p_brand) || ',|' || p_type || ',' AS raw,
  array_to_string(items, '; ') AS parsed, len(items)::INTEGER AS n
FROM (SELECT *, list_filter(list_transform(regexp_split_to_array(
    p_name || ' ; ' || upper(p_brand) || ',|' || p_type || ',', '[;,|]'),
  lambda x: lower(trim(x))), lambda x: x <> '') AS items FROM part)""")
def parsed_aspect_lists(spark, sf):
    raw = F.concat("p_name", F.lit(" ; "), F.upper("p_brand"), F.lit(",|"), "p_type", F.lit(","))
    rows = views.table(spark, sf, "part").select("p_partkey", raw.alias("raw"))
    parsed = asp.parse_aspects(F.col("raw"))
    return rows.select("p_partkey", "raw", F.array_join(parsed, _JOINED).alias("parsed"),
                       F.size(parsed).alias("n"))


_DISTINCT_TAGS = _ITEM_TAGS.rstrip() + """,
cells AS (SELECT DISTINCT review_key, domain, unnest(aspects) AS aspect FROM tagged)
"""


@query(_DISTINCT_TAGS + """,
totals AS (SELECT domain, count(*) AS total_reviews FROM tagged GROUP BY domain
           UNION ALL SELECT 'All', count(*) FROM tagged),
counted AS (SELECT domain, aspect, count(*) AS n FROM cells GROUP BY 1, 2
            UNION ALL SELECT 'All', aspect, count(*) FROM cells GROUP BY 2)
SELECT domain, aspect, n, total_reviews, printf('%.2f', (n / total_reviews * 100.0)::DOUBLE)::DOUBLE AS frequency_pct
FROM counted JOIN totals USING (domain)""")
def aspect_frequencies(spark, sf):
    return complaints.aspect_frequencies(_tagged_items(spark, sf))


@query(_DISTINCT_TAGS + """,
totals AS (SELECT domain, count(*) AS total_reviews FROM tagged GROUP BY domain),
counted AS (SELECT domain, aspect, count(*) AS n FROM cells GROUP BY 1, 2)
SELECT domain, aspect, n, total_reviews, printf('%.1f', (n / total_reviews * 100.0)::DOUBLE)::DOUBLE AS pct,
  repeat('=', floor(n / total_reviews * 100.0 / 4)::INTEGER) AS bar
FROM counted JOIN totals USING (domain)""")
def annotation_statistics(spark, sf):
    labelled = _tagged_items(spark, sf).select(
        "domain", F.array_join("aspects", "; ").alias("aspect_labels"))
    return complaints.annotation_statistics(labelled)


@query(_DISTINCT_TAGS + """,
totals AS (SELECT domain, count(*) AS total_reviews FROM tagged GROUP BY domain),
counted AS (SELECT domain, aspect, count(*) AS n FROM cells GROUP BY 1, 2)
SELECT domain, aspect, repeat('█', floor(printf('%.2f', (n / total_reviews * 100.0)::DOUBLE)::DOUBLE / 3)::INTEGER)
  AS bar FROM counted JOIN totals USING (domain)""")
def frequency_bars(spark, sf):
    freq = complaints.aspect_frequencies(_tagged_items(spark, sf)).where("domain <> 'All'")
    return freq.select(
        "domain", "aspect", numbers.text_bar(F.col("frequency_pct"), 3).alias("bar"))


@query(_ITEM_TAGS + """
SELECT domain, count(*) AS n_reviews, count(*) FILTER (len(aspects) >= 2) AS n_multi,
  round(avg(CASE WHEN len(aspects) >= 2 THEN 100.0 ELSE 0.0 END), 6) AS pct_multi
FROM tagged WHERE sentiment = 'negative' GROUP BY domain""")
def multi_aspect_share(spark, sf):
    negatives = _tagged_items(spark, sf).where(labels.is_negative("label"))
    return complaints.multi_aspect_share(negatives)


def _breakdown_sql(condition: str, top: int | None) -> str:
    names = S.display("aspect")
    limit = f"WHERE rank <= {top}" if top else ""
    return _ITEM_TAGS.rstrip() + f""",
neg AS (SELECT * FROM tagged WHERE {condition}),
counted AS (
  SELECT parent_asin, aspect, count(*) AS n FROM (
    SELECT parent_asin, unnest(aspects) AS aspect FROM neg) GROUP BY 1, 2),
totals AS (SELECT parent_asin, count(*) AS total_negatives FROM neg GROUP BY 1)
SELECT parent_asin, aspect, n, total_negatives, rank, {names} AS display_name,
  printf('%.1f', (n / total_negatives * 100.0)::DOUBLE)::DOUBLE AS percentage
FROM (SELECT *, row_number() OVER (PARTITION BY parent_asin ORDER BY n DESC, aspect)::INTEGER
        AS rank FROM counted JOIN totals USING (parent_asin)) {limit}"""


@query(_breakdown_sql("sentiment = 'negative'", None))
def complaint_breakdown(spark, sf):
    return complaints.complaint_breakdown(_tagged_items(spark, sf))


@query(_breakdown_sql(
    "sentiment = 'negative' OR predicted_sentiment = 'negative' OR rating <= 2", 6))
def wide_complaint_breakdown(spark, sf):
    return complaints.complaint_breakdown(_tagged_items(spark, sf), mode="wide", top=6)


@query(S.with_(S.DOC) + f"""
SELECT CASE domain WHEN 'Electronics' THEN 'ELEC' ELSE 'FASH' END || '-' || lpad(
    place::VARCHAR, 3, '0') AS review_id, domain, body AS text,
  array_to_string({S.annotated('body', 'domain')}, '; ') AS aspect_labels
FROM (SELECT *, row_number() OVER (PARTITION BY domain ORDER BY md5('42:' || row_id), row_id)
        AS place,
      CASE WHEN title <> '' AND NOT starts_with({S.strip('text')}, title)
        THEN title || '. ' || {S.strip('text')} ELSE {S.strip('text')} END AS body
      FROM doc_reviews
      WHERE sentiment = 'negative' AND length(text) BETWEEN 35 AND 750)
WHERE place <= 150""")
def annotation_set(spark, sf):
    return complaints.annotation_set(_docs(spark, sf))


_SCORED = S.with_(S.DOC, f"""labelled AS (
  SELECT row_id, domain, text, {S.annotated('text', 'domain')} AS truth,
    [{', '.join('{' + f"'a': '{a}', 'ok': {S._domain(a, 'domain', 'Electronics')}, 's': {S.score(a, 'text')}" + '}'
                for a in L.ASPECTS)}] AS cells FROM doc_reviews),
scored AS (
  SELECT row_id, domain, truth, list_filter(cells, lambda c: c.ok) AS scores FROM labelled),
predicted AS (
  SELECT row_id, domain, truth, scores,
    list_transform(list_filter(scores, lambda c: c.s >= 0.35), lambda c: c.a) AS detected
  FROM scored)""")


def _predictions(spark, sf):
    labelled = _docs(spark, sf).select(
        F.format_string("DOC-%03d", F.col("row_id")).alias("review_id"), "domain", "text",
        F.array_join(asp.annotate_aspects(F.col("text"), F.col("domain")), "; ")
        .alias("aspect_labels"))
    return complaints.aspect_predictions(labelled)


@query(_SCORED + """
SELECT 'DOC-' || CASE WHEN row_id < 1000 THEN lpad(row_id::VARCHAR, 3, '0')
    ELSE row_id::VARCHAR END AS review_id, domain,
  array_to_string(truth, '; ') AS ground_truth_aspects,
  array_to_string(detected, '; ') AS detected_aspects,
  '{' || array_to_string(list_transform(scores, lambda c:
    '"' || c.a || '":' || printf('%.4f', (c.s)::DOUBLE)::DOUBLE::VARCHAR), ',') || '}' AS confidence
FROM predicted""")
def aspect_predictions(spark, sf):
    return _predictions(spark, sf).select(
        "review_id", "domain", "ground_truth_aspects", "detected_aspects", "confidence")


@query(_SCORED + """
SELECT aspect, count(*) AS n, round(avg(score), 6) AS mean_score FROM (
  SELECT c.a AS aspect, c.s AS score FROM (SELECT unnest(scores) AS c FROM predicted))
WHERE score >= 0.4 GROUP BY aspect ORDER BY mean_score DESC, aspect""")
def confident_aspects(spark, sf):
    scores = asp.lexicon_scores(F.col("text"), F.col("domain"))
    cells = _docs(spark, sf).select(F.explode(scores).alias("aspect", "score"))
    return cells.where("score >= 0.4").groupBy("aspect").agg(
        F.count("*").alias("n"), F.round(F.avg("score"), 6).alias("mean_score")).orderBy(
        F.desc("mean_score"), "aspect")


def _cells(groups: str) -> str:
    return f""",
pairs AS (
  SELECT row_id, {groups}unnest(list_distinct(list_concat(truth, detected))) AS label,
    truth, detected FROM predicted),
counts AS (
  SELECT {groups}label,
    count(*) FILTER (list_contains(truth, label) AND list_contains(detected, label)) AS tp,
    count(*) FILTER (NOT list_contains(truth, label)) AS fp,
    count(*) FILTER (NOT list_contains(detected, label)) AS fn
  FROM pairs GROUP BY ALL)"""


_PRF = """
  CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END AS precision,
  CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END AS recall,
  CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0.0 END AS f1,
  tp + fn AS support"""


def _summary(group: str) -> str:
    return f"""
SELECT {group}count(*) AS aspect_count,
  printf('%.4f', (CASE WHEN sum(tp + fp) > 0 THEN sum(tp) / sum(tp + fp) ELSE 0.0 END)::DOUBLE)::DOUBLE
    AS micro_precision,
  printf('%.4f', (CASE WHEN sum(tp + fn) > 0 THEN sum(tp) / sum(tp + fn) ELSE 0.0 END)::DOUBLE)::DOUBLE
    AS micro_recall,
  printf('%.4f', (CASE WHEN sum(2 * tp + fp + fn) > 0 THEN 2 * sum(tp) / sum(2 * tp + fp + fn)
    ELSE 0.0 END)::DOUBLE)::DOUBLE AS micro_f1,
  printf('%.4f', (avg(precision))::DOUBLE)::DOUBLE AS macro_precision, printf('%.4f', (avg(recall))::DOUBLE)::DOUBLE AS macro_recall,
  printf('%.4f', (avg(f1))::DOUBLE)::DOUBLE AS macro_f1, any_value(sample_count) AS sample_count FROM metrics"""


@query(_SCORED + _cells("") + f""",
metrics AS (SELECT *, {_PRF}, (SELECT count(*) FROM predicted) AS sample_count FROM counts)"""
       + _summary(""))
def multilabel_summary(spark, sf):
    return complaints.multilabel_evaluation(_predictions(spark, sf), "truth", "detected")[0]


_TARGETS = ", ".join(
    f"('{d}', '{a}')" for d, aspects in L.TAXONOMY.items() for a in aspects)
_TARGET_METRICS = _SCORED + _cells("domain, ") + f""",
metrics AS (
  SELECT domain, label, tp, fp, fn, {_PRF}, sample_count FROM (
    SELECT t.domain, t.label, coalesce(tp, 0) AS tp, coalesce(fp, 0) AS fp, coalesce(fn, 0) AS fn,
      (SELECT count(*) FROM predicted p WHERE p.domain = t.domain) AS sample_count
    FROM (VALUES {_TARGETS}) t(domain, label) LEFT JOIN counts c USING (domain, label)))"""


def _by_domain(spark, sf):
    targets = asp.taxonomy(spark).select("domain", F.col("aspect").alias("label"))
    return complaints.multilabel_evaluation(
        _predictions(spark, sf), "truth", "detected", ["domain"], targets)


@query(_TARGET_METRICS + _summary("domain, ") + " GROUP BY domain")
def multilabel_summary_by_domain(spark, sf):
    return _by_domain(spark, sf)[0]


@query(_TARGET_METRICS + """
SELECT domain, label, printf('%.4f', (precision)::DOUBLE)::DOUBLE AS precision, printf('%.4f', (recall)::DOUBLE)::DOUBLE AS recall,
  printf('%.4f', (f1)::DOUBLE)::DOUBLE AS f1, support FROM metrics""")
def multilabel_per_aspect(spark, sf):
    return _by_domain(spark, sf)[1].orderBy("domain", F.desc("f1"), "label")


@query("""
WITH t AS (SELECT row_number() OVER () AS i, x FROM (SELECT unnest([
  'packaging', 'quality', 'price', 'delivery', 'customer_service', 'battery', 'performance',
  'compatibility', 'durability', 'size_fit', 'material', 'design', 'color']) AS x))
SELECT p_partkey, p_type AS domain, (SELECT string_agg(x, ',' ORDER BY x) FROM t WHERE CASE p_type
  WHEN 'SMALL' THEN i <= 9 WHEN 'LARGE' THEN i <= 5 OR i >= 9 ELSE TRUE END) AS candidates
FROM part""")
def candidate_aspects(spark, sf):
    """Two part types stand for the known domains, the others are unknown ones."""
    name = F.when(F.col("p_type") == "SMALL", "eLECTRONICS").when(
        F.col("p_type") == "LARGE", "fashion").otherwise(F.col("p_type"))
    found = F.array_sort(asp.candidate_aspects(name, "union"))
    return views.table(spark, sf, "part").select(
        "p_partkey", F.col("p_type").alias("domain"), F.array_join(found, ",").alias("candidates"))


_VERBAL = " ".join(f"WHEN '{a}' THEN {S.quoted(v)}" for a, v in L.VERBALIZATIONS.items())


@query(_ITEM_TAGS + f"""
SELECT review_key, aspect, CASE aspect {_VERBAL} END AS phrase, aspect AS back,
  {S.display('aspect')} AS shown
FROM (SELECT review_key, unnest(aspects) AS aspect FROM tagged)""")
def aspect_names(spark, sf):
    cells = _tagged_items(spark, sf).select("review_key", F.explode("aspects").alias("aspect"))
    phrase = asp.verbalize(F.col("aspect"))
    return cells.select(
        "review_key", "aspect", phrase.alias("phrase"), asp.unverbalize(phrase).alias("back"),
        asp.display_name(F.col("aspect")).alias("shown"))


def _signals(words) -> str:
    return S.has_word("lower(text)", words)


@query(f"""
SELECT conv_id, turn, CASE WHEN c AND NOT p THEN 'complaints' WHEN p AND NOT c THEN 'praises'
  ELSE 'general' END AS intent
FROM (SELECT conv_id, turn, {_signals(L.COMPLAINT_SIGNALS)} AS c,
        {_signals(L.PRAISE_SIGNALS)} AS p FROM conversations WHERE role = 'user')""")
def question_intents(spark, sf):
    return views.user_questions(spark, sf).select(
        "conv_id", "turn", asp.query_intent(F.col("question")).alias("intent"))


def _word_share_factory():
    """A small scorer over whole batches: the share of a text's words that end like the label says."""
    import pandas as pd

    endings = {"ing": "doing", "ed": "done", "s": "many"}

    def scorer(texts, _domains):
        low = pd.Series(texts, dtype=object).fillna("").str.lower()
        words = low.str.count("[a-z]+").clip(lower=1)
        shares = pd.DataFrame({label: low.str.count(f"{e}(?![a-z])") / words for e, label in endings.items()})
        return shares.to_dict("records")

    return scorer


@query(S.with_(S.DOC, """w AS (
  SELECT row_id, regexp_extract_all(lower(text), '[a-z]+') AS words FROM doc_reviews),
s AS (
  SELECT row_id,
    len(list_filter(words, lambda x: ends_with(x, 'ing'))) / greatest(len(words), 1) AS doing,
    len(list_filter(words, lambda x: ends_with(x, 'ed'))) / greatest(len(words), 1) AS done,
    len(list_filter(words, lambda x: ends_with(x, 's'))) / greatest(len(words), 1) AS many FROM w)""")
       + """
SELECT row_id, CASE WHEN doing >= done AND doing >= many THEN 'doing'
    WHEN done >= many THEN 'done' ELSE 'many' END AS label,
  printf('%.4f', (greatest(doing, done, many))::DOUBLE)::DOUBLE AS confidence FROM s""")
def batch_scores(spark, sf):
    scored = scoring.score_texts(_docs(spark, sf), _word_share_factory)
    label, confidence = scoring.best_label()
    return scored.select("row_id", label.alias("label"), confidence.alias("confidence"))


@query(S.with_(S.DOC) + f"""
SELECT row_id, {S.full_text()} AS body FROM doc_reviews""")
def combined_text(spark, sf):
    return _docs(spark, sf).select(
        "row_id", tx.full_text(F.col("title"), F.col("text")).alias("body"))
