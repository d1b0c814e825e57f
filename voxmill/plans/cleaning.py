"""Queries: scans, text cleanup, the cleaning funnel, streams checked against tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from voxmill import schemas
from voxmill.functions import labels, text as tx
from voxmill.operators import cleaning, sampling
from voxmill.plans import sql as S
from voxmill.plans.registry import query
from voxmill.session import TEXT_FILE_ROWS, new_path, tasks_for
from voxmill.sources import tables, views
from voxmill.streaming import reviews as stream


@query(S.with_(S.DOC) + "SELECT row_id, rating, title, text, parent_asin, domain FROM doc_reviews")
def review_scan(spark, sf):
    return views.doc_reviews(spark, sf).drop("sentiment")


@query(S.with_(S.META) + "SELECT * FROM metadata")
def metadata_scan(spark, sf):
    return views.raw_metadata(spark, sf).withColumns({
        "description": F.array_join("description", " "),
        "categories": F.array_join("categories", "|")})


@query(S.with_(S.DOC) + """
SELECT rating, title, text, parent_asin, 'Electronics' AS domain, NULL::VARCHAR AS user_id
FROM doc_reviews WHERE domain = 'Electronics' ORDER BY row_id LIMIT 500""")
def sample_first_reviews(spark, sf):
    rows = views.doc_reviews(spark, sf).where(labels.in_domain("electronics"))
    fields = ("rating", "title", "text", "parent_asin", "user_id")
    return tables.sample_reviews(rows, "Electronics", 500, fields)


@query(S.with_(S.DOC) + """
SELECT domain, count(*) AS reviews_loaded, 7::INTEGER AS n_columns FROM doc_reviews GROUP BY 1""")
def load_summary(spark, sf):
    return tables.load_summary(views.doc_reviews(spark, sf))


@query(S.with_(S.DOC) + "SELECT row_id, sentiment FROM doc_reviews WHERE domain = 'Fashion'")
def domain_filter(spark, sf):
    return views.doc_reviews(spark, sf).where(labels.in_domain("FASHION")).select(
        "row_id", "sentiment")


@query(S.with_(S.META) + """
SELECT domain, parent_asin, title, average_rating, NULL::VARCHAR AS price,
  description, categories, NULL::VARCHAR AS store FROM metadata""")
def conform_schema(spark, sf):
    partial = views.raw_metadata(spark, sf).drop("price", "store").withColumn(
        "description", F.array_join("description", " "))
    return tables.conform(partial, schemas.PRODUCT).withColumn(
        "categories", F.array_join("categories", "|"))


@query("""
SELECT p_partkey, try_cast(split_part(p_brand, '#', 2) AS DOUBLE) AS brand_number,
  try_cast(p_name AS DOUBLE) AS name_number FROM part""")
def numeric_coercion(spark, sf):
    return views.table(spark, sf, "part").select(
        "p_partkey",
        labels.to_number(F.split("p_brand", "#")[1]).alias("brand_number"),
        labels.to_number(F.col("p_name")).alias("name_number"))


@query(f"""
SELECT page_id AS row_id, cleaned, length(cleaned) AS n_chars, {S.words('cleaned')} AS n_words
FROM (SELECT page_id, {S.clean('html')} AS cleaned FROM pages)""")
def html_cleanup(spark, sf):
    cleaned = views.page_reviews(spark, sf).select(
        "row_id", tx.clean_text(F.col("text"), None).alias("cleaned"))
    return cleaned.withColumns({
        "n_chars": tx.char_count(F.col("cleaned")).cast("long"),
        "n_words": tx.word_count(F.col("cleaned")).cast("long")})


@query(f"""
SELECT doc_id AS row_id, {S.clean('text', 1000)} AS capped,
  length({S.clean('text')}) > 1000 AS was_long FROM documents""")
def length_cap(spark, sf):
    whole = tx.clean_text(F.col("text"), None)
    return views.text_table(spark, sf, "documents").select(
        F.col("doc_id").alias("row_id"), whole.alias("_whole")).select(
        "row_id", tx.cap_length(F.col("_whole"), 1000).alias("capped"),
        (F.length("_whole") > 1000).alias("was_long"))


@query(S.with_(S.DOC) + f"""
SELECT row_id, length(text) AS n_chars, {S.words('text')} AS n_words,
  CASE WHEN NOT regexp_matches(text, '{S.NWS}') THEN 'missing'
       WHEN {S.words(S.clean('text'))} < 3 OR length({S.clean('text')}) < 10 THEN 'short'
       ELSE 'ok' END AS reason FROM doc_reviews""")
def text_checks(spark, sf):
    raw = views.doc_reviews(spark, sf).select("row_id", "text", "rating").withColumns({
        "n_chars": tx.char_count(F.col("text")).cast("long"),
        "n_words": tx.word_count(F.col("text")).cast("long")})
    return cleaning.checked_reviews(raw, max_chars=None).select(
        "row_id", "n_chars", "n_words", F.col("_reason").alias("reason"))


def _kept(cap: int | None) -> str:
    return f"""cleaned AS (
  SELECT row_id, domain, parent_asin, rating, sentiment, NOT regexp_matches(text, '{S.NWS}') AS blank,
    {S.clean('title', cap)} AS title, {S.clean('text', cap)} AS text FROM doc_reviews),
checked AS (
  SELECT *, CASE WHEN blank THEN 'missing'
    WHEN {S.words('text')} < 3 OR length(text) < 10 THEN 'short' ELSE 'ok' END AS reason
  FROM cleaned),
ranked AS (
  SELECT *, CASE WHEN reason = 'ok' THEN
    row_number() OVER (PARTITION BY domain, reason, text ORDER BY row_id) END AS place
  FROM checked)"""


def _funnel(cap: int | None) -> str:
    shares = ", ".join(
        f"""CASE WHEN count(*) FILTER (reason = 'ok' AND place = 1 AND sentiment IS NOT NULL) > 0
        THEN printf('%.4f', (count(*) FILTER (reason = 'ok' AND place = 1 AND sentiment = '{s}')
          / count(*) FILTER (reason = 'ok' AND place = 1 AND sentiment IS NOT NULL) * 100.0)::DOUBLE)::DOUBLE
        ELSE 0.0 END AS {s}_pct""" for s in ("negative", "neutral", "positive"))
    counts = ", ".join(
        f"count(*) FILTER (reason = 'ok' AND place = 1 AND sentiment = '{s}') AS {s}_count"
        for s in ("negative", "neutral", "positive"))
    return S.with_(S.DOC, _kept(cap)) + f"""
SELECT domain, count(*) AS reviews_before,
  count(*) FILTER (reason = 'missing') AS missing_removed,
  count(*) FILTER (reason = 'short') AS short_removed,
  count(*) FILTER (reason = 'ok' AND place > 1) AS duplicates_removed,
  count(*) FILTER (reason = 'ok' AND place = 1 AND sentiment IS NULL) AS unlabeled_removed,
  count(*) FILTER (reason = 'ok' AND place = 1 AND sentiment IS NOT NULL) AS reviews_after,
  {counts}, {shares} FROM ranked GROUP BY domain"""


@query(_funnel(None))
def cleaning_funnel(spark, sf):
    return cleaning.cleaning_funnel(views.doc_reviews(spark, sf))


@query(_funnel(1000))
def capped_funnel(spark, sf):
    """With the length cap, which here decides what counts as a duplicate."""
    return cleaning.cleaning_funnel(views.doc_reviews(spark, sf), max_chars=1000)


@query(_funnel(None))
def cleaning_funnel_whole_text(spark, sf):
    return cleaning.cleaning_funnel(views.doc_reviews(spark, sf), max_chars=None)


@query(S.with_(S.DOC, _kept(None)) + """
SELECT row_id, domain, parent_asin, rating, sentiment, title, text FROM ranked
WHERE reason = 'ok' AND place = 1 AND sentiment IS NOT NULL""")
def clean_reviews(spark, sf):
    return cleaning.clean_reviews(
        views.doc_reviews(spark, sf).drop("sentiment"), max_chars=None)


@query(S.with_(S.DOC, _kept(None)) + """
SELECT domain, position, measure, value FROM (
  SELECT domain, unnest([
    {'position': 1, 'measure': 'Reviews before cleaning', 'value': count(*)},
    {'position': 2, 'measure': 'Reviews after cleaning',
     'value': count(*) FILTER (reason = 'ok' AND place = 1 AND sentiment IS NOT NULL)},
    {'position': 3, 'measure': 'Duplicates removed',
     'value': count(*) FILTER (reason = 'ok' AND place > 1)},
    {'position': 4, 'measure': 'Missing reviews removed',
     'value': count(*) FILTER (reason = 'missing')},
    {'position': 5, 'measure': 'Short reviews removed',
     'value': count(*) FILTER (reason = 'short')},
    {'position': 6, 'measure': 'Positive',
     'value': count(*) FILTER (reason = 'ok' AND place = 1 AND sentiment = 'positive')},
    {'position': 7, 'measure': 'Neutral',
     'value': count(*) FILTER (reason = 'ok' AND place = 1 AND sentiment = 'neutral')},
    {'position': 8, 'measure': 'Negative',
     'value': count(*) FILTER (reason = 'ok' AND place = 1 AND sentiment = 'negative')}
  ], recursive := true) FROM ranked GROUP BY domain)""")
def cleaning_report(spark, sf):
    return cleaning.cleaning_report(
        cleaning.cleaning_funnel(views.doc_reviews(spark, sf), max_chars=None))


@query("""
SELECT doc_id AS row_id, source, lang, text FROM (
  SELECT *, row_number() OVER (PARTITION BY source, text ORDER BY doc_id) AS place FROM documents)
WHERE place = 1""")
def keep_first_by_text_and_source(spark, sf):
    docs = views.table(spark, sf, "documents").select(
        F.col("doc_id").alias("row_id"), "source", "lang", "text")
    keys = [F.col("source"), cleaning.text_key(F.col("text"))]
    return cleaning.keep_first(docs, keys, "row_id")


@query(S.with_(S.DOC) + f"""
SELECT row_id, {S.clean(S.full_text())} AS features_text,
  CASE sentiment WHEN 'negative' THEN 0 WHEN 'neutral' THEN 1 WHEN 'positive' THEN 2 END AS label,
  sentiment FROM doc_reviews""")
def feature_text(spark, sf):
    from voxmill.operators import models

    rows = views.doc_reviews(spark, sf).withColumn(
        "sentiment", F.concat(F.lit(" "), F.upper("sentiment")))
    return models.training_rows(rows, None).select(
        "row_id", "features_text", "label", labels.decode_label(F.col("label")).alias("sentiment"))


@query(S.with_(S.ITEM) + """
SELECT domain,
  count(*) FILTER (sentiment = 'negative') AS n_label,
  count(*) FILTER (sentiment = 'negative' OR predicted_sentiment = 'negative') AS n_predicted,
  count(*) FILTER (sentiment = 'negative' OR predicted_sentiment = 'negative' OR rating <= 2)
    AS n_wide,
  count(*) FILTER (sentiment = 'positive' OR predicted_sentiment = 'positive' OR rating >= 4)
    AS p_wide FROM item_reviews GROUP BY domain""")
def sentiment_predicates(spark, sf):
    return views.item_reviews(spark, sf).groupBy("domain").agg(
        F.count_if(labels.is_negative("label")).alias("n_label"),
        F.count_if(labels.is_negative("predicted")).alias("n_predicted"),
        F.count_if(labels.is_negative("wide")).alias("n_wide"),
        F.count_if(labels.is_positive("wide")).alias("p_wide"))


@query(S.with_(S.DOC) + """
SELECT row_id, domain FROM doc_reviews
WHERE sentiment = 'negative' AND length(text) BETWEEN 35 AND 750""")
def informative_negatives(spark, sf):
    return views.doc_reviews(spark, sf).where(
        labels.is_negative("label") & F.length("text").between(35, 750)).select("row_id", "domain")


@query(S.with_(S.DOC) + """
SELECT row_id, domain, text, CASE WHEN length(text) > 120 THEN left(text, 120) || '...' ELSE text
  END AS snippet FROM doc_reviews""")
def text_snippets(spark, sf):
    return views.doc_reviews(spark, sf).select(
        "row_id", "domain", "text", tx.ellipsize(F.col("text"), 120, 120).alias("snippet"))


@query("""
SELECT event_id, try_cast(json_extract_string(props, '$.k') AS BIGINT) AS k,
  '{"event_type":"' || event_type || '","k":' || json_extract_string(props, '$.k') || '}'
    AS encoded FROM events""")
def json_fields(spark, sf):
    parsed = F.from_json("props", "k bigint")
    return views.table(spark, sf, "events").select(
        "event_id", parsed["k"].alias("k"),
        F.to_json(F.struct("event_type", parsed["k"].alias("k"))).alias("encoded"))


@query(S.with_(S.DOC) + """
SELECT row_id, parent_asin, row_number() OVER (PARTITION BY parent_asin ORDER BY row_id) - 1
  AS review_index FROM doc_reviews""")
def review_positions(spark, sf):
    from voxmill.operators import retrieval

    rows = views.doc_reviews(spark, sf).select("row_id", "parent_asin")
    return retrieval.review_positions(rows)


@query(S.with_(S.DOC) + """
SELECT md5(row_id::VARCHAR) AS row_id, parent_asin,
  row_number() OVER (PARTITION BY parent_asin ORDER BY md5(row_id::VARCHAR)) - 1 AS review_index
FROM doc_reviews""")
def digest_positions(spark, sf):
    """Positions along ids that are digests, as loaders give them."""
    from voxmill.operators import retrieval

    rows = views.doc_reviews(spark, sf).select(
        F.md5(F.col("row_id").cast("string")).alias("row_id"), "parent_asin")
    return retrieval.review_positions(rows)


# --- streams -------------------------------------------------------------------------------

_EVENTS = "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string"
_DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def _document_stream(spark, sf):
    return stream.read_stream(spark, f"{sf}/documents.parquet", _DOCUMENTS)


def _stream_reviews(spark, sf):
    return views.doc_ratings(_document_stream(spark, sf), views.table(spark, sf, "labels"))


@query(S.with_(S.DOC, _kept(None)) + """
SELECT row_id, domain, parent_asin, rating, sentiment, title, text FROM ranked
WHERE reason = 'ok' AND sentiment IS NOT NULL""")
def stream_clean_ingest(spark, sf):
    """The document file as a stream, joined with the label table, cleaned, appended to parquet."""
    path = new_path(spark, "ingest")
    cleaned = stream.clean_stream(_stream_reviews(spark, sf), max_chars=None)
    stream.ingest(cleaned, path, new_path(spark, "ingest-state")).awaitTermination()
    return spark.read.parquet(path)


@query("SELECT DISTINCT source, text FROM documents")
def stream_unique_texts(spark, sf):
    path = new_path(spark, "unique")
    unique = stream.unique_stream(_document_stream(spark, sf), ["source", "text"])
    stream.ingest(unique.select("source", "text"), path,
                  new_path(spark, "unique-state")).awaitTermination()
    return spark.read.parquet(path)


@query("""
SELECT doc_id, source, text FROM (
  SELECT *, row_number() OVER (PARTITION BY source, text ORDER BY doc_id DESC) AS n FROM documents) WHERE n = 1""")
def stream_first_rows(spark, sf):
    """The first row per source and text, where the last ids come first: each batch brings earlier rows."""
    path, files = new_path(spark, "first"), new_path(spark, "shuffled")
    # Three batches of several files, the larger orders in the first ones.
    docs = views.table(spark, sf, "documents").select((-F.col("doc_id")).alias("row_id"), "source", "text")
    each = tasks_for(docs.count(), 3 * TEXT_FILE_ROWS)
    docs.repartitionByRange(3 * each, F.desc("row_id")).write.parquet(files)
    stream.arbitrary_state(spark)
    arriving = stream.read_stream(spark, files, "row_id long, source string, text string", files_per_trigger=each)
    stream.ingest_changes(stream.first_rows_stream(arriving, ["source", "text"]), path,
                          new_path(spark, "first-state")).awaitTermination()
    return stream.read_first_rows(spark, path).select((-F.col("row_id")).alias("doc_id"), "source", "text")


@query("SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def stream_running_counts(spark, sf):
    path = new_path(spark, "counts")
    events = stream.read_stream(spark, f"{sf}/events.parquet", _EVENTS)
    stream.keep_latest(stream.running_counts(events, ["event_type"]), path,
                       new_path(spark, "counts-state")).awaitTermination()
    return stream.read_latest(spark, path)


@query("SELECT DISTINCT user_id, event_type FROM events")
def stream_unique_within_delay(spark, sf):
    """Bounded state: a key is forgotten once it is older than the delay."""
    path = new_path(spark, "recent")
    events = stream.read_stream(spark, f"{sf}/events.parquet", _EVENTS)
    unique = stream.unique_stream(
        events, ["user_id", "event_type"], event_time="ts", delay="60 days")
    stream.ingest(unique.select("user_id", "event_type"), path,
                  new_path(spark, "recent-state")).awaitTermination()
    return spark.read.parquet(path)


@query(S.with_(S.DOC) + """
SELECT domain, sentiment, split, count(*) AS n FROM (
  SELECT *, CASE WHEN place < n_train THEN 'train' WHEN place < n_train + n_val THEN 'validation'
    ELSE 'test' END AS split FROM (
    SELECT d.domain, d.sentiment, row_number() OVER (
        PARTITION BY d.domain, d.sentiment ORDER BY md5('42:' || row_id), row_id) - 1 AS place,
      s.n_train, s.n_val FROM doc_reviews d JOIN (
      SELECT domain, sentiment, n_train, f2 + CASE WHEN p2 <= l2 THEN 1 ELSE 0 END AS n_val FROM (
        SELECT *, floor(rest * v_total / rest_total) AS f2,
          v_total - sum(floor(rest * v_total / rest_total)) OVER (PARTITION BY domain) AS l2,
          row_number() OVER (PARTITION BY domain ORDER BY round(rest * v_total / rest_total
            - floor(rest * v_total / rest_total), 9) DESC, sentiment) AS p2 FROM (
          SELECT *, rest_total - ceil(round(rest_total * 0.5, 6)) AS v_total FROM (
            SELECT *, n - n_train AS rest, sum(n - n_train) OVER (PARTITION BY domain) AS rest_total
            FROM (
              SELECT *, f1 + CASE WHEN p1 <= l1 THEN 1 ELSE 0 END AS n_train FROM (
                SELECT *, floor(n * t_total / total) AS f1,
                  t_total - sum(floor(n * t_total / total)) OVER (PARTITION BY domain) AS l1,
                  row_number() OVER (PARTITION BY domain ORDER BY round(n * t_total / total
                    - floor(n * t_total / total), 9) DESC, sentiment) AS p1 FROM (
                  SELECT *, total - ceil(round(total * 0.3, 6)) AS t_total FROM (
                    SELECT domain, sentiment, count(*) AS n,
                      sum(count(*)) OVER (PARTITION BY domain) AS total
                    FROM doc_reviews GROUP BY 1, 2)))))))) s
    ON d.domain = s.domain AND d.sentiment = s.sentiment))
GROUP BY 1, 2, 3""")
def stratified_split_sizes(spark, sf):
    split = sampling.stratified_split(views.doc_reviews(spark, sf), ["domain"])
    return split.groupBy("domain", "sentiment", "split").agg(F.count("*").alias("n"))


@query(S.with_(S.DOC) + """
SELECT row_id, domain FROM (SELECT *, row_number() OVER (
  PARTITION BY domain ORDER BY md5('42:' || row_id), row_id) AS place FROM doc_reviews)
WHERE place <= 150""")
def seeded_sample(spark, sf):
    return sampling.sample_per_group(
        views.doc_reviews(spark, sf), ["domain"], 150).select("row_id", "domain")
