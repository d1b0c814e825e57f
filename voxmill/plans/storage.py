"""Queries that write a table to the work folder and read it back, and the stored-table jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from voxmill import jobs, schemas
from voxmill.config import DOMAINS
from voxmill.functions import aspects as asp
from voxmill.operators import evaluation
from voxmill.plans import sql as S
from voxmill.plans.cleaning import _kept
from voxmill.plans.evaluation import _CLASSES, _TABLE, _counts
from voxmill.plans.insights import _INSIGHTS
from voxmill.plans.registry import query
from voxmill.session import FILE_ROWS, new_path
from voxmill.sources import lines, tables, views
from voxmill.streaming import reviews as stream


@query(S.with_(S.DOC) + f"""
SELECT 'DOC-' || row_id AS review_id, domain, text,
  array_to_string({S.annotated('text', 'domain')}, '; ') AS aspect_labels FROM doc_reviews""")
def annotations_as_csv(spark, sf):
    labelled = views.doc_reviews(spark, sf).select(
        F.concat(F.lit("DOC-"), "row_id").alias("review_id"), "domain", "text",
        asp.annotate_aspects(F.col("text"), F.col("domain")).alias("aspect_labels"))
    return tables.read_annotations(
        spark, tables.write_annotations(labelled, new_path(spark, "annotations")))


@query("SELECT doc_id, text, lang, source, n_chars FROM documents")
def reviews_as_json_lines(spark, sf):
    docs = views.table(spark, sf, "documents")
    path = tables.write_table(docs, new_path(spark, "reviews") + ".jsonl")
    return tables.read_table(spark, path, docs.schema)


@query(S.with_(S.ITEM) + "SELECT review_key, rating, domain FROM item_reviews WHERE domain = 'Fashion'")
def domain_partitions(spark, sf):
    """One write partitioned by domain; the filter then reads one folder."""
    reviews = views.item_reviews(spark, sf).select("review_key", "rating", "domain")
    path = tables.save_by_domain(reviews, new_path(spark, "by-domain"))
    return tables.load_sentiment_data(spark, path, "fashion")


@query(_CLASSES + f"""
SELECT '{{"model":"' || model || '","domain":"' || domain || '","accuracy":' || accuracy::VARCHAR
  || ',"f1":' || f1::VARCHAR || '}}' AS value FROM ({_TABLE})""")
def metrics_as_json(spark, sf):
    table = evaluation.comparison_table(_counts(spark, sf)).select(
        "model", "domain", "accuracy", "f1")
    path = tables.write_table(tables.json_rows(table), new_path(spark, "metrics"))
    return tables.read_table(spark, path)


_LINES = "doc_id long, lang string, source string, n_chars long"


def _lines(spark, sf):
    path = new_path(spark, "lines")
    views.table(spark, sf, "documents").select("doc_id", "lang", "source", "n_chars").repartition(3).write.json(path)
    lines.register(spark)
    return path


@query("SELECT doc_id, lang, source, n_chars FROM documents WHERE lang = 'en' AND n_chars >= 500")
def filtered_lines(spark, sf):
    """JSON lines by byte ranges; the filters are tested as the lines are read."""
    rows = spark.read.format(lines.FORMAT).schema(_LINES).option("splitBytes", 4096).load(_lines(spark, sf))
    return rows.where("lang = 'en' and n_chars >= 500")


@query("SELECT doc_id, lang, source, n_chars FROM documents")
def streamed_lines(spark, sf):
    path = new_path(spark, "streamed")
    arriving = spark.readStream.format(lines.FORMAT).schema(_LINES).option("splitBytes", 16384).load(_lines(spark, sf))
    stream.ingest(arriving, path, new_path(spark, "streamed-state")).awaitTermination()
    return spark.read.parquet(path)


_FINAL = S.with_(S.DOC, _kept(None), """final AS (
  SELECT * FROM ranked WHERE reason = 'ok' AND place = 1 AND sentiment IS NOT NULL),
sizes AS (SELECT domain, parent_asin, count(*) AS n FROM final GROUP BY 1, 2),
kept AS (SELECT domain, parent_asin FROM sizes WHERE n >= 20)""")


def _built(spark, sf):
    return jobs.build_review_tables(
        views.doc_reviews(spark, sf).drop("sentiment"), views.source_metadata(spark, sf),
        new_path(spark, "tables"), max_chars=None)


@query(_FINAL + """
SELECT row_id, domain, parent_asin, NULL::VARCHAR AS asin, rating, sentiment, title, text,
  NULL::BIGINT AS "timestamp", NULL::BIGINT AS helpful_vote, NULL::BOOLEAN AS verified_purchase
FROM final JOIN kept USING (domain, parent_asin)""")
def stored_reviews(spark, sf):
    """The whole way from raw reviews and metadata to the stored review table."""
    return tables.read_table(spark, _built(spark, sf)["reviews"])


@query(_FINAL + """
SELECT domain, k.parent_asin, 'Source ' || k.parent_asin AS title,
  4.0::DOUBLE AS average_rating, 'None' AS price, d.lang || ' ' || d.source AS description,
  d.lang AS categories, 'A store' AS store
FROM kept k JOIN (
  SELECT source, CASE WHEN lang = 'en' THEN 'Electronics' ELSE 'Fashion' END AS domain,
    arg_min(lang, doc_id) AS lang FROM documents GROUP BY 1, 2) d USING (domain)
WHERE d.source = k.parent_asin""")
def stored_products(spark, sf):
    return tables.read_table(spark, _built(spark, sf)["products"]).withColumn(
        "categories", F.array_join("categories", "|"))


@query(_FINAL + """
SELECT domain, sum(n)::BIGINT AS reviews_before_product_filtering, count(*) AS unique_products,
  count(*) FILTER (n >= 20) AS products_with_min_reviews,
  coalesce(sum(n) FILTER (n >= 20), 0)::BIGINT AS reviews_remaining,
  coalesce(round(avg(n) FILTER (n >= 20), 6), 0.0) AS avg_reviews_per_product,
  coalesce((median(n) FILTER (n >= 20))::DOUBLE, 0.0) AS median_reviews_per_product,
  20::BIGINT AS min_reviews_threshold
FROM sizes GROUP BY domain""")
def stored_product_report(spark, sf):
    return tables.read_table(spark, _built(spark, sf)["product_report"])


_RAW = _INSIGHTS.replace("item_reviews AS (", "all_items AS (", 1).replace("bodies AS (", """
item_reviews AS (
  SELECT * REPLACE (sentiment AS predicted_sentiment) FROM (
    SELECT DISTINCT ON (review_key) * FROM all_items)
  WHERE (domain, parent_asin) IN (
    SELECT (domain, parent_asin) FROM all_items GROUP BY domain, parent_asin
    HAVING count(DISTINCT review_key) >= 20)),
bodies AS (""", 1)


@query(_RAW + "SELECT * FROM insights")
def raw_to_insights(spark, sf):
    """From raw JSON lines as files hold them, without row ids, to the stored insights table. The files
    are compressed; as one task reads each, they have FILE_ROWS lines at most."""
    base = new_path(spark, "raw")
    fields = [c for c in schemas.RAW_REVIEW.names if c not in ("row_id", "domain")]
    reviews = views.item_reviews(spark, sf).withColumns({
        "text": F.concat_ws(" ", "text", "review_key"), "timestamp": F.unix_timestamp("timestamp"),
        "user_id": F.lit(None).cast("string")})
    padded = F.concat(F.lit(" "), "parent_asin", F.lit("  "))
    meta = views.raw_metadata(spark, sf).drop("row_id").withColumn("parent_asin", padded)
    for domain in DOMAINS:
        reviews.where(F.col("domain") == domain).select(*fields).write.option("maxRecordsPerFile", FILE_ROWS).json(
            f"{base}/{tables.source_folder(domain)}", compression="gzip")
        meta.where(F.col("domain") == domain).drop("domain").write.option("maxRecordsPerFile", FILE_ROWS).json(
            f"{base}/{tables.source_folder(domain, 'metadata')}", compression="gzip")
    paths = jobs.build_review_tables(
        tables.union_domains([tables.load_reviews(spark, base, d) for d in DOMAINS]),
        tables.union_domains([tables.load_metadata(spark, base, d) for d in DOMAINS]), f"{base}/tables")
    reviews, products = (tables.read_table(spark, paths[n]) for n in ("reviews", "products"))
    return jobs.build_insights(spark, reviews, products, f"{base}/insights").drop("top_complaint_aspects")


@query("SELECT doc_id AS row_id, source, 'neutral' AS predicted_sentiment FROM documents")
def scored_or_plain(spark, sf):
    """No scored table is there, so the plain one serves, its label for the prediction."""
    plain = views.table(spark, sf, "documents").select(
        F.col("doc_id").alias("row_id"), "source", F.lit("neutral").alias("sentiment"))
    path = tables.write_table(plain, new_path(spark, "plain"))
    return tables.load_scored_reviews(spark, new_path(spark, "scored"), path).select(
        "row_id", "source", "predicted_sentiment")


@query("SELECT lang, count(*) AS n, count(*) AS verified FROM documents GROUP BY lang")
def verified_tables(spark, sf):
    """A table is read back with its columns checked before its rows are counted."""
    docs = views.table(spark, sf, "documents").withColumn("domain", F.col("lang"))
    path = tables.save_by_domain(docs, new_path(spark, "verified"))
    verified = tables.verify_table(spark, path, ("doc_id", "text", "domain"))
    stored = tables.read_table(spark, path).groupBy("lang").agg(F.count("*").alias("n"))
    total = stored.agg(F.sum("n")).first()[0]
    return stored.withColumn("verified", F.when(F.lit(verified == total), F.col("n")))


@query()
def stored_insights(spark, sf):
    """Insights built from the stored tables and read back."""
    paths = _built(spark, sf)
    reviews, products = (tables.read_table(spark, paths[n]) for n in ("reviews", "products"))
    return jobs.load_insights(spark, new_path(spark, "insights"), reviews, products)
