"""Queries: metadata cleaning, key validation, joins, review-count filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from voxmill.operators import products
from voxmill.plans import sql as S
from voxmill.plans.registry import query
from voxmill.session import new_path
from voxmill.sources import keyprofile, tables, views

# Metadata with repeated and missing keys: each part listed again under its size group's key.
_DIRTY = f"""dirty AS (
  SELECT *, row_id AS rid FROM metadata
  UNION ALL BY NAME
  SELECT * REPLACE (CASE WHEN row_id % 7 = 0 THEN '  ' WHEN row_id % 7 = 1 THEN NULL
      ELSE ' ' || parent_asin || ' ' END AS parent_asin,
      'other ' || title AS title), row_id + 1000000000 AS rid FROM metadata)"""


def _dirty_metadata(spark, sf, source=views.raw_metadata):
    meta = source(spark, sf)
    again = meta.withColumns({
        "parent_asin": F.when(F.col("row_id") % 7 == 0, "  ").when(
            F.col("row_id") % 7 == 1, F.lit(None)).otherwise(
            F.concat(F.lit(" "), "parent_asin", F.lit(" "))),
        "title": F.concat(F.lit("other "), "title"),
        "row_id": F.col("row_id") + 1000000000})
    return tables.union_domains([meta, again])


@query(S.with_(S.META, _DIRTY) + f"""
SELECT domain, trim(parent_asin) AS parent_asin, title, average_rating, price, description,
  categories, store
FROM (SELECT *, row_number() OVER (PARTITION BY domain, trim(parent_asin) ORDER BY rid) AS place
      FROM dirty WHERE parent_asin IS NOT NULL AND trim(parent_asin) <> '') WHERE place = 1""")
def clean_metadata(spark, sf):
    return products.clean_metadata(_dirty_metadata(spark, sf)).drop("row_id").withColumn(
        "categories", F.array_join("categories", "|"))


@query(S.with_(S.META, _DIRTY) + """
SELECT domain, count(*) AS raw_metadata_count,
  count(*) FILTER (coalesce(trim(parent_asin), '') = '') AS missing_parent_asin,
  count(*) FILTER (coalesce(trim(parent_asin), '') <> '')
    - count(DISTINCT trim(parent_asin)) FILTER (coalesce(trim(parent_asin), '') <> '')
    AS duplicate_parent_asin,
  count(DISTINCT trim(parent_asin)) FILTER (coalesce(trim(parent_asin), '') <> '')
    AS clean_metadata_count
FROM dirty GROUP BY domain""")
def metadata_quality(spark, sf):
    return products.metadata_quality(_dirty_metadata(spark, sf))


@query("""
SELECT p_partkey AS row_id, '$' || p_retailprice::VARCHAR AS price,
  p_retailprice AS price_num, CASE WHEN p_brand = 'Brand#1' THEN 'None' ELSE p_brand END AS store_price
FROM part""")
def price_fields(spark, sf):
    raw = F.concat(F.lit(" $"), F.col("p_retailprice").cast("string"), F.lit(" "))
    odd = F.when(F.col("p_brand") == "Brand#1", " NaN ").otherwise(F.col("p_brand"))
    return views.table(spark, sf, "part").select(
        F.col("p_partkey").alias("row_id"), products.price_text(raw).alias("price"),
        products.price_number(products.price_text(raw)).alias("price_num"),
        products.price_text(odd).alias("store_price"))


@query(S.with_(S.ITEM, S.META) + """
SELECT r.review_key, r.parent_asin, r.rating, r.domain, m.title AS product_title, m.price,
  m.average_rating, m.store
FROM item_reviews r JOIN metadata m USING (parent_asin)""")
def reviews_with_products(spark, sf):
    joined = products.join_reviews_with_products(
        views.item_reviews(spark, sf).select("review_key", "parent_asin", "rating", "domain"),
        views.raw_metadata(spark, sf), identity=["review_key"])
    return joined.select("review_key", "parent_asin", "rating", "domain", "product_title",
                         "price", "average_rating", "store")

_REVIEW_KEYS = {"domain": "domain", "parent_asin": "parent_asin"}
_REVIEW_KEYS_SCHEMA = "domain string, parent_asin string"


def _profiled(spark, sf):
    """Reviews stored with the profile of their keys."""
    path = keyprofile.write_with_key_profile(
        views.item_reviews(spark, sf).select("review_key", "parent_asin", "rating", "domain"),
        new_path(spark, "profiled") + ".parquet", _REVIEW_KEYS, items=50_000)
    return path, tables.read_table(spark, path)


@query(S.with_(S.ITEM, S.META) + """
SELECT r.review_key, r.parent_asin, r.rating, r.domain, m.title AS product_title, m.price,
  m.average_rating, m.store
FROM item_reviews r JOIN metadata m USING (parent_asin)""")
def profiled_reviews_with_products(spark, sf):
    """The hot products come from the sketch taken as the reviews were stored."""
    path, reviews = _profiled(spark, sf)
    hot = keyprofile.hot_from_profile(spark, path, _REVIEW_KEYS_SCHEMA, 35)
    joined = products.join_reviews_with_products(
        reviews, views.raw_metadata(spark, sf), identity=["review_key"], hot=hot, rows_per_task=35)
    return joined.select("review_key", "parent_asin", "rating", "domain", "product_title",
                         "price", "average_rating", "store")


@query(S.with_(S.ITEM) + """
SELECT domain, parent_asin, count(*) AS n FROM item_reviews GROUP BY 1, 2 HAVING count(*) >= 40""")
def frequent_products(spark, sf):
    path, reviews = _profiled(spark, sf)
    return keyprofile.frequent_keys(reviews, path, _REVIEW_KEYS, _REVIEW_KEYS_SCHEMA, 40)


@query(S.with_(S.ITEM, S.META) + """
SELECT domain, count(*) AS reviews, count(*) AS joined FROM item_reviews GROUP BY 1""")
def join_keeps_row_count(spark, sf):
    """Metadata that lists products twice, under padded keys, does not multiply reviews."""
    reviews = views.item_reviews(spark, sf).select("review_key", "parent_asin", "domain")
    joined = products.join_reviews_with_products(
        reviews, _dirty_metadata(spark, sf), identity=["review_key"])
    counts = joined.groupBy("domain").agg(F.count("*").alias("joined"))
    return reviews.groupBy("domain").agg(F.count("*").alias("reviews")).join(counts, "domain")


@query(S.with_(S.ITEM, S.GAPS) + """
SELECT review_key, parent_asin FROM item_reviews
WHERE parent_asin NOT IN (SELECT parent_asin FROM metadata)""")
def unmatched_reviews(spark, sf):
    return products.unmatched_reviews(
        views.item_reviews(spark, sf).select("review_key", "domain", "parent_asin"),
        views.catalog_with_gaps(spark, sf)).select("review_key", "parent_asin")


@query(S.with_(S.ITEM, S.GAPS) + """
SELECT DISTINCT parent_asin FROM item_reviews
EXCEPT SELECT parent_asin FROM metadata""")
def unmatched_products(spark, sf):
    return products.unmatched_products(
        views.item_reviews(spark, sf), views.catalog_with_gaps(spark, sf)).select("parent_asin")


@query(S.with_(S.ITEM, S.GAPS, _DIRTY) + """,
r AS (SELECT domain, parent_asin AS k, count(*) AS n FROM item_reviews GROUP BY 1, 2),
m AS (SELECT domain, nullif(trim(coalesce(parent_asin, '')), '') AS k, count(*) AS n
      FROM dirty GROUP BY 1, 2)
SELECT d.domain,
  (SELECT sum(n) FROM r WHERE r.domain = d.domain)::BIGINT AS reviews_count_before_join,
  (SELECT sum(n) FROM m WHERE m.domain = d.domain)::BIGINT AS metadata_count_before_join,
  0::BIGINT AS missing_parent_asin_in_reviews,
  (SELECT sum(n) FROM m WHERE m.domain = d.domain AND k IS NULL)::BIGINT
    AS missing_parent_asin_in_metadata,
  (SELECT sum(n - 1) FROM m WHERE m.domain = d.domain AND k IS NOT NULL)::BIGINT
    AS duplicate_metadata_parent_asin,
  (SELECT coalesce(sum(n), 0) FROM r WHERE r.domain = d.domain AND NOT EXISTS (
     SELECT 1 FROM m WHERE m.domain = r.domain AND m.k = r.k))::BIGINT AS unmatched_reviews_count,
  (SELECT count(*) FROM r WHERE r.domain = d.domain AND NOT EXISTS (
     SELECT 1 FROM m WHERE m.domain = r.domain AND m.k = r.k)) AS unmatched_unique_products,
  (SELECT coalesce(sum(n), 0) FROM r WHERE r.domain = d.domain AND EXISTS (
     SELECT 1 FROM m WHERE m.domain = r.domain AND m.k = r.k))::BIGINT AS joined_reviews_count
FROM (SELECT DISTINCT domain FROM item_reviews) d""")
def join_validation(spark, sf):
    return products.join_validation(views.item_reviews(spark, sf), _dirty_metadata(spark, sf, views.catalog_with_gaps))


_SIZES = """sizes AS (
  SELECT domain, parent_asin, count(*) AS n FROM item_reviews GROUP BY 1, 2)"""


@query(S.with_(S.ITEM, _SIZES) + "SELECT domain, parent_asin, n AS n_reviews FROM sizes WHERE n >= 20")
def products_with_min_reviews(spark, sf):
    return products.products_with_min_reviews(views.item_reviews(spark, sf))


@query(S.with_(S.ITEM, S.META, _SIZES) + """
SELECT review_key, parent_asin FROM item_reviews
WHERE parent_asin IN (SELECT parent_asin FROM sizes WHERE n >= 20)""")
def reviews_of_kept_products(spark, sf):
    return products.reviews_with_min(views.item_reviews(spark, sf).select(
        "review_key", "domain", "parent_asin")).select("review_key", "parent_asin")


@query(S.with_(S.ITEM, S.META, _SIZES) + """
SELECT parent_asin, title, store FROM metadata
WHERE parent_asin IN (SELECT parent_asin FROM sizes WHERE n >= 20)""")
def metadata_of_kept_products(spark, sf):
    return products.metadata_with_min(
        views.item_reviews(spark, sf).select("domain", "parent_asin"),
        views.raw_metadata(spark, sf)).select("parent_asin", "title", "store")


@query(S.with_(S.ITEM, _SIZES) + """
SELECT domain, sum(n)::BIGINT AS total_reviews, count(*) AS unique_products,
  round(avg(n), 6) AS mean_reviews, median(n)::DOUBLE AS median_reviews, max(n) AS max_reviews,
  count(*) FILTER (n >= 5) AS products_ge_5, count(*) FILTER (n >= 20) AS products_ge_20,
  round(count(*) FILTER (n >= 20) / count(*) * 100, 3) AS pct_ge_20
FROM sizes GROUP BY domain""")
def catalog_density(spark, sf):
    return products.catalog_density(views.item_reviews(spark, sf))


@query(S.with_(S.ITEM, _SIZES) + """
SELECT domain, sum(n)::BIGINT AS reviews_before_product_filtering, count(*) AS unique_products,
  count(*) FILTER (n >= 20) AS products_with_min_reviews,
  coalesce(sum(n) FILTER (n >= 20), 0)::BIGINT AS reviews_remaining,
  round(avg(n) FILTER (n >= 20), 6) AS avg_reviews_per_product,
  (median(n) FILTER (n >= 20))::DOUBLE AS median_reviews_per_product,
  20::BIGINT AS min_reviews_threshold
FROM sizes GROUP BY domain""")
def product_report(spark, sf):
    return products.product_report(views.item_reviews(spark, sf))


@query(S.with_(S.ITEM, S.META, _DIRTY) + """
SELECT parent_asin, title, row_id FROM (
  SELECT parent_asin, title, rid AS row_id,
    row_number() OVER (PARTITION BY parent_asin ORDER BY rid) AS place
  FROM dirty WHERE parent_asin IN (SELECT parent_asin FROM item_reviews))
WHERE place = 1 ORDER BY row_id LIMIT 1000""")
def sample_metadata(spark, sf):
    return products.sample_metadata(
        _dirty_metadata(spark, sf), views.item_reviews(spark, sf), 1000).select(
        "parent_asin", "title", "row_id")


@query(S.with_(S.ITEM, S.META) + """
SELECT t.parent_asin, t.review_count, t.avg_rating, t.pct_positive,
  left(coalesce(m.title, t.parent_asin), 45) || '...' AS title, m.store
FROM (SELECT parent_asin, count(*) AS review_count, round(avg(rating), 6) AS avg_rating,
        round(avg(CASE WHEN sentiment = 'positive' THEN 100.0 ELSE 0.0 END), 6) AS pct_positive
      FROM item_reviews GROUP BY 1 ORDER BY review_count DESC, parent_asin LIMIT 10) t
LEFT JOIN metadata m USING (parent_asin)""")
def top_products(spark, sf):
    return products.top_products(views.item_reviews(spark, sf), views.raw_metadata(spark, sf))


@query(S.with_(S.DOC) + """
SELECT row_id, parent_asin, domain FROM doc_reviews
UNION ALL SELECT l_orderkey * 8 + l_linenumber, 'P' || l_partkey, NULL FROM lineitem""")
def union_by_name(spark, sf):
    docs = views.doc_reviews(spark, sf).select("row_id", "parent_asin", "domain")
    items = views.table(spark, sf, "lineitem").select(
        F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("parent_asin"),
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("row_id"))
    return tables.union_domains([docs, items])


@query(S.with_(S.ITEM) + """
SELECT domain, count(DISTINCT parent_asin) AS n_products, count(DISTINCT title) AS n_titles
FROM item_reviews GROUP BY 1""")
def distinct_keys(spark, sf):
    return views.item_reviews(spark, sf).groupBy("domain").agg(
        F.count_distinct("parent_asin").alias("n_products"),
        F.count_distinct("title").alias("n_titles"))
