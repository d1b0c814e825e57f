"""Queries: the product insights table, catalog, benchmark quadrants, lookups."""

from __future__ import annotations

from pyspark.sql import functions as F

from voxmill.operators import insights, titles
from voxmill.plans import sql as S
from voxmill.plans.complaints import _ITEM_TAGS
from voxmill.plans.registry import query
from voxmill.session import FILE_ROWS, cut, new_path, tasks_for
from voxmill.sources import views
from voxmill.streaming import reviews as stream


def _insights(spark, sf):
    return insights.product_insights(
        views.item_reviews(spark, sf, for_text=True), views.raw_metadata(spark, sf))


def _pct(condition: str, whole: str = "count(*)") -> str:
    return f"printf('%.1f', (count(*) FILTER ({condition}) / {whole} * 100.0)::DOUBLE)::DOUBLE"


_INSIGHTS = _ITEM_TAGS.rstrip() + f""",
{S.META},
neg AS (
  SELECT parent_asin, aspect, count(*) AS n FROM (
    SELECT parent_asin, unnest(aspects) AS aspect FROM tagged WHERE sentiment = 'negative')
  GROUP BY 1, 2),
totals AS (
  SELECT parent_asin, any_value(domain) AS domain, printf('%.2f', (avg(rating))::DOUBLE)::DOUBLE AS average_rating,
    count(*) AS total_reviews,
    {', '.join(f"count(*) FILTER (sentiment = '{s}') AS {s}_reviews, {_pct(f"sentiment = '{s}'")} AS {s}_percentage, {_pct(f"predicted_sentiment = '{s}'")} AS pred_{s}_percentage" for s in ('positive', 'neutral', 'negative'))}
  FROM item_reviews GROUP BY 1),
ranked AS (
  SELECT parent_asin, list({{'aspect': aspect, 'display_name': {S.display('aspect')}, 'count': n,
      'percentage': printf('%.1f', (n / negative_reviews * 100.0)::DOUBLE)::DOUBLE}} ORDER BY n DESC, aspect) AS top
  FROM neg JOIN totals USING (parent_asin) GROUP BY 1),
insights AS (
  SELECT t.parent_asin, t.domain, coalesce(m.title, 'Product ' || t.parent_asin) AS title, m.price,
    t.average_rating, m.average_rating AS meta_average_rating, t.total_reviews,
    t.positive_reviews, t.neutral_reviews, t.negative_reviews,
    t.positive_percentage, t.neutral_percentage, t.negative_percentage,
    t.pred_positive_percentage, t.pred_neutral_percentage, t.pred_negative_percentage,
    CASE WHEN len(r.top) > 0 THEN array_to_string(list_transform(r.top[1:4], lambda e:
      e.display_name || ' (' || e.percentage::VARCHAR || '%)'), '; ')
      ELSE 'No severe complaint clusters detected.' END AS top_complaints_summary,
    coalesce(to_json(r.top)::VARCHAR, '[]') AS top_complaint_aspects_json
  FROM totals t LEFT JOIN metadata m USING (parent_asin) LEFT JOIN ranked r USING (parent_asin))
"""


@query(_INSIGHTS + "SELECT * FROM insights")
def product_insights(spark, sf):
    return insights.sorted_insights(_insights(spark, sf).drop("top_complaint_aspects"))


@query(_INSIGHTS + """
SELECT parent_asin, domain, title, total_reviews, average_rating,
  positive_reviews AS positive_count, neutral_reviews AS neutral_count,
  negative_reviews AS negative_count, positive_percentage, neutral_percentage,
  negative_percentage FROM insights""")
def product_info(spark, sf):
    return insights.product_info(
        views.item_reviews(spark, sf), views.raw_metadata(spark, sf)).orderBy(
        F.desc("total_reviews"), "parent_asin")


@query(_INSIGHTS + """
SELECT parent_asin, domain, title AS product_title, total_reviews,
  average_rating::VARCHAR || ' ★' AS avg_rating,
  positive_percentage::VARCHAR || '%' AS positive_share,
  neutral_percentage::VARCHAR || '%' AS neutral_share,
  negative_percentage::VARCHAR || '%' AS negative_share FROM insights""")
def catalog(spark, sf):
    return insights.catalog(insights.product_info(
        views.item_reviews(spark, sf), views.raw_metadata(spark, sf)))


@query(_INSIGHTS + """
SELECT parent_asin, average_rating, negative_percentage, total_reviews,
  round(r, 6) AS mean_rating, round(n, 6) AS mean_negative_pct,
  CASE WHEN average_rating >= round(r, 6) AND negative_percentage <= round(n, 6)
         THEN 'High Satisfaction'
       WHEN average_rating < round(r, 6) AND negative_percentage > round(n, 6)
         THEN 'High Friction'
       WHEN average_rating >= round(r, 6) THEN 'Well Rated, Many Complaints'
       ELSE 'Low Rated, Few Complaints' END AS quadrant
FROM insights, (SELECT avg(average_rating) AS r, avg(negative_percentage) AS n FROM insights)""")
def benchmark_quadrants(spark, sf):
    return insights.quadrants(_insights(spark, sf))


@query(_INSIGHTS + "SELECT * FROM insights")
def stream_product_insights(spark, sf):
    """Insights from the sums of batches, put together now and then."""
    path, files = new_path(spark, "sums"), new_path(spark, "arriving")
    reviews = views.item_reviews(spark, sf)
    # Five batches, each of as many files as its rows need.
    each = tasks_for(views.table(spark, sf, "lineitem").count(), 5 * FILE_ROWS)
    reviews.repartition(5 * each, F.xxhash64("review_key")).write.parquet(files)
    arriving = stream.read_stream(spark, files, reviews.schema, files_per_trigger=each)
    stream.ingest_sums(
        arriving, path, new_path(spark, "sums-state"),
        lambda batch: insights.product_sums(insights.enrich_reviews(batch)), insights.merged_sums,
        compact_every=2).awaitTermination()
    totals = insights.totals_from_sums(stream.read_sums(spark, path))
    return insights.insights_from_totals(totals, views.raw_metadata(spark, sf)).drop("top_complaint_aspects")


_WANTED = ["p17", "P42", "red widget", "BOLT", "nothing like this", "small"]


@query(_INSIGHTS + f"""
SELECT wanted, parent_asin, title, total_reviews FROM (
  SELECT w.wanted, i.*, row_number() OVER (PARTITION BY w.wanted ORDER BY
      CASE WHEN upper(i.parent_asin) = upper(trim(w.wanted)) THEN 0 ELSE 1 END,
      i.domain, i.total_reviews DESC, i.parent_asin) AS place
  FROM insights i JOIN (SELECT unnest({_WANTED}) AS wanted) w
    ON upper(i.parent_asin) = upper(trim(w.wanted)) OR contains(lower(i.title), lower(w.wanted)))
WHERE place = 1""")
def find_products(spark, sf):
    return insights.find_products(_insights(spark, sf), _WANTED).select(
        "wanted", "parent_asin", "title", "total_reviews")


@query(_INSIGHTS + """,
asked AS (SELECT DISTINCT unnest([p_name, ' p' || p_partkey || ' ', substr(p_name, 3, 5), left(p_brand, 2),
    p_type || '?']) AS wanted FROM part)
SELECT wanted, parent_asin, title, total_reviews FROM (
  SELECT w.wanted, i.*, row_number() OVER (PARTITION BY w.wanted ORDER BY
      CASE WHEN upper(i.parent_asin) = upper(trim(w.wanted)) THEN 0 ELSE 1 END,
      i.domain, i.total_reviews DESC, i.parent_asin) AS place
  FROM insights i JOIN asked w
    ON upper(i.parent_asin) = upper(trim(w.wanted)) OR contains(lower(i.title), lower(w.wanted)))
WHERE place = 1""")
def looked_up_products(spark, sf):
    """Thousands of strings at once, ids and parts of titles, through a stored index of title grams."""
    table = cut(_insights(spark, sf))
    index = titles.write_title_index(table, new_path(spark, "titles"))
    asked = views.table(spark, sf, "part").select(F.explode(F.array(
        "p_name", F.concat(F.lit(" p"), F.col("p_partkey"), F.lit(" ")), F.substring("p_name", 3, 5),
        F.substring("p_brand", 1, 2), F.concat("p_type", F.lit("?")))).alias("wanted"))
    return titles.lookup_products(table, asked, index).select("wanted", "parent_asin", "title", "total_reviews")


@query(_INSIGHTS + """
SELECT parent_asin, e.aspect, e.display_name, e.count, e.percentage FROM (
  SELECT parent_asin, unnest(top) AS e FROM ranked)""")
def stored_product_aspects(spark, sf):
    """The complaint lists read back from their JSON column."""
    from voxmill.schemas import COMPLAINT_ASPECTS

    stored = F.from_json("top_complaint_aspects_json", COMPLAINT_ASPECTS)
    return _insights(spark, sf).select("parent_asin", F.inline(stored))


@query(_INSIGHTS + """
SELECT parent_asin, 'Product: ' || CASE WHEN length(title) > 80 THEN left(title, 77) || '...'
    ELSE title END
  || chr(10) || 'Domain: ' || domain || ' | ASIN: ' || parent_asin || ' | Rating: '
  || printf('%.1f', (average_rating)::DOUBLE)::DOUBLE::VARCHAR || ' / 5.0' || chr(10) || chr(10)
  || 'Total Reviews: ' || total_reviews || chr(10) || chr(10)
  || 'Positive: ' || printf('%.0f', (positive_percentage)::DOUBLE)::DOUBLE::INTEGER || '%' || chr(10)
  || 'Neutral: ' || printf('%.0f', (neutral_percentage)::DOUBLE)::DOUBLE::INTEGER || '%' || chr(10)
  || 'Negative: ' || printf('%.0f', (negative_percentage)::DOUBLE)::DOUBLE::INTEGER || '%' || chr(10) || chr(10)
  || 'Top complaints:' || chr(10)
  || CASE WHEN top IS NOT NULL THEN array_to_string(list_transform(top[1:5], lambda e, i:
       i || '. ' || e.display_name || ' — ' || printf('%.0f', (e.percentage)::DOUBLE)::DOUBLE::INTEGER || '%'),
       chr(10)) ELSE 'No significant complaint patterns detected.' END AS summary
FROM insights LEFT JOIN ranked USING (parent_asin)""")
def product_summaries(spark, sf):
    return insights.product_summaries(_insights(spark, sf))


