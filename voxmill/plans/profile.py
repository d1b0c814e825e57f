"""Queries: descriptive analytics within and across domains."""

from __future__ import annotations

from pyspark.sql import functions as F

from voxmill.operators import products, profile
from voxmill.plans import sql as S
from voxmill.plans.registry import query
from voxmill.session import FILE_ROWS, new_path, tasks_for
from voxmill.sources import sketches, views

_DOCS = S.with_(S.DOC, f"""lens AS (
  SELECT *, length(text)::BIGINT AS char_count, {S.words('text')} AS word_count FROM doc_reviews)""")
_ITEMS = S.with_(S.ITEM)


def _lens(spark, sf):
    return profile.with_lengths(views.doc_reviews(spark, sf))


def _items(spark, sf):
    return views.item_reviews(spark, sf)


def _counts_sql(column: str) -> str:
    return _ITEMS + f"""
SELECT domain, {column}, count(*) AS n,
  round(count(*) / sum(count(*)) OVER (PARTITION BY domain) * 100, 6) AS pct
FROM item_reviews GROUP BY domain, {column}"""


@query(_counts_sql("rating"))
def rating_distribution(spark, sf):
    return profile.value_counts(_items(spark, sf), "rating", ["domain"])


@query(_counts_sql("verified_purchase"))
def verified_distribution(spark, sf):
    return profile.value_counts(_items(spark, sf), "verified_purchase", ["domain"])


@query(S.with_(S.DOC) + """
SELECT sentiment, count(*) AS n, round(count(*) / sum(count(*)) OVER () * 100, 6) AS pct,
  list_position(['positive', 'neutral', 'negative'], sentiment)::BIGINT AS position
FROM doc_reviews GROUP BY 1""")
def sentiment_distribution(spark, sf):
    counts = profile.value_counts(views.doc_reviews(spark, sf), "sentiment")
    return counts.withColumn("position", profile.label_position(F.col("sentiment")))


def _moments_sql(source: str, value: str, group: str = "") -> str:
    head = f"{group}, " if group else ""
    tail = f"GROUP BY {group}" if group else ""
    return f"""
SELECT {head}count({value}) AS n, round(avg({value}), 6) AS mean,
  round(stddev_samp({value}), 6) AS std, round(skewness({value}), 6) AS skew,
  median({value})::DOUBLE AS median FROM {source} {tail}"""


@query(_ITEMS + _moments_sql("item_reviews", "rating", "domain"))
def rating_moments(spark, sf):
    return profile.moments(_items(spark, sf), "rating", ["domain"])


@query(S.with_(S.DOC) + _moments_sql("doc_reviews", "rating"))
def rating_moments_overall(spark, sf):
    return profile.moments(views.doc_reviews(spark, sf), "rating")


def _describe_sql(source: str, value: str, points) -> str:
    at = ", ".join(f"round(quantile_cont({value}, {p}), 6)::DOUBLE AS p{int(round(p * 100))}"
                   for p in points)
    return f"""
SELECT count({value}) AS count, round(avg({value}), 6) AS mean,
  round(stddev_samp({value}), 6) AS std, min({value}) AS min, max({value}) AS max, {at}
FROM {source}"""


_LENGTH_POINTS = (0.25, 0.5, 0.75, 0.9, 0.95, 0.99)
_VOTE_POINTS = (0.5, 0.75, 0.9, 0.95, 0.99)


@query(_DOCS + _describe_sql("(SELECT word_count::BIGINT AS word_count FROM lens)", "word_count",
                             _LENGTH_POINTS))
def describe_word_counts(spark, sf):
    rows = _lens(spark, sf).withColumn("word_count", F.col("word_count").cast("long"))
    return profile.describe(rows, "word_count", _LENGTH_POINTS)


@query(_ITEMS + _describe_sql("item_reviews", "helpful_vote", _VOTE_POINTS))
def describe_votes(spark, sf):
    return profile.describe(_items(spark, sf), "helpful_vote", _VOTE_POINTS)


def _length_sql(group: str, q75: bool) -> str:
    columns = ", ".join(
        f"round(avg({m}_count), 6) AS {m}_mean, median({m}_count)::DOUBLE AS {m}_median, "
        f"round(stddev_samp({m}_count), 6) AS {m}_std"
        + (f", quantile_cont({m}_count, 0.75)::DOUBLE AS {m}_q75" if q75 else "")
        for m in ("char", "word"))
    return _DOCS + f"SELECT {group}, {columns} FROM lens GROUP BY {group}"


@query(_length_sql("sentiment", False))
def length_by_sentiment(spark, sf):
    return profile.length_by(views.doc_reviews(spark, sf), "sentiment")


@query(_length_sql("domain", True))
def length_by_domain(spark, sf):
    return profile.length_by(views.doc_reviews(spark, sf), "domain", with_q75=True)


@query(_ITEMS + f"""
SELECT verified_purchase, round(avg(rating), 6) AS mean_rating,
  median(rating)::DOUBLE AS median_rating, round(stddev_samp(rating), 6) AS std_rating,
  round(avg(CASE WHEN sentiment = 'positive' THEN 100.0 ELSE 0.0 END), 6) AS pct_positive,
  round(avg(CASE WHEN sentiment = 'negative' THEN 100.0 ELSE 0.0 END), 6) AS pct_negative,
  round(avg({S.words('text')}), 6) AS avg_words FROM item_reviews GROUP BY 1""")
def by_verification(spark, sf):
    return profile.by_verification(_items(spark, sf))


@query(_ITEMS + """
SELECT domain, round(avg(helpful_vote), 6) AS mean_votes,
  median(helpful_vote)::DOUBLE AS median_votes, max(helpful_vote) AS max_votes,
  round(avg(CASE WHEN helpful_vote = 0 THEN 100.0 ELSE 0.0 END), 6) AS zero_pct,
  round(avg(CASE WHEN helpful_vote >= 1 THEN 100.0 ELSE 0.0 END), 6) AS at_least_1_pct,
  round(avg(CASE WHEN helpful_vote >= 5 THEN 100.0 ELSE 0.0 END), 6) AS at_least_5_pct
FROM item_reviews GROUP BY 1""")
def votes_by_domain(spark, sf):
    return profile.votes_by_domain(_items(spark, sf))


def _crosstab_sql(rows: str, columns: str, within: str) -> str:
    return _ITEMS + f"""
SELECT {rows}, {columns}, count(*) AS n,
  round(count(*) / sum(count(*)) OVER (PARTITION BY {within}) * 100, 6) AS pct
FROM item_reviews GROUP BY {rows}, {columns}"""


@query(_crosstab_sql("rating", "domain", "domain"))
def rating_by_domain(spark, sf):
    return profile.crosstab(_items(spark, sf), "rating", "domain", "columns")


@query(_crosstab_sql("sentiment", "domain", "domain"))
def sentiment_by_domain(spark, sf):
    return profile.crosstab(_items(spark, sf), "sentiment", "domain", "columns")


@query(_crosstab_sql("verified_purchase", "sentiment", "verified_purchase"))
def sentiment_by_verification(spark, sf):
    return profile.crosstab(_items(spark, sf), "verified_purchase", "sentiment", "rows")


@query(_crosstab_sql("rating", "verified_purchase", "verified_purchase"))
def rating_by_verification(spark, sf):
    return profile.crosstab(_items(spark, sf), "rating", "verified_purchase", "columns")


@query(_ITEMS + """
SELECT domain,
  round(count(*) FILTER (NOT verified_purchase) / count(*) * 100, 6) AS pct_false,
  round(count(*) FILTER (verified_purchase) / count(*) * 100, 6) AS pct_true
FROM item_reviews GROUP BY 1""")
def verified_rate_by_domain(spark, sf):
    return profile.crosstab_wide(
        _items(spark, sf), "domain", "verified_purchase", [False, True], "rows").select(
        "domain", "pct_false", "pct_true")


@query(_ITEMS + """
SELECT rating::INTEGER AS stars,
  round(count(*) FILTER (predicted_sentiment = 'negative') / count(*) * 100, 6) AS pct_negative,
  round(count(*) FILTER (predicted_sentiment = 'neutral') / count(*) * 100, 6) AS pct_neutral,
  round(count(*) FILTER (predicted_sentiment = 'positive') / count(*) * 100, 6) AS pct_positive
FROM item_reviews GROUP BY 1""")
def stars_by_prediction(spark, sf):
    rows = _items(spark, sf).withColumn("stars", F.col("rating").cast("int"))
    return profile.crosstab_wide(
        rows, "stars", "predicted_sentiment", ["negative", "neutral", "positive"], "rows")


@query(_ITEMS + """
SELECT rating,
  round(count(*) FILTER (domain = 'Electronics') / sum(count(*) FILTER (domain = 'Electronics'))
    OVER () * 100, 6) AS "pct_Electronics",
  round(count(*) FILTER (domain = 'Fashion') / sum(count(*) FILTER (domain = 'Fashion'))
    OVER () * 100, 6) AS "pct_Fashion"
FROM item_reviews GROUP BY 1""")
def rating_shares_wide(spark, sf):
    return profile.crosstab_wide(
        _items(spark, sf), "rating", "domain", ["Electronics", "Fashion"], "columns")


@query(_ITEMS + """
SELECT domain, verified_purchase, count(*) AS n_reviews, round(avg(rating), 6) AS mean_rating,
  median(rating)::DOUBLE AS median_rating FROM item_reviews GROUP BY 1, 2""")
def rating_by_domain_and_verification(spark, sf):
    return profile.rating_by_two(_items(spark, sf), "domain", "verified_purchase")


@query(_ITEMS + """
SELECT domain, round(avg(rating) FILTER (NOT verified_purchase), 6) AS non_verified,
  round(avg(rating) FILTER (verified_purchase), 6) AS verified FROM item_reviews GROUP BY 1""")
def mean_rating_by_verification_wide(spark, sf):
    return profile.rating_by_two_wide(_items(spark, sf), "domain", "verified_purchase")


def _tier_case(value: str, bins) -> str:
    bounds, names = bins
    cases = " ".join(f"WHEN {value} <= {b} THEN '{n}'" for b, n in zip(bounds, names))
    return f"CASE {cases} ELSE '{names[-1]}' END"


def _tiers_sql(source: str, value: str, bins, group: str | None, mean: str | None = None) -> str:
    names = ", ".join(f"('{n}')" for n in bins[1])
    measured = f", round(avg({mean}), 6) AS mean_{mean}" if mean else ""
    kept = f", mean_{mean}" if mean else ""
    g, using = (f"{group}, ", f"{group}, tier") if group else ("", "tier")
    over = f"PARTITION BY {group}" if group else ""
    frame = f"(SELECT DISTINCT {group} FROM {source})," if group else ""
    return f"""
SELECT {g}tier, coalesce(n, 0) AS n{kept},
  round(coalesce(n, 0) / sum(coalesce(n, 0)) OVER ({over}) * 100, 6) AS pct
FROM (SELECT * FROM {frame} (VALUES {names}) v(tier))
LEFT JOIN (SELECT {g}{_tier_case(value, bins)} AS tier, count(*) AS n{measured}
           FROM {source} GROUP BY ALL) USING ({using})"""


_SIZES = S.with_(S.ITEM, """sizes AS (
  SELECT domain, parent_asin, count(*) AS n_reviews FROM item_reviews GROUP BY 1, 2)""")


@query(_SIZES + _tiers_sql("sizes", "n_reviews", profile.REVIEW_TIERS, None))
def review_tiers(spark, sf):
    return profile.tiers(
        products.reviews_per_product(_items(spark, sf)), "n_reviews", profile.REVIEW_TIERS)


@query(_SIZES + _tiers_sql("sizes", "n_reviews", profile.CROSS_DOMAIN_REVIEW_TIERS, "domain"))
def review_tiers_by_domain(spark, sf):
    return profile.tiers(
        products.reviews_per_product(_items(spark, sf)), "n_reviews",
        profile.CROSS_DOMAIN_REVIEW_TIERS, ["domain"])


@query(S.with_(S.ITEM, f"""counted AS (
  SELECT *, {S.words('text')} AS word_count FROM item_reviews)""")
       + _tiers_sql("counted", "helpful_vote", profile.VOTE_TIERS, None, "word_count"))
def vote_tiers(spark, sf):
    return profile.tiers(
        profile.with_lengths(_items(spark, sf)), "helpful_vote", profile.VOTE_TIERS,
        mean_of="word_count")


@query(_ITEMS + _tiers_sql("item_reviews", "helpful_vote", profile.CROSS_DOMAIN_VOTE_TIERS,
                           "domain"))
def vote_tiers_by_domain(spark, sf):
    return profile.tiers(
        _items(spark, sf), "helpful_vote", profile.CROSS_DOMAIN_VOTE_TIERS, ["domain"])


@query("""
SELECT unnest(['doc_id', 'lang', 'quality', 'toxic']) AS column_name,
  unnest([count(*) FILTER (doc_id IS NULL), count(*) FILTER (lang IS NULL),
          count(*) FILTER (quality IS NULL), count(*) FILTER (toxic IS NULL)]) AS missing,
  unnest(['bigint', 'string', 'int', 'int']) AS data_type,
  unnest([round(count(*) FILTER (doc_id IS NULL) / count(*) * 100, 3),
          round(count(*) FILTER (lang IS NULL) / count(*) * 100, 3),
          round(count(*) FILTER (quality IS NULL) / count(*) * 100, 3),
          round(count(*) FILTER (toxic IS NULL) / count(*) * 100, 3)]) AS missing_pct
FROM documents LEFT JOIN labels USING (doc_id)""")
def missing_audit(spark, sf):
    joined = views.table(spark, sf, "documents").join(
        views.table(spark, sf, "labels"), "doc_id", "left")
    return profile.missing_audit(joined, ["doc_id", "lang", "quality", "toxic"])


_TRIMMED = S.with_(S.DOC, f"""lens AS (
  SELECT *, ({S.words('text')})::BIGINT AS word_count FROM doc_reviews),
trimmed AS (SELECT * FROM lens WHERE word_count <= (SELECT quantile_cont(word_count, 0.99)
                                                    FROM lens))""")


def _trimmed(spark, sf):
    rows = _lens(spark, sf).withColumn("word_count", F.col("word_count").cast("long"))
    return profile.trim_at_percentile(rows, "word_count")


@query(_TRIMMED + """
SELECT least(floor((word_count - lo) / (hi - lo) * 40), 39)::INTEGER AS bin, count(*) AS n
FROM trimmed, (SELECT min(word_count)::DOUBLE AS lo, max(word_count)::DOUBLE AS hi FROM trimmed)
GROUP BY 1""")
def word_count_histogram(spark, sf):
    return profile.histogram(_trimmed(spark, sf), "word_count", 40)


@query(_SIZES + """
SELECT least(coalesce(floor((x - lo) / nullif(hi - lo, 0) * 30), 0), 29)::INTEGER AS bin,
  count(*) AS n
FROM (SELECT log10(n_reviews) AS x FROM sizes),
  (SELECT min(log10(n_reviews)) AS lo, max(log10(n_reviews)) AS hi FROM sizes) GROUP BY 1""")
def reviews_per_product_log_histogram(spark, sf):
    sizes = products.reviews_per_product(_items(spark, sf))
    return profile.histogram(sizes, "n_reviews", 30, log=True)


@query(_TRIMMED + """,
q AS (SELECT domain, sentiment, quantile_cont(word_count, 0.25)::DOUBLE AS q1,
        median(word_count)::DOUBLE AS median, quantile_cont(word_count, 0.75)::DOUBLE AS q3,
        round(avg(word_count), 6) AS mean FROM trimmed GROUP BY 1, 2)
SELECT domain, sentiment, q1, q.median, q3, mean,
  min(word_count) FILTER (word_count BETWEEN q1 - (q3 - q1) * 1.5 AND q3 + (q3 - q1) * 1.5)
    AS whisker_low,
  max(word_count) FILTER (word_count BETWEEN q1 - (q3 - q1) * 1.5 AND q3 + (q3 - q1) * 1.5)
    AS whisker_high
FROM trimmed JOIN q USING (domain, sentiment) GROUP BY ALL""")
def word_count_boxes(spark, sf):
    return profile.box_statistics(_trimmed(spark, sf), ["domain", "sentiment"], "word_count")


@query(_ITEMS + """
SELECT DISTINCT domain, rating,
  round(cume_dist() OVER (PARTITION BY domain ORDER BY rating), 6) AS cdf FROM item_reviews""")
def rating_cdf(spark, sf):
    return profile.cumulative_distribution(_items(spark, sf), "domain", "rating")


@query("""
SELECT DISTINCT l_returnflag AS flag, l_extendedprice AS price,
  round(cume_dist() OVER (PARTITION BY l_returnflag ORDER BY l_extendedprice), 6) AS cdf FROM lineitem""")
def price_cdf(spark, sf):
    """A continuous value: nearly every row has its own."""
    lines = views.table(spark, sf, "lineitem").select(
        F.col("l_returnflag").alias("flag"), F.col("l_extendedprice").alias("price"))
    return profile.cumulative_distribution(lines, "flag", "price")


@query("""
SELECT l_returnflag AS flag, point, count(*) AS n, true AS rank_within_bound, true AS distinct_within_bound
FROM lineitem, (SELECT unnest([10, 50, 90]) AS point) GROUP BY 1, 2""")
def sketched_quantiles(spark, sf):
    """Sketches of each file, merged; each estimate's true rank and the true number of keys decide."""
    points, path, files = (0.1, 0.5, 0.9), new_path(spark, "sketches"), new_path(spark, "files")
    lines = views.table(spark, sf, "lineitem").select("l_returnflag", "l_extendedprice", "l_partkey")
    parts = max(4, tasks_for(lines.count(), FILE_ROWS))
    lines.repartition(parts).write.parquet(files)
    stored = spark.read.parquet(files)
    sketches.sketch_new_files(stored, path, ["l_returnflag"], "l_extendedprice", "l_partkey")
    found = sketches.sketched_numbers(spark, path, ["l_returnflag"], points).select(
        F.col("l_returnflag").alias("flag"), "n", "distinct_keys",
        F.inline(F.zip_with(F.array(F.lit(10), F.lit(50), F.lit(90)), "quantiles", lambda p, q: F.struct(
            p.alias("point"), q.alias("estimate")))))
    # One row for each group and point.
    met = stored.join(F.broadcast(found), F.col("l_returnflag") == F.col("flag")).groupBy("flag", "point", "n").agg(
        F.avg((F.col("l_extendedprice") < F.col("estimate")).cast("double")).alias("_below"),
        F.avg((F.col("l_extendedprice") <= F.col("estimate")).cast("double")).alias("_upto"),
        F.first("distinct_keys").alias("_found"))
    # The different keys are found once, not for each point, each task holding its part of them.
    keys = stored.select(F.col("l_returnflag").alias("flag"), "l_partkey").repartition(
        parts, "flag", "l_partkey").distinct().groupBy("flag").agg(F.count("l_partkey").alias("_keys"))
    return met.join(F.broadcast(keys), "flag").select(
        "flag", "point", "n",
        ((F.col("_below") * 100 <= F.col("point") + 1) & (F.col("_upto") * 100 >= F.col("point") - 1)).alias("rank_within_bound"),
        (F.abs(F.col("_found") - F.col("_keys")) <= 0.05 * F.col("_keys")).alias("distinct_within_bound"))


@query(_DOCS + """
SELECT round(e, 6) AS mean_first, round(f, 6) AS mean_second, round(e - f, 6) AS difference,
  round((e - f) / f * 100, 6) AS pct
FROM (SELECT avg(word_count) FILTER (domain = 'Electronics') AS e,
        avg(word_count) FILTER (domain = 'Fashion') AS f FROM lens)""")
def verbosity_difference(spark, sf):
    return profile.mean_difference(
        _lens(spark, sf), "word_count", "domain", "Electronics", "Fashion")


@query(_DOCS + """
SELECT sentiment, round(quantile_cont(word_count, 0.1), 6)::DOUBLE AS low,
  round(quantile_cont(word_count, 0.9), 6)::DOUBLE AS high FROM lens GROUP BY 1""")
def word_count_quantiles(spark, sf):
    return profile.quantiles(
        _lens(spark, sf), ["sentiment"], "word_count", {"low": 0.1, "high": 0.9})
