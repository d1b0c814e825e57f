"""The product insights table and the lookups on it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voxmill.functions import aspects as asp, labels, numbers, text as tx
from voxmill.functions.lexicons import ASPECTS
from voxmill.operators.products import unique_products
from voxmill.schemas import COMPLAINT_ASPECTS

# Texts of the insights table and of a product's printed summary.
NO_COMPLAINTS = "No severe complaint clusters detected."
NO_PATTERNS = "No significant complaint patterns detected."


def with_predictions(reviews: DataFrame) -> DataFrame:
    """The predicted label, or the rating label where no model has scored the review."""
    if "predicted_sentiment" not in reviews.columns:
        return reviews.withColumn("predicted_sentiment", F.col("sentiment"))
    return reviews.withColumn(
        "predicted_sentiment", F.coalesce("predicted_sentiment", "sentiment"))


def enrich_reviews(reviews: DataFrame, only_negative: bool = True) -> DataFrame:
    """Full text and aspects; with ``only_negative`` other reviews keep an empty list and their
    text is never scanned."""
    out = with_predictions(reviews).withColumn(
        "full_text", tx.full_text(F.col("title"), F.col("text")))
    tagged = asp.tag_aspects(F.col("full_text"), F.col("domain"))
    if only_negative:
        tagged = F.when(labels.is_negative("predicted"), tagged).otherwise(
            F.array().cast("array<string>"))
    return out.withColumn("aspects", tagged)


def _sentiment_counts(prefix: str, column: str) -> list[Column]:
    return [
        F.count_if(F.col(column) == name).alias(f"{prefix}{name}")
        for name in ("positive", "neutral", "negative")]


def product_sums(enriched: DataFrame, order: str = "row_id") -> DataFrame:
    """Counts, rating sums and aspect counts per (product, domain), and the first ``_order``. The aspect
    list is fixed, so each aspect is one conditional count."""
    negative = labels.is_negative("label")
    return enriched.groupBy("parent_asin", "domain").agg(
        F.count("*").alias("total"),
        F.sum("rating").alias("rating_sum"), F.count("rating").alias("rating_n"),
        *_sentiment_counts("n_", "sentiment"),
        *_sentiment_counts("p_", "predicted_sentiment"),
        *[F.count_if(negative & F.array_contains("aspects", a)).alias(f"a_{a}") for a in ASPECTS],
        F.min(order).alias("_order"),
    )


def merged_sums(sums: DataFrame) -> DataFrame:
    """Sums of several sets of reviews as those of all of them."""
    added = [c for c in sums.columns if c not in ("parent_asin", "domain", "_order")]
    return sums.groupBy("parent_asin", "domain").agg(
        *[F.sum(c).alias(c) for c in added], F.min("_order").alias("_order"))


def totals_from_sums(sums: DataFrame) -> DataFrame:
    """One row per product; the earliest row's domain names it."""
    added = [c for c in sums.columns if c not in ("parent_asin", "domain", "_order")]
    return sums.groupBy("parent_asin").agg(
        F.min_by("domain", "_order").alias("domain"), *[F.sum(c).alias(c) for c in added])


def product_totals(enriched: DataFrame, order: str = "row_id") -> DataFrame:
    """Counts, rating sums and aspect counts per product: one pass, one shuffle of sums."""
    return totals_from_sums(product_sums(enriched, order))


def top_aspects(negatives: Column) -> Column:
    """Ranked (aspect, display_name, count, percentage) list from the aspect counts."""
    entries = F.array(*[
        F.struct((-F.col(f"a_{a}")).alias("_minus"), F.lit(a).alias("aspect")) for a in ASPECTS])
    ranked = F.array_sort(F.filter(entries, lambda e: e["_minus"] < 0))
    return F.transform(ranked, lambda e: F.struct(
        e["aspect"].alias("aspect"),
        asp.display_name(e["aspect"]).alias("display_name"),
        (-e["_minus"]).alias("count"),
        numbers.percent(-e["_minus"], negatives).alias("percentage"))).cast(COMPLAINT_ASPECTS)


def complaints_summary(ranked: Column, top: int = 4) -> Column:
    parts = F.transform(F.slice(ranked, 1, top), lambda e: F.concat(
        e["display_name"], F.lit(" ("), e["percentage"].cast("string"), F.lit("%)")))
    return F.when(F.size(ranked) > 0, F.array_join(parts, "; ")).otherwise(NO_COMPLAINTS)


def product_insights(reviews: DataFrame, products: DataFrame, order: str = "row_id") -> DataFrame:
    """One row per product: volumes, shares, ratings, metadata and ranked complaints."""
    return insights_from_enriched(enrich_reviews(reviews), products, order)


def insights_from_enriched(
    enriched: DataFrame, products: DataFrame, order: str = "row_id",
) -> DataFrame:
    """As :func:`product_insights`, from reviews that already carry predictions and aspects."""
    return insights_from_totals(product_totals(enriched, order), products)


def insights_from_totals(totals: DataFrame, products: DataFrame) -> DataFrame:
    meta = unique_products(products).select(
        "parent_asin", F.col("title").alias("_title"), "price",
        F.col("average_rating").alias("meta_average_rating"))
    total = F.col("total")
    ranked = F.col("top_complaint_aspects")
    out = totals.join(meta, "parent_asin", "left").withColumn(
        "top_complaint_aspects", top_aspects(F.col("n_negative")))
    return out.select(
        "parent_asin", "domain",
        F.coalesce("_title", F.concat(F.lit("Product "), F.col("parent_asin"))).alias("title"),
        "price",
        numbers.rounded(F.col("rating_sum") / F.col("rating_n"), 2).alias("average_rating"),
        "meta_average_rating",
        total.alias("total_reviews"),
        *[F.col(f"n_{s}").alias(f"{s}_reviews") for s in ("positive", "neutral", "negative")],
        *[numbers.percent(F.col(f"n_{s}"), total).alias(f"{s}_percentage")
          for s in ("positive", "neutral", "negative")],
        *[numbers.percent(F.col(f"p_{s}"), total).alias(f"pred_{s}_percentage")
          for s in ("positive", "neutral", "negative")],
        complaints_summary(ranked).alias("top_complaints_summary"),
        F.to_json(ranked).alias("top_complaint_aspects_json"),
        "top_complaint_aspects")


def sorted_insights(insights: DataFrame) -> DataFrame:
    return insights.orderBy("domain", F.desc("total_reviews"), "parent_asin")


def product_info(reviews: DataFrame, products: DataFrame, order: str = "row_id") -> DataFrame:
    """Catalog entries of all products, largest first."""
    sums = reviews.groupBy("parent_asin", "domain").agg(
        F.count("*").alias("total"), F.sum("rating").alias("rating_sum"),
        F.count("rating").alias("rating_n"), *_sentiment_counts("n_", "sentiment"),
        F.min(order).alias("_order"))
    added = [c for c in sums.columns if c not in ("parent_asin", "domain", "_order")]
    totals = sums.groupBy("parent_asin").agg(
        F.min_by("domain", "_order").alias("domain"), *[F.sum(c).alias(c) for c in added])
    titles = unique_products(products).select("parent_asin", F.col("title").alias("_title"))
    total = F.col("total")
    return totals.join(titles, "parent_asin", "left").select(
        "parent_asin", "domain",
        F.coalesce("_title", F.concat(F.lit("Product "), F.col("parent_asin"))).alias("title"),
        total.alias("total_reviews"),
        numbers.rounded(F.col("rating_sum") / F.col("rating_n"), 2).alias("average_rating"),
        *[F.col(f"n_{s}").alias(f"{s}_count") for s in ("positive", "neutral", "negative")],
        *[numbers.percent(F.col(f"n_{s}"), total).alias(f"{s}_percentage")
          for s in ("positive", "neutral", "negative")])


def catalog(info: DataFrame) -> DataFrame:
    """The printed catalog: shortened titles, formatted shares, by volume."""
    pct = [F.concat(F.col(f"{s}_percentage").cast("string"), F.lit("%")).alias(f"{s}_share")
           for s in ("positive", "neutral", "negative")]
    return info.orderBy(F.desc("total_reviews"), "parent_asin").select(
        "parent_asin", "domain", tx.ellipsize(F.col("title"), 50, 50).alias("product_title"),
        "total_reviews",
        F.concat(F.col("average_rating").cast("string"), F.lit(" ★")).alias("avg_rating"), *pct)


def quadrants(insights: DataFrame) -> DataFrame:
    """Each product against the catalog's mean rating and mean negative share."""
    means = insights.select(F.struct(
        F.avg("average_rating").alias("rating"), F.avg("negative_percentage").alias("negative"),
    )).scalar()
    good = F.col("average_rating") >= F.col("mean_rating")
    calm = F.col("negative_percentage") <= F.col("mean_negative_pct")
    return insights.select(
        "parent_asin", "average_rating", "negative_percentage", "total_reviews",
        F.round(means["rating"], 6).alias("mean_rating"),
        F.round(means["negative"], 6).alias("mean_negative_pct")).withColumn(
        "quadrant",
        F.when(good & calm, "High Satisfaction").when(~good & ~calm, "High Friction")
        .when(good, "Well Rated, Many Complaints").otherwise("Low Rated, Few Complaints"))


def find_products(insights: DataFrame, wanted: list[str]) -> DataFrame:
    """The product each wanted string means: an exact id first, ignoring case, else the first
    product in table order whose title contains it. Ids are found by an equi-join; only strings that
    are no id are looked for in titles, and a product is copied for those alone that it contains."""
    spark = insights.sparkSession
    asked = spark.createDataFrame([(w, w.strip().upper()) for w in dict.fromkeys(wanted)], "wanted string, _key string")
    # The wanted strings are the caller's own list.
    exact = insights.withColumn("_key", F.upper("parent_asin")).join(F.broadcast(asked), "_key").drop("_key")
    known = {r["wanted"] for r in exact.select("wanted").distinct().collect()}
    rest = [w for w in dict.fromkeys(wanted) if w not in known]
    hits = exact
    if rest:
        parts = F.array_compact(F.array(*[
            F.when(F.contains(F.lower("title"), F.lit(w.lower())), F.lit(w)) for w in rest]))
        hits = exact.unionByName(insights.withColumn("wanted", F.explode(parts)))
    window = Window.partitionBy("wanted").orderBy("domain", F.desc("total_reviews"), "parent_asin")
    return hits.withColumn("_n", F.row_number().over(window)).where("_n = 1").drop("_n")


class ProductNotFound(ValueError):
    pass


def _found(insights: DataFrame, product: str) -> DataFrame:
    hit = find_products(insights, [product])
    if not hit.take(1):
        raise ProductNotFound(f"Product '{product}' not found in product insights table.")
    return hit


SENTIMENT_COLUMNS = (
    "parent_asin", "domain", "title", "total_reviews", "positive_reviews", "neutral_reviews",
    "negative_reviews", "positive_percentage", "neutral_percentage", "negative_percentage",
    "average_rating",
)


def product_sentiment(insights: DataFrame, product: str) -> DataFrame:
    return _found(insights, product).select(*SENTIMENT_COLUMNS)


def product_aspects(insights: DataFrame, product: str) -> DataFrame:
    stored = F.from_json("top_complaint_aspects_json", COMPLAINT_ASPECTS)
    return _found(insights, product).select(F.inline(stored))


def whole_percent(value: Column) -> Column:
    return F.bround(value, 0).cast("int").cast("string")


def summary_text() -> Column:
    """The printed summary of a product, from the columns of the insights table."""
    ranked = F.from_json("top_complaint_aspects_json", COMPLAINT_ASPECTS)
    top = F.slice(ranked, 1, 5)
    lines = F.zip_with(
        top, F.sequence(F.lit(1), F.greatest(F.size(top), F.lit(1))),
        lambda e, i: F.concat(
            i.cast("string"), F.lit(". "), e["display_name"], F.lit(" — "),
            whole_percent(e["percentage"]), F.lit("%")))
    complaints = F.when(F.size(ranked) > 0, F.array_join(lines, "\n")).otherwise(
        NO_PATTERNS)
    share = {s: F.concat(F.lit(f"{s.capitalize()}: "), whole_percent(F.col(f"{s}_percentage")),
                         F.lit("%")) for s in ("positive", "neutral", "negative")}
    return F.concat_ws(
        "\n",
        F.concat(F.lit("Product: "), tx.ellipsize(F.col("title"), 80, 77)),
        F.concat(
            F.lit("Domain: "), F.col("domain"), F.lit(" | ASIN: "), F.col("parent_asin"),
            F.lit(" | Rating: "), numbers.rounded(F.col("average_rating"), 1).cast("string"), F.lit(" / 5.0")),
        F.lit(""),
        F.concat(F.lit("Total Reviews: "), F.col("total_reviews").cast("string")),
        F.lit(""),
        share["positive"], share["neutral"], share["negative"],
        F.lit(""),
        F.lit("Top complaints:"),
        complaints)


def product_summaries(insights: DataFrame) -> DataFrame:
    return insights.select("parent_asin", summary_text().alias("summary"))


def product_summary(insights: DataFrame, product: str) -> str:
    """One product's summary, or the message for an unknown one."""
    row = find_products(insights, [product]).select(summary_text().alias("summary")).first()
    return row["summary"] if row else f"Error: Product '{product}' was not found."
