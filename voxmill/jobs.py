"""The stored-table jobs: raw reviews and metadata to clean tables, and on to insights."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxmill import schemas
from voxmill.config import MIN_REVIEWS_PER_PRODUCT
from voxmill.functions import text as tx
from voxmill.operators import cleaning, insights, products
from voxmill.operators.skew import ROWS_PER_TASK
from voxmill.session import cut
from voxmill.sources import keyprofile, tables


def build_review_tables(
    raw_reviews: DataFrame, raw_metadata: DataFrame, folder: str,
    min_reviews: int = MIN_REVIEWS_PER_PRODUCT, max_chars: int | None = None,
) -> dict[str, str]:
    """Clean, validate, join and filter; write reviews, products and their reports.

    Every stage is stored before the next reads it, as each is used more than once: for the
    result and for its counters. Hot products are known from the sketch taken as the reviews are
    stored, so the join reads them once. What one shuffle finds serves all that need it: the texts
    that may be repeated, for the reviews and their funnel, and the reviews of each product.
    """
    spark = raw_reviews.sparkSession
    paths = {name: f"{folder.rstrip('/')}/{name}.parquet" for name in (
        "processed", "joined", "clean_metadata", "reviews", "products", "cleaning_report",
        "join_report", "product_report")}
    repeated = cleaning.repeated_texts(raw_reviews, max_chars=max_chars)
    keyprofile.write_with_key_profile(
        cleaning.clean_reviews(raw_reviews, max_chars=max_chars, repeated=repeated), paths["processed"],
        {"domain": F.col("domain"), "parent_asin": tx.strip(F.col("parent_asin"))}, partition_by=("domain",))
    processed = tables.read_table(spark, paths["processed"])
    sizes = cut(products.key_counts(processed))
    wanted = products.sample_metadata(raw_metadata, sizes)
    tables.write_table(products.clean_metadata(wanted, max_chars), paths["clean_metadata"])
    meta = tables.read_table(spark, paths["clean_metadata"])
    hot = keyprofile.hot_from_profile(
        spark, paths["processed"], "domain string, parent_asin string", ROWS_PER_TASK)
    joined = products.join_reviews_with_products(processed, meta, identity=["row_id"], hot=hot, sizes=sizes)
    tables.write_table(joined, paths["joined"])
    joined = tables.read_table(spark, paths["joined"])
    kept_reviews, kept_products = products.filter_by_min_reviews(joined, meta, min_reviews, "n_reviews")
    tables.write_table(tables.conform(kept_reviews, schemas.REVIEW), paths["reviews"])
    tables.write_table(tables.conform(kept_products, schemas.PRODUCT), paths["products"])
    reports = {
        "cleaning_report": cleaning.cleaning_funnel(raw_reviews, max_chars=max_chars, repeated=repeated),
        "join_report": products.join_validation(sizes, meta, "n_reviews"),
        "product_report": products.product_report(joined, min_reviews),
    }
    for name, report in reports.items():
        tables.write_table(report, paths[name])
    tables.verify_table(spark, paths["reviews"], schemas.REVIEW.names)
    tables.verify_table(spark, paths["products"], schemas.PRODUCT.names)
    return paths


def build_insights(
    spark: SparkSession, reviews: DataFrame, products_table: DataFrame, folder: str,
) -> DataFrame:
    """Write the enriched reviews, then the insights table made from them; returns the latter."""
    base = folder.rstrip("/")
    enriched = insights.enrich_reviews(reviews)
    tables.write_table(enriched, f"{base}/reviews_with_predictions.parquet")
    stored = tables.read_table(spark, f"{base}/reviews_with_predictions.parquet")
    table = insights.insights_from_enriched(stored, products_table)
    tables.write_table(insights.sorted_insights(table), f"{base}/product_insights.parquet")
    return tables.read_table(spark, f"{base}/product_insights.parquet")


def load_insights(
    spark: SparkSession, folder: str, reviews: DataFrame, products_table: DataFrame,
) -> DataFrame:
    """The stored insights table; built first when it is not there."""
    path = f"{folder.rstrip('/')}/product_insights.parquet"
    found = tables.first_existing(spark, [path])
    return found if found is not None else build_insights(
        spark, reviews, products_table, folder)
