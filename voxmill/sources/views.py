"""Review-shaped views of the test tables: the same columns a review source would give."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxmill.functions import labels, text as tx
from voxmill.operators.skew import broadcast_if_small
from voxmill.sources.tables import spread_small

#: Labels of documents, a few numbers each, that are copied to the documents; more are joined by a shuffle.
MAX_BROADCAST_LABELS = 2_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table whose texts are about to be cleaned, tagged or split into words."""
    return spread_small(table(spark, sf_dir, name))


def doc_ratings(documents: DataFrame, ratings: DataFrame) -> DataFrame:
    rating = (
        F.when(F.col("toxic") == 1, 1.0).when(F.col("quality") == 0, 2.0)
        .when(F.col("quality") == 1, 5.0).otherwise(3.0))
    # Labels are narrow: copied to the documents, so that no text is shuffled to find its label.
    ratings = broadcast_if_small(ratings.select("doc_id", "quality", "toxic"), MAX_BROADCAST_LABELS)
    return documents.join(ratings, "doc_id", "left").select(
        F.col("doc_id").alias("row_id"), rating.alias("rating"),
        tx.first_word(F.col("text")).alias("title"), "text",
        F.col("source").alias("parent_asin"),
        F.when(F.col("lang") == "en", "Electronics").otherwise("Fashion").alias("domain"))


def doc_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as reviews of their source, rated by the quality and toxicity labels."""
    return doc_ratings(text_table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
                       ).withColumn("sentiment", labels.rating_label(F.col("rating")))


def item_reviews(spark: SparkSession, sf_dir: str, for_text: bool = False) -> DataFrame:
    """Order lines as reviews of their part."""
    lines = (text_table if for_text else table)(spark, sf_dir, "lineitem")
    parts = table(spark, sf_dir, "part")
    rating = 1 + (F.col("l_orderkey") + 3 * F.col("l_linenumber")) % 5
    asin = F.concat(F.lit("P"), F.col("l_partkey").cast("string"))
    return lines.join(parts, lines["l_partkey"] == parts["p_partkey"]).select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
        .alias("review_key"),
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("row_id"),
        asin.alias("parent_asin"), asin.alias("asin"),
        rating.cast("double").alias("rating"),
        labels.rating_label(rating).alias("sentiment"),
        F.when(F.col("l_returnflag") == "R", "negative")
        .when(F.col("l_returnflag") == "N", "neutral").otherwise("positive")
        .alias("predicted_sentiment"),
        F.col("p_name").alias("title"),
        F.concat_ws(" ", "p_name", F.lower("p_type"), "p_brand").alias("text"),
        F.col("l_shipdate").alias("timestamp"),
        F.greatest(F.col("l_quantity") - 30, F.lit(0.0)).cast("long").alias("helpful_vote"),
        (F.col("l_linestatus") == "F").alias("verified_purchase"),
        F.when(F.col("p_type").isin("SMALL", "MEDIUM", "LARGE"), "Fashion")
        .otherwise("Electronics").alias("domain"))


def raw_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as product metadata."""
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("row_id"),
        F.when(F.col("p_type").isin("SMALL", "MEDIUM", "LARGE"), "Fashion")
        .otherwise("Electronics").alias("domain"),
        F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("parent_asin"),
        F.col("p_name").alias("title"),
        (1 + F.col("p_size") % 5).cast("double").alias("average_rating"),
        F.col("p_retailprice").cast("string").alias("price"),
        F.array("p_name", F.lit(None).cast("string"), "p_brand").alias("description"),
        F.array("p_type", "p_brand").alias("categories"),
        F.col("p_brand").alias("store"))


def source_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Document sources as products of each domain, described by their documents there."""
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("row_id"), F.col("source").alias("parent_asin"),
        F.when(F.col("lang") == "en", "Electronics").otherwise("Fashion").alias("domain"),
        F.concat(F.lit("Source "), "source").alias("title"),
        F.lit(4.0).alias("average_rating"), F.lit(" none ").alias("price"),
        F.array("lang", F.lit(None).cast("string"), "source").alias("description"),
        F.array("lang").alias("categories"), F.lit("  A   store ").alias("store"))


def catalog_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The metadata without the largest sizes, for queries about products that lack theirs."""
    sizes = table(spark, sf_dir, "part").where("p_size <= 40").select(F.col("p_partkey").alias("row_id"))
    return raw_metadata(spark, sf_dir).join(sizes, "row_id", "left_semi")


def vector_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored vectors as reviews of their label."""
    rating = (1 + F.col("vec_id") % 5).cast("double")
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("row_id"), F.concat(F.lit("V"), F.col("label")).alias("parent_asin"),
        F.col("embedding").cast("array<double>").alias("vec"),
        rating.alias("rating"), labels.rating_label(rating).alias("sentiment"),
        F.lit(None).cast("string").alias("predicted_sentiment"))


def user_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").where("role = 'user'").select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("query_id"),
        F.col("text").alias("question"), "conv_id", "turn")


def page_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Web pages as reviews with markup in their text."""
    return text_table(spark, sf_dir, "pages").select(
        F.col("page_id").alias("row_id"), F.col("html").alias("text"), "url")


def line_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long prediction table: three label sources for every order line."""
    lines = item_reviews(spark, sf_dir).select("domain", "review_key", "row_id", "sentiment",
                                               "predicted_sentiment", "rating", "helpful_vote")
    by_votes = (
        F.when(F.col("helpful_vote") > 12, "negative").when(F.col("helpful_vote") > 4, "neutral")
        .otherwise("positive"))
    near = (
        F.when(F.col("rating") + F.col("helpful_vote") % 2 <= 2, "negative")
        .when(F.col("rating") + F.col("helpful_vote") % 2 <= 3, "neutral").otherwise("positive"))
    models = F.array(
        F.struct(F.lit("flag").alias("model"), F.col("predicted_sentiment").alias("y_pred")),
        F.struct(F.lit("votes").alias("model"), by_votes.alias("y_pred")),
        F.struct(F.lit("near").alias("model"), near.alias("y_pred")))
    return lines.select("domain", F.col("review_key").alias("sample_id"),
                        F.col("sentiment").alias("y_true"), F.inline(models))
