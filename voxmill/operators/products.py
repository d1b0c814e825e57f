"""Product metadata: cleaning, key validation, the review join, review-count filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from voxmill.config import MIN_REVIEWS_PER_PRODUCT
from voxmill.functions import labels, text as tx
from voxmill.operators.cleaning import keep_first
from voxmill.operators.skew import ROWS_PER_TASK, hot_from_counts, salted_join
from voxmill.session import cut

# Spellings of a missing price.
NULL_PRICES = ("none", "nan", "null")
KEYS = ("domain", "parent_asin")
JOINED_COLUMNS = ("title", "average_rating", "price", "description", "categories", "store")


def has_key(key: str = "parent_asin") -> Column:
    return ~tx.is_blank(F.col(key))


def with_trimmed_key(df: DataFrame, key: str = "parent_asin") -> DataFrame:
    """Rows whose key is present, with outer whitespace removed from the key."""
    return df.where(has_key(key)).withColumn(key, tx.strip(F.col(key)))


def description_text(value: Column, is_array: bool, max_chars: int | None = None) -> Column:
    joined = F.array_join(F.array_compact(value), " ") if is_array else value
    return tx.clean_text(joined, max_chars)


def category_list(value: Column, is_array: bool) -> Column:
    items = F.array_compact(value) if is_array else F.when(value.isNotNull(), F.array(value))
    return F.coalesce(F.transform(items, tx.strip), F.array().cast("array<string>"))


def price_text(price: Column) -> Column:
    trimmed = tx.strip(price)
    return F.when(
        price.isNull() | F.lower(trimmed).isin(*NULL_PRICES), "None").otherwise(trimmed)


def price_number(price: Column) -> Column:
    return labels.to_number(F.regexp_replace(price, "[$,]", ""))


def clean_metadata(meta: DataFrame, max_chars: int | None = None) -> DataFrame:
    """One row per product key, the first by ``row_id``, with tidied fields."""
    types = dict(meta.dtypes)
    unique = keep_first(with_trimmed_key(meta), [F.col("domain"), F.col("parent_asin")], "row_id")
    rules = {
        "title": lambda c: tx.clean_text(c, max_chars),
        "description": lambda c: description_text(
            c, types["description"].startswith("array"), max_chars),
        "categories": lambda c: category_list(c, types["categories"].startswith("array")),
        "price": price_text,
        "store": tx.normalize_whitespace,
        "average_rating": labels.to_number,
    }
    return unique.withColumns(
        {name: rule(F.col(name)) for name, rule in rules.items() if name in types})


def metadata_quality(meta: DataFrame) -> DataFrame:
    """Per domain: raw rows, missing keys, duplicate keys, clean rows."""
    keyed = meta.select(
        "domain", F.when(has_key(), tx.strip(F.col("parent_asin"))).alias("_key"))
    per_key = keyed.groupBy("domain", "_key").agg(F.count("*").alias("_n"))
    known = F.col("_key").isNotNull()
    return per_key.groupBy("domain").agg(
        F.sum("_n").alias("raw_metadata_count"),
        F.coalesce(F.sum(F.when(~known, F.col("_n"))), F.lit(0)).alias("missing_parent_asin"),
        F.coalesce(F.sum(F.when(known, F.col("_n") - 1)), F.lit(0)).alias("duplicate_parent_asin"),
        F.count_if(known).alias("clean_metadata_count"),
    )


def product_columns(meta: DataFrame) -> DataFrame:
    """The metadata columns a joined review carries, the title under its own name."""
    present = [c for c in JOINED_COLUMNS if c in meta.columns]
    keys = [c for c in KEYS if c in meta.columns]
    return meta.select(*keys, *[
        F.col(c).alias("product_title" if c == "title" else c) for c in present])


def shared_keys(a: DataFrame, b: DataFrame) -> list[str]:
    """A product is known by its key within a domain, or by the key alone where one of the
    tables does not name the domain."""
    return [c for c in KEYS if c in a.columns and c in b.columns]


def unique_products(meta: DataFrame, keys: list[str] = ("parent_asin",)) -> DataFrame:
    """One row per key: the first by ``row_id``, or by title where the table has no row order."""
    order = F.col("row_id") if "row_id" in meta.columns else F.col("title")
    return keep_first(with_trimmed_key(meta), [F.col(k) for k in keys], order)


def join_reviews_with_products(
    reviews: DataFrame, meta: DataFrame, counted: Observation | None = None,
    identity: list[str] | None = None, hot: DataFrame | None = None,
    rows_per_task: int = ROWS_PER_TASK, sizes: DataFrame | None = None,
) -> DataFrame:
    """Reviews of known products. The product side is unique per key, so no review multiplies;
    hot products are spread over several tasks. ``counted`` receives the joined row count. With
    ``hot``, as from ``keyprofile.hot_from_profile``, the reviews are read once. With ``sizes``, the
    ``key_counts`` of the reviews, each one carries its product's as ``n_reviews``."""
    left, keys = with_trimmed_key(reviews), shared_keys(reviews, meta)
    right = product_columns(unique_products(meta, keys))
    right = right.drop(*[c for c in KEYS if c not in keys])
    if sizes is not None:
        right = right.join(with_trimmed_key(sizes).groupBy(*keys).agg(F.sum("n_reviews").alias("n_reviews")), keys)
    joined = salted_join(left, right, keys, identity=identity, hot=hot, rows_per_task=rows_per_task)
    return joined.observe(counted, F.count("*").alias("joined")) if counted else joined


def unmatched_reviews(
    reviews: DataFrame, meta: DataFrame, hot: DataFrame | None = None,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    keys = shared_keys(reviews, meta)
    known = with_trimmed_key(meta).select(*keys).distinct()
    return salted_join(with_trimmed_key(reviews), known, keys, "left_anti", hot=hot, rows_per_task=rows_per_task)


def unmatched_products(reviews: DataFrame, meta: DataFrame) -> DataFrame:
    """Keys that have reviews but no metadata."""
    keys = shared_keys(reviews, meta)
    return with_trimmed_key(reviews).select(*keys).distinct().join(
        with_trimmed_key(meta).select(*keys), keys, "left_anti")


def join_validation(reviews: DataFrame, meta: DataFrame, counted: str | None = None) -> DataFrame:
    """Nine counters per domain. Both sides are counted per key first; the join then sees at
    most one row per key from each. A row of ``reviews`` stands for as many as ``counted`` names, as
    in their ``key_counts``."""
    def per_key(df, name, n=F.lit(1)):
        return (
            df.select("domain", F.when(has_key(), tx.strip(F.col("parent_asin"))).alias("_key"), n.alias("_n"))
            .groupBy("domain", "_key").agg(F.sum("_n").alias(name))
        )

    left = per_key(reviews, "_reviews", F.col(counted) if counted else F.lit(1))
    right = per_key(meta, "_meta")
    both = left.join(
        right,
        left["domain"].eqNullSafe(right["domain"]) & left["_key"].eqNullSafe(right["_key"]),
        "full",
    ).select(
        F.coalesce(left["domain"], right["domain"]).alias("domain"),
        F.coalesce(left["_key"], right["_key"]).alias("_key"),
        F.coalesce("_reviews", F.lit(0)).alias("_reviews"),
        F.coalesce("_meta", F.lit(0)).alias("_meta"),
    )
    known = F.col("_key").isNotNull()
    has_reviews, has_meta = F.col("_reviews") > 0, F.col("_meta") > 0

    def total(condition, value):
        return F.coalesce(F.sum(F.when(condition, value)), F.lit(0)).cast("long")

    return both.groupBy("domain").agg(
        F.sum("_reviews").alias("reviews_count_before_join"),
        F.sum("_meta").alias("metadata_count_before_join"),
        total(~known, F.col("_reviews")).alias("missing_parent_asin_in_reviews"),
        total(~known, F.col("_meta")).alias("missing_parent_asin_in_metadata"),
        total(known & has_meta, F.col("_meta") - 1).alias("duplicate_metadata_parent_asin"),
        total(known & has_reviews & ~has_meta, F.col("_reviews")).alias("unmatched_reviews_count"),
        total(known & has_reviews & ~has_meta, F.lit(1)).alias("unmatched_unique_products"),
        total(known & has_reviews & has_meta, F.col("_reviews")).alias("joined_reviews_count"),
    )


def key_counts(reviews: DataFrame) -> DataFrame:
    """Rows per key as it stands, null keys too."""
    return reviews.groupBy("domain", "parent_asin").agg(F.count("*").alias("n_reviews"))


def reviews_per_product(reviews: DataFrame) -> DataFrame:
    return key_counts(reviews.where(F.col("parent_asin").isNotNull()))


def products_with_min_reviews(
    reviews: DataFrame, min_reviews: int = MIN_REVIEWS_PER_PRODUCT,
) -> DataFrame:
    return reviews_per_product(reviews).where(F.col("n_reviews") >= min_reviews)


def filter_by_min_reviews(
    reviews: DataFrame, meta: DataFrame, min_reviews: int = MIN_REVIEWS_PER_PRODUCT, counted: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Reviews and metadata of the products that have enough reviews."""
    return reviews_with_min(reviews, min_reviews, counted), metadata_with_min(reviews, meta, min_reviews)


def reviews_with_min(
    reviews: DataFrame, min_reviews: int = MIN_REVIEWS_PER_PRODUCT, counted: str | None = None,
) -> DataFrame:
    """The counts that find the kept products also tell which of them are hot. Where the reviews carry
    them, in the column ``counted``, as ``join_reviews_with_products`` adds it, nothing is joined."""
    if counted:
        return reviews.where(F.col(counted) >= min_reviews).drop(counted)
    sizes = cut(reviews_per_product(reviews))
    kept = sizes.where(F.col("n_reviews") >= min_reviews).select(*KEYS)
    return salted_join(reviews, kept, list(KEYS), "left_semi",
                       hot=hot_from_counts(sizes, list(KEYS), "n_reviews"))


def metadata_with_min(
    reviews: DataFrame, meta: DataFrame, min_reviews: int = MIN_REVIEWS_PER_PRODUCT,
) -> DataFrame:
    """Only the review counts are needed; the reviews are read once."""
    kept = products_with_min_reviews(reviews, min_reviews)
    keys = shared_keys(meta, kept)
    return meta.join(kept.select(*keys).distinct(), keys, "left_semi")


def catalog_density(reviews: DataFrame, thresholds: tuple[int, ...] = (5, 20)) -> DataFrame:
    """Per domain: unique products and how many reviews they have. The median is taken over
    (review count, number of products) pairs, so its state stays small."""
    sizes = (
        reviews_per_product(reviews).groupBy("domain", "n_reviews")
        .agg(F.count("*").alias("_products"))
    )
    n, products = F.col("n_reviews"), F.col("_products")
    unique = F.sum(products)
    return sizes.groupBy("domain").agg(
        F.sum(n * products).alias("total_reviews"),
        unique.alias("unique_products"),
        F.round(F.sum(n * products) / unique, 6).alias("mean_reviews"),
        F.percentile(n, 0.5, products).alias("median_reviews"),
        F.max(n).alias("max_reviews"),
        *[F.coalesce(F.sum(F.when(n >= t, products)), F.lit(0)).alias(f"products_ge_{t}")
          for t in thresholds],
        F.round(
            F.coalesce(F.sum(F.when(n >= thresholds[-1], products)), F.lit(0)) / unique * 100, 3
        ).alias(f"pct_ge_{thresholds[-1]}"),
    )


def product_report(
    reviews: DataFrame, min_reviews: int = MIN_REVIEWS_PER_PRODUCT,
) -> DataFrame:
    """Per domain: reviews before the filter, unique and kept products, reviews left and their
    mean and median per kept product (0.0 when none is left)."""
    sizes = (
        reviews_per_product(reviews).groupBy("domain", "n_reviews")
        .agg(F.count("*").alias("_products"))
    )
    n, products = F.col("n_reviews"), F.col("_products")
    enough = n >= min_reviews
    kept = F.coalesce(F.sum(F.when(enough, products)), F.lit(0))
    left = F.coalesce(F.sum(F.when(enough, n * products)), F.lit(0))
    return sizes.groupBy("domain").agg(
        F.sum(n * products).alias("reviews_before_product_filtering"),
        F.sum(products).alias("unique_products"),
        kept.alias("products_with_min_reviews"),
        left.alias("reviews_remaining"),
        F.coalesce(F.round(left / F.nullif(kept, F.lit(0)), 6), F.lit(0.0))
        .alias("avg_reviews_per_product"),
        F.coalesce(
            F.percentile(F.when(enough, n), 0.5, F.when(enough, products).otherwise(0)),
            F.lit(0.0)).alias("median_reviews_per_product"),
        F.lit(min_reviews).cast("long").alias("min_reviews_threshold"),
    )


def sample_metadata(
    meta: DataFrame, targets: DataFrame | None = None, sample_size: int | None = None,
) -> DataFrame:
    """First row per key, restricted to wanted keys, at most ``sample_size`` in file order."""
    keyed, keys = with_trimmed_key(meta), [c for c in KEYS if c in meta.columns]
    if targets is not None:
        wanted = shared_keys(meta, targets)
        keyed = keyed.join(with_trimmed_key(targets).select(*wanted).distinct(), wanted, "left_semi")
    unique = keep_first(keyed, [F.col(k) for k in keys], "row_id")
    return unique if sample_size is None else unique.orderBy("row_id").limit(sample_size)


def top_products(reviews: DataFrame, meta: DataFrame | None = None, n: int = 10) -> DataFrame:
    """The n most reviewed products with mean rating, share of positives and a short title."""
    ranked = (
        reviews.groupBy("parent_asin").agg(
            F.count("*").alias("review_count"),
            F.round(F.avg("rating"), 6).alias("avg_rating"),
            F.round(F.avg(F.when(F.col("sentiment") == "positive", 100.0).otherwise(0.0)), 6)
            .alias("pct_positive"),
        ).orderBy(F.desc("review_count"), "parent_asin").limit(n)
    )
    if meta is None:
        return ranked.withColumn("title", F.col("parent_asin"))
    titles = unique_products(meta).select("parent_asin", "title", "store")
    # ``ranked`` has n rows, the report's own limit; the titles wanted are at most as many.
    wanted = titles.join(F.broadcast(ranked.select("parent_asin")), "parent_asin", "left_semi")
    return ranked.join(F.broadcast(wanted), "parent_asin", "left").withColumn(
        "title", F.concat(
            F.substring(F.coalesce("title", "parent_asin"), 1, 45), F.lit("...")))
