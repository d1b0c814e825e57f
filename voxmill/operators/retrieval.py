"""Product-isolated top-k retrieval for a table of questions."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from voxmill.functions import aspects as asp, labels, numbers
from voxmill.operators.skew import broadcast_if_small, position_in_group, semi_join

#: Rows of a block. A product's reviews are copied to each block of its queries and the other way round,
#: so blocks are as large as a task can hold: at 256 numbers a vector 100 and 40 MB.
REVIEW_BLOCK = 50_000
QUERY_BLOCK = 20_000

_MATCHES = T.StructType([
    T.StructField("query_id", T.LongType()), T.StructField("row_id", T.LongType()),
    T.StructField("preferred", T.BooleanType()), T.StructField("similarity", T.DoubleType()),
])


def _block_counts(reviews: DataFrame, queries: DataFrame, key: str,
                  review_block: int, query_block: int) -> DataFrame:
    """Products that need more than one block: at most rows / block size of them."""
    def blocks(df, size, name):
        return df.groupBy(key).agg(F.ceil(F.count("*") / size).cast("int").alias(name)).where(
            F.col(name) > 1)

    return blocks(reviews, review_block, "_nr").join(
        blocks(queries, query_block, "_nq"), key, "full").na.fill(1, ["_nr", "_nq"])


def _vectors(rows: pa.Table) -> np.ndarray:
    """The vectors of a block as one array, without an object for each."""
    column = rows.column("vec")
    sizes = pc.unique(pc.list_value_length(column)).to_pylist()
    if len(sizes) > 1 or None in sizes:
        raise ValueError(f"vectors must have one length: {sizes}")
    flat = pc.list_flatten(column).to_numpy()
    return flat.astype(np.float64, copy=False).reshape(rows.num_rows, -1)


def _best_in_block(reviews: pa.Table, queries: pa.Table) -> pa.Table:
    """Each query's best ``top_k`` of one block of reviews; ties fall to the lower row id."""
    if not reviews.num_rows or not queries.num_rows:
        return to_arrow_schema(_MATCHES).empty_table()
    r, q = _vectors(reviews), _vectors(queries)
    reviews, queries = reviews.drop_columns("vec").to_pandas(), queries.drop_columns("vec").to_pandas()
    r_norm, q_norm = np.linalg.norm(r, axis=1), np.linalg.norm(q, axis=1)
    ids = reviews["row_id"].to_numpy()
    flags = {
        "complaints": reviews["is_negative"].to_numpy(),
        "praises": reviews["is_positive"].to_numpy(),
    }
    nobody = np.zeros(len(ids), dtype=bool)
    wishes, ks = queries["wish"].to_numpy(), queries["top_k"].to_numpy()
    query_ids = queries["query_id"].to_numpy()
    found = []
    for start in range(0, len(q), 64):
        part = q[start:start + 64]
        scale = np.outer(q_norm[start:start + 64], r_norm)
        sims = np.divide(part @ r.T, scale, out=np.zeros_like(scale), where=scale > 0)
        # Ten places: equal vectors tie exactly, whatever order the products were summed in.
        for i, sim in enumerate(np.round(sims, 10), start):
            preferred, k = flags.get(wishes[i], nobody), ks[i]
            # Preferred reviews come first: lift them above every other similarity.
            score = sim + preferred * 4.0
            if len(ids) > k:
                limit = np.partition(score, len(ids) - k)[len(ids) - k]
                near = np.flatnonzero(score >= limit - 1e-9)
            else:
                near = np.arange(len(ids))
            order = near[np.lexsort((ids[near], -sim[near], ~preferred[near]))][:k]
            found.append((
                np.full(len(order), query_ids[i]), ids[order], preferred[order], sim[order]))
    columns = [np.concatenate(parts) for parts in zip(*found)]
    return pa.Table.from_pandas(
        pd.DataFrame(dict(zip([f.name for f in _MATCHES.fields], columns))), to_arrow_schema(_MATCHES), preserve_index=False)


def top_matches(
    reviews: DataFrame, queries: DataFrame, prioritize: bool = True, key: str = "parent_asin",
    review_block: int = REVIEW_BLOCK, query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """The best ``top_k`` reviews of its own product for every query.

    reviews: key, row_id, vec, is_negative, is_positive; queries: query_id, key, vec, intent,
    top_k. Reviews and queries of a product meet block by block, so neither a product with a
    third of all reviews nor one with a third of all questions lands in one task. A block
    returns k rows per query, not its pairs; the last step ranks those.
    """
    wish = F.col("intent") if prioritize else F.lit("general")
    # Fresh column names: the queries may have been derived from the reviews themselves.
    queries = queries.select(*[
        F.col(c).alias(c) for c in ("query_id", key, "vec")],
        wish.alias("wish"), F.col("top_k").cast("int").alias("top_k"))
    reviews = semi_join(
        reviews.select(key, "row_id", "vec", "is_negative", "is_positive"), queries, key)
    counts = broadcast_if_small(_block_counts(
        reviews.select(key), queries.select(key), key, review_block, query_block))

    def blocked(df, own, other, identity, own_name, other_name):
        sized = df.join(counts, key, "left").na.fill(1, ["_nr", "_nq"])
        return sized.withColumn(
            own_name, F.pmod(F.xxhash64(identity), F.col(own)).cast("int")).withColumn(
            other_name, F.explode(F.sequence(F.lit(0), F.col(other) - 1))).drop("_nr", "_nq")

    left = blocked(reviews, "_nr", "_nq", "row_id", "_rb", "_qb")
    right = blocked(queries, "_nq", "_nr", "query_id", "_qb", "_rb")
    best = left.groupBy(key, "_rb", "_qb").cogroup(
        right.groupBy(key, "_rb", "_qb")).applyInArrow(_best_in_block, _MATCHES)
    ranked = best.withColumn("rank", F.row_number().over(
        Window.partitionBy("query_id").orderBy(
            F.desc("preferred"), F.desc("similarity"), "row_id")))
    return ranked.join(queries.select("query_id", key, "top_k"), "query_id").where(
        F.col("rank") <= F.col("top_k")).drop("top_k")


def with_polarity_flags(reviews: DataFrame) -> DataFrame:
    return reviews.withColumns({
        "is_negative": labels.is_negative("wide"), "is_positive": labels.is_positive("wide")})


def prepare_queries(queries: DataFrame, top_k: int = 5) -> DataFrame:
    out = queries.withColumn("intent", asp.query_intent(F.col("question")))
    return out if "top_k" in out.columns else out.withColumn("top_k", F.lit(top_k))


def retrieved_reviews(matches: DataFrame, reviews: DataFrame, columns: list[str]) -> DataFrame:
    """Matches with the reviews' own columns. Matches are few next to the reviews, and are
    copied to the reviews only if their number says so."""
    wanted = broadcast_if_small(matches.select(
        "query_id", "row_id", "rank", "preferred",
        numbers.rounded(F.col("similarity"), 4).alias("similarity_score")))
    return reviews.select("row_id", *columns).join(wanted, "row_id")


def review_positions(
    reviews: DataFrame, key: str = "parent_asin", parts: int | None = None,
) -> DataFrame:
    """0-based position of a review within its product, by row id, whatever the ids look like. The
    reviews are sorted over ``parts`` ranges, so a hot product is shared by many tasks."""
    return position_in_group(reviews, [key], [F.col("row_id")], out="review_index", parts=parts)


def sentiment_breakdown(retrieved: DataFrame) -> DataFrame:
    return retrieved.groupBy("query_id").agg(
        F.count("*").alias("retrieved_count"),
        *[F.count_if(F.col("sentiment") == s).alias(s)
          for s in ("positive", "neutral", "negative")])


def aspect_breakdown(retrieved: DataFrame, top: int | None = None) -> DataFrame:
    """Per query: how often each aspect occurs among the retrieved reviews."""
    sizes = retrieved.groupBy("query_id").agg(F.count("*").alias("_size"))
    counts = retrieved.select("query_id", F.explode("aspects").alias("aspect")).groupBy(
        "query_id", "aspect").agg(F.count("*").alias("n"))
    ranked = counts.join(sizes, "query_id").withColumn(
        "rank", F.row_number().over(
            Window.partitionBy("query_id").orderBy(F.desc("n"), "aspect")))
    if top:
        ranked = ranked.where(F.col("rank") <= top)
    return ranked.select(
        "query_id", "aspect", asp.display_name(F.col("aspect")).alias("label"), "n",
        numbers.percent(F.col("n"), F.col("_size")).alias("percentage"), "rank")


def isolation_audit(retrieved: DataFrame, queries: DataFrame) -> DataFrame:
    """Per query: reviews retrieved and how many belong to another product (must be 0)."""
    asked = queries.select("query_id", F.col("parent_asin").alias("_asked"))
    return retrieved.join(asked, "query_id").groupBy("query_id").agg(
        F.count("*").alias("reviews_retrieved"),
        F.count_if(F.col("parent_asin") != F.col("_asked")).alias("foreign_reviews"))


def unknown_products(queries: DataFrame, reviews: DataFrame) -> DataFrame:
    """Queries about products without any review."""
    return queries.join(reviews.select("parent_asin").distinct(), "parent_asin", "left_anti")


def check_products(queries: DataFrame, reviews: DataFrame) -> None:
    first = unknown_products(queries, reviews).select("parent_asin").first()
    if first:
        raise ValueError(f"Product '{first[0]}' not found in reviews table.")
