"""Exact product-isolated top-k that visits only the clusters of reviews that can hold an answer."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voxmill.operators.retrieval import _MATCHES, QUERY_BLOCK, REVIEW_BLOCK, _best_in_block
from voxmill.operators.skew import broadcast_if_small, semi_join
from voxmill.session import cut

#: Reviews of a product for each of its centroids, and centroids of all products together: with more
#: reviews the clusters grow, so that the table of centroids stays small enough to be copied.
CLUSTER_ROWS = 2_000
MAX_CENTROIDS = 20_000
#: Similarities are compared to ten places; bounds are wider by more than their rounding.
SLACK = 1e-9


def _unit(vectors: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(vectors, axis=1, keepdims=True)
    return np.divide(vectors, norms, out=np.zeros_like(vectors), where=norms > 0)


def _centroids(reviews: DataFrame, key: str, cluster_rows: int, max_centroids: int) -> dict[str, np.ndarray]:
    """Per product with several clusters its centroids, which are reviews drawn by a digest. At most
    about ``max_centroids`` vectors come to the driver."""
    sizes = reviews.groupBy(key).agg(F.count("*").alias("_n"))
    total = reviews.count()
    each = max(cluster_rows, -(-total // max_centroids))
    # A row is drawn with probability 1 / each; the digest repeats the draw in every run.
    drawn = reviews.where(F.pmod(F.xxhash64(F.lit("centroid"), "row_id"), F.lit(each)) == 0)
    large = sizes.where(F.col("_n") > each).select(key)
    rows = drawn.join(large, key, "left_semi").select(key, "row_id", "vec").orderBy("row_id").limit(
        2 * max_centroids).toPandas()
    return {k: _unit(np.array(some["vec"].tolist(), np.float64)) for k, some in rows.groupby(key)}


def _assigned(centroids: dict[str, np.ndarray], key: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            cluster, angle = np.zeros(len(batch), np.int32), np.full(len(batch), np.pi)
            for name, places in batch.groupby(key).indices.items():
                vectors = np.array(batch["vec"].iloc[places].tolist(), np.float64)
                unit = _unit(vectors)
                middle = centroids.get(name)
                if middle is None:
                    continue
                cosine = np.clip(unit @ middle.T, -1, 1)
                nearest = cosine.argmax(axis=1)
                zero = ~unit.any(axis=1)
                cluster[places] = np.where(zero, -1, nearest)
                angle[places] = np.arccos(cosine[np.arange(len(places)), nearest])
            yield batch.assign(_cluster=cluster, _angle=angle)

    return run


def _bounds(centroids: dict[str, np.ndarray], key: str):
    """Per query and cluster of its product, the largest similarity a review of it can have: the angle
    to the centroid less the cluster's radius."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            bound = np.ones(len(batch))
            for name, places in batch.groupby(key).indices.items():
                middle = centroids.get(name)
                if middle is None:
                    continue
                some = batch.iloc[places]
                unit = _unit(np.array(some["vec"].tolist(), np.float64))
                cluster = some["_cluster"].to_numpy()
                cosine = np.clip((unit * middle[np.maximum(cluster, 0)]).sum(axis=1), -1, 1)
                reach = np.cos(np.maximum(0, np.arccos(cosine) - some["_radius"].to_numpy()))
                # Zero vectors have similarity 0 to everything.
                bound[places] = np.where((cluster < 0) | ~unit.any(axis=1), 0.0, reach)
            yield batch.drop(columns=["vec", "_radius"]).assign(_bound=bound)

    return run


def _visit(reviews: DataFrame, visits: DataFrame, key: str, sizes: DataFrame, review_block: int,
           query_block: int) -> DataFrame:
    """The best of each visited cluster for each query that visits it, block by block."""
    home = [key, "_cluster"]
    asked = visits.groupBy(*home).agg(F.ceil(F.count("*") / query_block).cast("int").alias("_nq"))
    blocks = broadcast_if_small(sizes.join(asked, home).select(
        *home, F.ceil(F.col("_rows") / review_block).cast("int").alias("_nr"), "_nq"))

    def dealt(df: DataFrame, own: str, other: str, identity: str, own_name: str, other_name: str) -> DataFrame:
        return df.join(blocks, home).withColumn(own_name, F.pmod(F.xxhash64(identity), F.col(own)).cast("int")).withColumn(
            other_name, F.explode(F.sequence(F.lit(0), F.col(other) - 1))).drop("_nr", "_nq")

    by = [*home, "_rb", "_qb"]
    left = dealt(reviews, "_nr", "_nq", "row_id", "_rb", "_qb").groupBy(*by)
    right = dealt(visits, "_nq", "_nr", "query_id", "_qb", "_rb").groupBy(*by)
    return left.cogroup(right).applyInArrow(_best_in_block, _MATCHES)


def _ranked(found: DataFrame, queries: DataFrame) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("preferred"), F.desc("similarity"), "row_id")
    return found.withColumn("rank", F.row_number().over(order)).join(queries, "query_id").where(
        F.col("rank") <= F.col("top_k"))


def _score(preferred: Column, similarity: Column) -> Column:
    """As the matches are ordered: a preferred review before any other."""
    return similarity + F.when(preferred, 4.0).otherwise(0.0)


def pruned_matches(
    reviews: DataFrame, queries: DataFrame, prioritize: bool = True, key: str = "parent_asin",
    cluster_rows: int = CLUSTER_ROWS, max_centroids: int = MAX_CENTROIDS, review_block: int = REVIEW_BLOCK,
    query_block: int = QUERY_BLOCK,
) -> tuple[DataFrame, DataFrame]:
    """The result of ``retrieval.top_matches``, exactly, and (query_id, clusters, visited).

    A product's reviews are clustered around some of them, and each cluster's radius is known. A query
    first visits its most promising clusters until they hold ``top_k`` reviews; what it finds there is
    a score that the others must reach. It then visits only those of the other clusters whose bound
    does. Clusters are visited in blocks of reviews and queries, so that neither a hot product nor a
    popular one fills a task; their centroids are a table of bounded size.
    """
    wish = F.col("intent") if prioritize else F.lit("general")
    queries = cut(queries.select(
        F.col("query_id"), F.col(key), F.col("vec"), wish.alias("wish"), F.col("top_k").cast("int").alias("top_k")))
    reviews = cut(semi_join(reviews.select(key, "row_id", "vec", "is_negative", "is_positive"), queries, key))
    middles = _centroids(reviews, key, cluster_rows, max_centroids)
    schema = reviews.schema.simpleString()[7:-1]
    placed = cut(reviews.mapInPandas(_assigned(middles, key), f"{schema},_cluster:int,_angle:double"))
    sizes = cut(placed.groupBy(key, "_cluster").agg(
        F.count("*").alias("_rows"), F.max("_angle").alias("_radius"),
        F.max("is_negative").alias("_negative"), F.max("is_positive").alias("_positive")))
    placed = placed.drop("_angle")
    # Every query with every cluster of its product: as many rows as the product has clusters.
    lifted = F.coalesce(F.when(F.col("wish") == "complaints", F.col("_negative")).when(
        F.col("wish") == "praises", F.col("_positive")), F.lit(False))
    pairs = queries.join(broadcast_if_small(sizes), key).select(
        "query_id", key, "vec", "top_k", "_cluster", "_radius", "_rows", lifted.alias("_lifted"))
    kind = queries.schema[key].dataType.simpleString()
    bounds = pairs.mapInPandas(_bounds(middles, key), f"query_id long, {key} {kind}, top_k int, _cluster int, "
                               "_rows long, _lifted boolean, _bound double").withColumn(
        "_bound", _score(F.col("_lifted"), F.col("_bound") + SLACK))
    nearest = Window.partitionBy("query_id").orderBy(F.desc("_bound"), "_cluster").rowsBetween(
        Window.unboundedPreceding, -1)
    bounds = cut(bounds.withColumn("_first", F.coalesce(F.sum("_rows").over(nearest), F.lit(0)) < F.col("top_k")))

    def visits(chosen: DataFrame) -> DataFrame:
        return chosen.select("query_id", "_cluster").join(queries, "query_id")

    rows = sizes.select(key, "_cluster", "_rows")
    wanted = queries.select("query_id", "top_k")
    first = cut(_visit(placed, visits(bounds.where("_first")), key, rows, review_block, query_block))
    # The score of the last match so far; none where there are fewer than top_k.
    reached = _ranked(first, wanted).where(F.col("rank") == F.col("top_k")).select(
        "query_id", _score(F.col("preferred"), F.col("similarity")).alias("_least"))
    more = cut(bounds.where("not _first").join(reached, "query_id", "left").where(
        F.col("_least").isNull() | (F.col("_bound") >= F.col("_least"))))
    second = _visit(placed, visits(more), key, rows, review_block, query_block)
    matches = _ranked(first.unionByName(second), wanted).join(
        queries.select("query_id", key), "query_id").drop("top_k")
    visited = bounds.where("_first").select("query_id").unionByName(more.select("query_id")).groupBy("query_id").agg(
        F.count("*").alias("visited"))
    return matches, bounds.groupBy("query_id").agg(F.count("*").alias("clusters")).join(visited, "query_id")
