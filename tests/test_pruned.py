"""Cluster-pruned top-k: equal to the search through all reviews, with clusters left out."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import rows
from voxmill.operators import pruned, retrieval

REVIEWS = "row_id long, parent_asin string, vec array<double>, is_negative boolean, is_positive boolean"
QUERIES = "query_id long, parent_asin string, vec array<double>, intent string, top_k int"
FOUND = ("query_id", "row_id", "rank", "preferred", "similarity", "parent_asin")


def tables(spark, n=1500, dims=6, seed=1):
    draw = np.random.default_rng(seed)
    middles = draw.normal(size=(12, dims)) * 3
    vectors = middles[draw.integers(0, 12, n)] + draw.normal(size=(n, dims)) * 0.3
    vectors[:5] = 0
    vectors[20:40] = vectors[19]
    products = ["hot" if i % 5 else f"p{i % 7}" for i in range(n)]
    negative = draw.random(n) < 0.05
    reviews = [(i, p, v.tolist(), bool(x), not x) for i, (p, v, x) in enumerate(zip(products, vectors, negative))]
    queries = []
    for i in range(60):
        v = vectors[draw.integers(0, n)] + draw.normal(size=dims) * 0.1
        queries.append((i, "hot" if i % 3 else f"p{i % 8}", (v * (i != 9)).tolist(),
                        ["complaints", "praises", "general"][i % 3], [1, 5, 40, 2000][i % 4]))
    return spark.createDataFrame(reviews, REVIEWS), spark.createDataFrame(queries, QUERIES)


@pytest.mark.parametrize("cluster_rows, blocks", [(20, (50_000, 2_000)), (100, (30, 4)), (5000, (50_000, 2_000))])
def test_equal_to_the_whole_search(spark, cluster_rows, blocks):
    reviews, queries = tables(spark)
    want = retrieval.top_matches(reviews, queries)
    got, seen = pruned.pruned_matches(
        reviews, queries, cluster_rows=cluster_rows, review_block=blocks[0], query_block=blocks[1])
    assert rows(got, *FOUND) == rows(want, *FOUND)
    got, _ = pruned.pruned_matches(reviews, queries, prioritize=False, cluster_rows=cluster_rows)
    assert rows(got, *FOUND) == rows(retrieval.top_matches(reviews, queries, prioritize=False), *FOUND)
    assert seen.where("visited > clusters").isEmpty()


def test_most_clusters_are_skipped(spark):
    reviews, queries = tables(spark)
    few = queries.where("top_k <= 5 and intent = 'general' and parent_asin = 'hot' and query_id <> 9")
    _, seen = pruned.pruned_matches(reviews, few, cluster_rows=20)
    total, visited = seen.agg(F.sum("clusters"), F.sum("visited")).first()
    assert visited < total / 3


def test_centroids_are_bounded(spark):
    reviews, _ = tables(spark)
    assert sum(map(len, pruned._centroids(reviews, "parent_asin", 2, 50).values())) <= 100


def test_empty_tables(spark):
    reviews, queries = tables(spark, 60)
    assert pruned.pruned_matches(reviews.limit(0), queries)[0].isEmpty()
    assert pruned.pruned_matches(reviews, queries.limit(0))[0].isEmpty()
