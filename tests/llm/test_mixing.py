import hashlib
import math
from collections import Counter

from pyspark.sql import functions as F

from cases import frame
from voxmill.llm import mixing


def draw(key, salt):
    return (int(hashlib.md5(f"{key}:{salt}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52


def inverse(mean, u):
    k, term, total = 0, math.exp(-mean), math.exp(-mean)
    while total <= u and k < 10_000:
        k += 1
        term *= mean / k
        total += term
    return k


def corpus(spark):
    return spark.range(3000).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("s"), F.when(F.col("id") % 3 == 0, 0).otherwise(
            F.col("id") % 5)).alias("source"), F.repeat(F.lit("ab"), (F.col("id") % 40).cast("int")).alias("text"))


def test_counts_equal_the_inverse_distribution(spark):
    docs = corpus(spark)
    weights = {"s0": 3.0, "s1": 1.0, "s2": 500.0, "s3": 0.0}
    rates = {r._source: r._rate for r in mixing.source_rates(docs, weights=weights, size=2.0).collect()}
    sizes, every = Counter(), 0
    for r in docs.collect():
        sizes[r.source] += len(r.text)
        every += len(r.text)
    present = {s: weights.get(s, 1.0) for s in sizes}
    for s, rate in rates.items():
        assert math.isclose(rate, present[s] / sum(present.values()) * 2 * every / sizes[s])
    got = Counter(r.doc_id for r in mixing.mix(docs, weights=weights, size=2.0).collect())
    for r in docs.collect():
        assert got[r.doc_id] == inverse(rates[r.source], draw(r.doc_id, "mix:1"))


def test_large_means_are_sums_of_draws(spark):
    docs = spark.createDataFrame([(1, "a", "x" * 10), (2, "b", "x" * 10_000)], "doc_id long, source string, text string")
    rate = {r._source: r._rate for r in mixing.source_rates(docs).collect()}["a"]
    parts = math.ceil(rate / 100)
    want = sum(inverse(rate / parts, draw(1, f"mix:{p}")) for p in range(1, parts + 1))
    rows = mixing.mix(docs).where("doc_id = 1").collect()
    assert len(rows) == want and sorted(r.copy for r in rows) == list(range(want))
    assert abs(want - rate) < 6 * rate**0.5


def test_shares_come_near_the_targets(spark):
    mixed = mixing.mix(corpus(spark)).groupBy("source").agg(F.sum(F.length("text")).alias("n")).collect()
    total = sum(r.n for r in mixed)
    for r in mixed:
        assert abs(r.n / total - 1 / len(mixed)) < 0.03


def test_seed_repeats_and_order_is_shuffled(spark):
    first, again = ([tuple(r) for r in mixing.mix(corpus(spark), partitions=4).collect()] for _ in range(2))
    assert first == again
    other = [tuple(r) for r in mixing.mix(corpus(spark), seed="other").collect()]
    assert sorted(first) != sorted(other)
    ids = [r[0] for r in first]
    assert sum(a < b for a, b in zip(ids, ids[1:])) < 0.6 * len(ids)


def test_many_sources_are_joined_by_a_shuffle(spark, monkeypatch):
    want = sorted(tuple(r) for r in mixing.mix(corpus(spark)).collect())
    monkeypatch.setattr(mixing, "MAX_BROADCAST_SOURCES", 2)
    assert sorted(tuple(r) for r in mixing.mix(corpus(spark)).collect()) == want


def test_odd_rows_and_empty_table(spark):
    docs = frame(spark)
    mixed = mixing.mix(docs)
    assert set(mixed.columns) == set(docs.columns) | {"mix_rate"}
    assert mixed.where("size <> 'big'").count() == 0
    assert mixed.where("source is null").count() > 0
    assert mixing.mix(frame(spark, [])).count() == 0
    blank = spark.createDataFrame([(1, None, None)], "doc_id long, source string, text string")
    assert mixing.mix(blank).count() == 0


def test_rows_without_a_key_are_dealt_out(spark):
    docs = spark.range(4000).select(
        F.lit(None).cast("long").alias("doc_id"), F.lit("s").alias("source"), F.format_string("%05d", "id").alias("text"))
    parts = mixing.mix(docs, size=5.0, partitions=8).groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in parts) >= 4000
    assert max(r["count"] for r in parts) < 0.2 * sum(r["count"] for r in parts)
