"""Rows that earlier versions lost or misread: null ids and labels, odd numbers, long texts."""

import math

import pytest
from pyspark.sql import functions as F

from conftest import rows
from voxmill.functions import labels, numbers
from voxmill.operators import cleaning, evaluation, models, products, retrieval, sampling, skew

ODD = "row_id long, domain string, sentiment string"


def odd_rows(spark):
    data = [(None, "a", "positive"), (None, "a", None), (None, None, None)]
    data += [(i, ["a", None][i % 2], ["positive", "negative", None][i % 3]) for i in range(27)]
    return spark.createDataFrame(data, ODD)


def test_split_keeps_every_row(spark):
    df = odd_rows(spark)
    split = sampling.stratified_split(df, ["domain"])
    assert split.columns == [*df.columns, "split"]
    assert rows(split.na.fill("-").na.fill(-1), "row_id", "domain", "sentiment") == rows(
        df.na.fill("-").na.fill(-1))
    assert {r.split for r in split.collect()} == {"train", "validation", "test"}


def test_positions_of_null_ids_and_products(spark):
    reviews = spark.createDataFrame([(None, "P"), (None, "P"), (5, "P"), (70000, "P"), (None, None), (3, None)],
                                    "row_id long, parent_asin string")
    got = [(r.parent_asin, r.review_index) for r in retrieval.review_positions(reviews).collect()]
    assert sorted(got, key=str) == sorted([("P", i) for i in range(4)] + [(None, 0), (None, 1)], key=str)


@pytest.mark.parametrize("n", [1, 40, 1500, 50_000])
def test_sample_per_group_for_any_size(spark, n):
    df = spark.range(6000).select(
        F.col("id").alias("row_id"), F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("domain"))
    got = sampling.sample_per_group(df, ["domain"], n, position="place")
    sizes = {r["domain"]: (r["n"], r["top"]) for r in got.groupBy("domain").agg(
        F.count("*").alias("n"), F.max("place").alias("top")).collect()}
    assert sizes == {"a": (min(n, 2000),) * 2, "b": (min(n, 4000),) * 2}
    ranked = df.orderBy("domain", sampling.seeded_order("row_id"), "row_id").collect()
    for domain in "ab":
        best = [r.row_id for r in ranked if r.domain == domain][:n]
        assert {r.row_id for r in got.collect() if r["domain"] == domain} == set(best)


def test_sample_leaves_no_whole_group_to_a_task(spark):
    df = spark.range(20_000).select(F.col("id").alias("row_id"), F.lit("one").alias("domain"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = sampling.sample_per_group(df, ["domain"], 50_000)
        most = max(got.rdd.glom().map(len).collect())
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert most < 10_000


@pytest.mark.parametrize("text", ["5d", "5f", "0x1p3", "1e", "", " ", "nan", "1,5", "--1", ".", "1 2", None])
def test_not_numbers(spark, text):
    df = spark.createDataFrame([(text,)], "v string")
    assert df.select(labels.to_number(F.col("v"))).first()[0] is None
    assert df.select(products.price_number(F.col("v"))).first()[0] in (None, 15.0 if text == "1,5" else None)


@pytest.mark.parametrize("text, value", [("5", 5.0), (" -1.5e3 ", -1500.0), (".5", 0.5), ("1.", 1.0), ("inf", math.inf)])
def test_numbers(spark, text, value):
    assert spark.createDataFrame([(text,)], "v string").select(labels.to_number(F.col("v"))).first()[0] == value


def test_rounding_is_that_of_the_exact_value(spark):
    values = [2.675, 4.675, 0.125, 0.375, 2.5, 3.5, -2.5, -2.675, 1e-9, 0.0, 1e17, 12.345, 66.65, 33.35, 1.005, 0.285,
              *[k / 8 for k in range(-20, 20)], *[k / 200 for k in range(1, 400, 2)], *[k / 7 for k in range(50)]]
    for places in (0, 1, 2, 4):
        df = spark.createDataFrame([(v,) for v in values], "v double")
        got = df.select("v", numbers.rounded(F.col("v"), places).alias("r")).collect()
        assert [r.r for r in got] == [round(r.v, places) for r in got]
    assert spark.sql("select cast(null as double) v").select(numbers.rounded(F.col("v"), 2)).first()[0] is None


def test_unknown_labels_are_errors(spark):
    data = [("m1", 1, "positive", "mixed"), ("m2", 1, "positive", "POSITIVE"), ("m3", 1, "positive", "positive"),
            ("m1", 2, "negative", "negative"), ("m2", 2, "negative", "negative"), ("m3", 2, "negative", None),
            ("m1", 3, "neutral", "neutral"), ("m2", 3, "neutral", "neutral"), ("m3", 3, "neutral", "neutral")]
    predictions = spark.createDataFrame(data, "model string, sample_id long, y_true string, y_pred string")
    wide = evaluation.aligned_predictions(predictions, ["m1", "m2", "m3"], ["sample_id"])
    assert {r.sample_id: r.pred_m1 for r in wide.collect()} == {1: "mixed", 2: "negative", 3: "neutral"}
    errors = evaluation.error_analysis(wide, "m1", "m2", "m3")
    assert rows(errors, "sample_id") == [(1,), (2,)]
    texts = spark.createDataFrame([(1, "x" * 200)], "sample_id long, text string")
    found = {r.sample_id: r.text_snippet for r in evaluation.with_snippets(errors, texts, ["sample_id"]).collect()}
    assert found == {1: "x" * 120 + "...", 2: None}


def test_whole_vocabulary(spark):
    df = spark.createDataFrame([(1, "good sound good bass"), (2, "bad sound"), (3, "rare word here")],
                               "row_id long, features_text string")
    whole = models.tfidf_weights(df, size=None)
    bounded = models.tfidf_weights(df, size=50)
    assert rows(whole.withColumn("weight", F.round("weight", 9))) == rows(
        bounded.withColumn("weight", F.round("weight", 9)))
    assert models.vocabulary(df, size=None).count() == 13


def test_texts_that_part_after_a_thousand_characters_stay(spark):
    raw = spark.createDataFrame([(i, "d", "word " * 250 + end, 5.0) for i, end in enumerate("ab")],
                                "row_id long, domain string, text string, rating double")
    assert cleaning.clean_reviews(raw).count() == 2
    assert cleaning.cleaning_funnel(raw).first()["duplicates_removed"] == 0
    assert cleaning.clean_reviews(raw, max_chars=1000).count() == 1


def test_small_means_rows_and_bytes(spark):
    texts = spark.range(10).select(F.repeat(F.lit("x"), 1000).alias("t"), F.array(F.lit("y")).alias("a"))
    assert skew.is_small(texts, 10, 20_000) and not skew.is_small(texts, 10, 5_000) and not skew.is_small(texts, 9, 20_000)


def test_known_hot_keys_are_not_counted_again(spark):
    left = spark.range(3000).select(F.lit("k").alias("key"), "id")
    right = spark.createDataFrame([("k", 1)], "key string, v long")
    hot = skew.hot_from_counts(left.groupBy("key").agg(F.count("*").alias("n")), "key", "n", 500)
    assert [tuple(r) for r in hot.collect()] == [("k", 6)]
    assert skew.salted_join(left, right, "key", rows_per_task=500, hot=hot).count() == 3000
