import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

from voxmill.operators import insights, products


@pytest.fixture(scope="module")
def tables(spark):
    data = [
        (1, "P1", "Electronics", 1.0, "negative", "negative", "Bad battery", "The charger died"),
        (2, "P1", "Electronics", 5.0, "positive", "negative", "Fine", "The box was crushed"),
        (3, "P1", "Electronics", 2.0, "negative", "neutral", "Battery", "slow battery"),
        (4, "P1", "Electronics", 3.0, "neutral", None, "", "So so"),
        (5, "p2", "Fashion", 5.0, "positive", None, "Love", "Nice color"),
        (6, "P3", "Fashion", 1.0, "negative", "negative", None, "nothing said"),
        (7, "P3", "Electronics", 4.0, "positive", "positive", None, "later domain"),
    ]
    reviews = spark.createDataFrame(
        data, "row_id long, parent_asin string, domain string, rating double, sentiment string, "
        "predicted_sentiment string, title string, text string")
    meta = spark.createDataFrame(
        [(1, "P1", "Great Headphones " + "x" * 80, "$5", 4.5, "s"),
         (2, "P1", "Second", "1", 1.0, "s"), (3, "p2", "Red shirt", "None", None, None)],
        "row_id long, parent_asin string, title string, price string, average_rating double, "
        "store string")
    return reviews, meta, insights.product_insights(reviews, meta).cache()


def test_insights_row(tables):
    r = tables[2].where("parent_asin = 'P1'").first()
    assert (r.total_reviews, r.positive_reviews, r.neutral_reviews, r.negative_reviews) == (4, 1, 1, 2)
    assert (r.positive_percentage, r.neutral_percentage, r.negative_percentage) == (25.0, 25.0, 50.0)
    assert (r.pred_positive_percentage, r.pred_neutral_percentage,
            r.pred_negative_percentage) == (0.0, 50.0, 50.0)
    assert (r.average_rating, r.meta_average_rating, r.price) == (2.75, 4.5, "$5")
    assert json.loads(r.top_complaint_aspects_json) == [
        {"aspect": "battery", "display_name": "Battery & Charging", "count": 2, "percentage": 100.0},
        {"aspect": "performance", "display_name": "Performance & Functionality", "count": 1,
         "percentage": 50.0}]
    assert r.top_complaints_summary == (
        "Battery & Charging (100.0%); Performance & Functionality (50.0%)")


def test_insights_without_complaints_or_metadata(tables):
    by = {r.parent_asin: r for r in tables[2].collect()}
    assert by["p2"].top_complaints_summary == "No severe complaint clusters detected."
    assert by["p2"].top_complaint_aspects_json == "[]"
    assert by["P3"].title == "Product P3" and by["P3"].price is None
    assert by["P3"].domain == "Fashion"  # the domain of the first review


def test_insights_columns_and_ranges(tables):
    df = tables[2]
    assert len(df.columns) == 19
    for c in [c for c in df.columns if c.endswith("percentage")]:
        assert df.where(~F.col(c).between(0, 100)).isEmpty()
    ordered = insights.sorted_insights(df).collect()
    assert [r.parent_asin for r in ordered] == ["P1", "P3", "p2"]


def test_one_shuffle_of_sums(tables):
    reviews, _, _ = tables
    plan = insights.product_totals(insights.enrich_reviews(reviews))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in text and text.count("regexp_extract_all") == 1


def test_lookup(tables):
    df = tables[2]
    got = {r.wanted: r.parent_asin for r in insights.find_products(
        df, [" P2 ", "p3", "RED shi", "headphones", "p", "(", "zzz"]).collect()}
    assert got == {" P2 ": "p2", "p3": "P3", "RED shi": "p2", "headphones": "P1", "p": "P1"}


def test_product_api(tables):
    df = tables[2]
    s = insights.product_sentiment(df, "p1").first()
    assert (s.total_reviews, s.negative_percentage) == (4, 50.0)
    a = insights.product_aspects(df, "P1").collect()
    assert [x.aspect for x in a] == ["battery", "performance"]
    with pytest.raises(insights.ProductNotFound, match="not found"):
        insights.product_sentiment(df, "nope")
    assert "not found" in insights.product_summary(df, "nope")


def test_summary_layout(tables):
    text = insights.product_summary(tables[2], "P1").split("\n")
    assert text[0] == "Product: Great Headphones " + "x" * 60 + "..."
    assert text[1:] == [
        "Domain: Electronics | ASIN: P1 | Rating: 2.8 / 5.0", "", "Total Reviews: 4", "",
        "Positive: 25%", "Neutral: 25%", "Negative: 50%", "", "Top complaints:",
        "1. Battery & Charging — 100%", "2. Performance & Functionality — 50%"]
    assert insights.product_summary(tables[2], "p2").endswith(
        "No significant complaint patterns detected.")


def test_product_info_and_catalog(tables):
    reviews, meta, _ = tables
    info = insights.product_info(reviews, meta)
    r = info.where("parent_asin = 'P1'").first()
    assert (r.total_reviews, r.average_rating, r.negative_count, r.negative_percentage) == (
        4, 2.75, 2, 50.0)
    listed = insights.catalog(info).collect()
    assert [x.parent_asin for x in listed] == ["P1", "P3", "p2"]
    assert listed[0].product_title.endswith("...") and len(listed[0].product_title) == 53
    assert listed[0].avg_rating == "2.75 ★"


def test_quadrants(tables):
    got = {r.parent_asin: r.quadrant for r in insights.quadrants(tables[2]).collect()}
    assert got == {"P1": "High Friction", "p2": "High Satisfaction", "P3": "High Friction"}


def test_only_negatives_are_tagged(tables):
    enriched = insights.enrich_reviews(tables[0])
    assert rows(enriched.where("size(aspects) > 0"), "row_id") == [(1,), (2,), (3,)]
    assert enriched.where("row_id = 4").first().full_text == "So so"


def test_predictions_fall_back_to_labels(tables):
    reviews = tables[0]
    assert insights.with_predictions(reviews.drop("predicted_sentiment")).where(
        "predicted_sentiment <> sentiment").isEmpty()
    assert insights.with_predictions(reviews).where("predicted_sentiment is null").isEmpty()


def test_top_products(tables):
    reviews, meta, _ = tables
    got = products.top_products(reviews, meta, 2).orderBy(F.desc("review_count")).collect()
    assert [(r.parent_asin, r.review_count) for r in got] == [("P1", 4), ("P3", 2)]
    assert got[1].title == "P3..."
