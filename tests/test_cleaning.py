from conftest import rows
from pyspark.sql import functions as F

from voxmill.operators import cleaning, products

FUNNEL = [
    (1, "Excellent headphones! Clear audio and comfortable.", "5", "P1"),
    (2, "Excellent headphones! Clear audio and comfortable.", "5", "P1"),
    (3, "", "1", "P2"), (4, "ok", "3", "P3"),
    (5, "Broke immediately. Poor quality.", "1", "P4"),
    (6, "Average device. Works fine enough.", "3", "P5"),
]


def raw(spark, data=FUNNEL):
    return spark.createDataFrame(
        data, "row_id long, text string, rating string, parent_asin string").withColumn(
        "domain", F.lit("Electronics"))


def test_funnel(spark):
    row = cleaning.cleaning_funnel(raw(spark)).first()
    assert (row.reviews_before, row.missing_removed, row.short_removed, row.duplicates_removed,
            row.unlabeled_removed, row.reviews_after) == (6, 1, 1, 1, 0, 3)
    assert (row.negative_count, row.neutral_count, row.positive_count) == (1, 1, 1)
    kept = cleaning.clean_reviews(raw(spark))
    assert rows(kept, "row_id", "sentiment") == [
        (1, "positive"), (5, "negative"), (6, "neutral")]


def test_funnel_counts_unlabeled_rows(spark):
    more = FUNNEL + [(7, "A text with an odd rating.", "3.5", "P6"),
                     (8, "A text with an odd rating.", "5", "P6")]
    row = cleaning.cleaning_funnel(raw(spark, more)).first()
    removed = (row.missing_removed + row.short_removed + row.duplicates_removed
               + row.unlabeled_removed)
    assert row.unlabeled_removed == 1
    assert row.reviews_before - removed == row.reviews_after == 3
    assert cleaning.clean_reviews(raw(spark, more)).count() == 3


def test_cap_decides_duplicates(spark):
    long = "word " * 300
    data = [(1, long + "one", "5", "P"), (2, long + "two", "5", "P")]
    assert cleaning.clean_reviews(raw(spark, data), max_chars=1000).count() == 1
    assert cleaning.clean_reviews(raw(spark, data)).count() == 2
    assert cleaning.clean_reviews(raw(spark, data), max_chars=None).count() == 2


def test_hot_text_is_reduced_before_the_shuffle(spark):
    df = spark.range(20000).select(
        F.col("id").alias("row_id"),
        F.when(F.col("id") % 3 == 0, "same").otherwise(F.col("id").cast("string")).alias("text"))
    first = cleaning.keep_first(df, [cleaning.text_key(F.col("text"))], "row_id")
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert first.where("text = 'same'").collect()[0].row_id == 0
    assert first.count() == 1 + 20000 - 6667


def test_cleaning_is_not_evaluated_twice(spark):
    df = raw(spark).withColumn("rating", F.col("rating").try_cast("double"))
    plan = cleaning.clean_reviews(df)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("<[^>]+>") == 1


REVIEWS = [(1, "P1", 5.0), (2, "P1", 4.0), (3, "P2", 1.0), (4, "P3", 3.0)]
META = [
    (1, "P1", "<b>Headphones</b>", "4.5", "$29.99", ["High quality", None, "Wireless"],
     ["Electronics", "Audio"], " Acme   Inc "),
    (2, " P1 ", "Duplicate", "1", None, None, None, None),
    (3, "P2", "Other", "x", " nan ", [], [" a ", None], None),
    (4, None, "No key", "2", "1", None, None, None),
]


def reviews(spark):
    return spark.createDataFrame(REVIEWS, "row_id long, parent_asin string, rating double"
                                 ).withColumn("domain", F.lit("Electronics"))


def meta(spark):
    return spark.createDataFrame(
        META, "row_id long, parent_asin string, title string, average_rating string, price string,"
        " description array<string>, categories array<string>, store string").withColumn(
        "domain", F.lit("Electronics"))


def test_clean_metadata(spark):
    quality = products.metadata_quality(meta(spark)).first()
    assert (quality.raw_metadata_count, quality.missing_parent_asin,
            quality.duplicate_parent_asin, quality.clean_metadata_count) == (4, 1, 1, 2)
    by_key = {r.parent_asin: r for r in products.clean_metadata(meta(spark)).collect()}
    p1, p2 = by_key["P1"], by_key["P2"]
    assert (p1.title, p1.description, p1.categories, p1.average_rating, p1.price, p1.store) == (
        "Headphones", "High quality Wireless", ["Electronics", "Audio"], 4.5, "$29.99", "Acme Inc")
    assert (p2.price, p2.average_rating, p2.categories, p2.description, p2.store) == (
        "None", None, ["a"], "", "")


def test_join_never_multiplies(spark):
    joined = products.join_reviews_with_products(reviews(spark), meta(spark))
    assert joined.count() == 3
    assert rows(products.unmatched_reviews(reviews(spark), meta(spark)), "row_id") == [(4,)]
    assert rows(products.unmatched_products(reviews(spark), meta(spark)), "parent_asin") == [("P3",)]
    check = products.join_validation(reviews(spark), meta(spark)).first().asDict()
    assert check == {
        "domain": "Electronics", "reviews_count_before_join": 4, "metadata_count_before_join": 4,
        "missing_parent_asin_in_reviews": 0, "missing_parent_asin_in_metadata": 1,
        "duplicate_metadata_parent_asin": 1, "unmatched_reviews_count": 1,
        "unmatched_unique_products": 1, "joined_reviews_count": 3}


def test_joined_rows_are_observed(spark):
    from pyspark.sql import Observation

    seen = Observation("joined")
    products.join_reviews_with_products(reviews(spark), meta(spark), seen).collect()
    assert seen.get["joined"] == 3


def test_minimum_reviews(spark):
    data = [(i, "P_MANY" if i < 25 else "P_FEW") for i in range(30)]
    df = spark.createDataFrame(data, "row_id long, parent_asin string").withColumn(
        "domain", F.lit("Electronics"))
    report = products.product_report(df).first()
    assert (report.reviews_before_product_filtering, report.unique_products,
            report.products_with_min_reviews, report.reviews_remaining,
            report.avg_reviews_per_product, report.median_reviews_per_product) == (
        30, 2, 1, 25, 25.0, 25.0)
    empty = products.product_report(df.where("row_id >= 25")).first()
    assert (empty.avg_reviews_per_product, empty.median_reviews_per_product) == (0.0, 0.0)
    kept, _ = products.filter_by_min_reviews(df, df)
    assert kept.count() == 25
    twenty = products.products_with_min_reviews(df.where("row_id < 20"))
    assert twenty.count() == 1


def test_products_are_kept_per_domain(spark):
    data = [(i, "P", "Electronics" if i < 25 else "Fashion") for i in range(30)]
    df = spark.createDataFrame(data, "row_id long, parent_asin string, domain string")
    catalog = spark.createDataFrame(
        [(1, "P", "Electronics", "e"), (2, "P", "Fashion", "f")],
        "row_id long, parent_asin string, domain string, title string")
    kept, meta_kept = products.filter_by_min_reviews(df, catalog)
    assert kept.count() == 25 and rows(meta_kept, "domain") == [("Electronics",)]
    joined = products.join_reviews_with_products(df, catalog)
    assert dict(joined.groupBy("product_title").count().collect()) == {"e": 25, "f": 5}
    fewer = products.unmatched_reviews(df, catalog.where("domain = 'Fashion'"))
    assert fewer.count() == 25


def test_prices(spark):
    df = spark.createDataFrame([("$1,299.50",), (" None ",), (None,)], "p string")
    got = df.select(products.price_text(F.col("p")), products.price_number(F.col("p"))).collect()
    assert [tuple(r) for r in got] == [("$1,299.50", 1299.5), ("None", None), ("None", None)]


def test_only_rows_that_may_be_duplicates_are_compared(spark):
    more = FUNNEL + [(7, "A text with an odd rating.", "3.5", "P6"), (8, "A text with an odd rating.", "5", "P6"),
                     (9, "Another text with an odd rating.", "x", "P6"), (None, "A text without any row id.", "5", "P6"),
                     (10, " Broke immediately.  Poor quality.", "4", None)]
    other = raw(spark, more[:5]).withColumn("domain", F.lit("Fashion"))
    data = raw(spark, more).unionByName(other).unionByName(raw(spark, more[4:5]))
    repeated = cleaning.repeated_texts(data)
    assert repeated.count() == 4
    found, want = cleaning.clean_reviews(data, repeated=repeated), cleaning.clean_reviews(data)
    key = lambda r: str(r)
    assert sorted(map(key, found.select(want.columns).collect())) == sorted(map(key, want.collect()))
    counts = cleaning.cleaning_funnel(data, repeated=repeated)
    assert rows(counts) == rows(cleaning.cleaning_funnel(data)) and counts.count() == 2
    assert cleaning.repeated_texts(data, most=3) is None
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("LeftAnti") < plan.index("Window") < plan.index("LeftSemi")


def test_join_carries_the_reviews_of_each_product(spark):
    keys = [("F", " P1")] * 2 + [("F", "P1 ")] * 2 + [("F", "P2"), ("F", None), (None, "P1"), ("F", "P9")]
    df = spark.createDataFrame([(i, *k) for i, k in enumerate(keys)], "row_id long, domain string, parent_asin string")
    catalog = spark.createDataFrame([("F", "P1", 1, "a"), ("F", "P2", 2, "b"), ("F", "P3", 3, "c")],
                                    "domain string, parent_asin string, row_id long, title string")
    sizes = products.key_counts(df)
    checked = [products.join_validation(*x).orderBy("domain").collect() for x in ((sizes, catalog, "n_reviews"), (df, catalog))]
    assert checked[0] == checked[1] and len(checked[0]) == 2
    joined = products.join_reviews_with_products(df, catalog, sizes=sizes)
    plain = products.join_reviews_with_products(df, catalog)
    assert {(r.row_id, r.n_reviews) for r in joined.collect()} == {(0, 4), (1, 4), (2, 4), (3, 4), (4, 1)}
    for least in (1, 3):
        kept, some = products.filter_by_min_reviews(joined, catalog, least, "n_reviews")
        want, same = products.filter_by_min_reviews(plain, catalog, least)
        assert rows(kept.select(want.columns)) == rows(want) and rows(some) == rows(same)
    plan = products.reviews_with_min(joined, 3, "n_reviews")._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" not in plan
