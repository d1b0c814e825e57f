import pandas as pd
import pytest
from conftest import rows
from pyspark.sql import functions as F

from voxmill.operators import profile


@pytest.fixture(scope="module")
def data(spark):
    pdf = pd.DataFrame({
        "domain": ["a"] * 7 + ["b"] * 5,
        "rating": [5, 4, 5, 1, 3, 5, 2, 1, 1, 5, 4, 3],
        "helpful_vote": [0, 0, 1, 2, 5, 21, 3, 0, 0, 0, 6, 7],
        "verified_purchase": [True, False] * 6,
        "text": ["w " * (i + 1) for i in range(12)],
    }).astype({"rating": float})
    pdf["sentiment"] = pdf.rating.map(
        lambda r: "negative" if r <= 2 else "neutral" if r == 3 else "positive")
    return pdf, spark.createDataFrame(pdf)


def test_moments_match_pandas(data):
    pdf, df = data
    got = {r.domain: r for r in profile.moments(df, "rating", ["domain"]).collect()}
    for name, group in pdf.groupby("domain")["rating"]:
        r = got[name]
        assert (r.n, r["median"]) == (len(group), group.median())
        assert [r["mean"], r["std"], r["skew"]] == pytest.approx(
            [group.mean(), group.std(), group.skew()], abs=1e-6)
    whole = profile.moments(df, "rating").first()
    assert whole["skew"] == pytest.approx(pdf.rating.skew(), abs=1e-6)


def test_skew_needs_three_values(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("b", 1.0), ("b", 1.0), ("b", 1.0)],
                               "g string, x double")
    assert all(r["skew"] is None for r in profile.moments(df, "x", ["g"]).collect())


def test_describe_matches_pandas(data):
    pdf, df = data
    row = profile.describe(df, "helpful_vote", (0.25, 0.5, 0.9, 0.99)).first()
    d = pdf.helpful_vote.describe(percentiles=[0.25, 0.5, 0.9, 0.99])
    assert [row["count"], row["mean"], row["std"], row["min"], row["max"], row.p25, row.p50,
            row.p90, row.p99] == pytest.approx(
        [d[k] for k in ("count", "mean", "std", "min", "max", "25%", "50%", "90%", "99%")],
        abs=1e-6)


def test_shares_add_up(data):
    _, df = data
    for groups in ([], ["domain"]):
        counts = profile.value_counts(df, "rating", groups)
        total = counts.groupBy(*groups).agg(F.sum("pct").alias("s")).collect()
        assert all(r.s == pytest.approx(100, abs=1e-4) for r in total)
    tiers = profile.tiers(df, "helpful_vote", profile.VOTE_TIERS, ["domain"])
    assert tiers.count() == 10
    assert tiers.agg(F.sum("n")).first()[0] == 12


def test_tier_bounds(data):
    _, df = data
    got = {r.tier: r.n for r in profile.tiers(df, "helpful_vote", profile.VOTE_TIERS).collect()}
    assert got == {"0": 5, "1-2": 2, "3-5": 2, "6-20": 2, ">20": 1}


def test_crosstab(data):
    pdf, df = data
    expected = pd.crosstab(pdf.rating, pdf.domain, normalize="columns") * 100
    for r in profile.crosstab(df, "rating", "domain", "columns").collect():
        assert r.pct == pytest.approx(expected.loc[r.rating, r.domain], abs=1e-5)
    wide = profile.crosstab_wide(df, "domain", "verified_purchase", [False, True], "rows")
    assert rows(wide, "domain", "pct_true")[0] == ("a", pytest.approx(400 / 7, abs=1e-5))


def test_cdf_ends_at_one(data):
    _, df = data
    cdf = profile.cumulative_distribution(df, "domain", "rating")
    assert rows(cdf.groupBy("domain").agg(F.max("cdf"))) == [("a", 1.0), ("b", 1.0)]


def test_box_statistics(spark):
    df = spark.createDataFrame([("g", v) for v in (1, 2, 3, 4, 100)], "g string, x int")
    row = profile.box_statistics(df, ["g"], "x").first()
    assert (row.q1, row["median"], row.q3, row.whisker_low, row.whisker_high) == (2, 3, 4, 1, 4)


def test_histogram_closes_last_bin(spark):
    df = spark.range(0, 101).withColumnRenamed("id", "x")
    got = dict(profile.histogram(df, "x", 10).collect())
    assert got == {i: 10 if i < 9 else 11 for i in range(10)}
    same = spark.createDataFrame([(5,), (5,)], "x int")
    assert rows(profile.histogram(same, "x", 10)) == [(0, 2)]
    logs = spark.createDataFrame([(1,), (10,), (100,)], "x int")
    assert rows(profile.histogram(logs, "x", 2, log=True)) == [(0, 1), (1, 2)]


def test_trim_and_quantiles(spark):
    df = spark.range(1, 101).withColumnRenamed("id", "x")
    assert profile.trim_at_percentile(df, "x", 0.99).count() == 99
    assert profile.quantiles(df, [], "x", {"m": 0.5}).first().m == 50.5
    assert 49 <= profile.quantiles(df, [], "x", {"m": 0.5}, exact=False).first().m <= 51


def test_by_verification(data):
    pdf, df = data
    got = {r.verified_purchase: r for r in profile.by_verification(df).collect()}
    for flag, g in pdf.groupby("verified_purchase"):
        r = got[flag]
        assert [r.mean_rating, r.median_rating, r.std_rating, r.pct_positive] == pytest.approx(
            [g.rating.mean(), g.rating.median(), g.rating.std(),
             (g.sentiment == "positive").mean() * 100], abs=1e-6)
        assert r.avg_words == pytest.approx(g.text.str.split().str.len().mean(), abs=1e-6)


def test_votes_and_difference(data):
    pdf, df = data
    r = {x.domain: x for x in profile.votes_by_domain(df).collect()}["b"]
    assert (r.median_votes, r.max_votes, r.zero_pct, r.at_least_5_pct) == (0.0, 7, 60.0, 40.0)
    d = profile.mean_difference(df, "rating", "domain", "a", "b").first()
    means = pdf.groupby("domain").rating.mean()
    assert d.difference == pytest.approx(means["a"] - means["b"], abs=1e-6)


def test_missing_audit(spark):
    df = spark.createDataFrame([(1, None), (2, "x"), (None, None)], "a int, b string")
    got = {r.column_name: (r.missing, r.missing_pct, r.data_type)
           for r in profile.missing_audit(df).collect()}
    assert got == {"a": (1, 33.333, "int"), "b": (2, 66.667, "string")}
