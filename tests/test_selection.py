"""Distributed selection and prefix sums: exact results from plans that hold no group in a task."""

import random
import re

import pytest
from pyspark.sql import functions as F

from conftest import rows
from voxmill.operators import profile, retrieval, sampling, skew


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def grouped(spark, n):
    return spark.range(n).select(
        F.col("id").alias("row_id"), F.when(F.col("id") % 3 == 0, "rare").when(F.col("id") % 50 == 1, None)
        .otherwise("hot").alias("domain"), F.repeat(F.lit("x"), 30).alias("text"))


@pytest.mark.parametrize("n, at_once, digits", [(7, 100_000, 3), (7, 3, 1), (500, 2, 2), (5000, 10, 1), (1, 1, 3)])
def test_sample_is_the_first_rows_of_the_order(spark, n, at_once, digits):
    df = grouped(spark, 3000)
    got = sampling.sample_per_group(df, ["domain"], n, position="place", bucket_digits=digits, rows_at_once=at_once)
    want, seen = [], {}
    for r in df.withColumn("o", sampling.seeded_order("row_id")).orderBy("o").collect():
        seen[r.domain] = seen.get(r.domain, 0) + 1
        if seen[r.domain] <= n:
            want.append((r.row_id, seen[r.domain]))
    assert rows(got, "row_id", "place") == sorted(want)


def test_sample_of_null_and_repeated_ids(spark):
    df = spark.createDataFrame([(None, "a", f"t{i}") for i in range(40)] + [(1, "a", "u")] * 30 + [(2, None, "v")],
                               "row_id long, domain string, text string")
    got = sampling.sample_per_group(df, ["domain"], 60, rows_at_once=5, bucket_digits=1).collect()
    assert len(got) == 61 and len({r.text for r in got if r.row_id is None}) == 40
    few = [sampling.sample_per_group(df.repartition(k), ["domain"], 5).collect() for k in (1, 6)]
    assert sorted(map(str, few[0])) == sorted(map(str, few[1]))
    assert sampling.sample_per_group(df, ["domain"], 0).isEmpty()
    assert sampling.sample_per_group(df.limit(0), ["domain"], 3).isEmpty()


def test_selection_filters_below_every_shuffle_of_rows(spark):
    df = grouped(spark, 20_000)
    near = sampling.candidates_per_group(df, ["domain"], 50, rows_at_once=200)
    plan = plan_of(near)
    assert not re.search(r"Exchange (hash|range|single|round)", plan) and "Window" not in plan
    # At most n rows of a group, and the rows of the beginning in which n is reached.
    assert near.count() <= 3 * (50 + 200)


def ids(kind, n):
    draw = random.Random(4)
    return {"digests": [f"{draw.getrandbits(64):016x}" for _ in range(n)], "runs": list(range(n)),
            "ties": [draw.randrange(5) for _ in range(n)], "nulls": [None] * n}[kind]


@pytest.mark.parametrize("kind", ["digests", "runs", "ties", "nulls"])
def test_positions(spark, kind):
    values = ids(kind, 900)
    data = [(v, "hot" if i % 3 else f"p{i % 21}", i) for i, v in enumerate(values)]
    data += [(v, None, 1000 + i) for i, v in enumerate(values[:5])]
    df = spark.createDataFrame(data, f"row_id {'string' if kind == 'digests' else 'long'}, parent_asin string, n long")
    got = retrieval.review_positions(df.repartition(4), parts=7).collect()
    assert len(got) == len(data) and got[0].asDict().keys() == {"row_id", "parent_asin", "n", "review_index"}
    by_product = {}
    for r in got:
        by_product.setdefault(r.parent_asin, []).append((r.review_index, r.row_id))
    for some in by_product.values():
        some.sort()
        assert [i for i, _ in some] == list(range(len(some)))
        known = [v for _, v in some if v is not None]
        assert known == sorted(known)


def test_no_window_over_a_whole_group(spark):
    df = spark.range(6000).select(F.md5(F.col("id").cast("string")).alias("row_id"), F.lit("one").alias("parent_asin"))
    ranged = skew._by_ranges(df, ["parent_asin"], [F.col("row_id")], 12)
    sizes = [r["n"] for r in ranged.groupBy("_group", "_part").agg(F.count("*").alias("n")).collect()]
    assert len(sizes) == 12 and max(sizes) < 6000 / 4
    assert "Window" not in plan_of(skew.position_in_group(df, ["parent_asin"], [F.col("row_id")]))


def test_equal_keys_fill_several_ranges(spark):
    df = spark.range(4000).select(F.lit(None).cast("long").alias("row_id"), F.lit("one").alias("p"), "id")
    ranged = skew._by_ranges(df, ["p"], [F.col("row_id")], 8)
    assert ranged.select("_part").distinct().count() == 8


def test_cumulative_distribution_of_a_continuous_value(spark):
    df = spark.range(500).select((F.col("id") * 0.7 % 31).alias("x"), F.when(F.col("id") % 4 > 0, "a").alias("g"))
    got = {(r.g, r.x): r.cdf for r in profile.cumulative_distribution(df, "g", "x", parts=6).collect()}
    values = {}
    for r in df.collect():
        values.setdefault(r.g, []).append(r.x)
    for g, some in values.items():
        for x in some:
            assert got[g, x] == round(sum(y <= x for y in some) / len(some), 6)
    plan = plan_of(profile.cumulative_distribution(df, "g", "x"))
    assert all("_part" in line for line in plan.split("\n") if re.search(r"\bWindow\b", line))
