"""Product lookup through the stored gram index."""

import random

import pytest
from pyspark.sql import functions as F

from voxmill.operators import insights, titles
from voxmill.session import new_path


def products(spark):
    draw = random.Random(3)
    names = ["".join(draw.choices("abcé ", k=draw.randint(0, 12))) for _ in range(150)]
    data = [(["A", "B"][i % 2], f"P{i}", None if i % 50 == 7 else n.title(), draw.randint(1, 9)) for i, n in enumerate(names)]
    return spark.createDataFrame(data, "domain string, parent_asin string, title string, total_reviews long")


WANTED = ["p3", " P4 ", "p999", "a", "é", "ab", "abc", "CAB", "bca", "a b", "b a c", "zzz", "  ", "", "caé", "aaab", "%", None]


def test_lookup_equals_the_plain_search(spark):
    df = products(spark)
    index = titles.write_title_index(df, new_path(spark, "titles"))
    asked = spark.createDataFrame([(w,) for w in WANTED + WANTED], "wanted string")
    got = {r.wanted: r.parent_asin for r in titles.lookup_products(df, asked, index).collect()}
    want = {r.wanted: r.parent_asin for r in insights.find_products(df, [w for w in WANTED if w is not None]).collect()}
    assert got == want and len(got) > 8


def test_many_strings_stay_out_of_the_plan(spark):
    df = products(spark)
    index = titles.write_title_index(df, new_path(spark, "titles"))
    asked = spark.range(10_000).select(F.concat(F.lit("needle"), "id").alias("wanted"))
    found = titles.lookup_products(df, asked, index)
    plan = found._jdf.queryExecution().toString()
    assert "needle123" not in plan and "NestedLoop" not in plan and "Cartesian" not in plan
    assert found.isEmpty()


@pytest.mark.parametrize("n", [0, 1])
def test_empty_sides(spark, n):
    df = products(spark).limit(n * 5)
    index = titles.write_title_index(df, new_path(spark, "titles"))
    asked = spark.createDataFrame([("p1",)] * (1 - n), "wanted string")
    assert titles.lookup_products(df, asked, index).isEmpty()
