import pytest
from conftest import rows
from pyspark.sql import functions as F

from voxmill.operators import sampling, skew


def hot(spark, n=9000):
    """A third of the rows share one key."""
    return spark.range(n).select(
        F.col("id").alias("row_id"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(
            F.concat(F.lit("k"), F.col("id") % 500)).alias("key"))


def test_hot_keys_are_found_and_few(spark):
    assert rows(skew.hot_keys(hot(spark), "key", 1000)) == [("hot", 3)]
    assert skew.hot_keys(hot(spark), "key").isEmpty()
    assert skew.hot_keys(hot(spark), "key", 10).count() <= 900


def test_salted_join_equals_plain_join(spark):
    left = hot(spark)
    right = left.select("key").distinct().where("key <> 'k1'").withColumn(
        "value", F.length("key"))
    for how in ("inner", "left", "left_semi", "left_anti"):
        plain = left.join(right, "key", how)
        for limits in ({"rows_per_task": 500}, {"rows_per_task": 5, "max_broadcast": 3}, {}):
            salted = skew.salted_join(left, right, "key", how, identity=["row_id"], **limits)
            assert salted.exceptAll(plain.select(*salted.columns)).isEmpty()
            assert salted.count() == plain.count()
    with pytest.raises(ValueError):
        skew.salted_join(left, right, "key", "full")


def test_salting_spreads_the_hot_key(spark):
    left = hot(spark)
    right = left.select("key").distinct()
    spread = skew.salted_join(left, right, "key", rows_per_task=500, identity=["row_id"])
    assert "_salt" in spread._jdf.queryExecution().optimizedPlan().toString()
    salt = F.pmod(F.xxhash64("row_id"), F.lit(6))
    sizes = [r[1] for r in left.where("key = 'hot'").groupBy(salt).count().collect()]
    assert len(sizes) == 6 and max(sizes) < 2 * 500


def test_semi_join_both_ways(spark):
    keys = spark.createDataFrame([("hot",), ("k2",)], "key string")
    small = skew.semi_join(hot(spark), keys, "key")
    large = skew.semi_join(hot(spark), keys, "key", max_rows=0)
    assert rows(small, "row_id") == rows(large, "row_id")
    assert small.where("key not in ('hot', 'k2')").isEmpty()


def test_rank_in_group_is_exact(spark):
    df = hot(spark, 3000)
    ranked = skew.rank_in_group(
        df, ["key"], [F.col("row_id")], F.shiftright("row_id", 5), out="place")
    got = {(r.key, r.row_id): r.place for r in ranked.collect()}
    seen = {}
    for row_id, key in sorted((r.row_id, r.key) for r in df.collect()):
        assert got[(key, row_id)] == seen.get(key, 0)
        seen[key] = seen.get(key, 0) + 1


def test_ranking_shuffles_the_rows_once(spark):
    df = hot(spark, 3000).withColumn("payload", F.repeat(F.lit("x"), 20))
    ranked = skew.rank_in_group(df, ["key"], [F.col("row_id")], F.shiftright("row_id", 5), "n")
    plan = ranked._jdf.queryExecution().executedPlan().toString()
    carrying = [line for line in plan.split("\n") if "Exchange" in line and "_bucket" in line]
    # One for the rows, two for the counts (made, and sent back to the rows).
    assert len(carrying) <= 3


def test_rank_in_group_keeps_null_groups(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, "a")], "row_id long, key string")
    ranked = skew.rank_in_group(df, ["key"], [F.col("row_id")], F.shiftright("row_id", 1), "place")
    assert rows(ranked, "row_id", "place") == [(1, 0), (2, 1), (3, 0)]


def labelled(spark, counts):
    data, i = [], 0
    for label, n in counts.items():
        for _ in range(n):
            data.append((i, "all", label))
            i += 1
    return spark.createDataFrame(data, "row_id long, domain string, sentiment string")


def test_split_sizes(spark):
    for counts, expected in [
        ({"positive": 70, "negative": 20, "neutral": 10}, (70, 15, 15)),
        ({"positive": 30, "negative": 15, "neutral": 15}, (42, 9, 9)),
        ({"positive": 353, "negative": 54, "neutral": 33}, (308, 66, 66)),
        ({"positive": 226, "negative": 20, "neutral": 20}, (186, 40, 40)),
        ({"positive": 600, "negative": 60, "neutral": 46}, (494, 106, 106)),
    ]:
        split = sampling.stratified_split(labelled(spark, counts), ["domain"]).cache()
        row = sampling.split_summary(split, ["domain"]).first()
        assert (row.train, row.validation, row.test) == expected
        assert row.total == sum(counts.values())
        per_split = split.groupBy("split").agg(F.count_distinct("sentiment")).collect()
        assert all(r[1] == 3 for r in per_split)
        assert split.select("row_id").distinct().count() == row.total


def test_split_is_reproducible_and_seeded(spark):
    df = labelled(spark, {"positive": 60, "negative": 40})
    a = rows(sampling.stratified_split(df, ["domain"]), "row_id", "split")
    b = rows(sampling.stratified_split(df.repartition(5), ["domain"]), "row_id", "split")
    c = rows(sampling.stratified_split(df, ["domain"], seed=1), "row_id", "split")
    assert a == b != c


def test_sample_per_group(spark):
    df = labelled(spark, {"positive": 60, "negative": 4})
    got = sampling.sample_per_group(df, ["sentiment"], 10)
    assert dict(got.groupBy("sentiment").count().collect()) == {"positive": 10, "negative": 4}


@pytest.mark.parametrize("ids", ["single", "repeated", "null"])
def test_split_is_the_rank_along_the_digest(spark, ids):
    import hashlib

    def identity(i):
        return i if ids == "single" else i // 40 if ids == "repeated" else None if i % 3 else i

    data = [("ab"[i % 5 == 0], identity(i), ("positive", "negative", None)[i % 7 % 3], f"text {i}") for i in range(400)]
    df = spark.createDataFrame(data, "domain string, row_id long, sentiment string, text string").repartition(6)
    split = sampling.stratified_split(df, ["domain"])
    assert split.columns == [*df.columns, "split"]
    sizes = {(r.domain, r.sentiment): r for r in sampling.split_sizes(df, ["domain"], "sentiment").collect()}
    groups = {}
    for r in split.collect():
        order = "" if r.row_id is None else hashlib.md5(f"{sampling.SEED}:{r.row_id}".encode()).hexdigest()
        groups.setdefault((r.domain, r.sentiment), []).append((order, ("train", "validation", "test").index(r.split)))
    assert sum(map(len, groups.values())) == 400
    for key, found in groups.items():
        n = sizes[key]
        assert [p for _, p in sorted(found)] == [0] * n.n_train + [1] * n.n_val + [2] * n.n_test


def test_split_does_not_shuffle_the_rows(spark):
    df = spark.createDataFrame([("a", i, "positive", "t") for i in range(50)],
                               "domain string, row_id long, sentiment string, text string")
    plan = sampling.stratified_split(df, ["domain"])._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan
