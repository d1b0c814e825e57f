"""Stored sketches: files are sketched once, merged numbers are within their bounds."""

from pyspark.sql import functions as F

from voxmill.session import new_path
from voxmill.sources import sketches


def test_new_files_are_added_and_merged(spark):
    files, path = new_path(spark, "files"), new_path(spark, "sketches") + ".parquet"
    data = spark.range(20_000).select(
        (F.col("id") * 7919 % 20_011).alias("x"), (F.col("id") % 3000).alias("k"),
        F.when(F.col("id") % 3 > 0, "hot").when(F.col("id") % 2 == 0, "rare").alias("g"))
    data.where("k < 1500").repartition(2).write.parquet(files)
    assert sketches.sketch_new_files(spark.read.parquet(files), path, ["g"], "x", "k") == 2
    data.where("k >= 1500").repartition(3).write.mode("append").parquet(files)
    assert sketches.sketch_new_files(spark.read.parquet(files), path, ["g"], "x", "k") == 3
    assert sketches.sketch_new_files(spark.read.parquet(files), path, ["g"], "x", "k") == 0
    assert spark.read.parquet(path).count() == 15  # three groups of five files
    exact = {r.g: r for r in data.groupBy("g").agg(
        F.count("*").alias("n"), F.count_distinct("k").alias("k"), F.collect_list("x").alias("xs")).collect()}
    for r in sketches.sketched_numbers(spark, path, ["g"], (0.05, 0.5, 0.95)).collect():
        true = exact[r.g]
        assert r.n == true.n and abs(r.distinct_keys - true.k) <= 0.05 * true.k
        for point, estimate in zip((0.05, 0.5, 0.95), r.quantiles):
            assert abs(sum(x <= estimate for x in true.xs) / true.n - point) <= 0.01
    total = sketches.merged(spark, path, []).first()
    assert total.n == 20_000
