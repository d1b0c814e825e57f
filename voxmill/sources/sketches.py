"""Stored sketches of a table's files: quantiles and distinct keys of any set of groups without its rows.

Exact histograms stay the default (``profile``). Sketches serve tables that grow by files: a new file is
sketched once, and the sketches of all files are merged by group whenever numbers are wanted.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxmill.sources.tables import read_table

#: Size of a quantile sketch (rank error about 1.65 percent at 200, one percent less than half of it at
#: 800), and logarithm of the entries of a distinct-count sketch (error about 2 / sqrt(entries)).
QUANTILE_SIZE = 800
DISTINCT_BITS = 14


def sketch_new_files(df: DataFrame, path: str, groups: list[str], value: str, key: str) -> int:
    """Add to the sketch table at ``path`` a row for every group of every file of ``df`` that has none
    yet: (groups, file, n, values, keys). Only the rows of new files are aggregated. Returns how many
    files were new. Null values and keys are not counted by the sketches."""
    spark = df.sparkSession
    # The two places that name files write local ones differently.
    files = {re.sub("^file:/+", "file:/", f) for f in df.inputFiles()}
    try:
        files -= {r["file"] for r in read_table(spark, path).select("file").distinct().collect()}
    except FileNotFoundError:
        pass
    if not files:
        return 0
    # As many names as new files.
    rows = df.withColumn("file", F.regexp_replace(F.col("_metadata.file_path"), "^file:/+", "file:/"))
    decoded = spark.createDataFrame([(f,) for f in sorted(files)], "file string")
    new = rows.join(F.broadcast(decoded), "file", "left_semi")
    new.groupBy(*groups, "file").agg(
        F.count("*").alias("n"),
        F.kll_sketch_agg_double(F.col(value).cast("double"), F.lit(QUANTILE_SIZE)).alias("values"),
        F.theta_sketch_agg(F.col(key), F.lit(DISTINCT_BITS)).alias("keys"),
    ).write.mode("append").parquet(path)
    return len(files)


def merged(spark: SparkSession, path: str, groups: list[str]) -> DataFrame:
    """(groups, n, values, keys): the sketches of all files, merged by any of the stored groups."""
    return read_table(spark, path).groupBy(*groups).agg(
        F.sum("n").alias("n"), F.kll_merge_agg_double("values").alias("values"),
        F.theta_union_agg("keys", F.lit(DISTINCT_BITS)).alias("keys"))


def sketched_numbers(
    spark: SparkSession, path: str, groups: list[str], points: tuple[float, ...] = (0.25, 0.5, 0.75),
) -> DataFrame:
    """(groups, n, distinct_keys, quantiles): the estimates read off the merged sketches."""
    return merged(spark, path, groups).select(
        *groups, "n", F.theta_sketch_estimate("keys").cast("long").alias("distinct_keys"),
        F.array(*[F.kll_sketch_get_quantile_double("values", F.lit(p)) for p in points]).alias("quantiles"))
