"""Product lookup by title substrings through a stored table of title grams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voxmill.operators.skew import broadcast_if_small
from voxmill.sources.tables import read_table, write_table

#: Titles are indexed by their runs of one to GRAM characters: a string of fewer than GRAM characters is
#: a gram itself, a longer one contains its runs of GRAM.
GRAM = 3
KEY = ("domain", "parent_asin")


def _runs(text: Column, n: int) -> Column:
    """The distinct runs of ``n`` characters of a text."""
    starts = F.when(F.length(text) >= n, F.sequence(F.lit(1), F.length(text) - n + 1)).otherwise(
        F.array().cast("array<int>"))
    return F.array_distinct(F.transform(starts, lambda i: F.substring(text, i, F.lit(n))))


def title_grams(products: DataFrame) -> DataFrame:
    """(gram, domain, parent_asin): the grams of each product's title, lowered."""
    title = F.lower("title")
    grams = F.concat(*[_runs(title, n) for n in range(1, GRAM + 1)])
    return products.where(F.col("title").isNotNull()).select(F.explode(grams).alias("gram"), *KEY)


def write_title_index(products: DataFrame, path: str) -> str:
    """Store the grams, sorted, so that a lookup skips the parts of files that hold others; and, beside
    them, in how many titles each occurs."""
    grams = title_grams(products)
    write_table(grams.repartition("gram").sortWithinPartitions("gram"), f"{path}/grams.parquet")
    spark = products.sparkSession
    counts = read_table(spark, f"{path}/grams.parquet").groupBy("gram").agg(F.count("*").alias("titles"))
    write_table(counts.sortWithinPartitions("gram"), f"{path}/counts.parquet")
    return path


def lookup_products(products: DataFrame, asked: DataFrame, index: str) -> DataFrame:
    """``products`` with ``wanted`` for every string of ``asked`` (wanted) that means one: an exact id
    first, ignoring case, else the first product in table order whose title contains the string.

    Ids are found by an equi-join. Each other string takes its two rarest grams from the index; the
    products that have both are candidates, and only their titles are searched. A string with a gram
    that no title has is done at once. The strings are a table of any size; nothing of them enters the
    plan, and no string is held against all titles.
    """
    spark = products.sparkSession
    asked = asked.select("wanted").where(F.col("wanted").isNotNull()).distinct()
    exact = products.withColumn("_id", F.upper("parent_asin")).join(
        asked.withColumn("_id", F.upper(F.trim("wanted"))), "_id").drop("_id")
    rest = asked.join(exact.select("wanted"), "wanted", "left_anti")
    text = F.lower("wanted")
    grams = F.when(F.length(text) >= GRAM, _runs(text, GRAM)).otherwise(F.array(text))
    parts = rest.where(F.length("wanted") > 0).select("wanted", F.size(grams).alias("_n"), F.explode(grams).alias("gram"))
    known = parts.join(read_table(spark, f"{index}/counts.parquet"), "gram")
    rarest = known.groupBy("wanted").agg(
        F.count("*").alias("_known"), F.first("_n").alias("_n"),
        F.array_sort(F.collect_list(F.struct("titles", "gram"))).alias("_grams")).where("_known = _n").select(
        "wanted", F.slice("_grams", 1, 2).alias("_grams"))
    # As many rows as strings that can match; their postings come by an equi-join on the gram.
    chosen = broadcast_if_small(rarest.select(
        "wanted", F.size("_grams").alias("_of"), F.inline(F.transform("_grams", lambda g: F.struct(g["gram"].alias("gram"))))))
    postings = read_table(spark, f"{index}/grams.parquet").join(chosen, "gram")
    candidates = postings.groupBy("wanted", *KEY).agg(F.count("*").alias("_met"), F.first("_of").alias("_of")).where(
        "_met = _of").select("wanted", *KEY)
    named = products.join(candidates, list(KEY)).where(F.contains(F.lower("title"), text))
    # The empty string is in every title: it means the first product.
    first = products.where(F.col("title").isNotNull()).orderBy("domain", F.desc("total_reviews"), "parent_asin").limit(1)
    # Spelled so that it stays an equi-join, which a literal would not.
    nothing = F.coalesce(F.substring("parent_asin", 1, 0), F.lit(""))
    empty = first.withColumn("wanted", nothing).join(rest, "wanted", "left_semi")
    hits = exact.unionByName(named).unionByName(empty)
    place = Window.partitionBy("wanted").orderBy("domain", F.desc("total_reviews"), "parent_asin")
    return hits.withColumn("_n", F.row_number().over(place)).where("_n = 1").drop("_n")
