"""Streams: first rows whatever the arrival, running results from sums of batches."""

import random

from pyspark.sql import functions as F

from conftest import rows
from voxmill.operators import cleaning, insights
from voxmill.session import new_path
from voxmill.streaming import reviews as stream


def files_of(spark, frames):
    path = new_path(spark, "files")
    for df in frames:
        df.coalesce(1).write.mode("append").parquet(path)
    return path


def test_first_rows_equal_keep_first_for_shuffled_files(spark):
    draw = random.Random(2)
    data = [(i, draw.choice(["x", "y", None]), f"t{draw.randrange(12)}" if i % 9 else None) for i in range(200)]
    draw.shuffle(data)
    schema = "row_id long, domain string, text string"
    parts = [spark.createDataFrame(data[i:i + 40], schema) for i in range(0, 200, 40)]
    path = files_of(spark, parts)
    stream.arbitrary_state(spark)
    out, state = new_path(spark, "first"), new_path(spark, "state")
    for _ in range(2):  # a second start has nothing new to read
        arriving = stream.read_stream(spark, path, parts[0].schema, files_per_trigger=1)
        stream.ingest_changes(stream.first_rows_stream(arriving, ["domain", "text"]), out, state).awaitTermination()
    got = stream.read_first_rows(spark, out).na.fill("-")
    first = {}
    for i, domain, text in sorted(data):
        first.setdefault((domain, text), i)
    assert rows(got, "row_id") == sorted((i,) for i in first.values())
    known = spark.createDataFrame(data, schema).where("domain is not null and text is not null")
    kept = cleaning.keep_first(known, [F.col("domain"), F.col("text")], F.col("row_id"))
    assert set(rows(kept, "row_id")) <= set(rows(got, "row_id"))


def reviews(spark, n, start):
    i = F.col("id")
    return spark.range(start, start + n).select(
        i.alias("row_id"), F.concat(F.lit("P"), i % 5).alias("parent_asin"),
        F.when(i % 5 == 4, "Fashion").otherwise("Electronics").alias("domain"), (i % 5 + 1).cast("double").alias("rating"),
        F.element_at(F.array(F.lit("negative"), F.lit("neutral"), F.lit("positive")), (i % 3 + 1).cast("int")).alias("sentiment"),
        F.lit("").alias("title"), F.when(i % 2 == 0, "the battery died").otherwise("poor quality, bad price").alias("text"))


def test_insights_from_deltas_and_a_bounded_store(spark):
    parts = [reviews(spark, 15, 15 * k) for k in reversed(range(20))]
    path, out = files_of(spark, parts), new_path(spark, "sums")
    arriving = stream.read_stream(spark, path, parts[0].schema, files_per_trigger=1)
    held = []

    def sums(batch):
        held.append(len(stream._folders(spark, out)))
        return insights.product_sums(insights.enrich_reviews(batch))

    query = stream.ingest_sums(arriving, out, new_path(spark, "state"), sums, insights.merged_sums, compact_every=4)
    query.awaitTermination()
    assert len(held) == 20 and max(held) <= 4
    stored = stream.read_sums(spark, out)
    assert stored.count() <= 5 * 5
    meta = spark.createDataFrame([("P1", "One", "1", 4.0, 1)], "parent_asin string, title string, price string, average_rating double, row_id long")
    got = insights.insights_from_totals(insights.totals_from_sums(stored), meta).drop("top_complaint_aspects")
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    want = insights.product_insights(whole, meta).drop("top_complaint_aspects")
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_a_repeated_batch_adds_nothing(spark):
    out = new_path(spark, "sums")
    path = files_of(spark, [reviews(spark, 10, 0), reviews(spark, 10, 10)])
    count = lambda df: df.groupBy("domain").agg(F.count("*").alias("n"))
    merge = lambda df: df.groupBy("domain").agg(F.sum("n").alias("n"))
    for _ in range(2):  # without its checkpoint the second run repeats the batches
        arriving = stream.read_stream(spark, path, reviews(spark, 1, 0).schema, files_per_trigger=1)
        stream.ingest_sums(arriving, out, new_path(spark, "state"), count, merge, compact_every=2).awaitTermination()
    assert sum(r.n for r in stream.read_sums(spark, out).collect()) == 20


def test_older_states_are_removed(spark):
    path, out = files_of(spark, [reviews(spark, 10, 10 * k) for k in range(5)]), new_path(spark, "counts")
    arriving = stream.read_stream(spark, path, reviews(spark, 1, 0).schema, files_per_trigger=1)
    stream.keep_latest(stream.running_counts(arriving, ["domain"]), out, new_path(spark, "state")).awaitTermination()
    assert len(stream._folders(spark, out)) == 2
    assert sum(r.n for r in stream.read_latest(spark, out).collect()) == 50
