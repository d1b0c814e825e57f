"""Mixing sources to target weights by Poisson replication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxmill.llm.common import quoted, salt, stored, without
from voxmill.llm.sharding import unit_draw

#: Above this mean a count is the sum of independent draws, so that exp(-mean) stays exact.
MEAN_PER_DRAW = 100.0
#: A table of sources up to this many rows is broadcast; a larger one is joined by a shuffle.
MAX_BROADCAST_SOURCES = 10_000


def poisson_steps(mean: Column) -> Column:
    """P(count <= k) for k = 0, 1, ... as far as a draw of 52 bits can reach."""
    last = F.ceil(mean + 12 * F.sqrt(mean) + 40).cast("int")
    start = F.array(F.struct(F.exp(-mean).alias("term"), F.exp(-mean).alias("total")))

    def add(steps: Column, k: Column) -> Column:
        end = F.element_at(steps, -1)
        term = end["term"] * mean / k
        return F.concat(steps, F.array(F.struct(term.alias("term"), (end["total"] + term).alias("total"))))

    steps = F.aggregate(F.sequence(F.lit(1), last), start, add)
    return F.transform(steps, lambda s: s["total"])


def source_rates(
    docs: DataFrame, source: str = "source", text: str = "text",
    weights: dict[str, float] | None = None, size: float = 1.0,
) -> DataFrame:
    """(source, bytes, rate): how often a document of each source is to appear on average.

    A source's target share is its weight over the sum of the weights of the sources present
    (1 for a source that is not named, and for null); the rate is share * ``size`` * all bytes /
    the source's bytes. A source without any text has rate 0. ``size`` 1 keeps the volume.
    """
    named = F.lit(1.0)
    for name, weight in sorted((weights or {}).items()):
        if weight < 0:
            raise ValueError("weights must not be negative")
        named = F.when(F.col("_source") == name, F.lit(float(weight))).otherwise(named)
    sizes = docs.select(
        quoted(source).cast("string").alias("_source"),
        F.octet_length(F.coalesce(quoted(text).cast("string"), F.lit(""))).cast("long").alias("_size"),
    ).groupBy("_source").agg(F.sum("_size").alias("_bytes")).withColumn("_weight", named)
    sizes = stored(sizes, "mix-sizes")  # a row per source; read again for the totals
    whole, all_weights = sizes.agg(F.sum("_bytes"), F.sum("_weight")).first()
    rate = F.col("_weight") / F.lit(float(all_weights or 1)) * F.lit(float(size)) * F.lit(
        float(whole or 0)) / F.col("_bytes")
    return sizes.select("_source", "_bytes", F.when(
        (F.col("_bytes") > 0) & F.lit(bool(all_weights)), rate).otherwise(0.0).alias("_rate"))


def mix(
    docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text",
    weights: dict[str, float] | None = None, size: float = 1.0, seed: str = "mix",
    partitions: int | None = None,
) -> DataFrame:
    """Each row of ``docs`` as often as its Poisson draw says, shuffled globally, with ``copy``
    (from 0) and ``mix_rate``.

    The count is the inverse of the Poisson distribution with the source's mean at a draw that the
    seed and the key alone decide: the same seed repeats the mix, also after lost executors. The
    copies are dealt to partitions by a second draw and sorted by it there, which is one global
    shuffle of the chosen rows without a sampling pass. The hot source is never gathered: means
    are found from pre-aggregated sums, and rows are dealt by key, text and copy.
    Null or repeated keys draw alike, so they all come or all stay away at a low rate, as the checking
    SQL has it; they are dealt out by their texts. Equal rows stay together. Null text has no bytes; very
    long texts weigh by their bytes like others; an empty table stays empty. Columns of ``docs`` named
    like a result are replaced.
    """
    spark, others = docs.sparkSession, without(docs.columns, "copy", "mix_rate")
    rates = source_rates(docs, source, text, weights, size)
    parts = F.greatest(F.lit(1), F.ceil(F.col("_rate") / MEAN_PER_DRAW)).cast("int")
    rates = rates.withColumn("_parts", parts).withColumn(
        "_steps", poisson_steps(F.col("_rate") / F.col("_parts")))
    name = F.coalesce(quoted(key).cast("string"), F.lit(""))
    held = docs.select(
        F.struct(*[quoted(c) for c in others]).alias("_row"), name.alias("_key"),
        F.xxhash64(quoted(text).cast("string")).alias("_digest"), quoted(source).cast("string").alias("_source"))
    rates = rates.select("_source", "_rate", "_parts", "_steps")
    if rates.limit(MAX_BROADCAST_SOURCES + 1).count() <= MAX_BROADCAST_SOURCES:
        joined = held.join(F.broadcast(rates), held["_source"].eqNullSafe(rates["_source"]))
    else:
        held = held.withColumn("_salt", salt(spark, "_key"))
        salts = held.groupBy("_source").agg(F.collect_set("_salt").alias("_salts"))
        spread = rates.join(salts, rates["_source"].eqNullSafe(salts["_source"])).select(
            rates["_source"], "_rate", "_parts", "_steps", F.explode("_salts").alias("_salt"))
        joined = held.join(spread, held["_source"].eqNullSafe(spread["_source"])
                           & (held["_salt"] == spread["_salt"]))

    def draws(part: Column) -> Column:
        u = unit_draw(F.col("_key"), F.concat(F.lit(f"{seed}:"), part.cast("string")))
        return F.size(F.filter("_steps", lambda step: step <= u))

    count = F.aggregate(F.sequence(F.lit(1), F.col("_parts")), F.lit(0), lambda n, part: n + draws(part))
    copies = joined.select("_row", "_key", "_digest", "_rate", count.alias("_count")).where("_count > 0").select(
        "_row", "_key", "_digest", "_rate",
        F.explode(F.sequence(F.lit(0), F.col("_count") - 1)).alias("copy"))
    order = F.xxhash64(F.lit(seed), "_key", "copy", "_digest")
    dealt = copies.withColumn("_order", order)
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    return dealt.repartition(n, "_order").sortWithinPartitions("_order", "_key").select(
        *[F.col("_row")[c].alias(c) for c in others], "copy", F.col("_rate").alias("mix_rate"))
