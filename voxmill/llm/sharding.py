"""Sharding by rendezvous hashing of stable record keys over weighted shards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voxmill.llm.common import quoted, tasks_for, without

#: Rows that one task numbers; the count of buckets grows with the table.
ROWS_PER_BUCKET = 20_000


def unit_draw(key: Column, salt: Column | str) -> Column:
    """A number in (0, 1) that only the key and the salt decide: 52 bits of a digest."""
    digits = F.substring(F.md5(F.concat(key, F.lit(":"), F.lit(salt) if isinstance(salt, str) else salt)), 1, 13)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / float(2**52)


def rendezvous(key: Column, weights: list[float]) -> Column:
    """The shard with the largest score -weight / ln(draw of key and shard).

    A shard's share follows its weight. A new shard only wins records for itself: the scores of
    the others stay, so no record moves between two old shards.
    """
    if not weights or any(w <= 0 for w in weights):
        raise ValueError("weights must be positive")
    scores = [
        F.struct((-F.lit(float(w)) / F.ln(unit_draw(key, str(i)))).alias("score"),
                 F.lit(-i).alias("place"))
        for i, w in enumerate(weights)]
    best = F.greatest(*scores) if len(scores) > 1 else scores[0]
    return (-best["place"]).cast("int")


def record_key(column: Column) -> Column:
    """Records without a key share the empty one."""
    return F.coalesce(column.cast("string"), F.lit(""))


def shard(
    docs: DataFrame, key: str = "doc_id", weights: list[float] | None = None,
    grown: list[float] | None = None, text: str = "text",
) -> DataFrame:
    """The rows of ``docs`` less the text, with ``size``, ``text_crc32``, ``shard``, ``slot`` and
    ``grown_shard`` (the shard under the weights ``grown``, by default one more of weight 1).

    Slots count the rows of a shard from 0 without gaps, by the key's digest and the key. No task
    numbers a whole shard: rows are numbered in buckets of the digest, and the counts of earlier
    buckets of the shard are added. Buckets are about ROWS_PER_BUCKET rows, unless one key repeats.
    Null text: size 1, checksum 0. Null keys count as the empty key. Equal rows take neighbouring
    slots. Very long texts are measured whole; an empty table gives an empty one. Columns of ``docs``
    named like a result are replaced.
    """
    weights = list(weights or [1.0] * 16)
    grown = list(grown or [*weights, 1.0])
    results = ("size", "text_crc32", "shard", "slot", "grown_shard")
    others = without(docs.columns, text, *results)
    value = F.encode(F.coalesce(quoted(text).cast("string"), F.lit("")), "UTF-8")
    name = record_key(quoted(key))
    buckets = tasks_for(docs.select(key).count(), ROWS_PER_BUCKET)
    dealt = docs.select(
        F.struct(*[quoted(c) for c in others]).alias("_row"),
        (F.octet_length(value) + 1).cast("long").alias("size"),
        F.crc32(value).alias("text_crc32"),
        quoted(key).alias("_key"),
        rendezvous(name, weights).alias("shard"),
        rendezvous(name, grown).alias("grown_shard"),
        F.floor(unit_draw(name, "slot") * buckets).cast("int").alias("_bucket"))
    # The table of counts has a row per shard and bucket, so numbering it is bounded work.
    counts = dealt.groupBy("shard", "_bucket").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("shard").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "shard", "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inner = Window.partitionBy("shard", "_bucket").orderBy("_key", "text_crc32", "size")
    placed = dealt.withColumn("_inner", F.row_number().over(inner)).join(offsets, ["shard", "_bucket"])
    return placed.select(
        *[F.col("_row")[c].alias(c) for c in others], "size", "text_crc32", "shard",
        (F.col("_before") + F.col("_inner") - 1).cast("long").alias("slot"), "grown_shard")
