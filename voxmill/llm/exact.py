"""Exact deduplication by distributed most-significant-digit radix partitioning."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxmill.llm.common import keeping, quoted, salt, stored, without

#: Bytes of the first digit; each later digit is WIDEN times as wide as all before it, so a text of
#: n bytes takes about log(n) rounds.
FIRST_BYTES = 64
WIDEN = 7


def _bytes(text: str = "_text") -> Column:
    return F.encode(F.coalesce(F.col(text), F.lit("")), "UTF-8")


def _split(rows: DataFrame, key: list[str], *counts: Column) -> DataFrame:
    """The groups of two rows or more by ``key``, one row per salt that occurs in the group, so that
    joining them back spreads a hot group over many tasks. Counts are combined before the shuffle."""
    groups = rows.groupBy(*key).agg(
        F.count("*").alias("_n"), F.collect_set("_salt").alias("_salts"), *counts)
    return groups.where("_n > 1").withColumn("_salt", F.explode("_salts")).drop("_salts")


def exact_groups(
    docs: DataFrame, key: str = "doc_id", text: str = "text", carry_text: bool = True,
) -> DataFrame:
    """The rows of ``docs`` with ``keep_id``, ``group_size``, ``kept`` and ``text_sha256``.

    Rows with byte-identical text form a group; the one with the largest ``key`` stays. The text's
    bytes are read as digits: a round splits each group by its next digit. A group of one row, or
    one whose text has ended within the digit, is done; the others go on with a wider digit. Texts
    are equal because all their bytes were, no digest decides; ``text_sha256`` is only reported.

    Only (group, digit) counts meet in one task, and rows join them spread by salts. Rows alone in
    the first round are done at once, so later rounds carry only rows with a shared beginning. Each
    round is written to the shared folder. ``carry_text`` False leaves the text out of the result.

    Null text counts as empty text. Among rows that repeat a key, one stays; a null key ranks
    lowest. An empty table gives an empty one; columns named like a result are replaced.
    """
    spark = docs.sparkSession
    results = ("keep_id", "group_size", "kept", "text_sha256")
    others = without(docs.columns, text, *results)
    base = docs.select(
        F.struct(*[quoted(c) for c in others], F.lit(0).alias("_")).alias("_row"),
        quoted(key).alias("_id"), quoted(text).cast("string").alias("_text"),
        salt(spark, quoted(key)).alias("_salt"),
    ).withColumn("_digit", F.substring(_bytes(), 1, FIRST_BYTES))
    shared = _split(base, ["_digit"]).select("_digit", "_salt", F.lit(True).alias("_shared"))
    first = base.join(shared, ["_digit", "_salt"], "left")
    alone = F.col("_shared").isNull()
    rows = stored(first.select(
        "_row", "_id", "_salt", alone.alias("_done"), F.lit(0).cast("long").alias("_group"),
        (F.col("_text") if carry_text else F.when(~alone, F.col("_text"))).alias("_text"),
        F.sha2(_bytes(), 256).alias("_sha"), F.monotonically_increasing_id().alias("_seq")), "radix-0")
    done = [rows.where("_done").select(
        "_row", "_text", "_sha", F.col("_id").alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"))]
    # The first round only told which rows are alone; the next digit begins anew with its bytes.
    active, depth, width = rows.where("not _done"), 0, FIRST_BYTES * (1 + WIDEN)
    while active.limit(1).count():
        digits = active.withColumn("_digit", F.substring(_bytes(), depth + 1, width))
        groups = _split(
            digits, ["_group", "_digit"], F.max(F.struct("_id", "_seq")).alias("_top"),
            F.min("_seq").alias("_next"))
        joined = digits.join(groups, ["_group", "_digit", "_salt"], "left")
        n = F.coalesce("_n", F.lit(1).cast("long"))
        ended = F.octet_length("_digit") < width
        finished = ended | (n == 1)
        table = stored(joined.select(
            "_row", "_id", "_salt", finished.alias("_done"),
            F.coalesce("_next", "_seq").alias("_group"),
            (F.col("_text") if carry_text else F.when(~finished, F.col("_text"))).alias("_text"),
            "_sha", "_seq", n.alias("group_size"),
            F.when(n == 1, F.col("_id")).otherwise(F.col("_top")["_id"]).alias("keep_id"),
            F.coalesce(F.col("_top")["_seq"] == F.col("_seq"), F.lit(True)).alias("kept")), "radix")
        done.append(table.where("_done").select("_row", "_text", "_sha", "keep_id", "group_size", "kept"))
        active = table.where("not _done")
        depth, width = depth + width, (depth + width) * WIDEN
    whole = reduce(DataFrame.unionByName, done)
    return whole.select(
        *[F.col("_row")[c].alias(c) for c in others],
        *([F.col("_text").alias(text)] if carry_text else []),
        "keep_id", "group_size", "kept", F.col("_sha").alias("text_sha256"))


def deduplicate(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with the columns of ``docs``; see ``exact_groups``."""
    return keeping(docs, lambda d: exact_groups(d, key, text).where("kept"), key, text)
