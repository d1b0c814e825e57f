"""Spreading hot keys: salted joins, size-checked broadcasts, distributed ranks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voxmill.session import cut, shuffle_parts

ROWS_PER_TASK = 2_000_000


def hot_keys(
    df: DataFrame, on: str | list[str], rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """(key columns, _salts): keys with more rows than one task should hold and the number of tasks they
    need. There are at most rows / ``rows_per_task`` of them. Reads the key only; counts are
    combined before the shuffle."""
    keys = [on] if isinstance(on, str) else list(on)
    n = F.col("_n")
    return (
        df.select(*keys).na.drop().groupBy(*keys).agg(F.count("*").alias("_n"))
        .where(n > rows_per_task)
        .select(*keys, F.ceil(n / rows_per_task).cast("int").alias("_salts")))


def hot_from_counts(
    counts: DataFrame, on: str | list[str], n: str, rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """The table of ``hot_keys`` from counts that are already there."""
    keys = [on] if isinstance(on, str) else list(on)
    return counts.na.drop(subset=keys).where(F.col(n) > rows_per_task).select(
        *keys, F.ceil(F.col(n) / rows_per_task).cast("int").alias("_salts"))


def salted_join(
    left: DataFrame, right: DataFrame, on: str | list[str], how: str = "inner",
    rows_per_task: int = ROWS_PER_TASK, identity: list[str] | None = None,
    hot: DataFrame | None = None, max_broadcast: int = 200_000,
) -> DataFrame:
    """Equi-join of a large ``left`` with a ``right`` that is unique per key.

    The rows of a hot key are spread over as many tasks as they need and the one matching right
    row is copied to each. The salt comes from the row itself, so a recomputed task repeats it.
    ``hot`` is the table of ``hot_keys`` where it is known, which saves reading ``left`` for it.
    There are at most rows / ``rows_per_task`` hot keys; up to ``max_broadcast`` are broadcast,
    more come to the rows by a join of their own. Without hot keys this is a plain join.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"salting cannot serve a {how} join")
    keys = [on] if isinstance(on, str) else list(on)
    hot = cut(hot_keys(left, keys, rows_per_task) if hot is None else hot)
    found = hot.limit(max_broadcast + 1).count()
    if found == 0:
        return left.join(right, keys, how)
    # Beyond the limit hot keys are many, so no single one stands out in a shuffle of their list.
    hot = F.broadcast(hot) if found <= max_broadcast else hot
    salts = F.coalesce("_salts", F.lit(1))
    number = F.pmod(F.xxhash64(*(identity or left.columns)), salts).cast("int")
    copies = F.sequence(F.lit(0), salts - 1)
    salted = left.join(hot, keys, "left").withColumn("_salt", number)
    copied = right.join(hot, keys, "left").withColumn("_salt", F.explode(copies))
    return salted.drop("_salts").join(copied.drop("_salts"), keys + ["_salt"], how).drop("_salt")


def text_bytes(df: DataFrame) -> Column:
    """The bytes of a row: its texts and nested values as JSON, eight for any other column."""
    sized = [F.coalesce(F.octet_length(F.col(f"`{c}`") if t == "string" else F.to_json(
        F.struct(F.col(f"`{c}`")))), F.lit(0)) if t == "string" or "<" in t else F.lit(8) for c, t in df.dtypes]
    return sum(sized, F.lit(8))


def is_small(df: DataFrame, max_rows: int, max_bytes: int) -> bool:
    """Whether a stored table holds at most so many rows and bytes; reads no more than decides it."""
    head = df.limit(max_rows + 1)
    n, size = head.agg(F.count("*"), F.coalesce(F.sum(text_bytes(head)), F.lit(0))).first()
    return n <= max_rows and size <= max_bytes


def broadcast_if_small(
    df: DataFrame, max_rows: int = 200_000, max_bytes: int = 64 << 20,
) -> DataFrame:
    """Broadcast after counting rows and bytes; a larger table stays a shuffled side. ``df`` is
    stored first, so counting it and joining it do not compute it twice."""
    stored = cut(df)
    return F.broadcast(stored) if is_small(stored, max_rows, max_bytes) else stored


def semi_join(large: DataFrame, keys: DataFrame, key: str, max_rows: int = 200_000) -> DataFrame:
    """Rows of ``large`` whose key is listed: the list is broadcast when it is counted to be
    small, otherwise both sides are shuffled and hot keys spread."""
    listed = cut(keys.select(key).distinct())
    if is_small(listed, max_rows, 64 << 20):
        return large.join(F.broadcast(listed), key, "left_semi")
    return salted_join(large, listed, key, "left_semi")


def rank_in_group(
    df: DataFrame, groups: list[str], order: list[Column], bucket: Column, out: str = "rank",
) -> DataFrame:
    """Exact 0-based position of each row in its group without one task per group.

    ``bucket`` must not decrease along ``order``; null is the first bucket. Rows are numbered inside
    (group, bucket); the rows of earlier buckets are added from a table of counts. Rows with null
    groups, buckets or orders are numbered too.
    """
    # A struct of the group columns: equal also where a column is null, and one partitioning
    # serves the counts, the numbering and the join.
    # A struct around the bucket keeps rows whose bucket is null; it sorts first.
    keyed = df.withColumns({"_group": F.struct(*groups), "_bucket": F.struct(bucket.alias("b"))})
    earlier = Window.partitionBy("_group").orderBy("_bucket").rowsBetween(
        Window.unboundedPreceding, -1)
    offsets = (
        keyed.groupBy("_group", "_bucket").agg(F.count("*").alias("_n"))
        .withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0))).drop("_n")
    )
    inner = F.row_number().over(Window.partitionBy("_group", "_bucket").orderBy(*order))
    # Both sides are dealt and sorted alike. Broadcasting either could leave all rows to one task.
    joined = keyed.withColumn("_inner", inner).join(offsets.hint("merge"), ["_group", "_bucket"])
    return joined.withColumn(out, F.col("_before") + F.col("_inner") - 1).drop(
        "_before", "_inner", "_bucket", "_group")


def _by_ranges(df: DataFrame, groups: list[str], order: list[Column], parts: int | None) -> DataFrame:
    """``df``, stored once, sorted by groups and order over ranges that Spark draws from a sample: with
    ``_group``, ``_part`` (the range) and ``_at``, which grows along the order within a range. Rows that
    tie are told apart by a digest, so many equal keys do not fill one range."""
    hashed = [F.col(f"`{c}`") for c, t in df.dtypes if "map<" not in t]
    keys = [*[F.col(g) for g in groups], *order, F.col("_tie")]
    parts = parts or shuffle_parts(df.sparkSession)
    ranged = df.withColumn("_tie", F.xxhash64(*hashed)).repartitionByRange(parts, *keys).sortWithinPartitions(
        *keys).drop("_tie").withColumn("_at", F.monotonically_increasing_id())
    # The id is the partition's number, then the row's in 33 bits.
    return cut(ranged).withColumns({"_group": F.struct(*groups), "_part": F.shiftright("_at", 33)})


def _range_offsets(ranged: DataFrame, amount: Column) -> DataFrame:
    """(_group, _part, _first, _before, _whole): the amount that a group has in earlier ranges, and in
    all. A group has a row per range it reaches into, so the window is over no more than the ranges."""
    along = Window.partitionBy("_group").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sums = ranged.groupBy("_group", "_part").agg(amount.alias("_amount"), F.min("_at").alias("_first"))
    return broadcast_if_small(sums.select(
        "_group", "_part", "_first", F.coalesce(F.sum("_amount").over(along), F.lit(0)).alias("_before"),
        F.sum("_amount").over(Window.partitionBy("_group")).alias("_whole")))


def position_in_group(
    df: DataFrame, groups: list[str], order: list[Column], out: str = "rank", parts: int | None = None,
) -> DataFrame:
    """Exact 0-based position of each row in its group, for any order: prefix sums over ranges.

    The rows are sorted over ranges of (groups, order), stored, and counted per group and range; a
    row's position is its place in the range plus what earlier ranges hold of its group. No window
    holds a group, whatever the values of the order are. Null groups are a group; nulls come first.
    """
    ranged = _by_ranges(df, groups, order, parts)
    joined = ranged.join(_range_offsets(ranged, F.count("*")), ["_group", "_part"])
    return joined.withColumn(out, F.col("_before") + F.col("_at") - F.col("_first")).select(*df.columns, out)


def running_sum(
    df: DataFrame, groups: list[str], order: list[Column], amount: str, out: str, whole: str,
    parts: int | None = None,
) -> DataFrame:
    """Adds the sum of ``amount`` up to and including the row along the order in its group, and over
    the whole group: sums inside (group, range), and prefix sums over the ranges."""
    ranged = _by_ranges(df, groups, order, parts)
    inside = Window.partitionBy("_group", "_part").orderBy("_at").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    joined = ranged.withColumn("_inside", F.sum(amount).over(inside)).join(
        _range_offsets(ranged, F.sum(amount)), ["_group", "_part"])
    return joined.withColumns({out: F.col("_before") + F.col("_inside"), whole: F.col("_whole")}).select(
        *df.columns, out, whole)
