"""Seeded samples and exact stratified splits that never gather a stratum in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voxmill.config import SEED
from voxmill.operators.skew import broadcast_if_small, rank_in_group
from voxmill.session import cut

#: Places of the order: a blank or nothing, and the digits of a digest.
ORDER_DIGITS = 33


def seeded_order(identity: str, seed: int = SEED) -> Column:
    """A reproducible shuffle position: the digest of seed and row identity."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(identity).cast("string")))


def _boundaries(
    keyed: DataFrame, n: int, digits: int, rows_at_once: int,
) -> DataFrame:
    """(_group, _last): the shortest beginning of the order up to which a group has its n rows; groups
    of fewer rows have none. ``keyed`` has ``_group`` and ``_order``.

    Each round counts beginnings, combined before the shuffle, and finds the one in which n is
    reached. While that one alone holds more than ``rows_at_once`` rows in some group, the next round
    counts longer beginnings inside it.
    """
    along = Window.partitionBy("_group").orderBy("_start").rowsBetween(Window.unboundedPreceding, -1)
    done, within, depth = None, None, digits
    while True:
        rows = keyed
        if within is not None:
            near = within.select("_group", "_last", "_before")
            rows = _beside(keyed, near).where(F.substring("_order", 1, depth - digits) == F.col("_last"))
        before = F.lit(0) if within is None else F.first("_before")
        counts = rows.groupBy("_group", F.substring("_order", 1, depth).alias("_start")).agg(
            F.count("*").alias("_n"), before.alias("_base"))
        reached = counts.withColumn(
            "_before", F.col("_base") + F.coalesce(F.sum("_n").over(along), F.lit(0))).where(
            (F.col("_before") < n) & (F.col("_before") + F.col("_n") >= n)).select(
            "_group", F.col("_start").alias("_last"), "_before", "_n")
        reached = cut(reached)
        small = reached.where(F.col("_n") <= rows_at_once)
        within = reached.where(F.col("_n") > rows_at_once)
        if depth >= ORDER_DIGITS or within.isEmpty():
            last = reached.select("_group", "_last")
            return last if done is None else done.unionByName(last)
        found = small.select("_group", "_last")
        done, depth = found if done is None else done.unionByName(found), depth + digits


def _beside(rows: DataFrame, table: DataFrame, how: str = "inner") -> DataFrame:
    """Rows with what ``table`` says of their group; without a shuffle unless the groups are many."""
    table = broadcast_if_small(table.withColumnRenamed("_group", "_of"))
    return rows.join(table, rows["_group"].eqNullSafe(F.col("_of")), how).drop("_of")


def candidates_per_group(
    df: DataFrame, groups: list[str], n: int, seed: int = SEED, identity: str = "row_id",
    digits: int = 3, rows_at_once: int = 100_000,
) -> DataFrame:
    """``df`` with ``_order``, less the rows that can not be among the first n of their group by it:
    about n rows of a group, and up to ``rows_at_once`` more. The other rows are never shuffled."""
    # Null ids come first, as the empty text would; a digest of the row tells them apart.
    order = F.coalesce(seeded_order(identity, seed), F.concat(F.lit(" "), F.md5(F.to_json(F.struct("*")))))
    keyed = df.withColumns({"_order": order, "_group": F.struct(*groups)})
    last = _boundaries(keyed.select("_group", "_order"), n, digits, rows_at_once)
    near = _beside(keyed, last, "left")
    return near.where(F.col("_last").isNull() | (F.substring(
        F.col("_order"), F.lit(1), F.length("_last")) <= F.col("_last"))).drop("_last", "_group")


def sample_per_group(
    df: DataFrame, groups: list[str], n: int, seed: int = SEED, identity: str = "row_id",
    position: str | None = None, bucket_digits: int = 3, rows_at_once: int = 100_000,
) -> DataFrame:
    """Exactly n rows per group (all of a smaller one), whatever n: the first along a seeded digest.

    The digest's beginnings are counted to find where a group reaches n; only rows up to there are
    shuffled and ranked, in buckets of their digest, so no task holds a group. A null identity counts
    as the empty text; rows that tie are ordered by a digest of all columns."""
    if n < 1:
        return df.limit(0).withColumn(position, F.lit(0)) if position else df.limit(0)
    near = cut(candidates_per_group(df, groups, n, seed, identity, bucket_digits, rows_at_once))
    ranked = rank_in_group(
        near, groups, [F.col("_order"), F.col(identity)], F.substring("_order", 1, bucket_digits),
        out="_rank").where(F.col("_rank") < n).drop("_order")
    ranked = ranked.withColumn("_rank", (F.col("_rank") + 1).cast("int"))
    return ranked.withColumnRenamed("_rank", position) if position else ranked.drop("_rank")


def _allocated(size: Column, wanted: Column, strata: list[str], label: str) -> Column:
    """Largest-remainder share of ``wanted`` for each label of a stratum (small table)."""
    everyone = Window.partitionBy(*strata)
    exact = size * wanted / F.sum(size).over(everyone)
    floor = F.floor(exact)
    left = wanted - F.sum(floor).over(everyone)
    place = F.row_number().over(
        everyone.orderBy(F.desc(F.round(exact - floor, 9)), F.asc(label)))
    return floor, left, place


def split_sizes(
    df: DataFrame, strata: list[str], label: str, test_size: float = 0.15, val_size: float = 0.15,
) -> DataFrame:
    """Rows of each label that go to train, validation and test, per stratum."""
    holdout = test_size + val_size
    everyone = Window.partitionBy(*strata)
    sizes = df.groupBy(*strata, label).agg(F.count("*").alias("_n"))
    total = F.sum("_n").over(everyone)
    sizes = sizes.withColumn("_train_total", total - F.ceil(F.round(total * holdout, 6)))
    floor, left, place = _allocated(F.col("_n"), F.col("_train_total"), strata, label)
    sizes = sizes.withColumns({"_f": floor, "_l": left, "_p": place})
    sizes = sizes.withColumn(
        "n_train", F.col("_f") + F.when(F.col("_p") <= F.col("_l"), 1).otherwise(0))
    sizes = sizes.withColumn("_rest", F.col("_n") - F.col("n_train"))
    rest = F.sum("_rest").over(everyone)
    sizes = sizes.withColumn(
        "_val_total", rest - F.ceil(F.round(rest * (test_size / holdout), 6)))
    floor, left, place = _allocated(F.col("_rest"), F.col("_val_total"), strata, label)
    sizes = sizes.withColumns({"_f": floor, "_l": left, "_p": place})
    sizes = sizes.withColumn(
        "n_val", F.col("_f") + F.when(F.col("_p") <= F.col("_l"), 1).otherwise(0))
    return sizes.select(
        *strata, label, F.col("n_train").cast("long").alias("n_train"),
        F.col("n_val").cast("long").alias("n_val"),
        (F.col("_rest") - F.col("n_val")).cast("long").alias("n_test"))


def stratified_split(
    df: DataFrame, strata: list[str], label: str = "sentiment", seed: int = SEED,
    identity: str = "row_id", test_size: float = 0.15, val_size: float = 0.15,
    bucket_digits: int = 3,
) -> DataFrame:
    """Adds ``split``: train, validation or test, with exact sizes per label.

    Rows are ranked within (stratum, label) along a digest. The first digits of the digest are
    the rank's buckets, so even a label that holds most rows is spread over thousands of tasks.
    Only digests are ranked, to find where a split ends; the rows themselves are not shuffled.
    """
    keys = strata + [label]
    keyed = df.withColumn("_order", F.coalesce(seeded_order(identity, seed), F.lit("")))
    edges = _split_edges(
        keyed.select(*keys, "_order"), split_sizes(df, strata, label, test_size, val_size), keys, bucket_digits)
    # One row per stratum and label. Joined by shuffle, the rows of a label would meet in one task.
    joined = keyed.join(broadcast_if_small(edges), _same(keyed, keys))
    # Rows that tie where a split ends, as those of one id, are numbered; no others are.
    tied = F.coalesce((F.col("_order") == F.col("_end1")) & (F.col("_tied1") > 0), F.lit(False)) | F.coalesce(
        (F.col("_order") == F.col("_end2")) & (F.col("_tied2") > 0), F.lit(False))
    place = F.lit(0)
    if not edges.where("_tied1 > 0 or _tied2 > 0").isEmpty():
        hashed = [F.col(f"`{c}`") for c, t in df.dtypes if "map<" not in t]
        inner = F.row_number().over(Window.partitionBy(*keys, "_order").orderBy(F.xxhash64(*hashed)))
        joined = joined.where(~tied).withColumn("_place", F.lit(0)).unionByName(
            joined.where(tied).withColumn("_place", inner - 1))
        place = F.col("_place")

    def before(end, ties):
        return F.col(end).isNull() | (F.col("_order") < F.col(end)) | (
            (F.col("_order") == F.col(end)) & (place < F.col(ties)))

    split = F.when(before("_end1", "_tied1"), "train").when(
        before("_end2", "_tied2"), "validation").otherwise("test")
    return joined.select(*[f"`{c}`" for c in df.columns if c != "split"], split.alias("split"))


def _same(rows: DataFrame, keys: list[str]) -> list[Column]:
    return [rows[k].eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]


def _split_edges(
    keyed: DataFrame, sizes: DataFrame, keys: list[str], bucket_digits: int,
) -> DataFrame:
    """Stored, per stratum and label (_k0, _k1, ...): the place in the order at which validation begins
    (_end1) and test begins (_end2), null where there is no such row, and how many rows of that very
    place come before (_tied1, _tied2)."""
    named = [F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]
    sizes = broadcast_if_small(sizes.select(*named, "n_train", (F.col("n_train") + F.col("n_val")).alias("n_both")))
    ranked = rank_in_group(keyed, keys, [F.col("_order")], F.substring("_order", 1, bucket_digits), out="_rank")
    # A place is that of one id, so there is a row for nearly each row here; two are kept.
    places = ranked.groupBy(*keys, "_order").agg(F.min("_rank").alias("_first"), F.max("_rank").alias("_last"))
    held = places.join(sizes, _same(places, keys))

    def reached(n):
        return F.col(n).between(F.col("_first"), F.col("_last"))

    ends = held.where(reached("n_train") | reached("n_both")).groupBy(*[f"_k{i}" for i in range(len(keys))]).agg(
        *[f(F.when(reached(n), value)).alias(f"{name}{i}") for i, n in ((1, "n_train"), (2, "n_both"))
          for f, name, value in ((F.max, "_end", F.col("_order")), (F.max, "_tied", F.col(n) - F.col("_first")))])
    # Labels that lie in the training split as a whole have no end.
    names = [f"_k{i}" for i in range(len(keys))]
    every = sizes.select(*[F.col(c).alias(f"_of{c}") for c in names])
    same = [F.col(f"_of{c}").eqNullSafe(F.col(c)) for c in names]
    return cut(every.join(broadcast_if_small(ends), same, "left").select(
        *[F.col(f"_of{c}").alias(c) for c in names], "_end1", "_tied1", "_end2", "_tied2"))


def split_summary(split: DataFrame, strata: list[str]) -> DataFrame:
    names = ["train", "validation", "test"]
    wide = split.groupBy(*strata).pivot("split", names).count().na.fill(0)
    return wide.withColumn("total", F.col("train") + F.col("validation") + F.col("test"))
