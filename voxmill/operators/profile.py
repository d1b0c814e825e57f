"""Descriptive analytics: distributions, moments, cross-tabs, bins, box statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voxmill.config import LABEL_REPORT_ORDER
from voxmill.functions import numbers, text as tx
from voxmill.operators.skew import running_sum

# Upper bounds of the right-closed bins. A bin's name states its real bounds.
REVIEW_TIERS = ((1, 5, 10, 20), ("1", "2-5", "6-10", "11-20", ">20"))
CROSS_DOMAIN_REVIEW_TIERS = ((1, 3, 5, 10, 20), ("1", "2-3", "4-5", "6-10", "11-20", ">20"))
VOTE_TIERS = ((0, 2, 5, 20), ("0", "1-2", "3-5", "6-20", ">20"))
CROSS_DOMAIN_VOTE_TIERS = ((0, 2, 5), ("0", "1-2", "3-5", ">5"))


def with_lengths(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "char_count": tx.char_count(F.col("text")),
        "word_count": tx.word_count(F.col("text")),
    })


def value_histogram(df: DataFrame, groups: list[str], value: str) -> DataFrame:
    """(groups, value, n). Exact quantiles are read off it: their state is then one entry per
    distinct value and a group of any size arrives pre-aggregated."""
    return df.where(F.col(value).isNotNull()).groupBy(*groups, value).agg(
        F.count("*").alias("n"))


def value_counts(df: DataFrame, column: str, groups: list[str] = ()) -> DataFrame:
    """Counts and shares within the group; nulls are left out."""
    counts = value_histogram(df, list(groups), column)
    total = (F.sum("n").over(Window.partitionBy(*groups)) if groups
             else counts.select(F.sum("n")).scalar())
    return counts.withColumn("pct", F.round(F.col("n") / total * 100, 6))


def share(value: Column, groups: list[str]) -> Column:
    return value / F.sum(value).over(Window.partitionBy(*groups))


def quantiles(df: DataFrame, groups: list[str], value: str, points: dict[str, float],
              exact: bool = True) -> DataFrame:
    """Linear-interpolated quantiles; ``exact=False`` takes a sketch instead, for columns with
    very many distinct values."""
    at = list(points.values())
    if exact:
        table = value_histogram(df, groups, value).groupBy(*groups).agg(
            F.percentile(value, at, F.col("n")).alias("_q"))
    else:
        table = df.groupBy(*groups).agg(F.percentile_approx(value, at).alias("_q"))
    return table.select(
        *groups, *[F.round(F.col("_q")[i], 6).alias(n) for i, n in enumerate(points)])


def _summary(hist: DataFrame, groups: list[str], value: str, points: list[float]) -> DataFrame:
    """n, mean, std, skew, min, max and quantiles of the values of a histogram.

    The raw table is read once, for the histogram; centring it takes a second pass over its few
    rows, which share one shuffle.
    """
    x, n = F.col(value).cast("double"), F.col("n")
    first = hist.groupBy(*groups).agg(
        F.sum(n).alias("count"), (F.sum(x * n) / F.sum(n)).alias("_mean"),
        F.min(value).alias("min"), F.max(value).alias("max"),
        F.percentile(value, points, n).alias("_q"))
    off = x - F.col("_mean")
    sums = [F.sum(off * off * n).alias("_m2"), F.sum(off * off * off * n).alias("_m3")]
    if groups:
        centred = hist.join(first.select(*groups, "_mean"), groups).groupBy(*groups).agg(*sums)
        both = first.join(centred, groups)
    else:
        mean = first.select("_mean").scalar()
        both = first.withColumn("_c", hist.withColumn("_mean", mean).agg(*sums).select(
            F.struct("_m2", "_m3")).scalar()).select("*", "_c.*")
    count, m2, m3 = F.col("count"), F.col("_m2"), F.col("_m3")
    std = F.when(count > 1, F.sqrt(m2 / (count - 1)))
    # Bias-corrected sample skewness, null below three values or without spread.
    skew = F.when((count > 2) & (m2 > 0), (m3 / count) / F.pow(m2 / count, F.lit(1.5))
                  * F.sqrt(count * (count - 1)) / (count - 2))
    return both.withColumns({"mean": F.col("_mean"), "std": std, "skew": skew})


def moments(df: DataFrame, value: str, groups: list[str] = ()) -> DataFrame:
    """mean, median, std and skew of a column."""
    groups = list(groups)
    stats = _summary(value_histogram(df, groups, value), groups, value, [0.5])
    return stats.select(
        *groups, F.col("count").alias("n"), F.col("_q")[0].alias("median"),
        *[F.round(c, 6).alias(c) for c in ("mean", "std", "skew")])


def describe(df: DataFrame, value: str, points: tuple[float, ...], groups: list[str] = ()
             ) -> DataFrame:
    """count, mean, std, min, max and the given percentiles."""
    groups = list(groups)
    stats = _summary(value_histogram(df, groups, value), groups, value, list(points))
    return stats.select(
        *groups, "count", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"),
        "min", "max",
        *[F.round(F.col("_q")[i], 6).alias(f"p{int(round(p * 100))}")
          for i, p in enumerate(points)])


def length_by(df: DataFrame, group: str, with_q75: bool = False) -> DataFrame:
    """Mean, median, std (and 75 %) of characters and words per group."""
    rows = with_lengths(df)
    measures = F.array(
        F.struct(F.lit("char").alias("measure"), F.col("char_count").alias("value")),
        F.struct(F.lit("word").alias("measure"), F.col("word_count").alias("value")),
    )
    long = rows.select(group, F.inline(measures))
    points = (0.5, 0.75) if with_q75 else (0.5,)
    stats = describe(long, "value", points, [group, "measure"])
    columns = ["mean", "p50", "std"] + (["p75"] if with_q75 else [])
    wide = stats.groupBy(group).agg(*[
        F.max(F.when(F.col("measure") == m, F.col(c))).alias(
            f"{m}_{'median' if c == 'p50' else 'q75' if c == 'p75' else c}")
        for m in ("char", "word") for c in columns])
    return wide


def _pct_of(condition: Column, n: Column) -> Column:
    return F.round(F.sum(F.when(condition, n).otherwise(0)) / F.sum(n) * 100, 6)


def by_verification(df: DataFrame) -> DataFrame:
    """Rating, sentiment and length per verification status. One pass reduces the reviews to
    (status, rating, sentiment) cells; the rest is read off the cells."""
    cells = df.withColumn("_words", tx.word_count(F.col("text"))).groupBy(
        "verified_purchase", "rating", "sentiment").agg(
        F.count("*").alias("n"), F.sum("_words").alias("_words"))
    n = F.col("n")
    ratings = cells.where("rating is not null").groupBy("verified_purchase", "rating").agg(
        F.sum("n").alias("n"))
    rated = _summary(ratings, ["verified_purchase"], "rating", [0.5]).select(
        "verified_purchase", F.round("mean", 6).alias("mean_rating"),
        F.col("_q")[0].alias("median_rating"), F.round("std", 6).alias("std_rating"))
    shares = cells.groupBy("verified_purchase").agg(
        _pct_of(F.col("sentiment") == "positive", n).alias("pct_positive"),
        _pct_of(F.col("sentiment") == "negative", n).alias("pct_negative"),
        F.round(F.sum("_words") / F.sum(n), 6).alias("avg_words"))
    return shares.join(rated, "verified_purchase", "left")


def votes_by_domain(df: DataFrame) -> DataFrame:
    v, n = F.col("helpful_vote"), F.col("n")
    return value_histogram(df, ["domain"], "helpful_vote").groupBy("domain").agg(
        F.round(F.sum(v * n) / F.sum(n), 6).alias("mean_votes"),
        F.percentile(v, 0.5, n).alias("median_votes"),
        F.max(v).alias("max_votes"),
        _pct_of(v == 0, n).alias("zero_pct"),
        _pct_of(v >= 1, n).alias("at_least_1_pct"),
        _pct_of(v >= 5, n).alias("at_least_5_pct"))


def crosstab(df: DataFrame, rows: str, columns: str, normalize: str) -> DataFrame:
    """Long cross-tab (row, column, n, pct) normalised within ``rows`` or ``columns``."""
    counts = df.where(F.col(rows).isNotNull() & F.col(columns).isNotNull()).groupBy(
        rows, columns).agg(F.count("*").alias("n"))
    group = {"rows": rows, "columns": columns}[normalize]
    return counts.withColumn("pct", F.round(share(F.col("n"), [group]) * 100, 6))


def crosstab_wide(df: DataFrame, rows: str, columns: str, values: list, normalize: str
                  ) -> DataFrame:
    """Pivoted cross-tab in percent; combinations that do not occur are 0."""
    counts = df.where(F.col(rows).isNotNull()).groupBy(rows).pivot(columns, values).count().na.fill(0)
    cells = [F.col(f"`{v}`") for v in map(str, values)]
    if normalize == "rows":
        total = sum(cells[1:], cells[0])
        shares = [F.round(c / total * 100, 6) for c in cells]
    else:
        everything = Window.partitionBy()
        shares = [F.round(c / F.sum(c).over(everything) * 100, 6) for c in cells]
    return counts.select(rows, *[s.alias(f"pct_{v}") for s, v in zip(shares, values)])


def rating_by_two(df: DataFrame, a: str, b: str) -> DataFrame:
    """count, mean and median rating per pair of keys, from one histogram pass."""
    hist = value_histogram(df, [a, b], "rating")
    return hist.groupBy(a, b).agg(
        F.sum("n").alias("n_reviews"),
        F.round(F.sum(F.col("rating") * F.col("n")) / F.sum("n"), 6).alias("mean_rating"),
        F.percentile("rating", 0.5, F.col("n")).alias("median_rating"),
    )


def rating_by_two_wide(df: DataFrame, rows: str, flag: str) -> DataFrame:
    return df.groupBy(rows).pivot(flag, [False, True]).agg(F.round(F.avg("rating"), 6)).select(
        rows, F.col("`false`").alias("non_verified"), F.col("`true`").alias("verified"))


def tiers(df: DataFrame, value: str, bins, groups: list[str] = (), mean_of: str | None = None
          ) -> DataFrame:
    """Rows per bin and their share; every bin of every group is listed, empty ones with 0."""
    bounds, names = bins
    groups = list(groups)
    measured = [F.count("*").alias("n")]
    if mean_of:
        measured.append(F.round(F.avg(mean_of), 6).alias(f"mean_{mean_of}"))
    counted = df.withColumn("tier", numbers.binned(F.col(value), bounds, names)).groupBy(
        *groups, "tier").agg(*measured)
    # One small row per (group, bin): the groups that occur times the fixed list of names.
    present = counted.select(*groups).distinct() if groups else counted.select(
        F.lit(1).alias("_one")).distinct()
    frame = present.withColumn("tier", F.explode(F.array(*[F.lit(x) for x in names])))
    out = frame.join(counted, groups + ["tier"], "left").drop("_one")
    out = out.withColumn("n", F.coalesce("n", F.lit(0)))
    return out.withColumn("pct", F.round(share(F.col("n"), groups) * 100, 6))


def missing_audit(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(column, missing, pct, type), one pass over the table."""
    columns = columns or df.columns
    types = dict(df.dtypes)
    counted = df.agg(
        F.count("*").alias("_total"),
        *[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    entries = F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).alias("missing"),
                 F.lit(types[c]).alias("data_type"))
        for c in columns])
    return counted.select("_total", F.inline(entries)).select(
        "column_name", "missing", "data_type",
        F.round(F.col("missing") / F.col("_total") * 100, 3).alias("missing_pct"))


def trim_at_percentile(df: DataFrame, value: str, point: float = 0.99) -> DataFrame:
    """Rows whose value is at most the given percentile of all rows."""
    limit = value_histogram(df, [], value).select(F.percentile(value, point, F.col("n")))
    return df.where(F.col(value) <= limit.scalar())


def histogram(df: DataFrame, value: str, bins: int, log: bool = False) -> DataFrame:
    """Equal-width bins between the smallest and largest value, the last one closed.
    With ``log`` the widths are equal on the log10 scale and need positive values."""
    hist = value_histogram(df, [], value)
    x = F.log10(value) if log else F.col(value).cast("double")
    points = hist.select(x.alias("x"), "n")
    low, high = points.agg(F.min("x")).scalar(), points.agg(F.max("x")).scalar()
    position = F.floor((F.col("x") - low) / F.nullif(high - low, F.lit(0.0)) * bins)
    number = F.least(F.coalesce(position, F.lit(0)), F.lit(bins - 1)).cast("int")
    return points.groupBy(number.alias("bin")).agg(F.sum("n").alias("n"))


def box_statistics(df: DataFrame, groups: list[str], value: str) -> DataFrame:
    """Quartiles, mean, and whiskers: the extreme values within 1.5 interquartile ranges."""
    hist = value_histogram(df, groups, value)
    x, n = F.col(value), F.col("n")
    quartiles = hist.groupBy(*groups).agg(
        F.percentile(value, [0.25, 0.5, 0.75], n).alias("_q"),
        F.round(F.sum(x * n) / F.sum(n), 6).alias("mean"),
    ).select(*groups, F.col("_q")[0].alias("q1"), F.col("_q")[1].alias("median"),
             F.col("_q")[2].alias("q3"), "mean")
    reach = (F.col("q3") - F.col("q1")) * 1.5
    inside = x.between(F.col("q1") - reach, F.col("q3") + reach)
    return hist.join(quartiles, groups).groupBy(
        *groups, "q1", "median", "q3", "mean").agg(
        F.min(F.when(inside, x)).alias("whisker_low"),
        F.max(F.when(inside, x)).alias("whisker_high"))


def cumulative_distribution(
    df: DataFrame, group: str, value: str, parts: int | None = None,
) -> DataFrame:
    """Share of rows at or below each value. The running sum goes over distinct values, sorted over
    ``parts`` ranges, so a value that is different in every row needs no task for all of them."""
    summed = running_sum(
        value_histogram(df, [group], value), [group], [F.col(value)], "n", "_upto", "_whole", parts)
    return summed.select(group, value, F.round(F.col("_upto") / F.col("_whole"), 6).alias("cdf"))


def mean_difference(df: DataFrame, value: str, group: str, first: str, second: str) -> DataFrame:
    """Difference of two group means, absolute and in percent of the second."""
    def mean(name):
        return F.avg(F.when(F.col(group) == name, F.col(value)))

    a, b = mean(first), mean(second)
    return df.agg(
        F.round(a, 6).alias("mean_first"), F.round(b, 6).alias("mean_second"),
        F.round(a - b, 6).alias("difference"), F.round((a - b) / b * 100, 6).alias("pct"))


def label_position(label: Column, order=LABEL_REPORT_ORDER) -> Column:
    return F.array_position(F.array(*[F.lit(x) for x in order]), label)
