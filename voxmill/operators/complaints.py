"""Complaint aspects: frequencies, breakdowns per product, multi-label evaluation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voxmill.config import RUN_ASPECT_THRESHOLD
from voxmill.functions import aspects as asp, labels, numbers, text as tx
from voxmill.operators.sampling import sample_per_group
from voxmill.operators.skew import broadcast_if_small


def aspect_frequencies(df: DataFrame, aspects: str = "aspects") -> DataFrame:
    """How many reviews name each aspect, for each domain and for all, and their share.

    One grouping per (domain, aspect); the totals ride along as the null aspect.
    """
    tagged = df.select(
        "domain",
        F.explode(F.array_append(F.array_distinct(aspects), F.lit(None).cast("string")))
        .alias("aspect"))
    counts = tagged.groupBy("domain", "aspect").agg(F.count("*").alias("n"))
    both = counts.withColumn(
        "domain", F.explode(F.array(F.col("domain"), F.lit("All")))
    ).groupBy("domain", "aspect").agg(F.sum("n").alias("n"))
    total = F.max(F.when(F.col("aspect").isNull(), F.col("n"))).over(Window.partitionBy("domain"))
    return both.withColumn("total_reviews", total).where(F.col("aspect").isNotNull()).select(
        "domain", "aspect", "n", "total_reviews",
        numbers.rounded(F.col("n") / F.col("total_reviews") * 100.0, 2).alias("frequency_pct"))


def multi_aspect_share(df: DataFrame, aspects: str = "aspects") -> DataFrame:
    """Per domain: share of reviews that name two or more aspects."""
    several = F.size(F.array_distinct(aspects)) >= 2
    return df.groupBy("domain").agg(
        F.count("*").alias("n_reviews"), F.count_if(several).alias("n_multi"),
        F.round(F.avg(F.when(several, 100.0).otherwise(0.0)), 6).alias("pct_multi"))


def complaint_breakdown(
    reviews: DataFrame, mode: str = "label", top: int | None = None, aspects: str = "aspects",
    key: str = "parent_asin",
) -> DataFrame:
    """Per product: aspects of its negative reviews with count, share and rank.

    Counts are combined before the shuffle; the ranking then sees at most one row per product
    and aspect. The null aspect carries the number of negatives.
    """
    negatives = reviews.where(labels.is_negative(mode)).select(
        key, F.explode(F.array_append(F.array_distinct(aspects), F.lit(None).cast("string")))
        .alias("aspect"))
    counts = negatives.groupBy(key, "aspect").agg(F.count("*").alias("n"))
    total = F.max(F.when(F.col("aspect").isNull(), F.col("n"))).over(Window.partitionBy(key))
    ranked = counts.withColumn("total_negatives", total).where(
        F.col("aspect").isNotNull()).withColumn(
        "rank", F.row_number().over(Window.partitionBy(key).orderBy(F.desc("n"), "aspect")))
    if top:
        ranked = ranked.where(F.col("rank") <= top)
    return ranked.withColumns({
        "display_name": asp.display_name(F.col("aspect")),
        "percentage": numbers.percent(F.col("n"), F.col("total_negatives")),
    })


def annotation_statistics(df: DataFrame, labels_column: str = "aspect_labels") -> DataFrame:
    """Per domain and aspect of a labelled set: count, share, and a bar of one mark per 4 %."""
    parsed = df.withColumn("aspects", asp.parse_aspects(F.col(labels_column)))
    out = aspect_frequencies(parsed).where("domain <> 'All'")
    pct = F.col("n") / F.col("total_reviews") * 100.0
    return out.select(
        "domain", "aspect", "n", "total_reviews", numbers.rounded(pct, 1).alias("pct"),
        numbers.text_bar(pct, 4, "=").alias("bar"))


def annotation_set(
    reviews: DataFrame, per_domain: int = 150, seed: int = 42,
    min_chars: int = 35, max_chars: int = 750, prefixes: dict[str, str] | None = None,
) -> DataFrame:
    """Negative reviews of informative length, n per domain, with first labels and ids."""
    # Id prefixes.
    prefixes = prefixes or {"Electronics": "ELEC", "Fashion": "FASH"}
    informative = F.length(F.coalesce("text", F.lit(""))).between(min_chars, max_chars)
    candidates = reviews.where(labels.is_negative("label") & informative)
    # ``position`` is at most per_domain, the size of the sample itself.
    sampled = sample_per_group(candidates, ["domain"], per_domain, seed, position="position")
    prefix = F.create_map(*[F.lit(x) for kv in prefixes.items() for x in kv])[F.col("domain")]
    text = tx.full_text_once(F.col("title"), F.col("text"))
    return sampled.select(
        F.format_string("%s-%03d", prefix, F.col("position")).alias("review_id"),
        "domain", text.alias("text"),
        F.array_join(asp.annotate_aspects(text, F.col("domain")), "; ").alias("aspect_labels"))


def aspect_predictions(
    annotated: DataFrame, scores: Column | None = None, threshold: float = RUN_ASPECT_THRESHOLD,
) -> DataFrame:
    """Truth, detected aspects and confidences per review."""
    scores = asp.lexicon_scores(F.col("text"), F.col("domain")) if scores is None else scores
    scored = annotated.withColumn("_scores", scores)
    detected = asp.select_by_threshold(F.col("_scores"), threshold)
    return scored.select(
        "review_id", F.col("text").alias("review"), "domain",
        F.col("aspect_labels").alias("ground_truth_aspects"),
        F.array_join(detected, "; ").alias("detected_aspects"),
        F.to_json(asp.rounded_scores(F.col("_scores"))).alias("confidence"),
        detected.alias("detected"),
        asp.parse_aspects(F.col("aspect_labels")).alias("truth"))


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def label_counts(df: DataFrame, truth: str, predicted: str, groups: list[str] = ()) -> DataFrame:
    """True positives, false positives and misses per label. The two lists of a row are merged
    in the row, so no join is needed."""
    merged = F.array_distinct(F.concat(truth, predicted))
    cells = F.transform(merged, lambda a: F.struct(
        a.alias("label"),
        F.array_contains(truth, a).alias("t"), F.array_contains(predicted, a).alias("p")))
    rows = df.select(*groups, F.inline(cells))
    return rows.groupBy(*groups, "label").agg(
        F.count_if(F.col("t") & F.col("p")).alias("tp"),
        F.count_if(~F.col("t") & F.col("p")).alias("fp"),
        F.count_if(F.col("t") & ~F.col("p")).alias("fn"))


def label_metrics(counts: DataFrame, groups: list[str] = ()) -> DataFrame:
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    p, r = _ratio(tp, tp + fp), _ratio(tp, tp + fn)
    return counts.select(
        *groups, "label", p.alias("precision"), r.alias("recall"),
        _ratio(2 * tp, 2 * tp + fp + fn).alias("f1"), (tp + fn).alias("support"),
        "tp", "fp", "fn")


def multilabel_evaluation(
    df: DataFrame, truth: str, predicted: str, groups: list[str] = (),
    targets: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(summary, per label). With ``targets`` (groups, label) exactly those labels count and
    absent ones score 0; without it the labels that occur do."""
    groups = list(groups)
    counts = label_counts(df, truth, predicted, groups)
    if targets is not None:
        # Both sides are small: the taxonomy, and one row per group and label.
        counts = targets.join(broadcast_if_small(counts), groups + ["label"], "left").na.fill(
            0, ["tp", "fp", "fn"])
    per_label = label_metrics(counts, groups)
    sums = {c: F.sum(c) for c in ("tp", "fp", "fn")}
    micro_p = _ratio(sums["tp"], sums["tp"] + sums["fp"])
    micro_r = _ratio(sums["tp"], sums["tp"] + sums["fn"])
    micro_f = _ratio(2 * sums["tp"], 2 * sums["tp"] + sums["fp"] + sums["fn"])
    summary = per_label.groupBy(*groups).agg(
        F.count("*").alias("aspect_count"),
        numbers.rounded(micro_p, 4).alias("micro_precision"),
        numbers.rounded(micro_r, 4).alias("micro_recall"),
        numbers.rounded(micro_f, 4).alias("micro_f1"),
        numbers.rounded(F.avg("precision"), 4).alias("macro_precision"),
        numbers.rounded(F.avg("recall"), 4).alias("macro_recall"),
        numbers.rounded(F.avg("f1"), 4).alias("macro_f1"))
    sizes = df.groupBy(*groups).agg(F.count("*").alias("sample_count"))
    summary = summary.join(sizes, groups) if groups else summary.withColumn(
        "sample_count", sizes.scalar())
    rounded = per_label.select(*groups, "label", *[
        numbers.rounded(F.col(c), 4).alias(c) for c in ("precision", "recall", "f1")], "support")
    return summary, rounded
