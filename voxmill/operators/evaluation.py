"""Single-label evaluation and model comparison over a long prediction table.

Predictions are counted once per (group, truth, prediction); every metric is computed from those
few counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voxmill.config import COMBINED, LABELS
from voxmill.functions import numbers, text as tx
from voxmill.functions.labels import decode_label, encode_label
from voxmill.operators.skew import broadcast_if_small
from voxmill.session import cut


def confusion_counts(
    predictions: DataFrame, groups: list[str], with_combined: bool = False,
) -> DataFrame:
    """(groups, y_true, y_pred, n). The combined domain is the sum of the counted cells."""
    counts = predictions.groupBy(*groups, "y_true", "y_pred").agg(F.count("*").alias("n"))
    if not with_combined:
        return counts
    twice = counts.withColumn("domain", F.explode(F.array(F.col("domain"), F.lit(COMBINED))))
    return twice.groupBy(*groups, "y_true", "y_pred").agg(F.sum("n").alias("n"))


def confusion_matrix(counts: DataFrame, groups: list[str], labels=LABELS) -> DataFrame:
    """All label pairs in fixed order; pairs that never occur are 0."""
    names = F.array(*[F.lit(x) for x in labels])
    frame = counts.select(*groups).distinct().withColumn(
        "y_true", F.explode(names)).withColumn("y_pred", F.explode(names))
    return frame.join(counts, groups + ["y_true", "y_pred"], "left").select(
        *groups, "y_true", "y_pred", F.coalesce("n", F.lit(0)).alias("n"))


def confusion_matrix_wide(counts: DataFrame, groups: list[str], labels=LABELS) -> DataFrame:
    wide = confusion_matrix(counts, groups, labels).groupBy(*groups, "y_true").pivot(
        "y_pred", list(labels)).agg(F.sum("n"))
    return wide.select(*groups, "y_true", *[F.col(x).alias(f"pred_{x}") for x in labels])


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def class_metrics(counts: DataFrame, groups: list[str]) -> DataFrame:
    """Precision, recall, F1 and support of every label that occurs as truth or prediction."""
    n, same = F.col("n"), F.col("y_true") == F.col("y_pred")
    sides = F.array(
        F.struct(F.col("y_true").alias("label"), n.alias("t"), F.lit(0).cast("long").alias("p"),
                 F.when(same, n).otherwise(0).alias("tp")),
        F.struct(F.col("y_pred").alias("label"), F.lit(0).cast("long").alias("t"), n.alias("p"),
                 F.lit(0).cast("long").alias("tp")))
    sums = counts.select(*groups, F.inline(sides)).groupBy(*groups, "label").agg(
        F.sum("t").alias("support"), F.sum("p").alias("predicted"), F.sum("tp").alias("tp"))
    tp, t, p = F.col("tp"), F.col("support"), F.col("predicted")
    return sums.select(
        *groups, "label", _ratio(tp, p).alias("precision"), _ratio(tp, t).alias("recall"),
        _ratio(2 * tp, t + p).alias("f1"), "support", "tp")


def overall_metrics(counts: DataFrame, groups: list[str]) -> DataFrame:
    """Accuracy, weighted and macro averages, and the neutral class, unrounded."""
    per_class = class_metrics(counts, groups)
    support = F.col("support")
    total = F.sum("support")
    neutral = F.col("label") == "neutral"

    def weighted(column):
        return F.sum(F.col(column) * support) / total

    def of_neutral(column):
        return F.coalesce(F.max(F.when(neutral, F.col(column))), F.lit(0.0))

    return per_class.groupBy(*groups).agg(
        total.alias("sample_count"),
        (F.sum("tp") / total).alias("accuracy"),
        weighted("precision").alias("weighted_precision"),
        weighted("recall").alias("weighted_recall"),
        weighted("f1").alias("weighted_f1"),
        F.avg("precision").alias("macro_precision"),
        F.avg("recall").alias("macro_recall"),
        F.avg("f1").alias("macro_f1"),
        of_neutral("precision").alias("neutral_precision"),
        of_neutral("recall").alias("neutral_recall"),
        of_neutral("f1").alias("neutral_f1"),
        F.coalesce(F.max(F.when(neutral, support)), F.lit(0)).alias("neutral_support"))


METRICS = {
    "accuracy": "accuracy", "precision": "weighted_precision", "recall": "weighted_recall",
    "f1": "weighted_f1", "macro_f1": "macro_f1", "neutral_f1": "neutral_f1",
}


def comparison_table(counts: DataFrame) -> DataFrame:
    """Model × domain, rounded to four places."""
    overall = overall_metrics(counts, ["model", "domain"])
    return overall.select("model", "domain", *[
        numbers.rounded(F.col(source), 4).alias(name) for name, source in METRICS.items()])


def comparison_long(table: DataFrame) -> DataFrame:
    return table.unpivot(["model", "domain"], list(METRICS), "metric", "score")


def neutral_table(counts: DataFrame, groups: list[str]) -> DataFrame:
    return class_metrics(counts, groups).where(F.col("label") == "neutral").select(
        *groups, *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")], "support")


def against_baseline(table: DataFrame, baseline: str) -> DataFrame:
    """Every model's row next to the baseline's of the same domain; a missing one counts 0.0."""
    base = table.where(F.col("model") == baseline).select(
        "domain", *[F.col(c).alias(f"base_{c}") for c in METRICS])
    others = table.where(F.col("model") != baseline)
    return others.join(base, "domain", "left").na.fill(0.0, [f"base_{c}" for c in METRICS])


def class_weights(df: DataFrame, groups: list[str], label: str = "sentiment") -> DataFrame:
    """Balanced weights n / (k · n_label), from the counts."""
    counts = df.where(F.col(label).isNotNull()).groupBy(*groups, label).agg(F.count("*").alias("n"))
    everyone = Window.partitionBy(*groups)
    return counts.withColumn(
        "weight", F.sum("n").over(everyone) / (F.count("*").over(everyone) * F.col("n")))


def aligned_predictions(predictions: DataFrame, models: list[str], keys: list[str]) -> DataFrame:
    """One row per sample with a column per model. A label outside the three is kept as it is; the
    known ones are written in their normal form, and come before others where a model has several.

    Labels are aggregated as numbers of fixed size, unknown ones by their hash, so the aggregation
    stays a hash table; the distinct unknown labels, if there are any, give their names back."""
    known = encode_label(F.col("y_pred")).cast("long")
    # A hash of 63 bits, above the codes of the known labels.
    other = F.greatest(F.shiftrightunsigned(F.xxhash64("y_pred"), 1), F.lit(len(LABELS)).cast("long"))
    unknown = cut(predictions.where(known.isNull() & F.col("y_pred").isNotNull()).select("y_pred").distinct().select(
        other.alias("_hash"), "y_pred"))
    named = predictions.select(*keys, "y_true", "model", F.when(
        F.col("y_pred").isNotNull(), F.coalesce(known, other)).alias("_code"))
    wide = named.groupBy(*keys, "y_true").agg(*[
        F.min(F.when(F.col("model") == m, F.col("_code"))).alias(f"_code_{m}") for m in models])
    names = {m: decode_label(F.when(F.col(f"_code_{m}") < len(LABELS), F.col(f"_code_{m}")).cast("int")) for m in models}
    if unknown.isEmpty():
        return wide.select(*keys, "y_true", *[names[m].alias(f"pred_{m}") for m in models])
    unknown = broadcast_if_small(unknown)
    for m in models:
        found = unknown.select(F.col("_hash").alias(f"_code_{m}"), F.col("y_pred").alias(f"_other_{m}"))
        wide = wide.join(found, f"_code_{m}", "left")
    return wide.select(*keys, "y_true", *[F.coalesce(names[m], F.col(f"_other_{m}")).alias(f"pred_{m}") for m in models])


# The kinds of error; {0} and {1} are models.
NEUTRAL_ERROR, ALL_FAILED, SINGLE_ERROR = "Neutral Misclassification", "All Models Failed", "Single Model Error"
ONE_FAILED = "{0} Succeeded, {1} Failed"


def error_analysis(aligned: DataFrame, baseline: str, tuned: str, other: str) -> DataFrame:
    """Samples at least one model gets wrong, with the kinds of error. A model without a prediction,
    or with a label nobody knows, is wrong."""
    wrong = {m: ~F.col(f"pred_{m}").eqNullSafe(F.col("y_true")) for m in (baseline, tuned, other)}
    all_wrong = wrong[baseline] & wrong[tuned] & wrong[other]
    only_tuned_side = ~all_wrong & wrong[tuned] & ~wrong[other]
    tuned_better = ~all_wrong & ~only_tuned_side & ~wrong[tuned] & wrong[baseline]
    kinds = F.array_compact(F.array(
        F.when(F.col("y_true") == "neutral", NEUTRAL_ERROR),
        F.when(all_wrong, ALL_FAILED)
        .when(only_tuned_side, ONE_FAILED.format(other, tuned))
        .when(tuned_better, ONE_FAILED.format(tuned, baseline))))
    return aligned.where(wrong[baseline] | wrong[tuned] | wrong[other]).withColumn(
        "error_categories",
        F.when(F.size(kinds) == 0, SINGLE_ERROR).otherwise(F.array_join(kinds, ", ")))


def text_snippet(text: Column) -> Column:
    return tx.ellipsize(text, 120, 120)


def with_snippets(errors: DataFrame, texts: DataFrame, keys: list[str]) -> DataFrame:
    """The errors with the beginning of their text; only that is shuffled."""
    return errors.join(texts.select(*keys, text_snippet(F.col("text")).alias("text_snippet")), keys, "left")
