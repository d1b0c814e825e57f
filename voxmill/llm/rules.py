"""Quality rules: a table of thresholds compiled into one projection of built-in expressions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxmill.llm.common import SPACE, quoted, without

# Frequent words of the four corpus languages.
STOP_WORDS = (
    "the of and to in a is that it for on was be with as this by at are from "
    "de la en le que et des les un du une se au est qui dans pour par sur "
    "der die und den von zu das mit sich auf für ist im dem "
    "el los y las del por con para"
).split()

WINDOW = 8


@dataclass(frozen=True)
class Rule:
    """Rejects a text whose ``measure`` (SQL over the measured columns) lies outside the bounds.
    The rule is asked only of texts with at least ``from_words`` words."""

    name: str
    measure: str
    low: float | None = None
    high: float | None = None
    from_words: int = 0


RULES = (
    Rule("mean_word_length", "word_chars / n_words", 2.0, 15.0, 1),
    Rule("symbols_per_word", "n_symbols / n_words", None, 0.1, 1),
    Rule("echoed_words", "n_echo_words / n_words", None, 0.3, 20),
    Rule("stop_word_share", "n_stop_words / n_words", 0.02, None, 100),
    Rule("repeated_lines", "n_dup_lines / n_lines", None, 0.5, 1),
)


def _bind(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once, also where a lambda uses it per element."""
    return F.transform(F.array(value), body)[0]


def _repeated_words(words: Column) -> Column:
    """Words inside a window of eight that occurs again in the text.

    Windows are hashes of eight word hashes. Only where a hash repeats are the windows sorted by
    (hash, place); the places of repeated windows, in order, then each add the words that the
    window before has not covered. Linear but for that sort.
    """
    def covered(windows: Column) -> Column:
        ordered = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def starts(sorted_windows: Column) -> Column:
            return F.array_sort(F.transform(
                F.filter(sorted_windows, lambda w, j: (
                    (j > 0) & (F.get(sorted_windows, j - 1)["h"] == w["h"])) | (
                    F.coalesce(F.get(sorted_windows, j + 1)["h"] == w["h"], F.lit(False)))),
                lambda w: w["i"]))

        def total(places: Column) -> Column:
            return F.aggregate(
                F.transform(places, lambda p, j: F.least(
                    F.coalesce(F.get(places, j + 1) - p, F.lit(WINDOW)), F.lit(WINDOW))),
                F.lit(0).cast("long"), lambda total, n: total + n)

        sort_and_count = _bind(ordered, lambda o: _bind(starts(o), total))
        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0).cast("long")
                      ).otherwise(sort_and_count)

    def windows(hashes: Column) -> Column:
        places = F.sequence(F.lit(0), F.size(hashes) - WINDOW)
        return F.transform(places, lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(WINDOW)]))

    hashes = F.transform(words, lambda w: F.xxhash64(w))
    return F.when(F.size(words) < WINDOW, F.lit(0).cast("long")).otherwise(
        _bind(hashes, lambda h: _bind(windows(h), covered)))


def _measures(text: Column) -> Column:
    """One struct of all counts of a text; a null text has none."""
    words = F.filter(F.split(text, f"[{SPACE}]+"), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(f"[^{SPACE}]"))
    stop = F.array(*[F.lit(w) for w in STOP_WORDS])

    def counted(words: Column, lines: Column) -> Column:
        n = F.size(words)
        long = lambda c: c.cast("long")
        return F.struct(
            long(n).alias("n_words"),
            long(F.length(F.regexp_replace(text, f"[{SPACE}]+", ""))).alias("word_chars"),
            long(F.length(F.regexp_replace(text, r"[^#*$%&|<>]+", ""))).alias("n_symbols"),
            long(F.size(lines) - F.size(F.array_distinct(lines))).alias("n_dup_lines"),
            _repeated_words(words).alias("n_repeat_words"),
            long(F.size(lines)).alias("n_lines"),
            long(F.size(F.filter(words, lambda w: F.array_contains(stop, F.lower(w))))).alias(
                "n_stop_words"),
            long(F.size(F.filter(words, lambda w, i: (i > 0) & (F.get(words, i - 1) == w)))).alias(
                "n_echo_words"))

    return _bind(words, lambda w: _bind(lines, lambda li: counted(w, li)))


def verdict(rules: tuple[Rule, ...] = RULES) -> Column:
    """True where no rule rejects: the threshold table as one Boolean expression."""
    kept = F.lit(True)
    for rule in rules:
        value, inside = F.expr(rule.measure), F.lit(True)
        if rule.low is not None:
            inside = inside & (value >= rule.low)
        if rule.high is not None:
            inside = inside & (value <= rule.high)
        kept = kept & F.when(F.col("n_words") >= rule.from_words, F.coalesce(inside, F.lit(True))
                             ).otherwise(True)
    return kept


MEASURED = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines",
            "n_stop_words", "n_echo_words")


def quality_rules(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows of ``docs`` with the counts of MEASURED, ``base_failed`` and ``kept``.

    One projection without shuffles or user functions. Words are runs of other than ASCII white
    space. ``base_failed``: fewer than 20 words, or over 30 % of them in windows of eight words
    found twice or more. ``kept``: not ``base_failed`` and inside the bounds of every rule.
    A null or empty text has counts of 0 and fails; a very long one is judged as a whole; repeated rows
    are judged one by one; an empty table gives an empty one. Columns of ``docs`` named like a result
    are replaced.
    """
    results = (*MEASURED, "base_failed", "kept")
    others = without(docs.columns, *results)
    value = F.coalesce(quoted(text).cast("string"), F.lit(""))
    # The generator keeps the optimiser from evaluating the counts once per use.
    held = docs.select(
        F.struct(*[quoted(c) for c in others]).alias("_row"),
        F.explode(F.array(_measures(value))).alias("_m"))
    flat = held.select("_row", "_m.*")
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    judged = flat.withColumn("base_failed", failed).withColumn(
        "kept", ~F.col("base_failed") & verdict(rules))
    return judged.select(
        *[F.col("_row")[c].alias(c) for c in others], *results)
