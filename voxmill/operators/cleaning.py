"""Review cleaning: missing and short text, keep-first duplicates, labels, the row funnel."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voxmill.config import LABELS, MIN_CHARS, MIN_WORDS
from voxmill.functions import labels, numbers, text as tx
from voxmill.session import cut

#: Hashes of repeated texts that are copied to every task at most.
MAX_REPEATED = 1_000_000


def keep_first(df: DataFrame, keys: list[Column], order: Column | str) -> DataFrame:
    """The first row per key. Each map task keeps one candidate per key before the shuffle, so
    a key that holds a third of the rows still reaches its task as a few rows."""
    window = Window.partitionBy(*keys).orderBy(order)
    return (
        df.withColumn("_first", F.row_number().over(window)).where("_first = 1").drop("_first")
    )


def text_key(column: Column) -> Column:
    """A fixed-width stand-in for a whole text in shuffles."""
    return F.sha2(column, 256)


def computed_once(df: DataFrame, values: dict[str, Column]) -> DataFrame:
    """Adds or replaces columns whose expressions are costly. They come out of a generator,
    which later filters are not pushed through: a filter on the value then reads it instead of
    evaluating the expression a second time below."""
    made = F.inline(F.array(F.struct(*[c.alias(name) for name, c in values.items()])))
    return df.select(*[c for c in df.columns if c not in values], made)


def checked_reviews(
    raw: DataFrame, min_words: int = MIN_WORDS, min_chars: int = MIN_CHARS,
    max_chars: int | None = None,
) -> DataFrame:
    """Raw rows with cleaned text, numeric rating and what is wrong with the text, if anything."""
    values = {
        "_missing": tx.is_blank(F.col("text")),
        "text": tx.clean_text(F.col("text"), max_chars),
        "rating": labels.to_number(F.col("rating")),
    }
    if "title" in raw.columns:
        values["title"] = tx.clean_text(F.col("title"), max_chars)
    out = computed_once(raw, values)
    short = (tx.word_count(F.col("text")) < min_words) | (tx.char_count(F.col("text")) < min_chars)
    reason = F.when(F.col("_missing"), "missing").when(short, "short").otherwise("ok")
    return out.withColumn("_reason", reason).drop("_missing")


def _hash(subset: tuple[str, ...] = ("text",)) -> Column:
    return F.xxhash64("domain", *subset).alias("_hash")


def repeated_texts(
    raw: DataFrame, min_words: int = MIN_WORDS, min_chars: int = MIN_CHARS,
    max_chars: int | None = None, subset: tuple[str, ...] = ("text",), most: int = MAX_REPEATED,
) -> DataFrame | None:
    """(_hash): what the usable rows hash to that may be duplicates of another, for ``clean_reviews``
    and ``cleaning_funnel``; rows that hash alone need no comparison. None when they are more than
    ``most``: then all rows are compared."""
    used = raw.select(*dict.fromkeys(["domain", "text", "rating", *subset]))
    kept = checked_reviews(used, min_words, min_chars, max_chars).where("_reason = 'ok'")
    found = cut(kept.select(_hash(subset)).groupBy("_hash").agg(F.count("*").alias("_n")).where("_n > 1").select("_hash"))
    return found if found.count() <= most else None


def clean_reviews(
    raw: DataFrame, min_words: int = MIN_WORDS, min_chars: int = MIN_CHARS,
    max_chars: int | None = None, subset: tuple[str, ...] = ("text",), repeated: DataFrame | None = None,
) -> DataFrame:
    """Cleaned, unique, labelled reviews. ``row_id`` decides which duplicate is the first. With
    ``repeated``, as from ``repeated_texts`` of the same rows, only rows that may be duplicates are
    shuffled."""
    kept = checked_reviews(raw, min_words, min_chars, max_chars).where("_reason = 'ok'").drop("_reason")
    keys = [F.col("domain")] + [
        text_key(F.col(c)) if c == "text" else F.col(c) for c in subset]
    if repeated is None:
        unique = keep_first(kept, keys, "row_id")
    else:
        hashed, listed = kept.select("*", _hash(subset)), F.broadcast(repeated)
        alone = hashed.join(listed, "_hash", "left_anti").drop("_hash")
        again = hashed.join(listed, "_hash", "left_semi").drop("_hash")
        unique = alone.unionByName(keep_first(again, keys, "row_id"))
    return (
        unique.withColumn("sentiment", labels.rating_label(F.col("rating")))
        .where(F.col("sentiment").isNotNull())
    )


def cleaning_funnel(
    raw: DataFrame, min_words: int = MIN_WORDS, min_chars: int = MIN_CHARS,
    max_chars: int | None = None, repeated: DataFrame | None = None,
) -> DataFrame:
    """Per domain: rows before, removed for each cause, after, and label counts and shares.

    Only digests, ids and label codes are shuffled, never the texts; with ``repeated``, as from
    ``repeated_texts`` of the same rows, those of the rows that may be duplicates, and sums.
    """
    rows = checked_reviews(
        raw.select("domain", "row_id", "text", "rating"), min_words, min_chars, max_chars)
    ok = F.col("_reason") == "ok"
    alone = F.lit(False)
    if repeated is not None:
        listed = F.broadcast(repeated.withColumn("_again", F.lit(True)))
        rows = rows.select("*", _hash()).join(listed, "_hash", "left")
        alone = ok & F.col("_again").isNull()
    rows = rows.select(
        "domain", "row_id", "_reason", alone.alias("_alone"),
        F.when(ok & ~alone, text_key(F.col("text"))).alias("_key"),
        labels.encode_label(labels.rating_label(F.col("rating"))).alias("_code"),
    )
    # Texts that are alone are summed by their code, the others told apart.
    own = F.when(F.col("_alone") & F.col("row_id").isNotNull(), F.col("_code"))
    texts = rows.withColumn("_own", own).groupBy("domain", "_reason", "_alone", "_own", "_key").agg(
        F.count("*").alias("_n"), F.min_by("_code", "row_id").alias("_code")).withColumns({
            "_code": F.when(F.col("_alone"), F.col("_own")).otherwise(F.col("_code")),
            "_texts": F.when(F.col("_alone"), F.col("_n")).otherwise(1)})

    def total(condition, value=F.col("_n")):
        return F.coalesce(F.sum(F.when(condition, value)), F.lit(0)).cast("long")

    counted = texts.groupBy("domain").agg(
        F.sum("_n").alias("reviews_before"),
        total(F.col("_reason") == "missing").alias("missing_removed"),
        total(F.col("_reason") == "short").alias("short_removed"),
        total(ok, F.col("_n") - F.col("_texts")).alias("duplicates_removed"),
        total(ok & F.col("_code").isNull(), F.col("_texts")).alias("unlabeled_removed"),
        total(ok & F.col("_code").isNotNull(), F.col("_texts")).alias("reviews_after"),
        *[total(ok & (F.col("_code") == i), F.col("_texts")).alias(f"{name}_count")
          for i, name in enumerate(LABELS)],
    )
    return counted.withColumns({
        f"{name}_pct": numbers.percent(F.col(f"{name}_count"), F.col("reviews_after"), 4)
        for name in LABELS
    })


def cleaning_report(funnel: DataFrame) -> DataFrame:
    """The funnel as (domain, position, measure, value) rows in report order."""
    measures = [
        ("Reviews before cleaning", "reviews_before"),
        ("Reviews after cleaning", "reviews_after"),
        ("Duplicates removed", "duplicates_removed"),
        ("Missing reviews removed", "missing_removed"),
        ("Short reviews removed", "short_removed"),
        ("Positive", "positive_count"), ("Neutral", "neutral_count"),
        ("Negative", "negative_count"),
    ]
    lines = F.array(*[
        F.struct(F.lit(i).alias("position"), F.lit(name).alias("measure"),
                 F.col(column).alias("value"))
        for i, (name, column) in enumerate(measures, 1)
    ])
    return funnel.select("domain", F.inline(lines))
