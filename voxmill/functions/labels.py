"""Rating labels and the sentiment predicates built on them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from voxmill.config import LABELS


#: Fixed value: the spellings of a number.
NUMBER = r"(?i)^\s*[+-]?(\d+\.?\d*([eE][+-]?\d+)?|\.\d+([eE][+-]?\d+)?|inf(inity)?)\s*$"


def to_number(value: Column) -> Column:
    """Numeric coercion: unreadable values and NaN become null. Only decimal numbers and infinity are
    readable, not the suffixes and hexadecimal forms a cast takes."""
    number = value.try_cast("double")
    return F.when(~F.isnan(number) & value.cast("string").rlike(NUMBER), number)


def rating_label(rating: Column) -> Column:
    """At most 2 is negative, exactly 3 neutral, at least 4 positive, anything else null."""
    rating = to_number(rating)
    return (
        F.when(rating <= 2.0, "negative").when(rating == 3.0, "neutral")
        .when(rating >= 4.0, "positive")
    )


def encode_label(label: Column) -> Column:
    """negative, neutral, positive as 0, 1, 2; case and outer blanks do not matter."""
    label = F.lower(F.trim(label))
    code = F.when(label == LABELS[0], 0)
    for number, name in enumerate(LABELS[1:], 1):
        code = code.when(label == name, number)
    return code


def decode_label(code: Column) -> Column:
    return F.get(F.array(*[F.lit(name) for name in LABELS]), code)


def _true(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


_POLARITY = {
    "negative": lambda rating: rating <= 2.0,
    "positive": lambda rating: rating >= 4.0,
}


def has_polarity(
    polarity: str,
    mode: str,
    sentiment: Column | None = None,
    predicted: Column | None = None,
    rating: Column | None = None,
) -> Column:
    """Null-safe predicate. ``label`` reads the rating label, ``predicted`` adds the model's
    label, ``wide`` adds the star rating as well."""
    sentiment = F.col("sentiment") if sentiment is None else sentiment
    result = _true(sentiment == polarity)
    if mode == "label":
        return result
    predicted = F.col("predicted_sentiment") if predicted is None else predicted
    result = result | _true(predicted == polarity)
    if mode == "predicted":
        return result
    if mode != "wide":
        raise ValueError(f"unknown mode '{mode}'")
    rating = F.col("rating") if rating is None else rating
    return result | _true(_POLARITY[polarity](rating))


def is_negative(mode: str = "label", **columns) -> Column:
    return has_polarity("negative", mode, **columns)


def is_positive(mode: str = "wide", **columns) -> Column:
    return has_polarity("positive", mode, **columns)


def in_domain(domain: str | None) -> Column:
    """Case-insensitive domain filter; None and ``combined`` keep every row."""
    if not domain or domain.lower() == "combined":
        return F.lit(True)
    return F.lower(F.col("domain")) == domain.lower()
