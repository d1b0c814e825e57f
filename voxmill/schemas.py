"""Explicit schemas of the tables the operators read and write."""

from pyspark.sql import types as T

_STR, _DBL, _LNG, _BOOL = T.StringType(), T.DoubleType(), T.LongType(), T.BooleanType()


def _struct(*pairs) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in pairs])


RAW_REVIEW = _struct(
    ("row_id", _LNG), ("rating", _DBL), ("title", _STR), ("text", _STR), ("asin", _STR),
    ("parent_asin", _STR), ("user_id", _STR), ("timestamp", _LNG), ("helpful_vote", _LNG),
    ("verified_purchase", _BOOL), ("domain", _STR),
)

REVIEW = _struct(
    ("row_id", _LNG), ("domain", _STR), ("parent_asin", _STR), ("asin", _STR), ("rating", _DBL),
    ("sentiment", _STR), ("title", _STR), ("text", _STR), ("timestamp", _LNG),
    ("helpful_vote", _LNG), ("verified_purchase", _BOOL),
)

RAW_METADATA = _struct(
    ("domain", _STR), ("parent_asin", _STR), ("title", _STR), ("average_rating", _DBL),
    ("price", _STR), ("description", T.ArrayType(_STR)), ("categories", T.ArrayType(_STR)),
    ("store", _STR),
)

PRODUCT = _struct(
    ("domain", _STR), ("parent_asin", _STR), ("title", _STR), ("average_rating", _DBL),
    ("price", _STR), ("description", _STR), ("categories", T.ArrayType(_STR)), ("store", _STR),
)

ANNOTATION = _struct(
    ("review_id", _STR), ("domain", _STR), ("text", _STR), ("aspect_labels", _STR),
)

PREDICTION = _struct(
    ("model", _STR), ("domain", _STR), ("sample_id", _LNG), ("y_true", _STR), ("y_pred", _STR),
)

COMPLAINT_ASPECTS = T.ArrayType(_struct(
    ("aspect", _STR), ("display_name", _STR), ("count", _LNG), ("percentage", _DBL),
))
