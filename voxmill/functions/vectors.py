"""Vector columns held as arrays of doubles."""

from __future__ import annotations

from pyspark.ml.feature import HashingTF, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxmill.functions.text import word_tokens


def inner_product(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda s, x: s + x * x))


def unit(a: Column) -> Column:
    length = norm(a)
    return F.when(length > 0, F.transform(a, lambda x: x / length)).otherwise(a)


def text_vectors(df: DataFrame, text: str, out: str = "vec", dims: int = 256) -> DataFrame:
    """Hashed word counts, scaled to length one."""
    hashed = HashingTF(numFeatures=dims, inputCol="_words", outputCol="_tf")
    scaled = Normalizer(p=2.0, inputCol="_tf", outputCol="_unit")
    with_words = df.withColumn("_words", word_tokens(F.col(text)))
    vectors = scaled.transform(hashed.transform(with_words))
    return vectors.withColumn(out, vector_to_array("_unit")).drop("_words", "_tf", "_unit")
