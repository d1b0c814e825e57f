"""User-supplied batch scorers over review texts."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voxmill.functions import numbers

# A scorer maps a batch of (text, domain) to one {label: score} dict per row.
Scorer = Callable[[pd.Series, pd.Series], "list[dict[str, float]]"]


def score_texts(
    df: DataFrame, factory: Callable[[], Scorer], text: str = "text", domain: str = "domain",
    identity: str = "row_id",
) -> DataFrame:
    """(identity, scores). ``factory`` runs once per task, so a model is loaded once and then
    serves Arrow batches; only the three columns it needs cross into Python."""
    id_type = df.schema[identity].dataType
    schema = T.StructType([
        T.StructField(identity, id_type),
        T.StructField("scores", T.MapType(T.StringType(), T.DoubleType()))])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = factory()
        for batch in batches:
            yield pd.DataFrame({
                identity: batch[identity], "scores": scorer(batch[text], batch[domain])})

    return df.select(identity, text, domain).mapInPandas(run, schema)


def best_label(scores: str = "scores"):
    """The top label and its score (four places) of a score map; ties go to the first name."""
    entries = F.transform(F.map_entries(scores), lambda e: F.struct(
        (-e["value"]).alias("minus"), e["key"].alias("label")))
    top = F.array_min(entries)
    return top["label"], numbers.rounded(-top["minus"], 4)


def score_where(
    df: DataFrame, condition, factory: Callable[[], Scorer], text: str = "text",
    domain: str = "domain", identity: str = "row_id",
) -> DataFrame:
    """Scores only the rows that meet ``condition``; the others get an empty map. The filter
    comes first, since a Python function under ``when`` would still see every row."""
    scored = score_texts(df.where(condition), factory, text, domain, identity)
    return df.join(scored, identity, "left").withColumn(
        "scores", F.coalesce("scores", F.create_map().cast("map<string,double>")))
