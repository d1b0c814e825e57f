"""Dense text vectors: a randomised low-rank factorisation of TF-IDF rows."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxmill.config import SEED
from voxmill.operators import models
from voxmill.session import cut

#: Columns beyond the wanted rank, and passes over the rows, of the range finder.
OVERSAMPLING = 8
PASSES = 4


@dataclass(frozen=True)
class TextFactors:
    """``components`` (term x rank) spans the rows' leading directions, the strongest first."""

    terms: models.Terms
    components: np.ndarray
    singular_values: np.ndarray


def _batch(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Term numbers and weights of all rows one after the other, and the row of each."""
    indices, values = batch.column("indices"), batch.column("values")
    lengths = np.diff(indices.offsets.to_numpy())
    return (indices.flatten().to_numpy(), values.flatten().to_numpy(), np.repeat(np.arange(len(batch)), lengths))


def _summed(rows: np.ndarray, of: np.ndarray, n: int) -> np.ndarray:
    """The sums of ``rows`` by the number ``of`` each, in ``n`` rows."""
    out = np.zeros((n, rows.shape[1]))
    if len(of):
        order = np.argsort(of, kind="stable")
        starts = np.flatnonzero(np.diff(of[order], prepend=-1))
        out[of[order][starts]] = np.add.reduceat(rows[order], starts)
    return out


def _gram_times(weights: DataFrame, basis: np.ndarray) -> np.ndarray:
    """A^T A basis, for the rows A of ``weights``: each task sums its rows' share, a row per term; the
    shares are added before and after one shuffle. The result, terms x columns, comes to the driver."""
    def share(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(basis.shape)
        for batch in batches:
            term, weight, row = _batch(batch)
            projected = _summed(weight[:, None] * basis[term], row, len(batch))
            total += _summed(weight[:, None] * projected[row], term, len(basis))
        used = np.flatnonzero(total.any(axis=1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int32()), pa.array(list(total[used]), pa.list_(pa.float64()))], ["term", "share"])

    shares = weights.select("indices", "values").mapInArrow(share, "term int, share array<double>")
    summed = shares.groupBy("term").agg(Summarizer.sum(array_to_vector("share")).alias("_sum")).select(
        "term", vector_to_array("_sum").alias("sum")).collect()
    out = np.zeros(basis.shape)
    for r in summed:
        out[r["term"]] = r["sum"]
    return out


def fit_factors(
    rows: DataFrame, text: str = "features_text", rank: int = 64, size: int = 5000, passes: int = PASSES,
    oversampling: int = OVERSAMPLING, seed: int = SEED,
) -> TextFactors:
    """The ``rank`` leading right singular vectors of the TF-IDF rows, and their singular values."""
    return factor_rows(rows, text, rank, size, passes, oversampling, seed)[0]


def factor_rows(
    rows: DataFrame, text: str = "features_text", rank: int = 64, size: int = 5000, passes: int = PASSES,
    oversampling: int = OVERSAMPLING, seed: int = SEED,
) -> tuple[TextFactors, DataFrame]:
    """The factors, and the rows' stored weights (row_id, indices, values), so that the texts need not be
    read again to place the rows.

    A random basis of ``rank`` + ``oversampling`` columns is multiplied by A^T A in ``passes`` passes
    over the rows, made orthonormal in between; then the small matrix in that basis is decomposed.
    The driver holds terms x columns numbers, which ``size`` and ``rank`` bound, however many rows.
    """
    terms, counted = models.fit_counts(rows, text, size)
    n = len(terms.names)
    weights = cut(models.weighed(counted, terms))
    if not n:
        return TextFactors(terms, np.zeros((0, rank)), np.zeros(0)), weights
    basis = np.linalg.qr(np.random.default_rng(seed).normal(size=(n, min(n, rank + oversampling))))[0]
    for _ in range(passes - 1):
        basis = np.linalg.qr(_gram_times(weights, basis))[0]
    product = _gram_times(weights, basis)
    small = basis.T @ product
    values, vectors = np.linalg.eigh((small + small.T) / 2)
    first = np.argsort(values)[::-1][:rank]
    components = basis @ vectors[:, first]
    # The sign of a direction is free: most of its weight counts up.
    components *= np.where(components.sum(axis=0) < 0, -1.0, 1.0)
    return TextFactors(terms, components, np.sqrt(np.maximum(values[first], 0))), weights


def text_factors(
    rows: DataFrame, factors: TextFactors, text: str = "features_text", out: str = "vec", unit: bool = True,
) -> DataFrame:
    """(row_id, ``out``): the rows' coordinates along the components, of length one if ``unit``. A text
    without a known term is the zero vector."""
    return projected(models.tfidf_rows(rows, factors.terms, text), factors, out, unit)


def projected(weights: DataFrame, factors: TextFactors, out: str = "vec", unit: bool = True) -> DataFrame:
    """``text_factors`` from the rows' weights over the terms of the factors."""
    components = factors.components

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            term, weight, row = _batch(batch)
            found = _summed(weight[:, None] * components[term], row, len(batch))
            if unit:
                norms = np.linalg.norm(found, axis=1, keepdims=True)
                found = np.divide(found, norms, out=np.zeros_like(found), where=norms > 0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row_id"), pa.array(list(found), pa.list_(pa.float64()))], ["row_id", out])

    kind = weights.schema["row_id"].dataType.simpleString()
    return weights.mapInArrow(project, f"row_id {kind}, `{out}` array<double>")
