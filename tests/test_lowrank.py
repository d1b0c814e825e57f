"""Low-rank text vectors against plain numpy, and retrieval with them."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import rows as plain
from voxmill.operators import lowrank, models, retrieval

TOPICS = ("battery charge power cable plug", "shirt size fabric colour sleeve", "screen pixel bright glass panel")


def texts(spark, n=150):
    draw = np.random.default_rng(2)
    data = []
    for i in range(n):
        words = TOPICS[i % 3].split()
        data.append((i, " ".join(draw.choice(words, 12)) + " " + " ".join(draw.choice(["the", "and", "very", "good"], 5))))
    data += [(1000, None), (1001, "!!"), (1002, "unheard"), (0, "battery again")]
    return spark.createDataFrame(data, "row_id long, features_text string").repartition(3)


def matrix(df, names):
    out = np.zeros((df.count(), len(names)))
    for i, r in enumerate(df.collect()):
        out[i, r["indices"]] = r["values"]
    return out


def test_in_row_weights_equal_the_joined_ones(spark):
    df = texts(spark)
    inside = models.tfidf_weights(df.where("row_id > 0"), size=40)
    terms = {r.term for r in models.vocabulary(df.where("row_id > 0"), size=40).collect()}
    full = models.tfidf_weights(df.where("row_id > 0"), size=None)
    # The same rows and terms; the joined form is cut to the vocabulary and scaled again here.
    want, squares = {}, {}
    for r in full.collect():
        if r.term in terms:
            want[r.row_id, r.term] = r.weight
            squares[r.row_id] = squares.get(r.row_id, 0) + r.weight**2
    got = {(r.row_id, r.term): r.weight for r in inside.collect()}
    assert got.keys() == want.keys()
    for (row, term), w in want.items():
        assert got[row, term] == pytest.approx(w / squares[row] ** 0.5, rel=1e-9)


def test_singular_values_and_directions_are_numpys(spark):
    df = texts(spark)
    factors = lowrank.fit_factors(df, rank=6, size=60, passes=8)
    a = matrix(models.tfidf_rows(df, factors.terms), factors.terms.names)
    _, sigma, vt = np.linalg.svd(a, full_matrices=False)
    # The leading ones converge first; the rest is close after a few passes.
    assert factors.singular_values[:3] == pytest.approx(sigma[:3], rel=1e-6)
    assert factors.singular_values == pytest.approx(sigma[:6], rel=1e-3)
    for mine, theirs in zip(factors.components[:, :3].T, vt):
        assert abs(mine @ theirs) == pytest.approx(1, abs=1e-6)
    assert factors.components.T @ factors.components == pytest.approx(np.eye(6), abs=1e-9)


def test_vectors_have_a_fixed_size_and_find_their_topic(spark):
    df = texts(spark)
    factors = lowrank.fit_factors(df, rank=5)
    vectors = lowrank.text_factors(df, factors)
    found = {r.row_id: np.array(r.vec) for r in vectors.where("row_id > 0").collect()}
    assert {len(v) for v in found.values()} == {5} and vectors.count() == df.count()
    assert not found[1000].any() and not found[1001].any()
    assert all(abs(np.linalg.norm(v) - 1) < 1e-9 for i, v in found.items() if i < 1000)
    reviews = vectors.where("row_id between 1 and 999").select(
        "row_id", F.lit("p").alias("parent_asin"), "vec", F.lit(False).alias("is_negative"), F.lit(False).alias("is_positive"))
    asked = spark.createDataFrame([(0, "charge the battery"), (1, "which size is the shirt"), (2, "bright screen")],
                                  "row_id long, features_text string")
    queries = lowrank.text_factors(asked, factors).select(
        F.col("row_id").alias("query_id"), F.lit("p").alias("parent_asin"), "vec", F.lit("general").alias("intent"),
        F.lit(20).alias("top_k"))
    got = retrieval.top_matches(reviews, queries).collect()
    assert len(got) == 60 and all(r.row_id % 3 == r.query_id for r in got)


def test_nothing_to_learn_from(spark):
    for df in (texts(spark).limit(0), texts(spark).where("row_id = 1000")):
        factors = lowrank.fit_factors(df, rank=3)
        assert plain(lowrank.text_factors(df, factors).select("row_id", F.size("vec"))) == [
            (r[0], 3) for r in plain(df, "row_id")]
