"""Terms are counted exactly though only likely ones are shuffled, and a text's words are found once."""

import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from voxmill.functions import text as tx
from voxmill.operators import models


def _texts(n=400):
    draw = random.Random(5)
    words = [f"w{int(draw.paretovariate(0.7)) % 3000}" for _ in range(12_000)] + ["É", "x", "naïve", "a_b"]
    return [None, "", "x", "one"] + [" ".join(draw.choices(words, k=draw.randint(1, 60))) for _ in range(n)]


def _expected(texts):
    total, df = Counter(), Counter()
    for text in texts:
        words = [w for w in (text or "").lower().split() if len(w) > 1]
        terms = words + [f"{a} {b}" for a, b in zip(words, words[1:])]
        total.update(terms)
        df.update(set(terms))
    return sorted(((t, n, df[t]) for t, n in total.items()), key=lambda x: (-x[1], x[0]))


def _rows(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "row_id long, features_text string").repartition(5)


def test_vocabulary_is_exact_for_every_size(spark, monkeypatch):
    texts = _texts()
    expected = _expected(texts)
    rows = _rows(spark, texts)
    for size in (1, 40, 700, len(expected) + 5):
        assert [tuple(r) for r in models.vocabulary(rows, size=size).collect()] == expected[:size]
    assert sorted(map(tuple, models.vocabulary(rows, size=None).collect())) == sorted(expected)


def test_only_likely_terms_are_counted(spark):
    texts = _texts()
    words = _rows(spark, texts).select(tx.word_runs(F.col("features_text")).alias("w"))
    likely = models._likely_terms(words, 20)
    assert 20 <= np.count_nonzero(likely) < len(_expected(texts)) / 4


def test_rows_are_cut_so_that_a_bounded_number_of_words_is_counted_at_a_time(spark, monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(models, "WORDS_AT_ONCE", 5)
    batch = pa.RecordBatch.from_arrays([pa.array([["a"] * n for n in (2, 3, 0, 9, 1, 4)] + [None])], ["w"])
    assert [len(b) for b in models._word_slices([batch])] == [3, 1, 3]


def test_counts_hold_each_listed_term(spark):
    texts = ["bb cc bb cc", None, "", "dd x bb", "cc"]
    names = ["bb", "bb cc", "dd bb", "zz", "zz bb"]
    found = models.counted_terms(_rows(spark, texts), names).orderBy("row_id").collect()
    assert [(r[0], list(r[1]), list(r[2])) for r in found] == [
        (0, [0, 1], [2.0, 2.0]), (1, [], []), (2, [], []), (3, [0, 2], [1.0, 1.0]), (4, [], [])]


def test_tokens_are_named_once_in_the_expression_of_grams(spark):
    plan = _rows(spark, ["a"]).select(tx.one_and_two_grams(tx.word_tokens(F.col("features_text"))).alias("g"))
    assert plan._jdf.queryExecution().analyzed().toString().count("regexp_extract_all") == 1
    rows = _rows(spark, ["ab cd ef", "", None]).orderBy("row_id")
    assert [r[0] for r in rows.select(tx.one_and_two_grams(tx.word_tokens(F.col("features_text")))).collect()] == [
        ["ab", "cd", "ef", "ab cd", "cd ef"], [], None]


def test_runs_less_the_short_ones_are_the_tokens(spark):
    rows = _rows(spark, ["Ab, c d_e--1 22  ÀÉ x\U0001d400 \U0001d400", "", " -- ", "a"])
    runs = F.filter(tx.word_runs(F.col("features_text")), lambda w: F.length(w) > 1)
    assert rows.where(~runs.eqNullSafe(tx.word_tokens(F.col("features_text")))).count() == 0
