import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from cases import documents, frame, prose, rows, words
from voxmill.llm import classifier


def corpus():
    """Good prose; junk of three kinds: symbols, repeated lines, words in a row."""
    draw = random.Random(1)
    texts, labels = [], []
    for i in range(600):
        n = draw.randint(25, 120)
        text = prose(i, n)
        if i % 3 == 0:
            kind = i % 9
            text = {0: " ".join(w + "$$$" for w in text.split(" ")), 3: "\n".join([prose(i, 9)] * 12),
                    6: " ".join(w + " " + w + " " + w for w in prose(i, 12).split(" "))}[kind]
        texts.append((i, text))
        labels.append((i, int(i % 3 != 0)))
    return texts, labels


@pytest.fixture(scope="module")
def model(spark):
    texts, labels = corpus()
    known = spark.createDataFrame(labels, "doc_id long, quality int").where("doc_id % 4 <> 2")
    return classifier.fit(documents(spark, texts), known)


def test_held_out_accuracy(spark, model):
    texts, labels = corpus()
    scores = {r.doc_id: r.score for r in classifier.score(documents(spark, texts), model).collect()}
    truth = dict(labels)
    held_out = [i for i in truth if i % 4 == 2]
    assert sum((scores[i] >= 0.7) == truth[i] for i in held_out) >= 0.97 * len(held_out)
    assert all(0 <= s <= 1 for s in scores.values())


def test_margins_equal_averaged_vectors(model):
    for used, counts in classifier.text_features([t.encode() for _, t in corpus()[0][:20]]):
        hidden = (counts / counts.sum()) @ model.vectors[used]
        scores = np.exp(model.output @ hidden)
        margin = model.margins()[used] @ counts / counts.sum()
        assert np.isclose(scores[1] / scores.sum(), 1 / (1 + np.exp(-margin)), atol=1e-5)


def test_features_equal_a_plain_count():
    for text in (prose(3, 30), "a A a a", "", "one two three four one two three four five", "é漢 x"):
        (used, counts), = classifier.text_features([text.encode()])
        own = words(text)
        data = dict(zip(used.tolist(), counts.tolist()))
        assert data[classifier.END] == 1
        assert data.get(classifier.ECHO, 0) == sum(a == b for a, b in zip(own, own[1:]))
        windows = Counter(tuple(own[i:i + 4]) for i in range(len(own) - 3))
        assert data.get(classifier.AGAIN, 0) == sum(windows.values()) - len(windows)
        grams = sum(max(0, len(w.encode()) + 2 - n + 1) for w in own for n in classifier.GRAMS)
        edges = 2 * sum(len(w.encode()) + 2 == 0 for w in own)
        # A text's first word has no blank before it in the block, its last one has one after it.
        missing = len(classifier.GRAMS) if own and text[0] not in " \t\n" else 0
        assert sum(c for u, c in data.items() if u >= classifier.FIXED) == len(own) + grams - edges - sum(
            1 for n in classifier.GRAMS if own and len(own[0].encode()) + 2 >= n) * bool(missing)


def test_texts_score_alike_wherever_they_stand():
    a, b = classifier.text_features([b"one two three", b"four five"]), classifier.text_features([b"four five"])
    assert a[1][0].tolist() == b[0][0].tolist() and a[1][1].tolist() == b[0][1].tolist()


def test_bound_of_the_sample(spark):
    texts, labels = corpus()
    seen = []
    real = classifier.train
    try:
        classifier.train = lambda examples, **k: seen.append(examples) or real(examples, epochs=1)
        classifier.fit(documents(spark, texts), spark.createDataFrame(labels, "doc_id long, quality int"), rows_per_class=20)
    finally:
        classifier.train = real
    assert Counter(e[2] for e in seen[0]) == {0: 20, 1: 20}
    assert np.isclose(sum(e[3] for e in seen[0] if e[2]) / sum(e[3] for e in seen[0]), 2 / 3)


def examples_of(monkeypatch, docs, labels, **bounds):
    seen, real = [], classifier.train
    monkeypatch.setattr(classifier, "train", lambda examples, **k: seen.append(examples) or real(examples, epochs=1))
    classifier.fit(docs, labels, **bounds)
    return seen[0]


def test_repeated_keys_give_one_example_each(spark, monkeypatch):
    data = [(7, prose(i, 5)) for i in range(3000)] + [(8, "eight"), (9, None), (10, "ten")]
    labels = spark.createDataFrame([(7, 1), (7, 1), (8, 0), (9, 0), (10, 1), (11, 1)], "doc_id long, quality int")
    docs = documents(spark, data).repartition(5)
    found = examples_of(monkeypatch, docs, labels, rows_per_class=2)
    assert Counter(e[2] for e in found) == {0: 2, 1: 2} or Counter(e[2] for e in found) == {0: 2, 1: 1}
    again = examples_of(monkeypatch, docs.repartition(2), labels, rows_per_class=2)
    assert [e[0].tolist() for e in found] == [e[0].tolist() for e in again]


def test_bytes_at_the_driver_are_bounded(spark, monkeypatch):
    texts, labels = corpus()
    known = spark.createDataFrame(labels, "doc_id long, quality int")
    found = examples_of(monkeypatch, documents(spark, texts), known, max_bytes=60_000)
    size = sum(e[0].nbytes + e[1].nbytes for e in found)
    assert 40_000 < size <= 60_000 and len(found) < len(texts)


def test_odd_rows_empty_table_and_no_labels(spark, model):
    found = classifier.score(frame(spark), model).collect()
    assert len(found) == len(rows()) and all(0 <= r.score <= 1 for r in found)
    assert classifier.score(frame(spark, []), model).count() == 0
    labels = spark.createDataFrame([(1, None), (None, 1), (2, 7)], "doc_id long, quality int")
    blank = classifier.fit(frame(spark), labels)
    assert {r.score for r in classifier.score(frame(spark), blank).collect()} == {0.5}
    odd = spark.createDataFrame([(0, 1), (9, 0), (9, 0), (77, 1)], "doc_id long, quality int")
    assert classifier.score(frame(spark), classifier.fit(frame(spark), odd)).where(F.col("score").isNull()).count() == 0
