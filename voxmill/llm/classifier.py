"""A quality classifier: hashed word and character n-gram vectors, averaged, with a softmax."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voxmill.llm.common import quoted, stored
from voxmill.llm.words import LOWER, blocks, joined, mixed, segment_hashes, word_bounds

#: Vectors; words and character n-grams share them by hash. The first few have fixed meanings.
BUCKETS = 1 << 16
END, AGAIN, ECHO, FIXED = 0, 1, 2, 3
GRAMS = (3, 4)
WINDOW = 4


def text_features(texts: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Of each text, the distinct buckets of its features and how often each occurs.

    Features are the words (A-Z lowered), the character 3- and 4-grams inside words with their
    edges, one for the end of the text, one for each window of four words that the text has had
    before, and one for each word equal to the word before it.
    """
    data, at = joined(texts)
    data = LOWER[data]
    starts, ends = word_bounds(data)
    words = segment_hashes(data, starts, ends)
    word_at = np.searchsorted(starts, at)
    room = np.uint64(BUCKETS - FIXED)
    steps = np.zeros(len(data) + 1, np.int8)
    steps[starts] = 1
    steps[ends] = -1  # at least one blank lies between words
    blank = np.cumsum(steps[:-1], dtype=np.int8) == 0
    clean = np.where(blank, np.uint8(0x20), data).astype(np.uint64)
    grams: list[tuple[np.ndarray, np.ndarray]] = []  # places and buckets
    for n in GRAMS:
        if len(data) < n:
            continue
        code = np.zeros(len(data) - n + 1, np.uint64)
        inner = np.zeros(len(code), bool)
        for k in range(n):
            code = (code << np.uint64(8)) | clean[k:k + len(code)]
            if 0 < k < n - 1:
                inner |= blank[k:k + len(code)]
        places = np.flatnonzero(~inner)
        # Multiply-shift down to 32 bits, then to a bucket.
        code = (code[places] + np.uint64(n << 40)) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)
        grams.append((places, (code % room).astype(np.int64) + FIXED))
    word_buckets = (words % room).astype(np.int64) + FIXED
    if len(words) >= WINDOW:
        windows = words[:len(words) - WINDOW + 1].copy()
        for k in range(1, WINDOW):
            windows = mixed(windows) + words[k:len(words) - WINDOW + 1 + k]
    cuts = [np.searchsorted(places, at) for places, _ in grams]
    out = []
    for i in range(len(texts)):
        first, last = word_at[i], word_at[i + 1]
        own = words[first:last]
        again = 0
        if last - first >= WINDOW:
            again = last - first - WINDOW + 1 - len(np.unique(windows[first:last - WINDOW + 1]))
        echo = int((own[1:] == own[:-1]).sum())
        counts = np.bincount(np.concatenate(
            [word_buckets[first:last], *[b[c[i]:c[i + 1]] for (_, b), c in zip(grams, cuts, strict=True)]]),
            minlength=FIXED)
        counts[[END, AGAIN, ECHO]] = 1, again, echo
        used = np.flatnonzero(counts)
        out.append((used.astype(np.int32), counts[used].astype(np.float32)))
    return out


@dataclass
class SubwordModel:
    """``vectors`` (bucket x size) and ``output`` (2 x size)."""

    vectors: np.ndarray
    output: np.ndarray

    def margins(self) -> np.ndarray:
        """What each bucket adds to the difference of the two outputs: with averaged vectors a text's
        difference is the average of these, so scoring looks up one number per feature."""
        return (self.vectors @ (self.output[1] - self.output[0])).astype(np.float64)


def train(
    rows: list[tuple[np.ndarray, np.ndarray, int, float]], size: int = 8, epochs: int = 12,
    rate: float = 0.5, seed: int = 7,
) -> SubwordModel:
    """Stochastic gradient descent, one text (buckets, counts, label, weight) at a time, in a fixed
    order drawn from the seed, with a rate that falls to 0."""
    draw = np.random.Generator(np.random.PCG64(seed))
    model = SubwordModel(draw.uniform(-1 / size, 1 / size, (BUCKETS, size)).astype(np.float32),
                         np.zeros((2, size), np.float32))
    step, steps = 0, max(1, epochs * len(rows))
    for _ in range(epochs):
        for i in draw.permutation(len(rows)):
            used, counts, label, weight = rows[i]
            share = counts / counts.sum()
            hidden = share @ model.vectors[used]
            scores = model.output @ hidden
            likely = np.exp(scores - scores.max())
            likely /= likely.sum()
            wrong = -likely
            wrong[label] += 1
            wrong *= rate * (1 - step / steps) * weight
            back = wrong @ model.output
            model.output += np.outer(wrong, hidden)
            # As is usual for averaged vectors, each vector gets the gradient of the average in
            # proportion to how much of the text it makes up, scaled to its largest share.
            model.vectors[used] += np.outer(share / share.max(), back)
            step += 1
    return model


def fit(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
    rows_per_class: int = 2_500, max_bytes: int = 400 << 20,
) -> SubwordModel:
    """A model of ``labels`` (key, label 0 or 1), fitted on at most ``rows_per_class`` labelled keys
    of each class, drawn by a hash of the key.

    The bound holds whatever the input's size: the drawn keys are broadcast, the texts become
    feature counts on the executors, one text for each drawn key and label (of several, the one with
    the smallest hash), and only these come to the driver, where numpy trains. Should their counts
    exceed ``max_bytes``, the examples drawn last are left out. A drawn class is weighted by its share
    of all labelled rows. Rows without key, label or document are no examples; without any examples
    all scores are 0.5. Very long texts count as a whole; other columns are not read.
    """
    known = labels.select(quoted(key).alias("_id"), quoted(label).cast("int").alias("_label")).where(
        "_id is not null and _label in (0, 1)").distinct()
    sizes = {r["_label"]: r["count"] for r in known.groupBy("_label").count().collect()}
    drawn = None
    for value in sizes:
        part = known.where(F.col("_label") == value).orderBy(F.xxhash64("_id"), "_id").limit(rows_per_class)
        drawn = part if drawn is None else drawn.unionByName(part)
    if drawn is None:
        return SubwordModel(np.zeros((BUCKETS, 1), np.float32), np.zeros((2, 1), np.float32))
    rows = docs.select(quoted(key).alias("_id"), quoted(text).cast("string").alias("_text")).join(
        F.broadcast(drawn), "_id").groupBy("_id", "_label").agg(
        F.min_by("_text", F.xxhash64("_text")).alias("_text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, texts in blocks(batch.column(2)):
                found = text_features(texts)
                part = batch.slice(start, len(texts))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array([u.tobytes() for u, _ in found], pa.binary()),
                     pa.array([c.tobytes() for _, c in found], pa.binary())],
                    ["_id", "_label", "used", "counts"])

    kind = rows.schema["_id"].dataType.simpleString()
    counted = stored(rows.mapInArrow(count, f"_id {kind}, _label int, used binary, counts binary"), "examples")
    # Over the drawn keys alone, without their counts.
    along = Window.orderBy(F.xxhash64("_id"), "_id", "_label")
    kept = counted.select(
        "_id", "_label", (F.octet_length("used") + F.octet_length("counts")).cast("long").alias("_size")).select(
        "_id", "_label", F.sum("_size").over(along).alias("_bytes")).where(F.col("_bytes") <= max_bytes)
    table = counted.join(F.broadcast(kept.drop("_bytes")), ["_id", "_label"]).select(
        "_id", "_label", "used", "counts").toPandas()
    table = table.set_axis(["id", "label", "used", "counts"], axis=1).sort_values(["id", "used"], kind="stable")
    drawn_sizes = table["label"].value_counts()
    weights = {v: sizes[v] / sum(sizes.values()) * len(table) / drawn_sizes[v] for v in drawn_sizes.index}
    top = max(weights.values(), default=1.0)
    return train([(np.frombuffer(r.used, np.int32), np.frombuffer(r.counts, np.float32), int(r.label),
                   weights[r.label] / top) for r in table.itertuples(index=False)])


def score(docs: DataFrame, model: SubwordModel, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, score): the model's probability of label 1 for every row and its whole text.

    The model is a fixed-size table that goes with the tasks; no shuffle. A null text counts as
    empty and has the end feature alone; repeated rows score alike, very long texts as a whole; an empty
    table gives an empty one; other columns are not read, whatever they are called.
    """
    margins = model.margins()
    rows = docs.select(quoted(key).alias("_id"), quoted(text).cast("string").alias("_text"))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, texts in blocks(batch.column(1)):
                scores = [1 / (1 + np.exp(-float(margins[u] @ c / c.sum()))) for u, c in text_features(texts)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, len(texts)), pa.array(scores, pa.float64())], ["_id", "score"])

    kind = rows.schema["_id"].dataType.simpleString()
    return rows.mapInArrow(apply, f"_id {kind}, score double").withColumnRenamed("_id", key)
