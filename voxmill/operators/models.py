"""Text classification with Spark ML and TF-IDF weights as plain aggregations."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voxmill.config import COMBINED, SEED
from voxmill.functions import labels, numbers, text as tx
from voxmill.functions.binding import bind
from voxmill.operators import evaluation, sampling
from voxmill.session import cut, new_path, stored


class UnknownLabel(ValueError):
    pass


def feature_text(max_chars: int | None = None) -> Column:
    return tx.clean_text(tx.full_text(F.col("title"), F.col("text")), max_chars)


def training_rows(reviews: DataFrame, max_chars: int | None = None) -> DataFrame:
    """Feature text, normalised label and its code."""
    label = F.lower(F.trim("sentiment"))
    return reviews.select(
        "row_id", "domain", feature_text(max_chars).alias("features_text"),
        label.alias("sentiment"), labels.encode_label(label).alias("label"))


def check_labels(rows: DataFrame) -> None:
    unknown = rows.where(F.col("label").isNull()).select("sentiment").distinct().limit(5).collect()
    if unknown:
        raise UnknownLabel(f"unknown sentiment values: {sorted(str(r[0]) for r in unknown)}")


def term_counts(text: Column) -> Column:
    """A row's distinct words and word pairs with their counts, found inside the row: the terms
    are sorted and the lengths of their runs taken, so nothing is shuffled to count them."""
    grams = F.sort_array(tx.one_and_two_grams(tx.word_tokens(text)))

    def runs(terms):
        starts = F.filter(F.sequence(F.lit(1), F.size(terms)), lambda i: (i == 1) | (
            F.element_at(terms, i) != F.element_at(terms, F.greatest(i - 1, F.lit(1)))))
        ends = F.concat(F.slice(starts, 2, F.size(starts)), F.array(F.size(terms) + 1))
        return F.zip_with(starts, ends, lambda a, b: F.struct(
            F.element_at(terms, a).alias("term"), (b - a).cast("long").alias("tf")))

    return bind(grams, lambda t: F.when(F.size(t) > 0, runs(t)))


def row_terms(rows: DataFrame, text: str = "features_text") -> DataFrame:
    """(row_id, term, tf)."""
    return rows.select("row_id", F.inline(term_counts(F.col(text))))


#: A vocabulary of up to this many terms is broadcast; a larger or unbounded one is shuffled.
MAX_BROADCAST_TERMS = 100_000


#: Counters that terms are hashed to: a term can only be as frequent as its counter says.
COUNTERS = 1 << 20


def vocabulary(rows: DataFrame, text: str = "features_text", size: int | None = 5000) -> DataFrame:
    """The ``size`` most frequent words and word pairs, or all: (term, total, df).

    Nearly all pairs of a large table are rare, so with a ``size`` only terms that can be among the most
    frequent are counted and shuffled. The sums of what each task finds to be its most frequent terms
    give a bound that ``size`` terms reach; what is hashed to a counter below it cannot be one of them.
    All others are counted exactly, so neither bound nor hash decides anything."""
    words = rows.select(tx.word_runs(F.col(text)).alias("_words"))
    likely = None if size is None else _likely_terms(words, size)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _word_slices(batches):
            terms = _Terms(batch.column(0))
            keys, row = terms.keys, terms.row
            if likely is not None:
                near = likely[terms.cells()]
                keys, row = keys[near], row[near]
            found, code, totals = np.unique(keys, return_inverse=True, return_counts=True)
            # Each term once per row.
            once = np.unique(row * max(len(found), 1) + code) % max(len(found), 1)
            yield pa.RecordBatch.from_arrays(
                [terms.names(found), pa.array(totals), pa.array(np.bincount(once, minlength=len(found)))],
                ["term", "total", "df"])

    terms = words.mapInArrow(count, "term string, total long, df long").groupBy("term").agg(
        F.sum("total").alias("total"), F.sum("df").alias("df"))
    return terms if size is None else terms.orderBy(F.desc("total"), "term").limit(size)


def _likely_terms(words: DataFrame, size: int) -> np.ndarray:
    """For each counter, whether a term hashed to it can be among the ``size`` most frequent."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros(COUNTERS, np.int64)
        for batch in _word_slices(batches):
            terms = _Terms(batch.column(0))
            cells += np.bincount(terms.cells(), minlength=COUNTERS)
            found, totals = np.unique(terms.keys, return_counts=True)
            first = np.argsort(-totals, kind="stable")[:size]
            yield pa.RecordBatch.from_arrays(
                [terms.names(found[first]), pa.nulls(len(first), pa.int32()), pa.array(totals[first])],
                ["term", "cell", "n"])
        used = np.flatnonzero(cells)
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(len(used), pa.string()), pa.array(used, pa.int32()), pa.array(cells[used])], ["term", "cell", "n"])

    sums = cut(words.mapInArrow(count, "term string, cell int, n long").groupBy("term", "cell").agg(
        F.sum("n").alias("n")))
    most = sums.where("term is not null").orderBy(F.desc("n")).limit(size).agg(
        F.count("*"), F.min("n")).first()
    least = most[1] if most[0] == size else 1
    enough = sums.where("cell is not null").where(F.col("n") >= least).select("cell").toArrow()
    likely = np.zeros(COUNTERS, bool)
    likely[enough.column("cell").to_numpy()] = True
    return likely


#: Words that a task counts at a time; a longer row is counted alone. Fewer where rows are looked up, which
#: gain nothing from more.
WORDS_AT_ONCE, WORDS_LOOKED_UP = 1 << 19, 1 << 18


def _word_slices(batches: Iterator[pa.RecordBatch], words: int | None = None) -> Iterator[pa.RecordBatch]:
    """Batches cut by rows, so that what is counted at a time is bounded; the last column holds the words."""
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.list_value_length(batch.columns[-1]), 0).to_numpy(zero_copy_only=False))
        at = 0
        while at < len(batch):
            before = ends[at - 1] if at else 0
            to = max(int(np.searchsorted(ends, before + (words or WORDS_AT_ONCE), "right")), at + 1)
            yield batch.slice(at, to - at)
            at = to


class _Terms:
    """All words of two characters or more and neighbouring pairs of some rows: the row of each, and a key
    that tells them apart, made of the numbers of a pair's words among the different ones."""

    def __init__(self, runs: pa.ListArray):
        sizes = pc.fill_null(pc.list_value_length(runs), 0).to_numpy(zero_copy_only=False)
        flat = runs.flatten()
        long = pc.greater_equal(pc.utf8_length(flat), 2)
        found = flat.filter(long).dictionary_encode()
        row = np.repeat(np.arange(len(runs)), sizes)[long.to_numpy(zero_copy_only=False)]
        together = row[1:] == row[:-1]
        self.words, self.code = found.dictionary, found.indices.to_numpy().astype(np.int64)
        self.left, self.right = self.code[:-1][together], self.code[1:][together]
        self.row = np.concatenate([row, row[1:][together]])
        self.keys = np.concatenate([self.code, (self.left + 1) * (len(self.words) + 1) + self.right])

    def cells(self) -> np.ndarray:
        """The counter of each term, alike in every task."""
        hashes = pd.util.hash_array(self.words.to_numpy(zero_copy_only=False), categorize=False)
        pairs = hashes[self.left] * np.uint64(0x9E3779B97F4A7C15) + hashes[self.right]
        pairs = (pairs ^ (pairs >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        return (np.concatenate([hashes[self.code], pairs]) >> np.uint64(44)).astype(np.int64)

    def names(self, keys: np.ndarray) -> pa.Array:
        """The terms that some keys stand for."""
        left, right = np.divmod(keys, len(self.words) + 1)
        ends = self.words.take(pa.array(right))
        starts = self.words.take(pa.array(np.maximum(left - 1, 0)))
        return pc.if_else(pa.array(left > 0), pc.binary_join_element_wise(starts, ends, " "), ends)


class _Listed:
    """The terms of a list, looked up in rows of words."""

    def __init__(self, names: list[str]):
        self.number = {name: i for i, name in enumerate(names)}
        self.pairs = [(i, *name.split(" ")) for name, i in self.number.items() if " " in name]

    def counts(self, runs: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where each row's terms start, their numbers in ascending order, and how often they occur."""
        terms, size = _Terms(runs), len(self.number)
        place = {word: i for i, word in enumerate(terms.words.to_pylist())}
        n = len(place) + 1
        known = [(place[name], i) for name, i in self.number.items() if name in place] + [
            ((place[a] + 1) * n + place[b], i) for i, a, b in self.pairs if a in place and b in place]
        known = np.array(sorted(known), np.int64).reshape(-1, 2)
        at = np.minimum(np.searchsorted(known[:, 0], terms.keys), max(len(known) - 1, 0))
        hit = known[at, 0] == terms.keys if len(known) else np.zeros(len(at), bool)
        places, counts = np.unique(
            terms.row[hit] * size + (known[at[hit], 1] if len(known) else at[hit]), return_counts=True)
        return np.searchsorted(places, np.arange(len(runs) + 1) * size), places % size, counts


def tfidf_weights(rows: DataFrame, text: str = "features_text", size: int | None = 5000) -> DataFrame:
    """(row_id, term, weight): sublinear counts, smooth idf, unit length per row.

    With a bounded vocabulary a row's weights are found inside the row; only an unbounded one is
    joined to the rows' terms."""
    if size is not None and size <= MAX_BROADCAST_TERMS:
        terms, counted = fit_counts(cut(rows.select("row_id", text)), text, size)
        named = weighed(counted, terms).crossJoin(F.broadcast(  # one row
            rows.sparkSession.createDataFrame([(terms.names,)], "_names array<string>")))
        return named.select("row_id", F.inline(F.zip_with("indices", "values", lambda i, v: F.struct(
            F.get(F.col("_names"), i).alias("term"), v.alias("weight")))))
    vocab = vocabulary(rows, text, size).select("term", "df")
    total = rows.select(F.count("*")).scalar()
    idf = F.log((1.0 + total) / (1.0 + F.col("df"))) + 1.0
    weighted = row_terms(rows, text).join(vocab, "term").select(
        "row_id", "term", ((1.0 + F.log("tf")) * idf).alias("_raw"))
    # A window holds one row's terms.
    length = F.sqrt(F.sum(F.col("_raw") * F.col("_raw")).over(Window.partitionBy("row_id")))
    return weighted.select("row_id", "term", (F.col("_raw") / length).alias("weight"))


@dataclass(frozen=True)
class Terms:
    """A bounded vocabulary, the most frequent term first, with the smooth idf of each."""

    names: list[str]
    idf: list[float]


def counted_terms(rows: DataFrame, names: list[str], text: str = "features_text") -> DataFrame:
    """(row_id, indices, counts): how often each listed term occurs in each row. A term is looked up in
    a hash table inside the task, so nothing is shuffled."""
    if not names:
        return rows.select("row_id", F.array().cast("array<int>").alias("indices"),
                           F.array().cast("array<double>").alias("counts"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        listed = _Listed(names)
        for batch in _word_slices(batches, WORDS_LOOKED_UP):
            starts, places, counts = listed.counts(batch.column(1))
            starts = pa.array(starts, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(starts, pa.array(places, pa.int32())),
                 pa.ListArray.from_arrays(starts, pa.array(counts, pa.float64()))], ["row_id", "indices", "counts"])

    words = rows.select("row_id", tx.word_runs(F.col(text)).alias("_words"))
    kind = words.schema["row_id"].dataType.simpleString()
    return words.mapInArrow(count, f"row_id {kind}, indices array<int>, counts array<double>")


def fit_counts(rows: DataFrame, text: str = "features_text", size: int = 5000) -> tuple[Terms, DataFrame]:
    """The ``size`` most frequent terms, and the stored counts of ``rows`` over them. At most ``size``
    terms come to the driver."""
    found = vocabulary(rows, text, size).select("term", "df").collect()
    names = [r["term"] for r in found]
    counted = cut(counted_terms(rows, names, text))
    total = counted.count()
    return Terms(names, [math.log((1 + total) / (1 + r["df"])) + 1 for r in found]), counted


def fit_terms(rows: DataFrame, text: str = "features_text", size: int = 5000) -> Terms:
    return fit_counts(rows, text, size)[0]


def weighed(counted: DataFrame, terms: Terms) -> DataFrame:
    """(row_id, indices, values): sublinear counts times idf, of unit length per row."""
    idf = counted.sparkSession.createDataFrame([(terms.idf,)], "_idf array<double>")
    raw = F.zip_with("indices", "counts", lambda i, n: (1.0 + F.log(n)) * F.get(F.col("_idf"), i))
    held = counted.crossJoin(F.broadcast(idf)).select("row_id", "indices", _once(raw, "_raw"))  # one row
    length = F.sqrt(F.aggregate("_raw", F.lit(0.0), lambda s, x: s + x * x))
    return held.select("row_id", "indices", "_raw", _once(length, "_length")).select(
        "row_id", "indices", F.transform("_raw", lambda x: x / F.col("_length")).alias("values"))


def tfidf_rows(rows: DataFrame, terms: Terms, text: str = "features_text") -> DataFrame:
    """The weights of any rows over a fitted vocabulary."""
    return weighed(counted_terms(rows, terms.names, text), terms)


def _once(value: Column, name: str) -> Column:
    """``value`` under a name, from a generator, so that each use of the name does not compute it again."""
    return F.inline(F.array(F.struct(value.alias(name))))


class WordGrams(Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable,
                DefaultParamsWritable):
    """Words of two or more characters and neighbouring pairs."""

    def __init__(self, inputCol=None, outputCol=None):
        super().__init__()
        self._set(inputCol=inputCol, outputCol=outputCol)

    def _transform(self, df):
        tokens = tx.word_tokens(F.col(self.getInputCol()))
        return df.withColumn(self.getOutputCol(), tx.one_and_two_grams(tokens))


class SublinearCounts(Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable,
                      DefaultParamsWritable):
    """Replaces each count of a sparse vector by 1 + ln(count)."""

    def __init__(self, inputCol=None, outputCol=None):
        super().__init__()
        self._set(inputCol=inputCol, outputCol=outputCol)

    def _transform(self, df):
        parts = F.unwrap_udt(self.getInputCol())
        scaled = F.struct(
            parts["type"].alias("type"), parts["size"].alias("size"),
            parts["indices"].alias("indices"),
            F.transform(parts["values"], lambda x: 1.0 + F.log(x)).alias("values"))
        schema = T.StructType([T.StructField("v", VectorUDT())])
        vector = F.from_json(F.to_json(F.struct(scaled.alias("v"))), schema)["v"]
        return df.withColumn(self.getOutputCol(), vector)


def fit_classifier(
    train: DataFrame, size: int = 5000, c: float = 1.0, balanced: bool = True,
    max_iter: int = 1000,
) -> PipelineModel:
    """TF-IDF features and multinomial logistic regression with balanced class weights.

    train: features_text, label (0, 1, 2).
    """
    terms = vocabulary(train, "features_text", size).select("term", "df").collect()
    if not terms:
        raise ValueError("the training texts have no words")
    names = [r["term"] for r in terms]
    grams = WordGrams(inputCol="features_text", outputCol="_grams")
    counts = CountVectorizerModel.from_vocabulary(names, inputCol="_grams", outputCol="_tf")
    sublinear = SublinearCounts(inputCol="_tf", outputCol="_sub")
    # Later passes read the counted rows instead of tokenising again.
    tf = _stored_counts(train, names)
    idf = np.log((tf.count() + 1.0) / (np.array([r["df"] for r in terms]) + 1.0))
    weigh = ElementwiseProduct(
        scalingVec=Vectors.dense(idf + 1.0), inputCol="_sub", outputCol="_weighted")
    unit = Normalizer(p=2.0, inputCol="_weighted", outputCol="_features")
    rows = unit.transform(weigh.transform(tf)).select("_features", "label")
    sizes = rows.groupBy("label").count()
    n, k = sizes.agg(F.sum("count"), F.count("*")).first()
    if balanced:
        weights = sizes.select("label", (n / (k * F.col("count"))).alias("_weight"))
        # One row per class.
        rows = rows.join(F.broadcast(weights), "label")
    else:
        rows = rows.withColumn("_weight", F.lit(1.0))
    classifier = LogisticRegression(
        featuresCol="_features", labelCol="label", weightCol="_weight", family="multinomial",
        regParam=1.0 / (c * n), elasticNetParam=0.0, standardization=False, maxIter=max_iter,
        predictionCol="_prediction", probabilityCol="_probability", rawPredictionCol="_raw")
    fitted = classifier.fit(rows.withColumn("label", F.col("label").cast("double")))
    return PipelineModel([grams, counts, sublinear, weigh, unit, fitted])


def _stored_counts(train: DataFrame, names: list[str]) -> DataFrame:
    """(_sub, label), stored: what the stages up to ``SublinearCounts`` give, counted without making a
    row's terms. Few different numbers occur in it, so it is small."""
    counted = counted_terms(train.select(F.col("label").alias("row_id"), "features_text"), names)
    # The layout of a sparse vector: the table is read back as vectors.
    sparse = F.struct(
        F.lit(0).cast("tinyint").alias("type"), F.lit(len(names)).alias("size"), "indices",
        F.transform("counts", lambda n: 1.0 + F.log(n)).alias("values"))
    rows = counted.select(sparse.alias("_sub"), F.col("row_id").alias("label"))
    path = new_path(train.sparkSession, "counts")
    rows.write.parquet(path)
    schema = T.StructType([T.StructField("_sub", VectorUDT()), rows.schema["label"]])
    return train.sparkSession.read.schema(schema).parquet(path)


def score(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """Adds predicted_sentiment and predicted_confidence (four places): the stages of ``fit_classifier``
    applied to many rows at a time."""
    _, counts, _, weigh, _, fitted = model.stages
    names, weights = counts.vocabulary, weigh.getScalingVec().toArray()
    coefficients, intercepts = fitted.coefficientMatrix.toArray(), fitted.interceptVector.toArray()

    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        listed = _Listed(names)
        for batch in batches:
            parts = []
            for part in _word_slices([pa.RecordBatch.from_arrays([batch], ["_words"])], WORDS_LOOKED_UP):
                starts, places, n = listed.counts(part.column(0))
                row, size = np.repeat(np.arange(len(part)), np.diff(starts)), len(part)
                values = (1.0 + np.log(n)) * weights[places]
                values /= np.sqrt(np.bincount(row, values * values, size))[row]
                raw = np.stack([
                    np.bincount(row, values * c[places], size) + b for c, b in zip(coefficients, intercepts)])
                parts.append((raw.argmax(0), _highest_chance(raw)))
            best, chance = (np.concatenate(x) for x in zip(*parts)) if parts else ([], [])
            yield pa.StructArray.from_arrays(
                [pa.array(best, pa.int32()), pa.array(chance, pa.float64())], ["code", "chance"])

    found = F.arrow_udf(scored, "code int, chance double")(tx.word_runs(F.col("features_text")))
    return rows.withColumn("_scored", found).select(
        *rows.columns, labels.decode_label(F.col("_scored.code")).alias("predicted_sentiment"),
        numbers.rounded(F.col("_scored.chance"), 4).alias("predicted_confidence"))


def _highest_chance(raw: np.ndarray) -> np.ndarray:
    """The largest softmax of each column; certain where a class alone was learned from."""
    top = raw.max(0)
    certain = np.isposinf(top)
    return np.where(certain, 1.0, 1.0 / np.exp(raw - np.where(certain, 0.0, top)).sum(0))


def save_model(model: PipelineModel, folder: str, domain: str) -> str:
    path = f"{folder.rstrip('/')}/baseline_logistic_{domain.lower()}"
    model.write().overwrite().save(path)
    return path


def load_model(folder: str, domain: str) -> PipelineModel:
    return PipelineModel.load(f"{folder.rstrip('/')}/baseline_logistic_{domain.lower()}")


def train_and_evaluate(
    reviews: DataFrame, domains=("Electronics", "Fashion", COMBINED), size: int = 5000,
    seed: int = SEED, max_chars: int | None = None, max_iter: int = 1000,
    folder: str | None = None,
) -> DataFrame:
    """Per domain: stratified split, fit on train, metrics of validation and test.

    The loop is over the named domains; each step is a Spark job over that domain's rows.
    """
    prepared = training_rows(reviews, max_chars)
    check_labels(prepared)
    prepared = stored(prepared, "prepared")
    results = []
    for domain in domains:
        rows = prepared.where(labels.in_domain(domain)).withColumn("domain", F.lit(domain))
        split = sampling.stratified_split(rows, ["domain"], "sentiment", seed)
        sizes = dict(split.groupBy("split").count().collect())
        if not sizes:
            raise ValueError(f"No records found for domain '{domain}'.")
        model = fit_classifier(split.where("split = 'train'"), size, max_iter=max_iter)
        if folder:
            save_model(model, folder, domain)
        scored = score(model, split.where("split <> 'train'")).select(
            "domain", "split", F.col("sentiment").alias("y_true"),
            F.col("predicted_sentiment").alias("y_pred"))
        counts = evaluation.confusion_counts(scored, ["domain", "split"])
        metrics = evaluation.overall_metrics(counts, ["domain", "split"])
        results.append(metrics.withColumn("train_samples", F.lit(sizes.get("train", 0))))
    out = results[0]
    for more in results[1:]:
        out = out.unionByName(more)
    return out
