"""Incremental ingest of reviews with Structured Streaming."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from voxmill.config import MIN_CHARS, MIN_WORDS
from voxmill.functions import labels
from voxmill.operators.cleaning import checked_reviews, text_key


def read_stream(
    spark: SparkSession, folder: str, schema: T.StructType, pattern: str | None = None,
    files_per_trigger: int | None = None,
) -> DataFrame:
    """New parquet files of a table's folder (or its one file), read with a fixed schema."""
    reader = spark.readStream.schema(schema).format("parquet")
    place = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if files.exists(place) and files.getFileStatus(place).isFile():
        # A stream watches a folder: the file's own, for its name.
        folder, pattern = place.getParent().toString(), place.getName()
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(folder)


def clean_stream(
    raw: DataFrame, min_words: int = MIN_WORDS, min_chars: int = MIN_CHARS,
    max_chars: int | None = None,
) -> DataFrame:
    """The row-wise part of cleaning: works on a stream and on a table alike."""
    return (
        checked_reviews(raw, min_words, min_chars, max_chars)
        .where("_reason = 'ok'").drop("_reason")
        .withColumn("sentiment", labels.rating_label(F.col("rating")))
        .where(F.col("sentiment").isNotNull())
    )


def unique_stream(
    stream: DataFrame, keys: list[str], event_time: str | None = None, delay: str | None = None,
) -> DataFrame:
    """The first arrival per key. With ``delay`` a key is forgotten after that time, which
    bounds the state; without it every key is remembered. Texts are remembered as digests."""
    short = stream.withColumns({f"_k{i}": text_key(F.col(k).cast("string"))
                                for i, k in enumerate(keys)})
    names = [f"_k{i}" for i in range(len(keys))]
    if delay:
        unique = short.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(names)
    else:
        unique = short.dropDuplicates(names)
    return unique.drop(*names)


class _FirstRow(StatefulProcessor):
    """State of one key: the smallest order seen. Gives out a row whenever a smaller one comes."""

    def __init__(self, order: str, columns: list[str]):
        self.order, self.columns = order, columns

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.least = handle.getValueState("least", "least long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timers) -> Iterator[pd.DataFrame]:
        best = None
        for batch in rows:
            first = batch.sort_values([self.order, *self.columns], kind="stable").head(1)
            if best is None or first[self.order].iloc[0] < best[self.order].iloc[0]:
                best = first
        number = int(best[self.order].iloc[0])
        if not self.least.exists() or number < self.least.get()[0]:
            self.least.update((number,))
            yield best.assign(_key=key[0])[["_key", *self.columns]]

    def close(self) -> None:
        pass


def first_rows_stream(stream: DataFrame, keys: list[str], order: str = "row_id") -> DataFrame:
    """For each key its row with the smallest ``order``, whatever the order of arrival: a row comes out
    when its key is new, and again whenever an earlier row of the key arrives, which replaces it.

    The state of a key is one number; keys are digests of the key columns (nulls are a value). Rows
    without ``order`` never come first. The state store must be RocksDB, as ``arbitrary_state`` sets.
    ``read_first_rows`` gives the table of what has come out."""
    digest = F.sha2(F.concat_ws("\x1f", *[F.coalesce(F.concat(F.lit("="), F.col(k).cast("string")), F.lit("")) for k in keys]), 256)
    columns = stream.columns
    keyed = stream.withColumn("_key", digest).withColumn(
        order, F.coalesce(F.col(order).cast("long"), F.lit((1 << 63) - 1))).select("_key", *columns)
    return keyed.groupBy("_key").transformWithStateInPandas(
        _FirstRow(order, columns), outputStructType=keyed.schema, outputMode="Update", timeMode="None")


def arbitrary_state(spark: SparkSession) -> None:
    """Queries that start from now on keep their state in RocksDB."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass",
                   "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def ingest_changes(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write what comes out of each batch to a folder of its own; a repeated batch replaces itself."""
    def put(batch: DataFrame, batch_id: int) -> None:
        _replace(batch, f"{path}/batch={batch_id}", f"{path}/_aside-{batch_id}")

    return stream.writeStream.outputMode("update").option("checkpointLocation", checkpoint).trigger(
        availableNow=True).foreachBatch(put).start()


def read_first_rows(spark: SparkSession, path: str, order: str = "row_id") -> DataFrame:
    """The row that has the smallest ``order`` of each key, from all changes so far."""
    changes = spark.read.parquet(path)
    columns = [c for c in changes.columns if c not in ("_key", "batch")]
    best = changes.groupBy("_key").agg(F.min_by(F.struct(*columns), F.struct(order, "batch")).alias("_row"))
    return best.select("_row.*").withColumn(order, F.nullif(F.col(order), F.lit((1 << 63) - 1)))


def _replace(batch: DataFrame, path: str, aside: str) -> None:
    """Write aside, then take the name in one step."""
    batch.write.mode("overwrite").parquet(aside)
    spark = batch.sparkSession
    source, target = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (aside, path))
    files = source.getFileSystem(spark._jsc.hadoopConfiguration())
    files.delete(target, True)
    files.mkdirs(target.getParent())
    files.rename(source, target)


#: Batches whose sums are put together into one.
COMPACT_EVERY = 8


def ingest_sums(
    stream: DataFrame, path: str, checkpoint: str, sums: Callable[[DataFrame], DataFrame],
    merge: Callable[[DataFrame], DataFrame], compact_every: int = COMPACT_EVERY,
) -> StreamingQuery:
    """Running results as sums of batches: each batch adds the table ``sums(batch)`` under its number,
    and every ``compact_every`` batches the tables so far become one by ``merge``, which must give the
    same kind of table from a union of several. No state is kept besides; what is stored is bounded by
    the groups, and the last ``compact_every`` batches. A repeated batch replaces itself."""
    def put(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        _replace(sums(batch), f"{path}/batch={batch_id}", f"{path}/_aside-{batch_id}")
        if (batch_id + 1) % compact_every:
            return
        _replace(merge(read_sums(spark, path)), f"{path}/upto={batch_id}", f"{path}/_aside-upto-{batch_id}")
        # The new whole is in place; what it holds may go.
        kept = f"upto={batch_id}"
        files = spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
        for name in _folders(spark, path):
            kind, _, number = name.partition("=")
            if name != kept and int(number) <= batch_id:
                files.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{name}"), True)

    return stream.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(put).trigger(
        availableNow=True).start()


def _folders(spark: SparkSession, path: str) -> list[str]:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(place):
        return []
    names = [f.getPath().getName() for f in files.listStatus(place)]
    return sorted(n for n in names if n.startswith(("batch=", "upto=")))


def read_sums(spark: SparkSession, path: str) -> DataFrame:
    """The tables that add up to the whole: the newest compacted one, and the batches after it."""
    names = _folders(spark, path)
    upto = max((int(n.partition("=")[2]) for n in names if n.startswith("upto=")), default=-1)
    wanted = [f"{path}/{n}" for n in names
              if n == f"upto={upto}" or n.startswith("batch=") and int(n.partition("=")[2]) > upto]
    return spark.read.parquet(*wanted)


def running_counts(stream: DataFrame, keys: list[str]) -> DataFrame:
    return stream.groupBy(*keys).agg(F.count("*").alias("n"))


def ingest(stream: DataFrame, path: str, checkpoint: str,
           partition_by: tuple[str, ...] = ()) -> StreamingQuery:
    """Append everything available to a parquet table, exactly once, then stop."""
    writer = stream.writeStream.format("parquet").outputMode("append").option(
        "checkpointLocation", checkpoint).trigger(availableNow=True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return writer.start(path)


def keep_latest(counts: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write the complete counts after each batch to a folder of its own. A batch is written aside and
    takes its name in one step, so ``read_latest`` sees a whole state at any time; a repeated batch
    replaces itself. The state before stays for those who still read it, older ones go."""
    def replace(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        _replace(batch, f"{path}/batch={batch_id}", f"{path}/_aside-{batch_id}")
        files = spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
        for name in _folders(spark, path):
            if int(name.partition("=")[2]) < batch_id - 1:
                files.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{name}"), True)

    return counts.writeStream.outputMode("complete").option(
        "checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(replace).start()


def read_latest(spark: SparkSession, path: str) -> DataFrame:
    """The newest complete state that ``keep_latest`` has written."""
    states = spark.read.parquet(path)
    newest = states.agg(F.max("batch")).first()[0]
    return states.where(F.col("batch") == newest).drop("batch")
