"""Shared by the corpus operators: stored tables, salts, rows held as one struct."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voxmill.session import new_path

#: White space of the word rule, as a class body for Java, RE2 and Python patterns.
SPACE = r"\x20\x09-\x0D"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def stored(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: later jobs neither recompute it nor see
    another order of its rows, and a lost executor takes nothing with it. ``options``: the writer's."""
    path = new_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    # No merging and no inference over many files: the schema is known.
    return df.sparkSession.read.schema(df.schema).parquet(path)


def salt_count(spark: SparkSession) -> int:
    """Into how many parts a hot key is split: as many as there are reduce tasks."""
    return max(64, int(spark.conf.get("spark.sql.shuffle.partitions")))


def salt(spark: SparkSession, *columns: Column | str) -> Column:
    """A part number that depends on the row alone, so a repeated task deals rows out alike."""
    return F.pmod(F.xxhash64(*columns), F.lit(salt_count(spark))).cast("int")


def tasks_for(rows: int, rows_per_task: int) -> int:
    return max(1, math.ceil(rows / rows_per_task))


def without(columns: list[str], *names: str) -> list[str]:
    """Column names less ``names``, which Spark compares without case."""
    taken = {n.lower() for n in names}
    return [c for c in columns if c.lower() not in taken]


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


#: Parts a hot key is split into where the parts that occur are held as bits of one long.
BITS = 64


def bit_salt(*columns: Column | str) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(BITS)).cast("int")


def salt_bits(column: str = "_salt") -> Column:
    """Aggregate: the salts of a group as bits, a fixed-size state that combines before the shuffle."""
    return F.bit_or(F.expr(f"shiftleft(1L, {column})"))


def each_salt(column: str = "_bits") -> Column:
    return F.explode(F.expr(f"filter(sequence(0, {BITS - 1}), i -> (shiftright({column}, i) & 1L) = 1L)"))


def spread_join(left: DataFrame, right: DataFrame, on: list[str], by: str, how: str = "inner") -> DataFrame:
    """``left`` joined with ``right``, which is unique by ``on``. A key that fills many rows of
    ``left`` is dealt to up to BITS tasks by the column ``by``; the right row is copied to those."""
    salted = left.withColumn("_salt", bit_salt(by))
    wanted = salted.groupBy(*on).agg(salt_bits().alias("_bits"))
    copied = right.join(wanted, on).withColumn("_salt", each_salt()).drop("_bits")
    return salted.join(copied, [*on, "_salt"], how).drop("_salt")


def release(spark: SparkSession) -> None:
    """Ask the driver to collect garbage: shuffle files of finished jobs are deleted only then."""
    import gc

    gc.collect()
    spark._jvm.System.gc()


def discard(table: DataFrame) -> None:
    """Delete the files of a ``stored`` table that only stored tables were made from."""
    spark = table.sparkSession
    for file in table.inputFiles()[:1]:
        folder = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(file)).getParent()
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def keeping(docs: DataFrame, operator, *named: str) -> DataFrame:
    """``operator(docs)`` with the columns of ``docs`` only, whatever the others are called: columns
    besides ``named`` have other names while the operator runs."""
    safe = [c if c in named else f"_c{i}" for i, c in enumerate(docs.columns)]
    return operator(docs.toDF(*safe)).select(*safe).toDF(*docs.columns)
