"""Files that queries make grow in number with the rows, not in size."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from voxmill.operators import retrieval
from voxmill.plans import cleaning, insights, profile
from voxmill.session import tasks_for

LINES = ("l_orderkey long, l_linenumber long, l_partkey long, l_suppkey long, l_returnflag string, l_linestatus string, "
         "l_quantity double, l_extendedprice double, l_shipdate timestamp")


def _tables(spark, folder, n=600):
    spark.range(n).select(
        F.col("id").alias("l_orderkey"), F.lit(1).cast("long").alias("l_linenumber"), (F.col("id") % 7).alias("l_partkey"),
        F.lit(1).cast("long").alias("l_suppkey"), F.element_at(F.array(F.lit("A"), F.lit("N"), F.lit("R")), (
            F.col("id") % 3 + 1).cast("int")).alias("l_returnflag"), F.lit("F").alias("l_linestatus"),
        F.lit(35.0).alias("l_quantity"), (F.col("id") % 100).cast("double").alias("l_extendedprice"),
        F.lit("2024-01-01").cast("timestamp").alias("l_shipdate")).write.parquet(f"{folder}/lineitem.parquet")
    spark.range(7).select(
        F.col("id").alias("p_partkey"), F.concat(F.lit("part "), "id").alias("p_name"), F.lit("SMALL").alias("p_type"),
        F.lit("Brand").alias("p_brand"), F.lit(3).alias("p_size"), F.lit(1.5).alias("p_retailprice")).write.parquet(
            f"{folder}/part.parquet")
    spark.range(n).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("text "), F.col("id") % 50).alias("text"), F.lit("en").alias("lang"),
        F.lit("src").alias("source"), F.lit(6).cast("long").alias("n_chars")).write.parquet(f"{folder}/documents.parquet")
    return folder


def _files(spark, monkeypatch, module, name):
    """The files in the folder that a query makes under ``name``."""
    made = {}
    whole = module.new_path
    monkeypatch.setattr(module, "new_path", lambda s, n: made.setdefault(n, whole(s, n)))
    return lambda: spark.read.parquet(made[name]).inputFiles()


def test_arriving_files_grow_in_number(spark, tmp_path, monkeypatch):
    folder = _tables(spark, str(tmp_path))
    monkeypatch.setattr(insights, "FILE_ROWS", 30)
    files = _files(spark, monkeypatch, insights, "arriving")
    found = insights.stream_product_insights(spark, folder).agg(F.sum("total_reviews")).first()[0]
    assert found == 600 and len(files()) == 20


def test_shuffled_documents_grow_in_number_of_files(spark, tmp_path, monkeypatch):
    folder = _tables(spark, str(tmp_path))
    monkeypatch.setattr(cleaning, "TEXT_FILE_ROWS", 50)
    files = _files(spark, monkeypatch, cleaning, "shuffled")
    found = cleaning.stream_first_rows(spark, folder).collect()
    assert sorted(r["doc_id"] for r in found) == list(range(550, 600)) and len(files()) == 12


def test_sketched_files_grow_in_number(spark, tmp_path, monkeypatch):
    folder = _tables(spark, str(tmp_path))
    monkeypatch.setattr(profile, "FILE_ROWS", 50)
    files = _files(spark, monkeypatch, profile, "files")
    found = profile.sketched_quantiles(spark, folder).collect()
    assert len(files()) == 12 and len(found) == 9
    assert all(r["n"] == 200 and r["rank_within_bound"] and r["distinct_within_bound"] for r in found)


def test_tasks_for():
    assert [tasks_for(n, 10) for n in (0, 10, 11)] == [1, 1, 2]


def test_vectors_of_a_block_are_one_array_without_copies():
    rows = pa.table({"vec": pa.array([[1.0, 2.0], [3.0, 4.0]])})
    assert np.array_equal(retrieval._vectors(rows), [[1, 2], [3, 4]])
    for odd in ([[1.0], None], [[1.0], [1.0, 2.0]]):
        with pytest.raises(ValueError):
            retrieval._vectors(pa.table({"vec": pa.array(odd, pa.list_(pa.float64()))}))
