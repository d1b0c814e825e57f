import pytest
from conftest import rows
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from voxmill import schemas
from voxmill.config import REVIEW_OUTPUT_COLUMNS
from voxmill.functions import labels
from voxmill.operators import cleaning, products
from voxmill.session import build_session, new_path, work_folder
from voxmill.sources import tables
from voxmill.streaming import reviews as stream


def small(spark):
    return spark.createDataFrame(
        [(1, "Electronics", 'He said "a, b"\nnext line'), (2, "Fashion", "plain"), (3, "Fashion", None)],
        "row_id int, domain string, text string")


@pytest.mark.parametrize("name", ["t.parquet", "t.csv", "t.jsonl", "t.json", "plain"])
def test_formats_round_trip(spark, tmp_path, name):
    path = tables.write_table(small(spark), str(tmp_path / name))
    back = tables.read_table(spark, path, small(spark).schema)
    assert rows(back.na.fill(""), "row_id", "domain", "text") == rows(small(spark).na.fill(""))


def test_unknown_domain():
    assert tables.source_folder("Fashion", "metadata").startswith("raw_meta_")
    with pytest.raises(ValueError, match="Unsupported domain 'Toys'"):
        tables.source_folder("Toys")


def test_missing_table(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        tables.read_table(spark, str(tmp_path / "none.parquet"))


def test_load_reviews_and_metadata(spark, tmp_path):
    base = str(tmp_path)
    raw = small(spark).withColumn("rating", F.lit(4.0)).drop("domain")
    tables.write_table(raw, f"{base}/{tables.source_folder('Fashion')}.json")
    (tmp_path / f"{tables.source_folder('Fashion')}.json").rename(
        tmp_path / tables.source_folder("Fashion"))
    got = tables.load_reviews(spark, base, "Fashion")
    assert got.schema.names == schemas.RAW_REVIEW.names
    assert got.where("domain <> 'Fashion' or title is not null").isEmpty()
    sample = tables.sample_reviews(got, "Fashion", 2, ("rating", "text", "not_there"))
    assert sample.columns == ["rating", "text", "not_there", "domain"] and sample.count() == 2


def test_domain_folders_are_pruned(spark, tmp_path):
    path = tables.save_by_domain(small(spark), str(tmp_path / "reviews"))
    both = tables.load_sentiment_data(spark, path, "combined")
    one = tables.load_sentiment_data(spark, path, "FASHION")
    assert (both.count(), one.count()) == (3, 2)
    plan = tables.read_table(spark, path).where("domain = 'Fashion'")
    assert "PartitionFilters: [isnotnull(domain" in plan._jdf.queryExecution().executedPlan().toString()


def test_verify(spark, tmp_path):
    path = tables.write_table(spark.createDataFrame([(1, 2)], "col1 int, col2 int"),
                              str(tmp_path / "v.parquet"))
    assert tables.verify_table(spark, path, ("col1", "col2")) == 1
    with pytest.raises(ValueError, match="missing_col"):
        tables.verify_table(spark, path, ("col1", "missing_col"))


def test_conform(spark):
    out = tables.conform(small(spark), schemas.REVIEW)
    assert tuple(out.columns) == REVIEW_OUTPUT_COLUMNS
    assert out.schema["rating"].dataType.simpleString() == "double"
    assert out.where("sentiment is not null").isEmpty()


def test_fallback_chain(spark, tmp_path):
    plain = small(spark).withColumn("sentiment", F.lit("neutral"))
    path = tables.write_table(plain, str(tmp_path / "plain.parquet"))
    df = tables.load_scored_reviews(spark, str(tmp_path / "scored.parquet"), path)
    assert df.where("predicted_sentiment = 'neutral'").count() == 3
    assert tables.first_existing(spark, [str(tmp_path / "x"), str(tmp_path / "y")]) is None
    with pytest.raises(FileNotFoundError):
        tables.load_scored_reviews(spark, str(tmp_path / "a"), str(tmp_path / "b"))


def test_union_by_name(spark):
    a, b = spark.sql("select 1 as x, 'a' as d"), spark.sql("select 'b' as d, 2 as x, 3 as y")
    assert sorted(tables.union_domains([a, b]).collect(), key=str) == [(1, "a", None), (2, "b", 3)]


def test_annotations_and_reports(spark, tmp_path):
    df = spark.createDataFrame([("E-1", "Electronics", 'A "b", c', ["battery", "price"])],
                               "review_id string, domain string, text string, aspect_labels array<string>")
    path = tables.write_annotations(df, str(tmp_path / "annotations"))
    assert rows(tables.read_annotations(spark, path)) == [
        ("E-1", "Electronics", 'A "b", c', "battery; price")]
    table = spark.createDataFrame([("a", 1.5), ("b", None)], "m string, v double")
    assert tables.markdown_table(table) == "| m | v |\n| :--- | :--- |\n| a | 1.5 |\n| b |  |"
    many = spark.range(300)
    assert tables.markdown_table(many).count("\n") == 301
    assert rows(tables.json_rows(table))[0][0] == '{"m":"a","v":1.5}'


def test_spread_small(spark, monkeypatch):
    cores = spark.sparkContext.defaultParallelism
    assert tables.spread_small(spark.range(10).coalesce(1)).rdd.getNumPartitions() == cores
    monkeypatch.setattr(tables, "SPREAD_BYTES", 1)
    large = spark.range(10)
    assert tables.spread_small(large) is large


def test_loaders_give_stable_ids(spark, tmp_path):
    base = str(tmp_path)
    reviews = [("good sound and bass", 5.0, "P1"), ("bad sound and bass", 1.0, "P1"), (None, None, None)]
    spark.createDataFrame(reviews, "text string, rating double, parent_asin string").write.json(
        f"{base}/{tables.source_folder('Fashion')}")
    spark.createDataFrame([("P1", "T", ["a"]), ("P2", None, None)], "parent_asin string, title string, "
                          "description array<string>").write.json(f"{base}/{tables.source_folder('Fashion', 'metadata')}")
    first = {r.text: r.row_id for r in tables.load_reviews(spark, base, "Fashion").collect()}
    again = {r.text: r.row_id for r in tables.load_reviews(spark, base, "Fashion").repartition(3).collect()}
    assert first == again and len(set(first.values())) == 3 and None not in first.values()
    assert products.clean_metadata(tables.load_metadata(spark, base, "Fashion")).count() == 2


def test_only_a_missing_path_counts_as_no_table(spark, tmp_path):
    (tmp_path / "empty").mkdir()
    with pytest.raises(AnalysisException):
        tables.read_table(spark, str(tmp_path / "empty"))
    with pytest.raises(FileNotFoundError):
        tables.read_table(spark, str(tmp_path / "none"))


def test_padded_keys_reach_the_stored_tables(spark, tmp_path):
    from voxmill import jobs

    data = [(i, "Fashion", f"review number {i} is fine", "t", 5.0, "P1") for i in range(30)]
    raw = spark.createDataFrame(data, "row_id long, domain string, text string, title string, rating double, "
                                "parent_asin string")
    meta = spark.createDataFrame([(1, "Fashion", "  P1 ", "Shoe", 4.0, "5", ["d"], ["c"], "s")],
                                 "row_id long, domain string, parent_asin string, title string, average_rating double, "
                                 "price string, description array<string>, categories array<string>, store string")
    paths = jobs.build_review_tables(raw, meta, str(tmp_path))
    stored = tables.read_table(spark, paths["reviews"])
    assert stored.count() == 30 and stored.select("row_id").distinct().count() == 30
    built = jobs.build_insights(spark, stored, tables.read_table(spark, paths["products"]), str(tmp_path))
    assert built.first()["title"] == "Shoe"


def test_streams_read_files_and_folders_alike(spark, tmp_path):
    df = spark.range(40).select("id", F.col("id").cast("string").alias("text"))
    df.coalesce(1).write.parquet(str(tmp_path / "one"))
    file = next(str(p) for p in (tmp_path / "one").iterdir() if p.name.startswith("part"))
    df.repartition(4).write.parquet(str(tmp_path / "many.parquet"))
    got = []
    for k, source in enumerate((file, str(tmp_path / "many.parquet"))):
        out = str(tmp_path / f"out{k}")
        stream.ingest(stream.read_stream(spark, source, df.schema), out, str(tmp_path / f"state{k}")).awaitTermination()
        got.append(rows(spark.read.parquet(out)))
    assert got[0] == got[1] == rows(df)


def test_work_folder_comes_from_the_session(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    assert work_folder(spark) == folder and new_path(spark, "x").startswith(folder)
    assert build_session().conf.get("spark.sql.adaptive.enabled") == "true"


REVIEW_DDL = "row_id long, domain string, text string, rating double"


def batches(spark, path):
    first = [(1, "a", "A first good text", 5.0), (2, "a", "<b>Second</b> bad text", 1.0),
             (3, "b", "short", 1.0), (4, "b", "No label for this one", 3.5)]
    second = [(5, "b", "A first good text", 4.0), (6, "b", "A third text &amp; more", 3.0)]
    for i, data in enumerate((first, second)):
        spark.createDataFrame(data, REVIEW_DDL).coalesce(1).write.mode("append").parquet(path)


def test_stream_equals_batch(spark, tmp_path):
    source = str(tmp_path / "in")
    batches(spark, source)
    raw = spark.read.schema(REVIEW_DDL).parquet(source)
    live = stream.read_stream(spark, source, raw.schema, files_per_trigger=1)
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    stream.ingest(stream.clean_stream(live), out, state, ("domain",)).awaitTermination()
    expected = stream.clean_stream(raw)
    got = spark.read.parquet(out)
    assert rows(got, "row_id", "text", "sentiment") == rows(expected, "row_id", "text", "sentiment")
    assert got.count() == 4
    # A second run with the same state finds nothing new.
    stream.ingest(stream.clean_stream(live), out, state, ("domain",)).awaitTermination()
    assert spark.read.parquet(out).count() == 4


def test_stream_dedup_and_counts(spark, tmp_path):
    source = str(tmp_path / "in")
    batches(spark, source)
    raw = spark.read.schema(REVIEW_DDL).parquet(source)
    live = stream.read_stream(spark, source, raw.schema, files_per_trigger=1)
    out = str(tmp_path / "unique")
    stream.ingest(stream.unique_stream(live, ["text"]), out, str(tmp_path / "s1")).awaitTermination()
    unique = spark.read.parquet(out)
    batch = cleaning.keep_first(raw, [cleaning.text_key(F.col("text"))], "row_id")
    assert rows(unique, "text") == rows(batch, "text")
    counts = str(tmp_path / "counts")
    labelled = live.withColumn("sentiment", labels.rating_label(F.col("rating")))
    stream.keep_latest(stream.running_counts(labelled, ["domain", "sentiment"]), counts,
                       str(tmp_path / "s2")).awaitTermination()
    assert stream.read_latest(spark, counts).agg(F.sum("n")).first()[0] == 6


def test_raw_files_are_compressed_and_of_bounded_rows(spark, tmp_path, monkeypatch):
    from voxmill.plans import storage

    monkeypatch.setattr(storage, "new_path", lambda s, name: str(tmp_path / name))
    monkeypatch.setattr(storage, "FILE_ROWS", 20)
    spark.range(6).selectExpr(
        "id as p_partkey", "concat('part number ', id) as p_name", "'Brand#1' as p_brand",
        "if(id % 2 = 0, 'SMALL', 'PROMO') as p_type", "cast(id as int) as p_size", "1.5D as p_retailprice",
    ).write.parquet(f"{tmp_path}/part.parquet")
    spark.range(180).selectExpr(
        "id as l_orderkey", "1 as l_linenumber", "id % 6 as l_partkey", "7L as l_suppkey", "'R' as l_returnflag",
        "date'1995-01-01' as l_shipdate", "31.0D as l_quantity", "'F' as l_linestatus",
    ).coalesce(1).write.parquet(f"{tmp_path}/lineitem.parquet")
    assert storage.raw_to_insights(spark, str(tmp_path)).count() == 6
    raw = [p for d in tables.REVIEW_FOLDERS.values() for p in (tmp_path / "raw" / d).glob("part-*")]
    assert len(raw) > 2 and all(p.name.endswith(".json.gz") for p in raw)
    assert max(spark.read.text(str(p)).count() for p in raw) == 20
    stored = next((tmp_path / "raw" / "tables" / "reviews.parquet").glob("part-*"))
    assert ".zstd." in stored.name
