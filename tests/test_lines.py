"""The JSON lines source: byte ranges, filters, early stop, appended lines in a stream."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import EqualTo, GreaterThan

from conftest import rows
from voxmill.session import new_path
from voxmill.sources import lines
from voxmill.streaming import reviews as stream

SCHEMA = "row_id long, text string, rating double, verified_purchase boolean, extra string"


def written(path, name, start, n):
    path.mkdir(exist_ok=True)
    with open(path / name, "a", encoding="utf-8") as file:
        for i in range(start, start + n):
            record = {"text": "é" * (i % 7) + f"t{i}", "rating": i % 5 + (0.5 if i % 2 else 0), "verified_purchase": i % 3 == 0}
            if i % 4 == 0:
                record["extra"] = {"k": [i]}
            file.write(json.dumps(record, ensure_ascii=bool(i % 2)) + "\n")
            if i % 10 == 0:
                file.write("\n")


def load(spark, path, **options):
    lines.register(spark)
    return spark.read.format(lines.FORMAT).schema(SCHEMA).options(**options).load(str(path))


@pytest.mark.parametrize("split", [7, 100, 1 << 20])
def test_every_line_is_read_once(spark, tmp_path, split):
    written(tmp_path / "d", "a.json", 0, 60)
    written(tmp_path / "d", "b.json", 60, 40)
    (tmp_path / "d" / "_SUCCESS").write_text("")
    df = load(spark, tmp_path / "d", splitBytes=split)
    plain = spark.read.schema("text string, rating double, verified_purchase boolean, extra string").json(str(tmp_path / "d"))
    columns = ["text", "rating", "verified_purchase"]
    assert rows(df, *columns) == rows(plain, *columns)
    ids = [r.row_id for r in df.collect()]
    assert len(set(ids)) == 100 and sorted(ids) == sorted(r.row_id for r in load(spark, tmp_path / "d").collect())
    assert {json.loads(r.extra)["k"][0] for r in df.where("extra is not null").collect()} == set(range(0, 100, 4))


def test_filters_are_tested_at_the_source(spark, tmp_path):
    written(tmp_path / "d", "a.json", 0, 50)
    df = load(spark, tmp_path / "d").where((F.col("rating") >= 3) & (F.col("verified_purchase") == True))  # noqa: E712
    plain = [i for i in range(50) if i % 5 + (0.5 if i % 2 else 0) >= 3 and i % 3 == 0]
    assert sorted(r.text.lstrip("é") for r in df.collect()) == sorted(f"t{i}" for i in plain)
    reader = lines.LinesReader(T._parse_datatype_string(SCHEMA), {"path": str(tmp_path / "d")})
    left = list(reader.pushFilters([EqualTo(("verified_purchase",), True), GreaterThan(("rating",), 3.0), EqualTo(("a", "b"), 1)]))
    assert len(left) == 1 and len(reader.filters) == 2
    found = [r for p in reader.partitions() for r in reader.read(p)]
    assert found and all(r[3] is True and r[2] > 3 for r in found)


def test_early_stop(spark, tmp_path):
    written(tmp_path / "d", "a.json", 0, 5000)
    schema = T._parse_datatype_string(SCHEMA)
    reader = lines.LinesReader(schema, {"path": str(tmp_path / "d"), "limit": "4", "splitbytes": "50000"})
    parts = reader.partitions()
    assert len(parts) > 3 and all(len(list(reader.read(p))) == 4 for p in parts[:-1])
    assert load(spark, tmp_path / "d", limit=10).limit(10).count() == 10


def test_broken_lines_and_missing_tables(spark, tmp_path):
    written(tmp_path / "d", "a.json", 0, 5)
    with open(tmp_path / "d" / "a.json", "a") as file:
        file.write('{"text": "cut\n[1]\n')
    assert load(spark, tmp_path / "d", mode="dropmalformed").count() == 5
    with pytest.raises(Exception, match="byte"):
        load(spark, tmp_path / "d").count()
    with pytest.raises(Exception, match="No table"):
        load(spark, tmp_path / "nothing").count()
    (tmp_path / "e").mkdir()
    assert load(spark, tmp_path / "e").count() == 0


def test_stream_reads_appended_lines_once(spark, tmp_path):
    lines.register(spark)
    out, state = new_path(spark, "lines"), new_path(spark, "lines-state")

    def run():
        arriving = spark.readStream.format(lines.FORMAT).schema(SCHEMA).option("splitBytes", 300).load(str(tmp_path / "d"))
        stream.ingest(arriving, out, state).awaitTermination()

    written(tmp_path / "d", "a.json", 0, 20)
    with open(tmp_path / "d" / "a.json", "a") as file:
        file.write('{"text": "not yet whole')
    run()
    assert spark.read.parquet(out).count() == 20
    with open(tmp_path / "d" / "a.json", "a") as file:
        file.write(' now"}\n')
    written(tmp_path / "d", "b.json", 20, 5)
    run()
    got = [r.text.lstrip("é") for r in spark.read.parquet(out).collect()]
    assert sorted(got) == sorted([f"t{i}" for i in range(25)] + ["not yet whole now"])
