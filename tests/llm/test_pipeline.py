"""The pipeline against a brute-force version of its stages, and the queries against their SQL."""

import re
import zlib
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cases import documents, frame, numbered, prose
from test_minhash import brute as near_brute
from test_mixing import draw, inverse
from test_rules import measured
from voxmill.llm import queries, rules
from voxmill.llm.common import stored

DATA = Path("/root/testdata/sf0.001")
needs_data = pytest.mark.skipif(not DATA.exists(), reason="no test tables")


def good(text):
    m = measured(text)
    n = m["n_words"]
    if m["base_failed"]:
        return False
    bounds = {"mean_word_length": m["word_chars"] / n, "symbols_per_word": m["n_symbols"] / n,
              "echoed_words": m["n_echo_words"] / n, "stop_word_share": m["n_stop_words"] / n,
              "repeated_lines": m["n_dup_lines"] / m["n_lines"]}
    return all((r.low is None or bounds[r.name] >= r.low) and (r.high is None or bounds[r.name] <= r.high)
               for r in rules.RULES if n >= r.from_words)


def corpus():
    """Prose long enough to pass, with stop words, copies, near copies and junk."""
    pairs = list(numbered())
    for i in range(60):
        words = prose(900 + i % 50, 70).split(" ")
        words[::9] = ["the"] * len(words[::9])
        if i >= 55:
            words[5] = "changed"
        pairs.append((100 + i, " ".join(words)))
    return [(i, t, "en", f"src{i % 4}", len(t or "")) for i, t in pairs]


def test_stages_equal_brute_force(spark):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    left, kept = rows, docs
    for (name, stage), step in zip(corpus_pipeline.STAGES, (
            lambda rows: [r for r in rows if good(r[1])],
            lambda rows: [max((s for s in rows if s[1] == t), key=lambda s: s[0]) for t in {r[1] for r in rows}],
            lambda rows: [r for r in rows if near_brute([(s[0], s[1]) for s in rows], 5)[r[0]][2]])):
        kept, left = stored(stage(spark, kept, ""), "stage"), step(left)
        assert kept.columns == docs.columns, name
        assert sorted(tuple(r) for r in kept.collect()) == sorted(left), name
    sizes = Counter()
    for r in left:
        sizes[r[3]] += len(r[1].encode())
    want = Counter()
    for r in left:
        rate = sum(sizes.values()) / len(sizes) / sizes[r[3]]
        want[r] += inverse(rate, draw(r[0], "mix:1"))
    mixed = stored(corpus_pipeline.STAGES[3][1](spark, kept, ""), "stage")
    assert mixed.columns == docs.columns
    assert Counter(tuple(r) for r in mixed.collect()) == +want
    placed = corpus_pipeline.STAGES[4][1](spark, mixed, "")
    assert Counter(r.doc_id for r in placed.where("piece = 0").collect()) == Counter(
        {i: n for i, n in Counter(r[0] for r in want.elements()).items()})


def test_stages_take_odd_rows_and_empty_tables(spark):
    for data in (None, []):
        docs = frame(spark, data)
        for _, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, "")
            assert out.count() >= 0
            if stage is not corpus_pipeline.STAGES[-1][1]:
                assert out.columns == docs.columns


def test_near_duplicates_are_a_stage():
    assert [n for n, _ in corpus_pipeline.STAGES][2] == "MinHash near-dedup" and len(corpus_pipeline.STAGES) == 5
    assert {int(re.match(r"op(\d+)_", q)[1]) for q in queries.QUERIES} == set(range(1, 14))


@needs_data
def test_run_ends_in_packed_sequences(spark):
    out = corpus_pipeline.run(spark, str(DATA))
    assert out.count() > 0
    assert out.groupBy("sequence_id").agg(F.sum("length").alias("n")).agg(F.max("n")).first()[0] <= 2048


TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}


@needs_data
@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for table in ("documents", "conversations"):
        con.execute(f"create view {table} as select * from read_parquet('{DATA}/{table}.parquet')")
    df = queries.QUERIES[name](spark, str(DATA))
    cursor = con.execute(queries.ORACLES[name])
    assert {f.name: TYPES[f.dataType.simpleString()] for f in df.schema.fields} == {
        d[0]: str(d[1]) for d in cursor.description}
    names = [d[0] for d in cursor.description]
    want = sorted(tuple(r[names.index(c)] for c in sorted(names)) for r in cursor.fetchall())
    assert sorted(tuple(r[c] for c in sorted(names)) for r in df.collect()) == want


@needs_data
@pytest.mark.parametrize("name, columns", [
    ("op11_conversation_repair", "conv_id gaps blank duplicate truncated illegal cost audit repaired_sha256"),
    ("op12_main_text", "page_id url text n_chars"), ("op13_source_divergence", "lang source part item value rank")])
def test_queries_on_other_tables_have_their_columns(spark, name, columns):
    found = queries.QUERIES[name](spark, str(DATA))
    assert set(columns.split()) <= set(found.columns)
    if name != "op13_source_divergence":
        key, table = ("conv_id", "conversations") if name.startswith("op11") else ("page_id", "pages")
        ids = {r[key] for r in spark.read.parquet(f"{DATA}/{table}.parquet").collect()}
        rows = [r[key] for r in found.collect()]
        assert len(rows) == len(ids) and set(rows) == ids


@needs_data
@pytest.mark.parametrize("name, columns", [
    ("op1_radix_dedup", "doc_id keep_id group_size kept text_sha256"),
    ("op2_best_fit_packing", "doc_id piece start length ids_crc32 sequence_id offset"),
    ("op4_quality_rules", "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept"),
    ("op5_rendezvous_shards", "doc_id size text_crc32 law shard slot grown_shard"),
    ("op6_secret_scan", "doc_id n_assign n_access n_hex base_sha256 spans"),
    ("op7_repeated_passages", "doc_id n_bytes n_removed n_spans kept_sha256"),
    ("op8_minhash_near_dedup", "doc_id n_shingles component_id kept"),
    ("op9_suffix_tree_scores", "doc_id held_out n_tokens n_known train_tokens base_score score"),
    ("op10_quality_classifier", "doc_id held_out score predicted")])
def test_queries_return_every_document(spark, name, columns):
    found = queries.QUERIES[name](spark, str(DATA))
    assert set(columns.split()) <= set(found.columns)
    ids = {r.doc_id for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    rows = found.collect()
    assert {r.doc_id for r in rows} == ids
    if "held_out" in columns:
        folds, held = (10, 0) if name.startswith("op9") else (4, 2)
        assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % folds == held) for r in rows)
