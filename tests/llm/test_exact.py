import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from cases import documents, frame, numbered, prose, rows
from voxmill.llm import exact


def expected(pairs):
    groups = defaultdict(list)
    for i, t in pairs:
        groups[t or ""].append(i)
    return {i: (max(groups[t or ""]), len(groups[t or ""]), i == max(groups[t or ""]),
                hashlib.sha256((t or "").encode()).hexdigest()) for i, t in pairs}


@pytest.mark.parametrize("carry", [True, False])
def test_groups_equal_brute_force(spark, carry):
    # Texts that part only after 64, 512 and 40,000 bytes, and one that ends on a digit's border.
    long = prose(1, 9000)
    pairs = numbered() + [(100, long), (101, long + "a"), (102, long + "b"), (103, long), (104, "y" * 64),
                          (105, "y" * 64), (106, "y" * 65), (107, "y" * 512), (108, "y" * 512 + "z"),
                          *[(110 + i, f"{i % 2}" * (i // 2 + 1) + long) for i in range(6)],
                          (120, "a" * 64 + long), (121, "b" * 64 + long), (122, "a" * 64 + long),
                          (123, "b" * 64 + long), (124, "a" * 64 + long + "c"), (125, "b" * 64 + long + "c")]
    found = exact.exact_groups(documents(spark, pairs), carry_text=carry)
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept, r.text_sha256) for r in found.collect()}
    assert got == expected(pairs)
    assert ("text" in found.columns) == carry


def test_every_row_has_a_result_and_one_of_a_group_stays(spark):
    found = exact.exact_groups(frame(spark)).collect()
    assert len(found) == len(rows())
    by_text = defaultdict(list)
    for r in found:
        by_text[r.text or ""].append(r)
    for group in by_text.values():
        assert sum(r.kept for r in group) == 1
        assert {r.group_size for r in group} == {len(group)}
        assert len({r.keep_id for r in group}) == 1


def test_deduplicate_keeps_columns(spark):
    docs = frame(spark)
    left = exact.deduplicate(docs)
    assert left.columns == docs.columns
    kept = left.collect()
    assert len(kept) == len({r[1] or "" for r in rows()})
    assert {r.size for r in kept} == {"big"} and {r.kept for r in kept} == {None}


def test_empty_table(spark):
    assert exact.exact_groups(frame(spark, [])).count() == 0
    assert exact.deduplicate(frame(spark, [])).count() == 0


def test_hot_group_is_spread(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.when(
        F.col("id") % 3 == 0, F.lit("the same text " * 20)).otherwise(F.col("id").cast("string")).alias("text"))
    found = exact.exact_groups(docs, carry_text=False)
    top = found.groupBy("group_size").count().orderBy(F.desc("group_size")).first()
    assert tuple(top) == (1334, 1334)
    assert found.where("kept").count() == 4000 - 1333
