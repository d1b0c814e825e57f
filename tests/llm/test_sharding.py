import hashlib
import math
import zlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from cases import frame, rows
from voxmill.llm import sharding


def draw(key, salt):
    return (int(hashlib.md5(f"{key}:{salt}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52


def winner(key, weights):
    return max(range(len(weights)), key=lambda i: -weights[i] / math.log(draw(key, i)))


def test_shards_equal_brute_force(spark):
    weights = [1.0, 2.0, 0.5]
    docs = frame(spark)
    found = sharding.shard(docs, weights=weights).collect()
    assert len(found) == len(rows())
    texts = {r[0]: r[1] for r in rows() if r[0] not in (None, 500)}
    for r in found:
        name = "" if r.doc_id is None else str(r.doc_id)
        assert r["shard"] == winner(name, weights)
        assert r.grown_shard == winner(name, [*weights, 1.0])
        assert r.grown_shard in (r["shard"], 3)
        if r.doc_id in texts:
            data = (texts[r.doc_id] or "").encode()
            assert (r["size"], r.text_crc32) == (len(data) + 1, zlib.crc32(data))


def test_slots_have_no_gaps(spark, monkeypatch):
    monkeypatch.setattr(sharding, "ROWS_PER_BUCKET", 50)
    docs = spark.range(5000).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"))
    slots = defaultdict(list)
    for r in sharding.shard(docs).collect():
        slots[r["shard"]].append(r.slot)
    assert len(slots) == 16
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_shares_follow_weights(spark):
    docs = spark.range(6000).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"))
    found = sharding.shard(docs, weights=[1.0, 2.0, 3.0], grown=[1.0, 2.0, 3.0, 6.0]).collect()
    share = Counter(r["shard"] for r in found)
    for i, n in share.items():
        assert abs(n / 6000 - (i + 1) / 6) < 0.03
    moved = [r for r in found if r.grown_shard != r["shard"]]
    assert {r.grown_shard for r in moved} == {3} and abs(len(moved) / 6000 - 0.5) < 0.03


def test_empty_table(spark):
    assert sharding.shard(frame(spark, [])).count() == 0
