import math
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cases import documents, frame, numbered, prose, rows, words
from voxmill.llm import suffixtree


def corpus():
    """Plain prose, and one passage that many texts share."""
    passage = prose(1, 40)
    return numbered() + [(100 + i, prose(300 + i, 60) + " " + passage + " " + prose(600 + i, 10)) for i in range(150)]


def trained(i):
    return i % 5 != 0


@pytest.fixture(scope="module")
def scored(spark):
    docs = documents(spark, corpus())
    return {r.doc_id: r for r in suffixtree.score(docs, train=F.col("doc_id") % 5 != 0).collect()}


def counts():
    tokens = {i: [*words(t), None] for i, t in corpus()}
    return tokens, Counter(w for i, own in tokens.items() if trained(i) for w in own)


def test_base_equals_brute_force(scored):
    tokens, c = counts()
    total, kinds = sum(c.values()), len(c)
    assert scored.keys() == tokens.keys()
    for i, own in tokens.items():
        r = scored[i]
        base = sum(math.log10((c[w] + 0.1) / (total + 0.1 * (kinds + 1))) for w in own)
        assert (r.n_tokens, r.n_known, r.train_tokens, r.train) == (
            len(own), sum(c[w] > 0 for w in own), total, trained(i))
        assert math.isclose(r.base_score, base, rel_tol=1e-9)


def test_score_equals_a_plain_tree(scored):
    """The same model from n-gram counts in dictionaries."""
    tokens, c = counts()
    total, once = sum(c.values()), max(1, sum(n == 1 for n in c.values()))
    least = max(2.0, suffixtree.LEAST_SHARE * total)
    start = "<start>"
    sizes = {(w,): n for w, n in c.items()}
    sizes[(start,)] = c[None]
    chance = {(w,): n / (total + once) for w, n in c.items()}
    frequent = {g for g, n in sizes.items() if n >= 1}
    states, shares = {}, {}
    for n in range(2, suffixtree.DEPTH + 2):
        found = Counter()
        for i, own in tokens.items():
            if trained(i):
                line = [start, *own]
                found.update(tuple(line[k:k + n]) for k in range(len(line) - n + 1))
        level = {g: m for g, m in found.items() if m >= least and g[:-1] in frequent and g[1:] in frequent}
        by_context = {}
        for g, m in level.items():
            by_context.setdefault(g[:-1], {})[g] = m
        new = {}
        for context, own in by_context.items():
            size = sizes[context]
            share = {g: (m - suffixtree.DISCOUNT) / size for g, m in own.items()}
            gain = sum(m * math.log(m / size / chance[g[1:]]) for g, m in own.items())
            rest = size - sum(own.values())
            if rest > 0:
                gain += rest * math.log(rest / size / max(1e-12, 1 - sum(chance[g[1:]] for g in own)))
            kept = gain > 0.5 * len(own) * math.log(total) + 2
            if kept:
                states[context] = 1 - sum(share.values())
                shares.update(share)
            for g in own:
                new[g] = share[g] + states[context] * chance[g[1:]] if kept else chance[g[1:]]
        chance, sizes, frequent = new, {g: float(m) for g, m in level.items()}, set(level)
    assert states
    for i, own in tokens.items():
        line, score = [start, *own], 0.0
        for k in range(1, len(line)):
            p = (c[line[k]] or once) / (total + once)
            for n in range(1, min(suffixtree.DEPTH, k) + 1):
                context = tuple(line[k - n:k])
                if context in states:
                    p = states[context] * p + shares.get((*context, line[k]), 0.0)
            score += math.log10(p)
        assert math.isclose(scored[i].score, score, rel_tol=1e-9)


def test_score_beats_the_base_on_held_out_rows(scored):
    held_out = [r for r in scored.values() if not r.train]
    assert sum(r.score for r in held_out) > sum(r.base_score for r in held_out)


def test_chances_add_up_to_one():
    """After any context, over all words and the unseen one."""
    hashes = np.arange(1, 9, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    flat = np.full(8, 1 / 8)
    tree = suffixtree.SuffixTree()
    after = suffixtree.grams(np.array([hashes[0], hashes[1]]), 2)[1:]
    tree.contexts.append(suffixtree.HashTable(hashes[:1], np.array([0.4])))
    tree.pairs.append(suffixtree.HashTable(after, np.array([0.6])))
    total = 0.0
    for i, word in enumerate(hashes):
        stream = np.array([suffixtree.START, hashes[0], word])
        found = tree.raise_chances(stream, np.arange(3), np.array([1.0, flat[0], flat[i]]))
        total += found[2]
    assert math.isclose(total, 1.0)


def test_counters_are_added_in_groups(spark, monkeypatch):
    docs = documents(spark, corpus()).repartition(7).select(F.lit(True).alias("train"), "text")
    _, cells = suffixtree.count_words(docs)
    monkeypatch.setattr(suffixtree, "FAN", 2)
    _, again = suffixtree.count_words(docs)
    assert (cells == again).all()
    assert cells.sum() == sum(len(words(t)) + 1 for _, t in corpus())
    numbers = np.array([0, 1, 255, 256, 1 << 40])
    assert (suffixtree._numbers(suffixtree._planes(numbers)) == numbers).all()


def test_odd_rows_empty_table_and_nothing_to_learn(spark):
    found = suffixtree.score(frame(spark)).collect()
    assert len(found) == len(rows())
    assert all(np.isfinite([r.score, r.base_score]).all() and r.n_tokens > 0 for r in found)
    assert suffixtree.score(frame(spark, [])).count() == 0
    none = suffixtree.score(frame(spark), train=F.lit(None).cast("boolean")).collect()
    assert {(r.base_score, r.score, r.n_known) for r in none} == {(0.0, 0.0, 0)}
    assert pd.Series([r.train_tokens for r in none]).eq(0).all()


def test_a_phrase_is_modelled_however_large_the_corpus(spark, monkeypatch):
    """2 occurrences among 600,000 tokens (under 4e-6 of them) make contexts, on the executors alone."""
    from pyspark.sql.classic.dataframe import DataFrame

    def refused(self):
        raise AssertionError("the tree was brought to the driver")

    monkeypatch.setattr(DataFrame, "toPandas", refused)
    filler = " ".join(f"w{i}" for i in range(1500))
    phrase = "quick brown foxes jump over lazy dogs"
    pairs = [(i, filler) for i in range(400)] + [(1000, phrase), (1001, phrase)]
    pairs += [(2000, phrase), (2001, " ".join(reversed(phrase.split(" "))))]
    found = {r.doc_id: r for r in suffixtree.score(documents(spark, pairs), train=F.col("doc_id") < 2000).collect()}
    assert found[1000].train_tokens * 4e-6 > 2
    assert found[2000].base_score == pytest.approx(found[2001].base_score)
    assert found[2000].score > found[2001].score + 10


def test_tables_are_cut_into_parts_and_texts_scored_in_rounds(spark, monkeypatch, scored):
    """Many ranges of hashes, blocks and rounds give the scores of one; a part sends each n-gram, and
    asks for each shorter one, once, so no row of a table is an occurrence."""
    monkeypatch.setattr(suffixtree, "PART_TOKENS", 300)
    monkeypatch.setattr(suffixtree, "HELD", 500)
    monkeypatch.setattr(suffixtree, "SCORED", 2000)
    docs = documents(spark, corpus())
    found = {r.doc_id: r for r in suffixtree.score(docs, train=F.col("doc_id") % 5 != 0).collect()}
    assert found.keys() == scored.keys()
    for i, r in found.items():
        assert (r.n_tokens, r.n_known, r.train_tokens) == (scored[i].n_tokens, scored[i].n_known, scored[i].train_tokens)
        assert math.isclose(r.score, scored[i].score, rel_tol=1e-9)
        assert math.isclose(r.base_score, scored[i].base_score, rel_tol=1e-9)


def test_a_task_passes_on_a_row_for_each_part(spark):
    rows = documents(spark, corpus()).repartition(2).select(F.lit(True).alias("train"), "text")
    found = suffixtree._frequent_grams(rows, 2, 2.0, lambda whole, context, tail: np.ones(len(whole), bool), 3).collect()
    want = Counter()
    for _, text in corpus():
        line = [None, *words(text), ""]
        want.update(zip(line, line[1:]))
    assert len(found) == 8 and sum(len(r.gram) // 8 for r in found) == sum(n > 1 for n in want.values())
    assert sum(np.frombuffer(r.n, np.int64).sum() for r in found) == sum(n for n in want.values() if n > 1)
    for r in found:
        gram, context, tail = (np.frombuffer(r[c], np.uint64) for c in ("gram", "context", "tail"))
        assert (gram == suffixtree._gram(context, tail, 2)).all() and (gram[1:] > gram[:-1]).all()
        assert (gram >> np.uint64(61) == r.part).all()


def test_stored_tables_are_compressed(spark):
    """Besides their values, which are the plain ones."""
    docs = documents(spark, corpus()).select(F.lit(True).alias("train"), "text")
    table = suffixtree.stored(docs, "texts")
    assert all(".zstd." in f for f in table.inputFiles())
    assert sorted(str(r.text) for r in table.collect()) == sorted(str(r.text) for r in docs.collect())


def test_texts_are_read_once(spark):
    """Counting n-grams of each length and scoring take the words that were found in one pass."""
    reads = spark.sparkContext.accumulator(0)

    def passed(batches):
        for batch in batches:
            reads.add(batch.num_rows)
            yield batch

    docs = documents(spark, corpus())
    found = suffixtree.score(docs.mapInArrow(passed, docs.schema), train=F.col("doc_id") % 5 != 0).collect()
    assert len(found) == len(corpus()) == reads.value


def test_tables_of_parts_are_read_where_they_are(spark):
    """Of two tables that meet part by part, only what asks is shuffled."""
    rows = spark.range(64).select(
        (F.col("id") % 8).alias("part"), F.col("id").alias("block"), F.lit(b"").alias("gram"))
    table = suffixtree.bucketed(rows.where("id < 8").select(
        "part", *[F.lit(b"").alias(c) for c in ("gram", "n", "size", "kinds")]), "model", 3)
    found = suffixtree._answered(rows, table)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
    assert sorted(r.block for r in found.collect()) == list(range(64))
    name = suffixtree.bucketed(rows, "gone", 3)
    files = len(name.inputFiles())
    suffixtree.dropped(name)
    assert files and not [t.name for t in spark.catalog.listTables() if t.name.startswith("gone")]


def test_hashes_that_differ_in_low_bits_are_told_apart():
    for hashes in (np.arange(5000, dtype=np.uint64)[::-1] % np.uint64(70), np.array([2**64 - 1, 0, 2**64 - 1], np.uint64),
                   np.zeros(0, np.uint64), np.arange(9, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)):
        order, out = suffixtree._order(hashes)
        assert (out == np.sort(hashes)).all() and (hashes[order] == out).all()
        values, places = suffixtree._numbered(hashes)
        assert (values == np.unique(hashes)).all() and (values[places] == hashes).all()


def test_counts_of_any_size_are_passed_on():
    numbers, bounds = np.array([0, 254, 255, 256, 1 << 40, 3]), np.array([0, 2, 2, 6])
    short, large = suffixtree._short(numbers, bounds)
    assert (suffixtree._long(short, large) == numbers).all()
    assert (suffixtree._long(short.slice(2), large.slice(2)) == numbers[2:]).all()
