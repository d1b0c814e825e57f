import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from cases import frame, prose, rows
from voxmill.llm import divergence

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def expected(data, least=3, top=200):
    """data: (lang, source, text)."""
    counts, found = defaultdict(Counter), defaultdict(Counter)
    groups = set()
    for lang, source, text in data:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(UPPER))
        counts[lang, source].update(terms)
        found[lang].update(set(terms))
    out = set()
    for lang, source in groups:
        kept = sorted(t for t, n in found[lang].items() if n >= least)
        v = len(kept)
        mates = [s for g, s in groups if g == lang]

        def shares(of):
            c = {t: sum(counts[lang, s][t] for s in of) for t in kept}
            n = sum(c.values())
            return c, {t: 1 + 10**9 * (c[t] + 1) // (n + v) for t in kept}

        own, p = shares([source])
        parts = {"pair": [], "term": []}
        for other in mates:
            if other != source:
                q = shares([other])[1]
                parts["pair"].append((-sum((p[t] - q[t]) ** 2 // q[t] for t in kept), other.encode(), other))
        q = shares(mates)[1]
        for t in kept:
            if own[t] and p[t] > q[t]:
                parts["term"].append((-((p[t] - q[t]) ** 2 // q[t]), t.encode(), t))
        for part, items in parts.items():
            for rank, (value, _, item) in enumerate(sorted(items)[:None if part == "pair" else top], 1):
                out.add((lang, source, part, item, -value, rank))
    return out


def columns(df):
    return {(r.lang, r.source, r.part, r.item, r.value, r.rank) for r in df.collect()}


def test_audit_equals_brute_force_on_odd_rows(spark):
    found = divergence.divergence_audit(frame(spark))
    assert columns(found) == expected([(r[2], r[3], r[1]) for r in rows()])


@pytest.mark.parametrize("tile, at_once, block", [(64, 8192, 200_000), (2, 3, 40)])
def test_audit_equals_brute_force(spark, monkeypatch, tile, at_once, block):
    monkeypatch.setattr(divergence, "TILE", tile)
    monkeypatch.setattr(divergence, "TERMS_AT_ONCE", at_once)
    monkeypatch.setattr(divergence, "ROWS_PER_BLOCK", block)
    draw = random.Random(3)
    # One language with a hot source, one with ties, one whose terms are all too rare, one source alone.
    data = [("en", "hot" if i % 3 else f"s{i % 7}", prose(draw.randint(0, 12), draw.randint(0, 60)))
            for i in range(90)]
    data += [("de", s, "Éins zwei éins DREI") for s in ("a", "b", "c", "é")] + [("fr", s, s + " rare") for s in "xy"]
    data += [(None, None, "eins eins"), (None, "", "eins zwei"), (None, "z", "eins 12 &&"), ("it", "only", "a a a")]
    docs = spark.createDataFrame(data, "lang string, source string, text string").repartition(4)
    assert columns(divergence.divergence_audit(docs, top_terms=5)) == expected(data, top=5)


def test_products_equal_the_plain_matrix_product():
    draw = np.random.default_rng(5)
    terms, columns = np.unique(draw.integers(0, [500, 300], (4000, 2)), axis=0).T
    x = np.zeros((500, 300), np.int64)
    x[terms, columns] = 1
    shuffled = draw.permutation(len(terms))
    i, j, n = divergence.one_hot_products(terms[shuffled], columns[shuffled])
    got = np.zeros((300, 300), np.int64)
    np.add.at(got, (i, j), n)
    assert (got == np.triu(x.T @ x, 1)).all()


def test_joint_tables_are_whole(spark):
    data = [("en", f"s{i % 3}", prose(i % 5, 30)) for i in range(30)] + [("en", "empty", None)]
    docs = spark.createDataFrame(data, "lang string, source string, text string")
    counts = divergence.term_counts(docs)
    sums = divergence.totals(counts, docs.select("lang", "source").distinct())
    joint = divergence.joint_levels(counts, sums).collect()
    v = sums.first().terms
    per_pair = Counter()
    for r in joint:
        per_pair[r.source, r.other] += r.n_terms
    assert len(per_pair) == 12 and set(per_pair.values()) == {v}


def test_counts_are_passed_on_in_parts(spark, monkeypatch):
    data = [("en", f"s{i % 3}", prose(i, 40)) for i in range(40)]
    docs = spark.createDataFrame(data, "lang string, source string, text string").repartition(2)
    monkeypatch.setattr(divergence, "TERMS_HELD", 5)
    assert columns(divergence.divergence_audit(docs)) == expected(data)


def test_empty_table(spark):
    assert divergence.divergence_audit(frame(spark, [])).count() == 0


def test_terms_are_told_apart_by_group_and_document():
    """Counts and documents of a block of texts, with blanks, junk, characters beyond ASCII and no text:
    one row for each language and term, however many sources have it."""
    import pyarrow as pa

    texts = ["Ab ab 12ab\ncd", "", "ÄB　x漢字 ab", "&&", "ab", "\x7fAB", "ab", None]
    langs, sources = ["en", "en", "de", "de", "en", "", "en", "en"], ["a", "b", "a", "a", "a", "", "c", "c"]
    batch = pa.RecordBatch.from_arrays([pa.array(x, pa.string()) for x in (langs, sources, texts)], ["l", "s", "t"])
    found = [r for b in divergence._counted(iter([batch])) for r in b.to_pylist()]
    want, documents = defaultdict(Counter), Counter()
    for lang, source, text in zip(langs, sources, texts, strict=True):
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(UPPER))
        documents.update((lang, t) for t in set(terms))
        for t in terms:
            want[lang, t][source] += 1
    assert {(r["lang"], r["term"]): r["documents"] for r in found} == documents
    assert {(r["lang"], r["term"]): {c["source"]: c["count"] for c in r["counts"]} for r in found} == want
    assert len(found) == len(want)
