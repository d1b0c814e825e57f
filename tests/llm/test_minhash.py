import random
from itertools import combinations

import numpy as np
import pytest

from cases import documents, frame, numbered, prose, rows, words
from voxmill.llm import minhash


def shingles(text, size):
    w = words(text)
    return {tuple(w[i:i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set())


def brute(pairs, size, percent=80):
    sets = {i: shingles(t, size) for i, t in pairs}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in combinations(sorted(sets), 2):
        common = len(sets[a] & sets[b])
        if sets[a] and sets[b] and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {i: (len(s), find(i), find(i) == i) for i, s in sets.items()}


def family(seed, n, share, size=120):
    """Copies of one text with a share of its words changed: links, chains and near misses."""
    draw, base = random.Random(seed), prose(seed, size).split(" ")
    return [" ".join("w%d" % draw.randrange(10**6) if draw.random() < share else w for w in base) for _ in range(n)]


def corpus():
    texts = [t for _, t in numbered()]
    for seed, share in ((1, 0.01), (2, 0.02), (3, 0.03), (4, 0.06)):
        texts += family(seed, 25, share)
    base = prose(5, 200).split(" ")
    texts += [" ".join(base[i:i + 150]) for i in range(0, 50, 4)]  # a chain of shifted windows
    order = list(enumerate(texts))
    random.Random(6).shuffle(order)
    return [(k, t) for k, (_, t) in enumerate(order)]


@pytest.mark.parametrize("size, most, block", [(5, 20_000, 512), (4, 3, 8)])
def test_components_equal_brute_force(spark, monkeypatch, size, most, block):
    monkeypatch.setattr(minhash, "BLOCK_MEMBERS", block)
    pairs = corpus()
    found = minhash.near_duplicates(documents(spark, pairs), size=size, max_family=most).collect()
    assert {r._id: (r.n_shingles, r.component_id, r.kept) for r in found} == brute(pairs, size)


def test_components_of_a_path_a_star_and_a_ring(spark):
    path = [(i, i + 1) for i in range(40)]
    star = [(100, 100 + i) for i in range(1, 60)]
    ring = [(200 + i, 200 + (i + 1) % 9) for i in range(9)]
    links = spark.createDataFrame(path + star + ring + [(7, 7)], "a long, b long")
    got = {r.node: r.root for r in minhash.components(links).collect()}
    want = {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(60)}, **{200 + i: 200 for i in range(9)}}
    assert got == want
    assert minhash.components(links.where("a < 0")).count() == 0


def test_linked_roots_form_a_forest_over_exact_links():
    draw = random.Random(8)
    sets = [np.array(sorted(draw.sample(range(40), draw.randint(5, 12))), np.uint64) for _ in range(60)]
    root = np.arange(60) // 2
    forest = minhash.linked_roots(sets, root, np.arange(60), np.arange(60), 50)
    group = {i: i for i in range(30)}

    def find(groups, i):
        while groups[i] != i:
            i = groups[i]
        return i

    for a, b in forest:
        assert find(group, a) != find(group, b)
        group[find(group, a)] = find(group, b)
    want = {i: i for i in range(30)}
    for i, j in combinations(range(60), 2):
        x, y = set(sets[i].tolist()), set(sets[j].tolist())
        if 100 * len(x & y) >= 50 * len(x | y):
            want[find(want, int(root[i]))] = find(want, int(root[j]))
    same = lambda g: {(a, b) for a, b in combinations(range(30), 2) if find(g, a) == find(g, b)}
    assert same(group) == same(want)


def test_signatures_estimate_the_similarity():
    left, right = np.arange(0, 900, dtype=np.uint64), np.arange(100, 1000, dtype=np.uint64)
    found = minhash.signatures([minhash.mixed(left), minhash.mixed(right)])
    assert abs((found[0] == found[1]).mean() - 0.8) < 0.15


def test_deduplicate_keeps_columns_and_odd_rows(spark):
    docs = frame(spark)
    left = minhash.deduplicate(docs, size=4)
    assert left.columns == docs.columns
    ids = {r.doc_id for r in left.collect()}
    want = brute([(i, t) for i, t in numbered()], 4)
    assert {i for i in ids if i is not None and i < 500} == {i for i, (_, _, kept) in want.items() if kept}
    assert None in ids and 500 in ids
    found = minhash.near_duplicates(docs, size=4)
    assert found.count() == len(rows())
    assert minhash.deduplicate(frame(spark, [])).count() == 0
