import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest

from cases import documents, frame, numbered, prose, rows
from voxmill.llm import repeats

LENGTH = 200


def brute(pairs, length=LENGTH):
    starts = defaultdict(int)
    data = [(i, (t or "").encode()) for i, t in pairs]
    for _, t in data:
        for p in range(len(t) - length + 1):
            starts[t[p:p + length]] += 1
    out = {}
    for i, t in data:
        covered = bytearray(len(t))
        for p in range(len(t) - length + 1):
            if starts[t[p:p + length]] > 1:
                covered[p:p + length] = b"\1" * length
        kept = bytes(b for b, c in zip(t, covered) if not c)
        runs = sum(1 for p, c in enumerate(covered) if c and not (p and covered[p - 1]))
        out[i] = (len(t), sum(covered), runs, hashlib.sha256(kept).hexdigest())
    return out


def got(df):
    return {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect()}


def overlapping():
    """Passages cut at all offsets, so that repeats of 190 to 400 bytes chain in many ways."""
    draw, base = random.Random(3), prose(9, 300)
    out = []
    for i in range(80):
        at, n = draw.randrange(len(base) - 450), draw.randrange(150, 450)
        out.append((1000 + i, prose(2000 + i, draw.randrange(3, 40)) + base[at:at + n] + prose(3000 + i, 5)))
    return out


def edited():
    """Near copies with one word in twenty changed."""
    draw, words = random.Random(4), prose(10, 200).split(" ")
    out = []
    for i in range(40):
        own = [("%d" % draw.randrange(9)) if draw.random() < 0.05 else w for w in words]
        out.append((5000 + i, " ".join(own)))
    return out


@pytest.mark.parametrize("most", [20_000, 3])
def test_result_equals_brute_force(spark, most):
    # With groups of at most three, large ones are split all the way.
    pairs = numbered() + overlapping() + edited() + [(8000, "ab" * 400), (8001, "z" * 199), (8002, "z" * 200)]
    assert got(repeats.repeated_bytes(documents(spark, pairs), max_group=most)) == brute(pairs)


def test_very_common_line_with_different_neighbours(spark):
    line = prose(11, 12)[:70]
    pairs = [(i, prose(100 + i, 20) + line + prose(400 + i, 20)) for i in range(60)]
    pairs += [(100 + i, "q" * 80 + line + "r" * 70 + prose(i, 9)) for i in range(4)]
    for most in (20_000, 5):
        assert got(repeats.repeated_bytes(documents(spark, pairs), max_group=most)) == brute(pairs)


def test_long_text_in_pieces(spark, monkeypatch):
    passage = prose(12, 100)
    pairs = [(0, prose(13, 3000) + passage + prose(14, 3000) + passage + prose(15, 10)), (1, prose(16, 500))]
    want = brute(pairs)
    whole = [np.concatenate([p for _, _, p in parts]) for parts in repeats.anchors([t.encode() for _, t in pairs], LENGTH)]
    monkeypatch.setattr(repeats, "BLOCK", 1000)
    parts = [np.concatenate([p for _, _, p in parts]) for parts in repeats.anchors([t.encode() for _, t in pairs], LENGTH)]
    for a, b in zip(whole, parts):
        assert sorted(a.tolist()) == sorted(b.tolist())
    assert got(repeats.repeated_bytes(documents(spark, pairs))) == want


def test_equal_strings_hold_a_common_anchor():
    draw = random.Random(5)
    passage = prose(17, 60).encode()[:LENGTH]
    for _ in range(30):
        a = prose(draw.random(), 30).encode() + passage + prose(draw.random(), 10).encode()
        b = prose(draw.random(), 5).encode() + passage
        found = []
        for text in (a, b):
            at = text.index(passage)
            found.append({(g, p - at) for parts in repeats.anchors([text], LENGTH) for gs, _, ps in parts
                          for g, p in zip(gs.tolist(), ps.tolist()) if 0 <= p - at <= LENGTH - repeats.GRAM})
        assert found[0] & found[1]


def test_intervals_are_those_of_the_tree():
    lcp = np.array([0, 3, 3, 1, 0, 2, 5, 2])
    found = set(repeats.lcp_intervals(lcp))
    assert found == {(3, 0, 2), (1, 0, 3), (5, 5, 6), (2, 4, 7), (0, 0, 7)}


def test_odd_rows_and_empty_table(spark):
    found = repeats.repeated_bytes(frame(spark))
    assert found.count() == len(rows())
    copies = found.where("doc_id = 500").collect()
    assert sorted(r.n_removed for r in copies)[0] == 0
    assert sorted(r.n_removed for r in copies)[1] == sorted(r.n_bytes for r in copies)[1]
    assert repeats.repeated_bytes(frame(spark, [])).count() == 0


def test_spans_and_texts_are_returned(spark):
    pairs = numbered() + overlapping() + [(8000, "ab" * 400), (8001, "z" * 199), (8002, "z" * 200)]
    data, want = {i: (t or "").encode() for i, t in pairs}, brute(pairs)
    found = repeats.repeated_passages(documents(spark, pairs)).collect()
    assert {r.doc_id for r in found} == set(data) and len(found) == len(pairs)
    for r in found:
        at, left = 0, b""
        for s in r.spans:
            assert at <= s.start < s.end
            left, at = left + data[r.doc_id][at:s.start], s.end
        left += data[r.doc_id][at:]
        assert bytes(r.kept) == left
        assert (r.n_bytes, sum(s.end - s.start for s in r.spans), len(r.spans),
                hashlib.sha256(left).hexdigest()) == want[r.doc_id]
    assert any(0 < len(r.kept) < r.n_bytes for r in found)
