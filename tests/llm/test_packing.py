import struct
import zlib
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cases import documents, frame, numbered, prose, rows
from voxmill.llm import packing

tokens = pytest.importorskip("tokenizers")
vocabulary = pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def reference():
    return tokens.Tokenizer.from_file(vocabulary.path("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def encoder():
    return packing.Encoder(vocabulary.path("byte_bpe_50k.tiktoken"), vocabulary.PATTERN)


def ids(encoder, text):
    data = encoder(text)
    return list(struct.unpack(f"<{len(data) // 4}I", data))


@given(text=st.text(alphabet="ab ,.'1é漢\n\t <|endoftext|>", max_size=60))
@settings(max_examples=300, deadline=None)
def test_encoder_equals_the_tokenizer(text):
    ours = packing._encoder(vocabulary.path("byte_bpe_50k.tiktoken"), vocabulary.PATTERN)
    theirs = tokens.Tokenizer.from_file(vocabulary.path("byte_bpe_50k.json")) if not hasattr(
        test_encoder_equals_the_tokenizer, "kept") else test_encoder_equals_the_tokenizer.kept
    test_encoder_equals_the_tokenizer.kept = theirs
    assert ids(ours, text) == theirs.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("text", [
    " a", "a ", "a  b", "a   b", "a\n b", "a \nb", "a \n b", "", " ", "   ", "<|endoftext|>",
    "a <|endoftext|> b", "it's we'll", "x" * 500, "  a", "a　 b"])
def test_encoder_on_white_space(encoder, reference, text):
    assert ids(encoder, text) == reference.encode(text, add_special_tokens=False).ids


def test_placements_equal_brute_force(spark, reference):
    pairs = numbered()
    found = packing.packed_placements(documents(spark, pairs), capacity=256).collect()
    wanted = {}
    for i, t in pairs:
        own = reference.encode(t or "", add_special_tokens=False).ids + [0]
        first = len(own) % 256 or 256
        cuts = [0, *range(first, len(own), 256), len(own)]
        for n, (a, b) in enumerate(zip(cuts, cuts[1:])):
            wanted[i, n] = (a, b - a, zlib.crc32(struct.pack(f"<{b - a}I", *own[a:b])))
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in found} == wanted
    bins = defaultdict(list)
    for r in found:
        bins[r.sequence_id].append((r.offset, r.length))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 256
    assert len(bins) <= -(-sum(v[1] for v in wanted.values()) // 256) + 2


def test_sequences_hold_the_ids(spark, encoder):
    pairs = [(i, prose(i, 20 + i)) for i in range(30)]
    placed = packing.pack(packing.token_pieces(documents(spark, pairs), capacity=128), 128)
    sequences = packing.packed_sequences(placed).collect()
    whole = {i: encoder(t) + b"\0\0\0\0" for i, t in pairs}
    assert sum(r.length for r in sequences) * 4 == sum(map(len, whole.values()))
    for r in sequences:
        assert len(r.ids) == 4 * r.length <= 4 * 128
    short = {i for i, data in whole.items() if len(data) <= 4 * 128}
    for r in sequences:
        if len(r.doc_ids) == 1 and r.doc_ids[0] in short:
            assert bytes(r.ids) == whole[r.doc_ids[0]]


def test_odd_rows_and_empty_table(spark):
    found = packing.packed_placements(frame(spark))
    assert found.select("doc_id").where("doc_id is null").count() == 2
    assert found.where("piece = 0").count() == len(rows())
    assert packing.packed_placements(frame(spark, [])).count() == 0


@given(st.lists(st.integers(1, 50), max_size=200), st.integers(1, 9))
@settings(max_examples=200, deadline=None)
def test_bins_never_overflow(lengths, most):
    bins, filled = packing.OpenBins(50, most), defaultdict(int)
    for n in lengths:
        bin_id, offset = bins.place(n)
        assert offset == filled[bin_id] and offset + n <= 50
        filled[bin_id] += n
        assert bins.open <= most
        assert bins.spaces == sum(1 << f for f, b in enumerate(bins.bins) if b)


def test_fullest_bin_closes_first():
    bins = packing.OpenBins(10, 2)
    assert [bins.place(n) for n in (6, 7, 8)] == [(0, 0), (1, 0), (2, 0)]  # closes the bin of 7
    assert bins.place(3) == (0, 6)
    assert bins.place(2) == (2, 8)


def test_pieces_with_one_id_are_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(packing, "PIECES_PER_TASK", 500)
    pieces = spark.createDataFrame(
        [(None, 0, 1 + i % 40) for i in range(4000)], "doc_id long, piece int, length long")
    placed = packing.pack(pieces, 64).collect()
    tasks = defaultdict(int)
    for r in placed:
        tasks[r.sequence_id >> 32] += 1
    assert len(placed) == 4000 and max(tasks.values()) < 1000
