"""Packing token sequences by bounded-space online best fit."""

from __future__ import annotations

import base64
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxmill.llm.common import quoted, stored, tasks_for

END = "<|endoftext|>"
END_ID = 50256
SEPARATOR = 0
#: Remembered words of a worker; beyond this the memory starts afresh.
MAX_WORDS = 500_000
#: Pieces that one packing task deals with; the number of tasks grows with the input.
PIECES_PER_TASK = 50_000
#: A task packs its share in this many rounds, each from its longest piece to its shortest: with
#: 4,096 open bins hardly any is closed before short pieces have filled it.
ROUNDS = 10


class Encoder:
    """Token ids of a text as little-endian unsigned 32-bit bytes.

    The byte-level vocabulary splits a text before a space that follows no space, so words between
    single spaces are encoded on their own and remembered. Texts with two spaces in a row or with
    the end marker are encoded whole.
    """

    def __init__(self, ranks_file: str, pattern: str):
        import tiktoken

        with open(ranks_file, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self._all = tiktoken.Encoding(
            "byte-bpe", pat_str=pattern, mergeable_ranks=ranks, special_tokens={END: END_ID})
        self._words: dict[str, bytes] = {}

    @staticmethod
    def _pack(ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}I", *ids)

    def _word(self, word: str) -> bytes:
        if len(self._words) >= MAX_WORDS:
            self._words.clear()
        ids = self._words[word] = self._pack(self._all.encode_ordinary(" " + word))
        return ids

    def __call__(self, text: str) -> bytes:
        if "  " in text or END in text:
            return self._pack(self._all.encode(text, allowed_special={END}, disallowed_special=()))
        first, *rest = text.split(" ")
        known, missed = self._words.get, self._word
        return self._pack(self._all.encode_ordinary(first)) + b"".join(
            [known(word) or missed(word) for word in rest])


_ENCODERS: dict[tuple[str, str], Encoder] = {}


def _encoder(ranks_file: str, pattern: str) -> Encoder:
    """One per worker process."""
    if (ranks_file, pattern) not in _ENCODERS:
        _ENCODERS[ranks_file, pattern] = Encoder(ranks_file, pattern)
    return _ENCODERS[ranks_file, pattern]


def token_pieces(
    docs: DataFrame, key: str = "doc_id", text: str = "text", capacity: int = 2048,
    ranks_file: str | None = None, pattern: str | None = None,
) -> DataFrame:
    """(key, piece, start, length, ids): the token ids of each text and one separator id, cut where
    they exceed ``capacity``.

    ``ids`` holds little-endian unsigned 32-bit integers. All pieces but the first are full, so a
    text has as few pieces as possible and one short one at most. A null text counts as empty and
    gives the separator alone; repeated rows are tokenised one by one; an empty table gives an empty
    one; other columns are not read, whatever they are called. The vocabulary is installed on every
    machine; its path is a parameter.
    """
    if ranks_file is None or pattern is None:
        import public_tokenizers

        ranks_file = ranks_file or public_tokenizers.path("byte_bpe_50k.tiktoken")
        pattern = pattern or public_tokenizers.PATTERN
    rows = docs.select(quoted(key).alias("doc_id"), quoted(text).cast("string").alias("text"))
    width, separator = 4 * capacity, struct.pack("<I", SEPARATOR)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(ranks_file, pattern)
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                batch = whole.slice(at, 500)
                row, piece, start, ids = [], [], [], []
                for i, value in enumerate(batch.column(1)):
                    data = encode(value.as_py() or "") + separator
                    first = len(data) % width or width
                    for n, begin in enumerate([0, *range(first, len(data), width)]):
                        row.append(i)
                        piece.append(n)
                        start.append(begin // 4)
                        ids.append(data[begin:(first if n == 0 else begin + width)])
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()), pa.array([len(x) // 4 for x in ids], pa.int64()),
                    pa.array(ids, pa.binary())], ["doc_id", "piece", "start", "length", "ids"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(cut, f"doc_id {kind}, piece int, start long, length long, ids binary")


class OpenBins:
    """A fixed number of open bins. A bit set holds the free spaces that occur, so the tightest bin
    for a piece is the lowest bit from its length on; when all bins are open and none fits, the
    fullest closes."""

    def __init__(self, capacity: int, most: int):
        self.capacity, self.most = capacity, most
        self.spaces = 0
        self.bins: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.open = self.made = 0

    def _take(self, free: int) -> int:
        bins = self.bins[free]
        bin_id = bins.pop()
        if not bins:
            self.spaces ^= 1 << free
        self.open -= 1
        return bin_id

    def place(self, length: int) -> tuple[int, int]:
        """(bin, offset) of a piece."""
        fitting = self.spaces >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            bin_id = self._take(free)
        else:
            if self.open == self.most:
                self._take((self.spaces & -self.spaces).bit_length() - 1)
            free, bin_id = self.capacity, self.made
            self.made += 1
        left = free - length
        if left:
            if not self.bins[left]:
                self.spaces |= 1 << left
            self.bins[left].append(bin_id)
            self.open += 1
        return bin_id, self.capacity - free


def pack(pieces: DataFrame, capacity: int = 2048, open_bins: int = 4096) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``.

    ``pieces`` needs a long ``length`` of 1 to ``capacity`` and the columns doc_id and piece. They
    are dealt to tasks of about PIECES_PER_TASK by a hash of id, piece and place in the table, so copies
    and rows with a null or repeated id are dealt out too, and each task sees a fair draw of lengths;
    a task streams through its share and keeps only the free spaces of its open bins. Pieces come in
    ROUNDS, longest first, in an order that the rows decide, so a repeated task packs alike.
    Pieces are read twice: give a stored table.
    """
    tasks = tasks_for(pieces.count(), PIECES_PER_TASK)
    names = [c for c in pieces.columns if c.lower() not in ("sequence_id", "offset")]
    place_at = names.index("length")

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins, base = OpenBins(capacity, open_bins), TaskContext.get().partitionId() << 32
        for batch in batches:
            placed = [bins.place(n) for n in batch.column(place_at).to_pylist()]
            numbers = np.array(placed, np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(base + numbers[:, 0]), pa.array(numbers[:, 1])],
                [*names, "sequence_id", "offset"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.select(*names).schema)
    row = F.struct(*[quoted(c) for c in names]).alias("_row")
    numbered = pieces.select(row, F.monotonically_increasing_id().alias("_place"))
    doc, piece = F.col("_row.doc_id"), F.col("_row.piece")
    deal, turn = F.xxhash64(doc, piece, "_place"), F.pmod(F.xxhash64("_place", piece, doc), F.lit(ROUNDS))
    return numbered.repartition(tasks, deal).sortWithinPartitions(
        turn, F.desc("_row.length"), doc, piece, "_place").select("_row.*").mapInArrow(fill, f"{fields}, sequence_id long, offset long")


def packed_sequences(placed: DataFrame) -> DataFrame:
    """(sequence_id, length, doc_ids, ids): the sequences themselves, from placed pieces with their
    ``ids``. A group is one sequence, so at most ``capacity`` tokens meet."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "ids")))
    joined = F.aggregate("_parts", F.lit(b""), lambda data, part: F.concat(data, part["ids"]))
    return placed.groupBy("sequence_id").agg(F.sum("length").alias("length"), parts.alias("_parts")).select(
        "sequence_id", "length", F.transform("_parts", lambda p: p["doc_id"]).alias("doc_ids"),
        joined.alias("ids"))


def packed_placements(
    docs: DataFrame, key: str = "doc_id", text: str = "text", capacity: int = 2048, **tokenizer,
) -> DataFrame:
    """Where each piece of each text goes, with ``ids_crc32`` in place of the ids, which need no
    shuffle: only lengths decide. Empty for an empty table."""
    pieces = token_pieces(docs, key, text, capacity, **tokenizer)
    light = stored(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"), "pieces")
    return pack(light, capacity)
