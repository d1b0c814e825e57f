"""Language-model scores from a probabilistic suffix tree over words."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.core.broadcast import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxmill.llm import common
from voxmill.llm.common import discard, quoted, release
from voxmill.llm.words import BLOCK, blocks, hashed_words, mixed
from voxmill.session import new_path, shuffle_parts

#: Longest context in words.
DEPTH = 3
#: Occurrences that an n-gram must have to be a context or one of its next words: what occurs once
#: says nothing about what repeats. All else is decided by the divergence test.
LEAST_COUNT = 2
#: The share of the training tokens that an n-gram must make up besides: none.
LEAST_SHARE = 0.0
#: Taken off each pair's count and given to the shorter context.
DISCOUNT = 0.75
#: Counters that pairs of words are hashed to; a pair can only be frequent if its counter is.
CELLS, CELL_BLOCK = 1 << 20, 1 << 12
#: The most bits of a hash that choose one of the marks.
MARKS = 27
#: Training tokens for each part of a table of n-grams, about; a part is a range of hashes.
PART_TOKENS = 400_000
#: Places that a task counts n-grams of before it passes them on.
HELD = 1 << 21
#: Bytes of text that are hashed at a time, about: what this takes stays in the processor's cache.
HASHED = 1 << 16
#: Bytes of text that are scored together: the more, the fewer n-grams are looked up twice.
SCORED = 8 * BLOCK
#: Rounds in which blocks are scored, so that only one round's lookups are on disk, and blocks that
#: a round has at least.
ROUNDS, ROUND_BLOCKS = 4, 4
#: Tables of counters added up in one step.
FAN = 256

#: How tables of packed numbers are written: hashes do not repeat, so no dictionary is sought.
PACKED = {"compression": "zstd", "parquet.compression.codec.zstd.level": "1", "parquet.enable.dictionary": "false"}

START, END = np.uint64(0x51AB7), np.uint64(0xE2D)
_FACTORS = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)]


def stored(df: DataFrame, name: str) -> DataFrame:
    """A stored table in few bytes: several are on disk at a time."""
    return common.stored(df, name, **(PACKED if "part" in df.columns else {"compression": "zstd"}))


def bucketed(df: DataFrame, name: str, bits: int) -> DataFrame:
    """A stored table whose files are dealt by ``part``, as a shuffle would deal them, so that work on
    its parts reads them where they are. The session's catalog knows its name until ``dropped``."""
    spark = df.sparkSession
    path = new_path(spark, name)
    table = path.rsplit("/", 1)[1].replace("-", "_")
    df.write.format("parquet").options(path=path, **PACKED).bucketBy(
        min(shuffle_parts(spark), 1 << bits), "part").saveAsTable(table)
    return spark.table(table)


def dropped(table: DataFrame) -> None:
    """Delete a ``bucketed`` table that only stored tables were made from."""
    files = table.inputFiles()[:1]
    discard(table)
    for file in files:
        table.sparkSession.sql(f"DROP TABLE IF EXISTS `{file.rsplit('/', 2)[1].replace('-', '_')}`")


def token_stream(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Start, words and end of each text as hashes, and where each text begins (and the end)."""
    cuts = np.flatnonzero(np.diff(np.cumsum([len(t) for t in texts]) // HASHED, prepend=-1)).tolist()
    found = [hashed_words(texts[i:j]) for i, j in zip(cuts, [*cuts[1:], len(texts)])] or [hashed_words([])]
    words = np.concatenate([w for w, _ in found])
    sizes = np.concatenate([np.diff(at) for _, at in found]) + 2
    begins = np.concatenate([[0], np.cumsum(sizes)])
    out = np.empty(begins[-1], np.uint64)
    inside = np.ones(len(out), bool)
    inside[begins[:-1]] = inside[begins[1:] - 1] = False
    out[inside] = words
    out[begins[:-1]], out[begins[1:] - 1] = START, END
    return out, begins


def grams(tokens: np.ndarray, n: int) -> np.ndarray:
    """For each place, a hash of the n tokens that end there (0 before there are n), made from the
    hashes of all but the last and of all but the first."""
    if n == 1:
        return tokens
    shorter = grams(tokens, n - 1)
    out = _gram(_before(shorter), shorter, n)
    out[:n - 1] = 0
    return out


def _gram(context: np.ndarray, tail: np.ndarray, n: int) -> np.ndarray:
    return mixed(context * _FACTORS[0] + tail * _FACTORS[1] + np.uint64(n))


def _before(values: np.ndarray) -> np.ndarray:
    """The value of the place before."""
    return np.concatenate([np.zeros(1, values.dtype), values[:-1]])


def _depths(begins: np.ndarray) -> np.ndarray:
    """Each place's number of tokens before it in its text."""
    return np.arange(begins[-1]) - np.repeat(begins[:-1], np.diff(begins))


def _cell(pairs: np.ndarray) -> np.ndarray:
    return (pairs >> np.uint64(44)).astype(np.int64)


class HashTable:
    """Sorted hashes with values; a table of their upper bits answers most misses at once."""

    def __init__(self, hashes: np.ndarray, *values: np.ndarray):
        order = np.argsort(hashes)
        self.hashes, self.values = hashes[order], [v[order] for v in values]
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[_cell(hashes)] = True

    def find(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The places of ``wanted`` that the table holds, and where it holds them."""
        places = np.flatnonzero(self.maybe[_cell(wanted)])
        if not len(self.hashes) or not len(places):
            return places[:0], places[:0]
        at = np.minimum(np.searchsorted(self.hashes, wanted[places]), len(self.hashes) - 1)
        there = self.hashes[at] == wanted[places]
        return places[there], at[there]


@dataclass
class SuffixTree:
    """For each context length from 1, the retained contexts with the share they leave to shorter
    ones, and the shares of their next words: the part of the model that a block of texts needs."""

    contexts: list[HashTable] = field(default_factory=list)
    pairs: list[HashTable] = field(default_factory=list)

    def raise_chances(self, tokens: np.ndarray, depths: np.ndarray, chance: np.ndarray) -> np.ndarray:
        """Chances of all tokens without context, raised step by step to those after the longest
        retained context: own share + share left * the shorter context's chance."""
        for n, (contexts, pairs) in enumerate(zip(self.contexts, self.pairs, strict=True), 2):
            places, at = contexts.find(_before(grams(tokens, n - 1)))
            near = depths[places] >= n - 1
            places, at = places[near], at[near]
            both = grams(tokens, n)[places]
            hit, where = pairs.find(both)
            _raise(chance, places, contexts.values[0][at], places[hit], pairs.values[0][where])
        return chance


def _raise(chance: np.ndarray, places: np.ndarray, leaves: np.ndarray, hit: np.ndarray, own: np.ndarray) -> None:
    """One step to a longer context: what it leaves at the places that have one, and shares of words."""
    chance[places] *= leaves
    chance[hit] += own


def _order(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order that sorts hashes, and the sorted hashes. Their upper bits are sorted with the place in
    the lower ones, which is faster than an argsort; what only these bits tell apart is put right after."""
    low = np.uint64((1 << len(hashes).bit_length()) - 1)
    keys = np.sort((hashes & ~low) | np.arange(len(hashes), dtype=np.uint64))
    order = (keys & low).astype(np.int64)
    out = hashes[order]
    if (out[1:] < out[:-1]).any():
        order = order[np.argsort(out, kind="stable")]
        out = hashes[order]
    return order, out


def _first(values: np.ndarray) -> np.ndarray:
    """Which of sorted values differ from the one before."""
    out = np.ones(len(values), bool)
    np.not_equal(values[1:], values[:-1], out=out[1:])
    return out


def _numbered(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different hashes, sorted, and for each of ``hashes`` its place there."""
    order, out = _order(hashes)
    first = _first(out)
    places = np.empty(len(out), np.int64)
    places[order] = np.cumsum(first) - 1
    return out[first], places


def _distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different values, sorted, and how often each occurs."""
    values = np.sort(values)
    first = np.flatnonzero(_first(values))
    return values[first], np.diff(np.append(first, len(values)))


def _counted(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Per block of a batch whose first column marks training texts: the place of its first text, its
    tokens, where texts begin, and which tokens are training tokens. A batch of blocks (``_in_blocks``)
    has its words found already."""
    if "vocab" in batch.schema.names:
        for i in range(batch.num_rows):
            tokens, begins, train = _block(batch.slice(i, 1))
            yield i, tokens, begins, np.repeat(train, np.diff(begins))
        return
    train = batch.column(0).to_numpy(zero_copy_only=False).astype(bool)
    for start, texts in blocks(batch.column(column)):
        tokens, begins = token_stream(texts)
        yield start, tokens, begins, np.repeat(train[start:start + len(texts)], np.diff(begins))


def count_words(rows: DataFrame) -> tuple[DataFrame, np.ndarray]:
    """From (train, text): the table (h, n_train, n_all) of all words and ends, and the counters of
    the training pairs. Words are counted in parts of HELD before the shuffle; a task has one set of
    counters, and sets are added up in groups of FAN."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["h", "n_train", "n_all", "cells"]
        cells = np.zeros(CELLS, np.int64)
        held, size = [], 0

        def emptied() -> pa.RecordBatch:
            values, total = _distinct(np.concatenate([tokens for tokens, _, _ in held]))
            own, sums = _distinct(np.concatenate([tokens[own] for tokens, own, _ in held]))
            trained = np.zeros(len(values), np.int64)
            trained[np.searchsorted(values, own)] = sums
            np.add(cells, np.bincount(_cell(np.concatenate([pairs for _, _, pairs in held])), minlength=CELLS), out=cells)
            return pa.RecordBatch.from_arrays(
                [pa.array(values.view(np.int64)), pa.array(trained), pa.array(total), pa.nulls(len(values), pa.binary())], names)

        for batch in batches:
            for _, tokens, begins, own in _counted(batch, 1):
                deep = _depths(begins) > 0
                held.append((tokens[deep], own[deep], grams(tokens, 2)[deep & own]))
                size += len(tokens)
                if size > HELD:
                    yield emptied()
                    held, size = [], 0
        if held:
            yield emptied()
        parts = cells.reshape(-1, CELL_BLOCK)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(parts))), pa.nulls(len(parts), pa.int64()), pa.nulls(len(parts), pa.int64()),
             pa.array([_planes(p) for p in parts], pa.binary())], names)

    counted = stored(rows.mapInArrow(count, "h long, n_train long, n_all long, cells binary"), "counts")
    words = counted.where("cells is null").groupBy("h").agg(
        F.sum("n_train").alias("n_train"), F.sum("n_all").alias("n_all"))
    tables = counted.where("cells is not null").select(F.col("h").alias("block"), "cells")
    left = tables.count() // (CELLS // CELL_BLOCK)
    while left > 1:
        left = -(-left // FAN)
        tables = stored(tables.withColumn("part", F.pmod(F.monotonically_increasing_id(), F.lit(left))).groupBy(
            "block", "part").applyInArrow(_add, "block long, cells binary"), "counters")
    whole = np.zeros((CELLS // CELL_BLOCK, CELL_BLOCK), np.int64)
    for row in tables.toLocalIterator():
        whole[row["block"]] += _numbers(row["cells"])
    return words, whole.reshape(-1)


def _planes(numbers: np.ndarray) -> bytes:
    """Numbers with all their lowest bytes first, then the next: long runs of zeros, which compress."""
    return numbers.astype("<i8").view(np.uint8).reshape(-1, 8).T.tobytes()


def _numbers(planes: bytes) -> np.ndarray:
    return np.frombuffer(planes, np.uint8).reshape(8, -1).T.copy().view("<i8").reshape(-1)


def _add(group: pa.Table) -> pa.Table:
    total = sum(_numbers(c) for c in group.column("cells").to_pylist())
    return pa.table({"block": group.column("block")[:1], "cells": pa.array([_planes(total)], pa.binary())})


def _parts(hashes: np.ndarray, bits: int) -> np.ndarray:
    """The part of each hash: its upper bits."""
    return (hashes >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(hashes), np.int64)


def _packed(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """The values between the bounds as bytes, one row each."""
    return pa.BinaryArray.from_buffers(pa.binary(), len(bounds) - 1, [
        None, pa.py_buffer((bounds * values.itemsize).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(values))])


def _row(*columns: np.ndarray) -> list[pa.Array]:
    return [_packed(c, np.array([0, len(c)])) for c in columns]


def _read(column: pa.ChunkedArray | pa.Array, kind: type = np.uint64) -> np.ndarray:
    """The values of all rows, one row after the other; not copied if they lie together."""
    found = []
    for chunk in column.chunks if isinstance(column, pa.ChunkedArray) else [column]:
        at, data = _offsets(chunk), chunk.buffers()[2] if len(chunk) else None
        if data is not None:
            found.append(np.frombuffer(data, np.uint8)[at[0]:at[-1]].view(kind))
    return found[0] if len(found) == 1 else np.concatenate(found) if found else np.zeros(0, kind)


def _offsets(chunk: pa.Array) -> np.ndarray:
    """Where the bytes of each row begin (and the end)."""
    if not len(chunk):
        return np.zeros(1, np.int64)
    kind = np.int64 if pa.types.is_large_binary(chunk.type) else np.int32
    return np.frombuffer(chunk.buffers()[1], kind)[chunk.offset:chunk.offset + len(chunk) + 1]


def _lengths(column: pa.ChunkedArray) -> np.ndarray:
    """How many 8-byte values each row has."""
    return np.concatenate([np.zeros(0, np.int64), *[np.diff(_offsets(c)) // 8 for c in column.chunks]])


def _short(numbers: np.ndarray, bounds: np.ndarray) -> list[pa.Array]:
    """Counts between the bounds, mostly small: a byte each, and the larger ones besides."""
    large = numbers >= 255
    return [_packed(np.minimum(numbers, 255).astype(np.uint8), bounds),
            _packed(numbers[large], np.append(0, np.cumsum(large))[bounds])]


def _long(short: pa.ChunkedArray, large: pa.ChunkedArray) -> np.ndarray:
    """The counts that ``_short`` has packed."""
    out = _read(short, np.uint8).astype(np.int64)
    out[out == 255] = _read(large, np.int64)
    return out


def _dealt(hashes: np.ndarray, bits: int, *columns: np.ndarray) -> list[pa.Array]:
    """The parts that the hashes fall into, and per part the hashes and the columns' values."""
    part = _parts(hashes, bits)
    order = np.argsort(part.astype(np.uint16) if bits <= 16 else part, kind="stable")
    part = part[order]
    first = np.flatnonzero(np.diff(part, prepend=-1))
    bounds = np.append(first, len(part))
    return [pa.array(part[first]), *[_packed(c[order], bounds) for c in (hashes, *columns)]]


def _find(table: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of ``wanted`` a sorted table holds, and the places there."""
    if not len(table):
        return np.zeros(len(wanted), bool), np.zeros(len(wanted), np.int64)
    at = np.minimum(np.searchsorted(table, wanted), len(table) - 1)
    return table[at] == wanted, at


def _sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values, first) if len(first) else values[:0]


def _each(table: DataFrame, work, schema: str) -> DataFrame:
    """``work`` on every row (as a batch of one) of a table whose rows are parts."""
    names = [c.strip().split(" ")[0] for c in schema.split(",")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                if (out := work(batch.slice(i, 1))) is not None:
                    yield pa.RecordBatch.from_arrays(out, names)

    return table.mapInArrow(run, schema)


def _marks(table: DataFrame, bits: int, marks: int, only: str | None = None) -> np.ndarray:
    """Bits, 2 ** ``marks`` of them, that are set for the column ``gram`` of a table of parts, where the
    numbers in the column ``only`` are above 0. A gram whose bit is not set is not in the table; the
    others are looked up, so the marks save work and decide nothing. A part has its own range of them."""
    size = 1 << (marks - bits)

    def mark(rows: pa.Table) -> pa.Table:
        gram = _read(rows.column("gram"))
        if only:
            gram = gram[_read(rows.column(only), np.int64) > 0]
        own = np.zeros(size, bool)
        own[(gram >> np.uint64(64 - marks)).astype(np.int64) & (size - 1)] = True
        return pa.table({"part": rows.column("part")[:1],
                         "marks": pa.array([np.packbits(own, bitorder="little").tobytes()], pa.binary())})

    out = np.zeros((1 << bits, size >> 3), np.uint8)
    for row in table.select("part", "gram", *[only] * bool(only)).groupBy("part").applyInArrow(
            mark, "part long, marks binary").toLocalIterator():
        out[row["part"]] = np.frombuffer(row["marks"], np.uint8)
    return out.reshape(-1)


def _marked(marks: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = (hashes >> np.uint64(64 - (len(marks) * 8).bit_length() + 1)).astype(np.int64)
    return (marks[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def _counted_grams(gram: np.ndarray, context: np.ndarray, tail: np.ndarray, sums: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """Different n-grams, sorted, with their context, tail and summed counts, or how often they occur."""
    order, gram = _order(gram)
    first = np.flatnonzero(_first(gram))
    at = order[first]
    counts = np.diff(np.append(first, len(gram))) if sums is None else _sums(sums[order], first)
    return gram[first], context[at], tail[at], counts


def _frequent_grams(rows: DataFrame, n: int, least: float, likely, bits: int) -> DataFrame:
    """(part, gram, context, tail, n): the n-grams with at least ``least`` training occurrences, with
    the hashes of all but the last word and of all but the first, a row of sorted numbers for each
    part. ``likely`` says which n-grams can be that frequent, from these three hashes of each place of a
    block, in order; the others are not counted. A task sums its own before the shuffle, so a part gets a frequent one once a task."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def emptied() -> pa.RecordBatch:
            gram, context, tail, sums = _counted_grams(*(np.concatenate(x) for x in zip(*held, strict=True)))
            # They are sorted, so those of a part lie together.
            part = _parts(gram, bits)
            first = np.flatnonzero(np.diff(part, prepend=-1))
            bounds = np.append(first, len(part))
            return pa.RecordBatch.from_arrays(
                [pa.array(part[first]), _packed(context, bounds), _packed(tail, bounds), *_short(sums, bounds)],
                ["part", "context", "tail", "n", "large"])

        for batch in batches:
            for _, tokens, begins, own in _counted(batch, 1):
                tail = grams(tokens, n - 1)
                context = _before(tail)
                whole = _gram(context, tail, n)
                places = np.flatnonzero(own & (_depths(begins) >= n - 1) & likely(whole, context, tail))
                held.append((whole[places], context[places], tail[places]))
                size += len(places)
                if size > HELD:
                    yield emptied()
                    held, size = [], 0
        if size:
            yield emptied()

    def total(found: pa.Table) -> pa.Table:
        context, tail = _read(found.column("context")), _read(found.column("tail"))
        gram, context, tail, sums = _counted_grams(
            _gram(context, tail, n), context, tail, _long(found.column("n"), found.column("large")))
        often = sums >= least
        return pa.table([found.column("part")[:1], *_row(gram[often], context[often], tail[often], sums[often])],
                        ["part", "gram", "context", "tail", "n"])

    return rows.mapInArrow(
        count, "part long, context binary, tail binary, n binary, large binary").groupBy("part").applyInArrow(
        total, "part long, gram binary, context binary, tail binary, n binary")


def _in_order(told: pa.Table) -> pa.Table:
    """What the parts answered, in the order of what they were asked for: sorted hashes."""
    return told.sort_by("part")


def _with_below(found: DataFrame, known: DataFrame, n: int, bits: int) -> DataFrame:
    """(part, gram, context, n, below): n-grams with the chance of their tail, those whose tail is
    known. A part asks for each tail once, however many of its n-grams share it, and gets a number for
    each, so no hash comes back."""
    def ask(row: pa.RecordBatch) -> list[pa.Array]:
        parts, tails = _dealt(_distinct(_read(row.column("tail")))[0], bits)
        return [pa.array(np.full(len(parts), row.column("part")[0].as_py())), parts, tails]

    def answer(asked: pa.Table, own: pa.Table) -> pa.Table:
        wanted, bounds = _read(asked.column("tail")), np.append(0, np.cumsum(_lengths(asked.column("tail"))))
        there, at = _find(_read(own.column("gram")), wanted)
        below = np.full(len(wanted), np.nan)
        below[there] = _read(own.column("chance"), np.float64)[at[there]]
        return pa.table([asked.column("unit"), asked.column("part"), _packed(below, bounds)], ["unit", "part", "below"])

    def add(row: pa.Table, told: pa.Table) -> pa.Table:
        context, tail = _read(row.column("context")), _read(row.column("tail"))
        below = _read(_in_order(told).column("below"), np.float64)[_numbered(tail)[1]]
        there = below == below
        context, tail, below = context[there], tail[there], below[there]
        return pa.table([row.column("part"), *_row(
            _gram(context, tail, n), context, _read(row.column("n"), np.int64)[there], below)][:5]
                        if row.num_rows else [pa.array([], pa.int64())] + [pa.array([], pa.binary())] * 4,
                        ["part", "gram", "context", "n", "below"])

    told = _each(found.select("part", "tail"), ask, "unit long, part long, tail binary").groupBy("part").cogroup(
        known.select("part", "gram", "chance").groupBy("part")).applyInArrow(
        answer, "unit long, part long, below binary")
    return found.groupBy("part").cogroup(told.groupBy("unit")).applyInArrow(
        add, "part long, gram binary, context binary, n binary, below binary")


def _kept_contexts(level: DataFrame, known: DataFrame, tokens: int, bits: int) -> DataFrame:
    """(unit, part, gram, n, size, kinds, leaves): for each part ``unit`` of the level, of all contexts
    it has n-grams after, in order, the count and what they leave (not a number if they do not tell
    their next words apart); and with unit -1 what the model has of the part: n-grams that are contexts
    or are after one, with their counts and those of the next words. Parts of the level send a
    context's sums, not its next words."""
    names = ["sum", "below", "kinds", "gain"]

    def ask(row: pa.RecordBatch) -> list[pa.Array]:
        n, below = _read(row.column("n"), np.int64).astype(float), _read(row.column("below"), np.float64)
        contexts, inverse = _numbered(_read(row.column("context")))
        sums = [np.bincount(inverse, w, len(contexts)) for w in (n, below, np.ones(len(n)), n * np.log(n / below))]
        parts, *columns = _dealt(contexts, bits, *sums)
        return [pa.array(np.full(len(parts), row.column("part")[0].as_py())), parts, *columns]

    def decide(asked: pa.Table, own: pa.Table) -> pa.Table:
        sent = _read(asked.column("gram"))
        contexts, inverse = _numbered(sent)
        size, below, kinds, gain = (
            np.bincount(inverse, _read(asked.column(c), np.float64), len(contexts)) for c in names)
        grams, numbers = _read(own.column("gram")), _read(own.column("n"), np.int64)
        there, at = _find(grams, contexts)
        total = np.where(there, numbers[at], 1) if len(numbers) else np.ones(len(contexts), np.int64)
        rest = np.maximum(total - size, 0.0)
        gain = gain - size * np.log(total) + np.where(rest > 0, rest * np.log(
            np.maximum(rest / total, 1e-12) / np.maximum(1 - below, 1e-12)), 0.0)
        kept = there & (gain > 0.5 * kinds * float(np.log(max(tokens, 2))) + 2)
        leaves = np.where(kept, _leaves(size, kinds, total), np.nan)
        bounds = np.append(0, np.cumsum(_lengths(asked.column("gram"))))
        nothing = [_packed(grams[:0], np.zeros(len(bounds), np.int64))] * 3
        part = (asked if asked.num_rows else own).column("part")[0].as_py()
        told = pa.table([asked.column("unit"), asked.column("part"), nothing[0], _packed(total[inverse], bounds),
                         *nothing[1:], _packed(leaves[inverse], bounds)], columns)
        sums = np.zeros((2, len(grams)), np.int64)
        sums[:, at[kept]] = size[kept], kinds[kept]
        whole = _read(own.column("own"), bool) | (sums[1] > 0)
        model = pa.table([pa.array([-1], pa.int64()), pa.array([part], pa.int64()),
                          *_row(grams[whole], numbers[whole], *sums[:, whole], leaves[:0])], columns)
        return pa.concat_tables([told, model])

    columns = ["unit", "part", "gram", "n", "size", "kinds", "leaves"]
    sent = _each(level, ask, "unit long, part long, gram binary, sum binary, below binary, kinds binary, gain binary")
    return sent.groupBy("part").cogroup(known.select("part", "gram", "n", "own").groupBy("part")).applyInArrow(
        decide, "unit long, part long, gram binary, n binary, size binary, kinds binary, leaves binary")


def _leaves(size: np.ndarray, kinds: np.ndarray, total: np.ndarray) -> np.ndarray:
    """What contexts leave to the shorter ones, from the counts of their next words and how many differ."""
    return 1 - (size - DISCOUNT * kinds) / total


def _known(level: DataFrame, kept: DataFrame) -> DataFrame:
    """(part, gram, n, own, chance): the n-grams of a level, whether they have a share of their own (are
    after a kept context), and their chance."""
    def add(row: pa.Table, told: pa.Table) -> pa.Table:
        if not row.num_rows:
            return pa.table([pa.array([], pa.int64())] + [pa.array([], pa.binary())] * 4, names)
        told, inverse = _in_order(told), _numbered(_read(row.column("context")))[1]
        n, chance = _read(row.column("n"), np.int64), _read(row.column("below"), np.float64).copy()
        leaves = _read(told.column("leaves"), np.float64)[inverse]
        own = leaves == leaves
        total = _read(told.column("n"), np.int64)[inverse][own]
        chance[own] = (n[own] - DISCOUNT) / total + leaves[own] * chance[own]
        return pa.table([row.column("part"), *_row(_read(row.column("gram")), n, own, chance)], names)

    names = ["part", "gram", "n", "own", "chance"]
    return level.groupBy("part").cogroup(kept.where("unit >= 0").select("unit", "part", "n", "leaves").groupBy(
        "unit")).applyInArrow(add, "part long, gram binary, n binary, own binary, chance binary")


def _known_words(words: DataFrame, texts: int, whole: int, bits: int) -> DataFrame:
    """The same of the training words, with the start as often as there are texts; chances are shares
    of ``whole``."""
    shift = F.shiftrightunsigned("gram", 64 - bits) if bits else F.lit(0).cast("long")
    start = words.sparkSession.range(1).select(
        F.lit(int(START)).cast("long").alias("gram"), F.lit(texts).cast("long").alias("n"))
    rows = words.where("n_train > 0").select(F.col("h").alias("gram"), F.col("n_train").alias("n")).unionByName(start)

    def sort(rows: pa.Table) -> pa.Table:
        gram, n = rows.column("gram").to_numpy().view(np.uint64), rows.column("n").to_numpy()
        order = np.argsort(gram)
        n = n[order]
        return pa.table([rows.column("part")[:1], *_row(gram[order], n, np.ones(len(n), bool), n / whole)],
                        ["part", "gram", "n", "own", "chance"])

    return rows.withColumn("part", shift).groupBy("part").applyInArrow(
        sort, "part long, gram binary, n binary, own binary, chance binary")


_MODEL = "part long, gram binary, n binary, size binary, kinds binary"


def _merged(rows: pa.Table) -> pa.Table:
    """A part of the model in one row, sorted."""
    gram, *numbers = (_read(rows.column(c), k) for c, k in (
        ("gram", np.uint64), ("n", np.int64), ("size", np.int64), ("kinds", np.int64)))
    order = np.argsort(gram)
    return pa.table([rows.column("part")[:1], *_row(gram[order], *[x[order] for x in numbers])],
                    ["part", "gram", "n", "size", "kinds"])


def grow_tree(rows: DataFrame, cells: np.ndarray, words: DataFrame, texts: int, tokens: int, whole: int) -> tuple[DataFrame, int, int]:
    """(part, gram, n, size, kinds): the tree of the contexts that tell their next words apart from the
    shorter context's (for them, all occurrences and how many different of the next words that they
    give shares to), their next words, and all training words, each with its count; with the bits that
    number the parts and those that choose marks. What a context leaves and a word's share follow from
    these whole numbers.

    Level by level, n-grams are counted exactly; a pair whose hashed counter is too low is left out
    before, and a longer n-gram unless both its shorter ones are marked. A context is retained if the
    divergence of its next words from the shorter context's, times its count, exceeds what its
    parameters cost. Every level is a stored table, a row of sorted numbers for each range of hashes;
    there are as many ranges as the tokens need, so the tree grows with the input and no process holds
    it. Parts ask each other for the shorter context's chances and for their own contexts, each once,
    so a frequent word's rows never meet. ``whole``: of which a word's count is its chance.
    """
    least, spark = max(float(LEAST_COUNT), LEAST_SHARE * tokens), rows.sparkSession
    bits = max(0, tokens // PART_TOKENS).bit_length()
    marks = max(bits + 3, min(MARKS, max(16, (2 * tokens).bit_length())))
    known = bucketed(_known_words(words, texts, whole, bits), "known-1", bits)

    def last(row: pa.RecordBatch) -> list[pa.Array]:
        own = _read(row.column("own"), bool)
        gram, n = _read(row.column("gram"))[own], _read(row.column("n"), np.int64)[own]
        return [row.column("part"), *_row(gram, n, np.zeros_like(n), np.zeros_like(n))]

    model = []
    enough = cells >= least
    likely = lambda whole, context, tail: enough[_cell(whole)]
    for n in range(2, DEPTH + 2):
        found = bucketed(_frequent_grams(rows, n, least, likely, bits).drop("gram"), f"grams-{n}", bits)
        if n > 2:
            bitmap.destroy()
        release(spark)
        level = bucketed(_with_below(found, known, n, bits), f"level-{n}", bits)
        dropped(found)
        release(spark)
        kept = stored(_kept_contexts(level, known, tokens, bits), f"contexts-{n}")
        dropped(known)
        known = bucketed(_known(level, kept), f"known-{n}", bits)
        dropped(level)
        model.append(stored(kept.where("unit < 0").select("part", "gram", "n", "size", "kinds"), f"model-{n - 1}"))
        discard(kept)
        release(spark)
        if n <= DEPTH:
            bitmap = spark.sparkContext.broadcast(_marks(known, bits, marks))

            def likely(whole: np.ndarray, context: np.ndarray, tail: np.ndarray, m: Broadcast = bitmap) -> np.ndarray:
                known = _marked(m.value, tail)
                return known & _before(known)  # a place's context is the tail of the place before

    model.append(stored(_each(known, last, _MODEL), f"model-{DEPTH + 1}"))
    dropped(known)
    whole = model[0]
    for part in model[1:]:
        whole = whole.unionByName(part)
    out = bucketed(whole.groupBy("part").applyInArrow(_merged, _MODEL), "model", bits)
    for part in model:
        discard(part)
    release(spark)
    return out, bits, marks


def _in_blocks(rows: DataFrame) -> DataFrame:
    """``rows`` (train, _id, _text) in blocks of about SCORED bytes of text, a row each, dealt to ROUNDS
    turns: the ids, which texts train, where their tokens begin (and the end), the different tokens'
    hashes, sorted, and for each token its place there. So texts are read and hashed once."""
    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, done = TaskContext.get().partitionId(), 0
        for batch in batches:
            for at, texts in blocks(batch.column(2), SCORED):
                part = batch.slice(at, len(texts))
                tokens, begins = token_stream(texts)
                vocab, places = _numbered(tokens)
                train = part.column(0).to_numpy(zero_copy_only=False).astype(bool)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([(task << 32) + done]), pa.array([(task + done) % turns], pa.int32()),
                     pa.ListArray.from_arrays(pa.array([0, len(texts)], pa.int32()), part.column(1)),
                     *_row(train, begins, vocab, places.astype(np.int32))],
                    ["block", "turn", "ids", "train", "begins", "vocab", "places"])
                done += 1

    turns, kind = ROUNDS, rows.schema["_id"].dataType.simpleString()
    return rows.mapInArrow(number, f"block long, turn int, ids array<{kind}>, train binary, begins binary, "
                           "vocab binary, places binary")


def _block(row: pa.RecordBatch | pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens, where texts begin (and the end), and which texts train, of one block."""
    return (_read(row.column("vocab"))[_read(row.column("places"), np.int32)], _read(row.column("begins"), np.int64),
            _read(row.column("train"), bool))


def _looked_up(tokens: np.ndarray, depths: np.ndarray, context: np.ndarray, marks: tuple[np.ndarray, np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For n from 2, the places whose n-grams a block asks for, and these: those marked as contexts, or
    as n-grams after what is marked as a context. ``context``: the tokens that are so marked; ``marks``:
    of all n-grams of the model, and of contexts. The longest n-grams are no contexts."""
    every, contexts = marks
    shorter = tokens
    for n in range(2, DEPTH + 2):
        whole = _gram(_before(shorter), shorter, n)
        after, deep = _before(context), depths >= n - 1
        places = np.flatnonzero(deep if n <= DEPTH else deep & after)
        grams = whole[places]
        there = _marked(every, grams)
        places, grams = places[there], grams[there]
        if n <= DEPTH:
            marked = _marked(contexts, grams)
            context = np.zeros(len(tokens), bool)
            context[places] = marked
            there = marked | after[places]
            places, grams = places[there], grams[there]
        yield places, grams
        shorter = whole


def _wanted(rows: DataFrame, marks: Broadcast, bits: int) -> DataFrame:
    """(block, part, gram): what each block asks the parts of the model for, each n-gram once, however
    often it occurs: its words, and what ``_looked_up`` finds."""
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                tokens, begins, _ = _block(row)
                vocab, spots = _read(row.column("vocab")), _read(row.column("places"), np.int32)
                context = _marked(marks.value[1], vocab)[spots]
                asked = [_distinct(whole)[0] for _, whole in _looked_up(tokens, _depths(begins), context, marks.value)]
                parts, keys = _dealt(np.concatenate([vocab, *asked]), bits)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(parts), row.column("block")[0].as_py())), parts, keys], ["block", "part", "gram"])

    return rows.select("block", "train", "begins", "vocab", "places").mapInArrow(
        ask, "block long, part long, gram binary")


def _answered(wanted: DataFrame, model: DataFrame) -> DataFrame:
    """(block, part, numbers, large): three counts, as the model has them, for each n-gram that a block
    asks a part for, zeros if it is not there."""
    def answer(asked: pa.Table, own: pa.Table) -> pa.Table:
        keys, bounds = _read(asked.column("gram")), np.append(0, np.cumsum(_lengths(asked.column("gram"))))
        there, at = _find(_read(own.column("gram")), keys)
        at, numbers = at[there], np.zeros((len(keys), 3), np.int64)
        for i, c in enumerate(("n", "size", "kinds")):
            numbers[there, i] = _read(own.column(c), np.int64)[at]
        return pa.table([asked.column("block"), asked.column("part"), *_short(numbers.reshape(-1), bounds * 3)],
                        ["block", "part", "numbers", "large"])

    return wanted.groupBy("part").cogroup(model.groupBy("part")).applyInArrow(
        answer, "block long, part long, numbers binary, large binary")


def _chances(row: pa.Table, told: pa.Table, marks: tuple[np.ndarray, np.ndarray], bits: int, base: float,
             spare: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The counts and the chances of a block's tokens, and how deep each is in its text, from what the
    parts answered: without context, then raised level by level as by ``SuffixTree``."""
    tokens, begins, _ = _block(row)
    told, depths = _in_order(told), _depths(begins)
    vocab, spots = _read(row.column("vocab")), _read(row.column("places"), np.int32)
    levels = [(places, *_numbered(whole)) for places, whole in _looked_up(
        tokens, depths, _marked(marks[1], vocab)[spots], marks)]
    keys = _parts(np.concatenate([vocab, *[own for _, own, _ in levels]]), bits)
    numbers = np.empty((len(keys), 3), np.int64)
    numbers[np.argsort(keys, kind="stable")] = _long(told.column("numbers"), told.column("large")).reshape(-1, 3)
    own, at = numbers[:len(vocab)], len(vocab)
    c = own[:, 0].astype(float)[spots]
    chance = np.where(c > 0, c, spare) / base
    context = own[:, 2] > 0
    # Of the shorter n-gram at each place: where it is among those asked for, if it is a context.
    before = np.where(context[spots], spots, -1)
    for n, (places, values, inverse) in enumerate(levels, 2):
        leaves = np.where(context, _leaves(own[:, 1], own[:, 2], np.maximum(own[:, 0], 1)), np.nan)
        total, last = own[:, 0], _before(before)
        raised = np.flatnonzero((last >= 0) & (depths >= n - 1))
        own = numbers[at:at + len(values)]
        at += len(values)
        counts = own[:, 0][inverse]
        hit = (last[places] >= 0) & (counts > 0)
        _raise(chance, raised, leaves[last[raised]], places[hit], (counts[hit] - DISCOUNT) / total[last[places[hit]]])
        context, before = own[:, 2] > 0, np.full(len(tokens), -1)
        before[places] = np.where(context[inverse], inverse, -1)
    return c, chance, depths


def score(docs: DataFrame, key: str = "doc_id", text: str = "text", train: Column | None = None) -> DataFrame:
    """(key, train, n_tokens, n_known, train_tokens, base_score, score) of every row of ``docs``.

    Tokens are the words (other than ASCII white space, A-Z lowered) and one end; words are told
    apart by 64-bit hashes. ``train`` marks the rows to learn from. ``base_score`` adds
    log10((c + 0.1) / (N + 0.1 * (V + 1))). ``score`` adds the log10 chances of the tokens after
    their longest retained context. Without context a token has c / (N + m), and all unseen words
    together, which are one symbol as in the base, m / (N + m), m being how many words were seen
    once; a context's chances are its discounted shares plus what they leave times the shorter
    context's, so at each place the chances add up to 1.

    Texts are scored in blocks of about SCORED bytes (a longer one alone): the different n-grams of a
    block are looked up in the parts of the stored model, and what is found comes back to the block. A null text
    counts as empty and has the end alone; repeated rows are scored one by one; without training
    rows both scores are 0 for unseen words; an empty table gives an empty one; other columns are not
    read, whatever they are called.
    """
    train = F.lit(True) if train is None else F.coalesce(train, F.lit(False))
    spark = docs.sparkSession
    cut = _in_blocks(docs.select(train.alias("train"), quoted(key).alias("_id"), quoted(text).cast("string").alias("_text")))
    path = new_path(spark, "blocks")
    # Places repeat, so here the usual level saves bytes.
    cut.write.partitionBy("turn").options(**{**PACKED, "parquet.compression.codec.zstd.level": "3"}).parquet(path)
    seen = spark.read.schema(cut.schema).parquet(path)
    rows = seen.select("train", "begins", "vocab", "places")
    counted, cells = count_words(rows)
    words = stored(counted, "words")
    discard(counted)
    trained = F.col("n_train") > 0
    tokens, kinds, once = words.agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in (
        F.col("n_train"), trained.cast("long"), (F.col("n_train") == 1).cast("long"))]).first()
    end = words.where(F.col("h") == int(END)).select("n_train").first()
    spare = max(once, 1)
    model, bits, marks = grow_tree(rows, cells, words, end["n_train"] if end else 0, tokens, tokens + spare)
    discard(words)
    maps = spark.sparkContext.broadcast((_marks(model, bits, marks), _marks(model, bits, marks, "kinds")))
    release(spark)
    rounds = ROUNDS if seen.count() >= ROUNDS * ROUND_BLOCKS else 1

    def solve(texts: pa.Table, found: pa.Table) -> pa.Table:
        _, begins, train = _block(texts)
        c, chance, depths = _chances(texts, found, maps.value, bits, tokens + spare, spare)
        numbers = np.zeros((len(c) + 1, 3))
        numbers[1:, 0] = c > 0
        numbers[1:, 1] = np.log10((c + 0.1) / (tokens + 0.1 * (kinds + 1)))
        numbers[1:, 2] = np.log10(chance)
        numbers[1:][depths == 0] = 0
        sums = np.cumsum(numbers, axis=0)
        total = sums[begins[1:]] - sums[begins[:-1]]
        return pa.table({
            key: texts.column("ids").combine_chunks().flatten(), "train": pa.array(train), "n_tokens": pa.array(np.diff(begins) - 1),
            "n_known": pa.array(np.rint(total[:, 0]).astype(np.int64)),
            "train_tokens": pa.array(np.full(len(total), tokens, np.int64)),
            "base_score": pa.array(total[:, 1]), "score": pa.array(total[:, 2])})

    id_kind = seen.schema["ids"].dataType.elementType.simpleString()
    name = key.replace("`", "``")
    done = []
    for turn in range(rounds):
        part = seen.where(F.col("turn") == turn) if rounds > 1 else seen
        hits = _answered(_wanted(part, maps, bits), model)
        done.append(part.drop("turn").groupBy("block").cogroup(hits.groupBy("block")).applyInArrow(
            solve, f"`{name}` {id_kind}, train boolean, n_tokens long, n_known long, train_tokens long, "
            "base_score double, score double"))
        if rounds > 1:
            done[-1] = stored(done[-1], f"scores-{turn}")
            release(spark)
    if rounds > 1:
        maps.destroy()
        dropped(model)
    out = done[0]
    for scores in done[1:]:
        out = out.unionByName(scores)
    return out
