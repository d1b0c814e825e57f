"""Long repeated passages: maximal repeats from the interval tree of a sparse enhanced suffix array."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxmill.llm.common import (
    bit_salt, each_salt, quoted, release, salt_bits, spread_join, stored,
)
from voxmill.llm.words import BLOCK, mixed, segment_hashes

#: Bytes of an anchor's gram. Of every LENGTH bytes, the gram with the least hash is an anchor.
GRAM = 50
#: A group of anchors with more different surroundings than this is split by what stands around.
MAX_GROUP = 20_000


def least_in_windows(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each window of ``width`` values, from running minima of blocks as wide."""
    n = len(values) - width + 1
    padded = np.full(-(-len(values) // width) * width, ~np.uint64(0))
    padded[:len(values)] = values
    rows = padded.reshape(-1, width)
    after = np.minimum.accumulate(rows, axis=1).reshape(-1)
    before = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(before[:n], after[width - 1:width - 1 + n])


def _pieces(texts: list[bytes], length: int) -> Iterator[list[tuple[int, int, int, int, bytes]]]:
    """Groups of about BLOCK bytes of (text, first byte, own part from, to, bytes). A longer text
    comes in overlapping pieces, as what is an anchor depends on its surroundings only."""
    group, size = [], 0
    for i, text in enumerate(texts):
        for begin in range(0, len(text), BLOCK) if len(text) >= length else ():
            end = min(begin + BLOCK, len(text))
            first, last = max(0, begin - 2 * length), min(len(text), end + 2 * length)
            group.append((i, first, begin, end, text[first:last]))
            size += last - first
            if size >= BLOCK:
                yield group
                group, size = [], 0
    if group:
        yield group


def anchors(texts: list[bytes], length: int) -> list[list[tuple[np.ndarray, np.ndarray, np.ndarray]]]:
    """For each text, (gram hash, hash of the surroundings, place) of its anchors, in parts.

    Two equal strings of ``length`` bytes hold the same anchors at the same places: the least hash
    among their grams depends on their bytes alone. The surroundings are all bytes that a string
    of ``length`` bytes around the gram can have, less what the text's ends cut off.
    """
    found: list[list[tuple[np.ndarray, np.ndarray, np.ndarray]]] = [[] for _ in texts]
    window, reach = length - GRAM + 1, length - GRAM
    for group in _pieces(texts, length):
        data = np.frombuffer(b"".join(p[4] for p in group), np.uint8)
        ends = np.cumsum([len(p[4]) for p in group])
        owner = np.repeat(np.arange(len(group)), [len(p[4]) for p in group])
        n = len(data) - GRAM + 1
        starts = np.arange(n)
        inside = owner[:n] == owner[GRAM - 1:]
        hashes = segment_hashes(data, starts, starts + GRAM)
        least = least_in_windows(hashes, window)
        # A window over a border has no say: 0 is below every hash.
        least[owner[:len(least)] != owner[window + GRAM - 2:]] = 0
        padding = np.zeros(window - 1, np.uint64)
        highest = ~least_in_windows(~np.concatenate([padding, least, padding]), window)
        places = np.flatnonzero((highest[:n] == hashes) & inside & (hashes != 0))
        who, grams = owner[places], hashes[places]
        begins = ends - np.array([len(p[4]) for p in group])
        left, right = np.maximum(places - reach, begins[who]), np.minimum(places + length, ends[who])
        around = mixed(segment_hashes(data, left, right) + (places - left).astype(np.uint64))
        cuts = np.searchsorted(who, np.arange(len(group) + 1))
        for j, (i, first, begin, end, _) in enumerate(group):
            own = slice(cuts[j], cuts[j + 1])
            place = places[own] - begins[j] + first
            mine = (place >= begin) & (place < end)
            found[i].append((grams[own][mine], around[own][mine], place[mine]))
    return found


def _texts(docs: DataFrame, key: str, text: str) -> DataFrame:
    value = F.encode(F.coalesce(quoted(text).cast("string"), F.lit("")), "UTF-8")
    return docs.select(quoted(key).alias("_id"), value.alias("_text")).select(
        "_id", F.xxhash64("_text").alias("r1"), F.xxhash64(F.lit(1), "_text").alias("r2"), "_text")


def _classes(texts: DataFrame, length: int) -> DataFrame:
    """One row for each different text: (u, r1, r2, rep, n, bits, n_bytes, anchors)."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                values = batch.column(3).to_pylist()
                found = anchors(values, length)
                offsets = np.cumsum([0, *[sum(len(g) for g, _, _ in parts) for parts in found]])
                g, c, pos = (np.concatenate([np.empty(0, kind), *[part[k] for parts in found for part in parts]])
                             for k, kind in enumerate((np.uint64, np.uint64, np.int64)))
                items = pa.StructArray.from_arrays(
                    [pa.array(g.view(np.int64)), pa.array(c.view(np.int64)), pa.array(pos)], ["g", "c", "pos"])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), batch.column(2), pa.array([len(v) for v in values], pa.int64()),
                     pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), items)],
                    ["_id", "r1", "r2", "n_bytes", "anchors"])

    kind = texts.schema["_id"].dataType.simpleString()
    scanned = texts.mapInArrow(scan, f"_id {kind}, r1 long, r2 long, n_bytes long, "
                               "anchors array<struct<g:long,c:long,pos:long>>")
    return scanned.withColumn("_salt", bit_salt("_id")).groupBy("r1", "r2").agg(
        F.count("*").alias("n"), F.min("_id").alias("rep"), F.first("n_bytes").alias("n_bytes"),
        salt_bits().alias("bits"), F.first("anchors").alias("anchors")).withColumn(
        "u", F.monotonically_increasing_id())


_SURROUNDINGS = ("key long, a int, b int, g long, c long, k long, bits long, big boolean, left binary, right binary")


def _surroundings(suspects: DataFrame, length: int) -> DataFrame:
    """The bytes before (reversed) and from each wanted anchor, of one place for each surroundings."""
    reach = length - GRAM

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 200):
                batch = whole.slice(at, 200)
                out: list[list] = [[] for _ in range(7)]
                for text, wanted in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    for w in wanted or ():
                        p = w["pos"]
                        for column, value in zip(out, (w["g"], w["c"], w["k"], w["bits"], w["big"], text[
                                max(0, p - reach):p][::-1], text[p:p + length]), strict=True):
                            column.append(value)
                g, c, k, bits, big, left, right = out
                yield pa.RecordBatch.from_arrays([
                    pa.array(g, pa.int64()), pa.array([0] * len(g), pa.int32()), pa.array([GRAM] * len(g), pa.int32()),
                    pa.array(g, pa.int64()), pa.array(c, pa.int64()), pa.array(k, pa.int64()), pa.array(bits, pa.int64()),
                    pa.array(big, pa.bool_()), pa.array(left, pa.binary()), pa.array(right, pa.binary())],
                    ["key", "a", "b", "g", "c", "k", "bits", "big", "left", "right"])

    return suspects.select("_text", "wanted").mapInArrow(cut, _SURROUNDINGS)


def _matrix(values: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """The strings as rows of a matrix, filled with zeros, and their lengths."""
    sizes = np.array([len(v) for v in values], np.int64)
    return np.array(values, f"S{width}").view(np.uint8).reshape(len(values), width), sizes


def _common(rows: np.ndarray, sizes: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Length of the longest common prefix of rows i and rows j."""
    unlike = rows[i] != rows[j]
    first = np.where(unlike.any(axis=1), unlike.argmax(axis=1), rows.shape[1])
    return np.minimum(first, np.minimum(sizes[i], sizes[j]))


def _order(rows: np.ndarray, sizes: np.ndarray, groups: np.ndarray) -> np.ndarray:
    """Rows by group, then as strings, a prefix before what it begins."""
    width = rows.shape[1]
    return np.lexsort((sizes, np.ascontiguousarray(rows).view(f"S{width}").reshape(-1), groups))


def _range_least(values: np.ndarray):
    """Minima of ranges values[i:j] (i < j) from tables of powers of two."""
    tables = [values]
    while 2 * (1 << len(tables)) // 2 <= len(values):
        half = 1 << (len(tables) - 1)
        tables.append(np.minimum(tables[-1][:-half], tables[-1][half:]))

    def least(i: np.ndarray, j: np.ndarray) -> np.ndarray:
        out = np.empty(len(i), values.dtype)
        power = np.int64(np.log2(np.maximum(j - i, 1)))
        for p in np.unique(power):
            at = power == p
            out[at] = np.minimum(tables[p][i[at]], tables[p][j[at] - (1 << int(p))])
        return out

    return least


def lcp_intervals(lcp: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(common length, first, last) of all intervals of a suffix array, by a scan with a stack:
    lcp[i] is the common length of suffix i and the one before it (lcp[0] is not read)."""
    stack = [(0, 0)]
    for i in range(1, len(lcp) + 1):
        now = int(lcp[i]) if i < len(lcp) else -1
        first = i - 1
        while stack and stack[-1][0] > now:
            length, first = stack.pop()
            yield length, first, i - 1
        if not stack or stack[-1][0] < now:
            stack.append((now, first))


def repeat_extents(
    left: list[bytes], right: list[bytes], groups: np.ndarray, length: int,
) -> tuple[np.ndarray, np.ndarray]:
    """How far each surroundings' repeats of at least ``length`` bytes reach left and right of its
    anchor (0, 0 without one). Rows of one group are compared; they come group by group.

    The right sides, sorted, are a suffix array of the anchors. Every interval of its tree is a set
    of places with a common right side; sorted by their reversed left sides, neighbours there give
    each place's longest common left extension inside the interval. Where left sides differ the
    repeat is maximal. A place takes an interval's repeat if both parts together are long enough;
    over all intervals this finds its furthest reach among all places, not just its neighbours'.
    """
    rights, right_sizes = _matrix(right, length)
    lefts, left_sizes = _matrix(left, max(1, length - GRAM))
    order = _order(rights, right_sizes, groups)
    by_left = _order(lefts, left_sizes, groups)
    far_left, far_right = np.zeros(len(groups), np.int64), np.zeros(len(groups), np.int64)
    if len(groups) < 2:
        return far_left, far_right
    lcp_right = np.concatenate([[0], _common(rights, right_sizes, order[:-1], order[1:])])
    lcp_left = np.concatenate([[0], _common(lefts, left_sizes, by_left[:-1], by_left[1:])])
    starts = np.flatnonzero(np.concatenate([[True], groups[1:] != groups[:-1]]))
    sizes = np.diff(np.append(starts, len(groups)))
    rank = np.empty(len(groups), np.int64)
    rank[by_left] = np.arange(len(groups))
    two = starts[sizes == 2]
    good = lcp_right[two + 1] + lcp_left[two + 1] >= length
    for k in (0, 1):
        far_left[two[good] + k], far_right[two[good] + k] = lcp_left[two[good] + 1], lcp_right[two[good] + 1]
    for start, size in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist(), strict=True):
        own_left = lcp_left[start:start + size]
        least = _range_least(own_left)
        longest = own_left[1:].max()
        members = order[start:start + size]
        for common, first, last in lcp_intervals(lcp_right[start:start + size]):
            if common < GRAM or common + longest < length:
                continue
            who = members[first:last + 1]
            ranks = rank[who] - start
            turn = np.argsort(ranks)
            who, ranks = who[turn], ranks[turn]
            between = least(ranks[:-1] + 1, ranks[1:] + 1)
            reach = np.maximum(np.concatenate([between, [0]]), np.concatenate([[0], between]))
            hit = reach + common >= length
            far_left[who[hit]] = np.maximum(far_left[who[hit]], reach[hit])
            far_right[who[hit]] = np.maximum(far_right[who[hit]], common)
    return far_left, far_right


def _extents(rows: DataFrame, length: int) -> DataFrame:
    """(g, c, bits, far_left, far_right) of the surroundings, group by group as they stream by."""
    names = ["g", "c", "bits", "far_left", "far_right"]

    def solve(table: pa.Table) -> pa.RecordBatch:
        key, c, k = (table.column(x).to_numpy() for x in ("key", "c", "k"))
        one = np.concatenate([[True], (key[1:] != key[:-1]) | (c[1:] != c[:-1])])
        table = table.filter(pa.array(one))
        key, k = key[one], k[one]
        left, right = table.column("left").to_pylist(), table.column("right").to_pylist()
        far_left, far_right = repeat_extents(left, right, key, length)
        # Surroundings that occur at several places repeat as a whole.
        sizes = np.array([[len(x), len(y)] for x, y in zip(left, right, strict=True)], np.int64).reshape(-1, 2)
        whole = (k > 1) & (sizes.sum(axis=1) >= length)
        far_left[whole], far_right[whole] = sizes[whole, 0], sizes[whole, 1]
        return pa.RecordBatch.from_arrays(
            [table.column(x).combine_chunks() for x in ("g", "c", "bits")]
            + [pa.array(far_left), pa.array(far_right)], names).filter(pa.array(far_right > 0))

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            key = batch.column(0).to_numpy()
            if held and key[-1] == held[0].column(0)[-1].as_py() and key[0] == key[-1]:
                held.append(batch)
                continue
            cut = int(np.flatnonzero(key != key[-1])[-1]) + 1 if key[0] != key[-1] else 0
            if held or cut:
                yield solve(pa.Table.from_batches([*held, batch.slice(0, cut)]).combine_chunks())
            held = [batch.slice(cut)]
        if held:
            yield solve(pa.Table.from_batches(held).combine_chunks())

    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.select("key", "g", "c", "k", "bits", "left", "right").repartition(
        tasks, "key").sortWithinPartitions("key", "c").mapInArrow(
        stream, "g long, c long, bits long, far_left long, far_right long")


def _split_groups(rows: DataFrame, length: int, most: int) -> tuple[list[DataFrame], list[DataFrame]]:
    """Groups too large for a task, split until they are not.

    Two places that share ``length`` bytes share either half of what is still open: more bytes to
    the left or more to the right. So a row goes to a group for each, and rows alone in a group are
    done. When a group's common bytes make up ``length``, all its places repeat, and counting them,
    which combines before the shuffle, is enough. Returns the small groups and finished extents.
    """
    small, done = [], []
    while True:
        step = F.ceil((F.lit(length) - F.col("a") - F.col("b")) / 2).cast("int")
        left_to, right_to = F.col("a") + step, F.lit(length) - F.col("a") - step + 1
        sides = F.array(
            F.struct(F.lit("left").alias("side"), left_to.alias("a"), F.col("b").alias("b"),
                     F.substring("left", F.lit(1), left_to).alias("part"), left_to.alias("size")),
            F.struct(F.lit("right").alias("side"), F.col("a").alias("a"), F.greatest("b", right_to).alias("b"),
                     F.substring("right", F.lit(1), F.greatest("b", right_to)).alias("part"),
                     F.greatest("b", right_to).alias("size")))
        rows = rows.withColumn("_s", F.explode(sides)).where(F.octet_length("_s.part") == F.col("_s.size")).select(
            F.xxhash64("key", "_s.side", "_s.part").alias("key"), "_s.a", "_s.b", "g", "c", "k", "bits", "left", "right")
        rows = stored(rows, "split")
        sizes = rows.withColumn("_salt", bit_salt("c")).groupBy("key").agg(
            F.count("*").alias("_n"), salt_bits().alias("_bits")).where("_n > 1").withColumn("_salt", each_salt())
        rows = rows.withColumn("_salt", bit_salt("c")).join(sizes.drop("_bits"), ["key", "_salt"]).drop("_salt")
        full = F.col("a") + F.col("b") >= length
        done.append(rows.where(full).select("g", "c", "bits", F.col("a").cast("long").alias("far_left"),
                                            F.col("b").cast("long").alias("far_right")))
        small.append(rows.where(~full & (F.col("_n") <= most)))
        rows = rows.where(~full & (F.col("_n") > most)).drop("_n")
        if not rows.limit(1).count():
            return small, done


def repeated_bytes(
    docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = 200, max_group: int = MAX_GROUP,
) -> DataFrame:
    """(key, n_bytes, n_removed, n_spans, kept_sha256) of every row: the sizes and the digest of what
    ``repeated_passages`` returns, without moving the texts."""
    found = _passages(docs, key, text, length, max_group, digest=True)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select(quoted(key), "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
                        F.col("kept").alias("kept_sha256"))


def repeated_passages(
    docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = 200, max_group: int = MAX_GROUP,
) -> DataFrame:
    """(key, n_bytes, spans, kept) of every row: the maximal runs (start, end) of bytes of its text, as
    UTF-8, that are covered by a string of ``length`` bytes that starts anywhere else, and what is
    left without them.

    Equal texts are one class; a class of several rows is removed whole, if long enough. The other
    texts are compared at anchors, chosen so that any two equal strings of ``length`` bytes hold a
    common one. Anchors with equal surroundings repeat as a whole, which counting shows. Where
    surroundings differ, one place of each goes, with its bytes, to a sparse suffix array of the
    anchor (see ``repeat_extents``), and the reach found there goes back to all places. Which places
    repeat each other is not returned.

    Hot anchors: counts combine before the shuffle, places join them spread by salts, and an anchor
    with over ``max_group`` different surroundings is split by what stands around it; nothing is
    dropped. A null text counts as empty; texts under ``length`` bytes lose nothing; repeated rows
    are copies of each other and lose all. Very long texts are taken whole. An empty table gives an
    empty one; other columns are not read, whatever they are called.
    """
    return _passages(docs, key, text, length, max_group, digest=False)


def _passages(docs: DataFrame, key: str, text: str, length: int, max_group: int, digest: bool) -> DataFrame:
    """``repeated_passages``, with the SHA-256 of ``kept`` in its place if ``digest``."""
    if length < GRAM + 2:
        raise ValueError(f"repeats must have at least {GRAM + 2} bytes")
    spark, texts = docs.sparkSession, _texts(docs, key, text)
    classes = stored(_classes(texts, length), "texts")
    release(spark)
    places = classes.select("u", "n", F.inline("anchors")).withColumn("_salt", bit_salt("u", "pos"))
    groups = places.groupBy("g").agg(
        F.count("*").alias("_n"), (F.min("c") != F.max("c")).alias("differ"), salt_bits().alias("_bits")).where("_n > 1")
    repeated = stored(places.join(
        groups.select("g", "differ", each_salt().alias("_salt")), ["g", "_salt"]).drop("_salt"), "places")
    one = stored(repeated.where("differ").withColumn("_salt", bit_salt("u", "pos")).groupBy("g", "c").agg(
        F.count("*").alias("k"), F.min(F.struct("u", "pos")).alias("at"), salt_bits().alias("bits")), "surroundings")
    release(spark)
    large = one.groupBy("g").count().where(F.col("count") > max_group).select("g", F.lit(True).alias("big"))
    wanted = spread_join(one, large, ["g"], "c", "left").groupBy("at.u").agg(F.collect_list(F.struct(
        "g", "c", "k", "bits", F.coalesce("big", F.lit(False)).alias("big"), "at.pos")).alias("wanted"))
    chosen = repeated.select("u").distinct().join(wanted, "u", "left").join(
        classes.select("u", "r1", "r2", "rep", "n"), "u")
    suspects = stored(texts.join(
        chosen, (texts["r1"] == chosen["r1"]) & (texts["r2"] == chosen["r2"]) & texts["_id"].eqNullSafe(chosen["rep"])
    ).select("u", chosen["r1"], chosen["r2"], "n", "_text", "wanted"), "suspects")
    release(spark)
    around = _surroundings(suspects, length)
    extents = [_extents(around.where("not big").drop("big"), length)]
    if large.limit(1).count():
        small, done = _split_groups(around.where("big").drop("big"), length, max_group)
        extents += [*[_extents(s, length) for s in small], *done]
    whole = extents[0]
    for more in extents[1:]:
        whole = whole.unionByName(more)
    if len(extents) > 1:
        whole = whole.groupBy("g", "c").agg(F.first("bits").alias("bits"), *[
            F.max(x).alias(x) for x in ("far_left", "far_right")])
    whole = stored(whole, "extents")
    release(spark)
    alone = repeated.where("n = 1")
    uniform = alone.where("not differ").select(
        "u", "pos", F.lit(length - GRAM).cast("long").alias("far_left"), F.lit(length).cast("long").alias("far_right"))
    differing = alone.where("differ").withColumn("_salt", bit_salt("u", "pos")).join(
        whole.withColumnRenamed("bits", "_bits").withColumn("_salt", each_salt()).drop("_bits"),
        ["g", "c", "_salt"]).select("u", "pos", "far_left", "far_right")
    spans = uniform.unionByName(differing).select("u", F.struct(
        (F.col("pos") - F.col("far_left")).alias("a"), (F.col("pos") + F.col("far_right")).alias("b")).alias("span"))
    spans = spans.groupBy("u").agg(F.collect_list("span").alias("spans"))
    left_over = stored(_without_spans(
        suspects.where("n = 1").select("u", "r1", "r2", "_text").join(spans, "u"), digest), "left-over").dropDuplicates(
        ["r1", "r2"])
    release(spark)
    rows = texts.select("_id", "r1", "r2", F.octet_length("_text").cast("long").alias("n_bytes"),
                        (F.sha2("_text", 256) if digest else F.col("_text")).alias("_own")).withColumn("_salt", bit_salt("_id"))
    copies = classes.where("n > 1").select("r1", "r2", F.col("bits").alias("_bits"), F.lit(True).alias("copied"))
    rows = rows.join(copies.withColumn("_salt", each_salt()).drop("_bits"), ["r1", "r2", "_salt"], "left")
    gone = F.coalesce("copied", F.lit(False)) & (F.col("n_bytes") >= length)
    rows = rows.join(left_over, ["r1", "r2"], "left")
    zero = F.lit(0).cast("long")
    whole = F.array(F.struct(zero.alias("start"), F.col("n_bytes").alias("end")))
    nothing = F.lit(hashlib.sha256(b"").hexdigest()) if digest else F.lit(b"")
    return rows.select(
        F.col("_id").alias(key), "n_bytes",
        F.when(gone, whole).otherwise(F.coalesce("spans", F.slice(whole, 1, 0))).alias("spans"),
        F.when(gone, nothing).otherwise(F.coalesce("kept", "_own")).alias("kept"))


def cut_spans(text: bytes, spans: list[tuple[int, int]]) -> tuple[bytes, list[tuple[int, int]]]:
    """The text without the spans, and the maximal runs removed."""
    runs: list[list[int]] = []
    for a, b in sorted((max(0, a), min(len(text), b)) for a, b in spans):
        if runs and a <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], b)
        else:
            runs.append([a, b])
    kept, at = [], 0
    for a, b in runs:
        kept.append(text[at:a])
        at = b
    return b"".join([*kept, text[at:]]), [(a, b) for a, b in runs]


def _without_spans(rows: DataFrame, digest: bool) -> DataFrame:
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                batch = whole.slice(at, 500)
                runs, left = [], []
                for text, spans in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                    kept, found = cut_spans(text, [(s["a"], s["b"]) for s in spans])
                    runs.append([{"start": a, "end": b} for a, b in found])
                    left.append(hashlib.sha256(kept).hexdigest() if digest else kept)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1),
                     pa.array(runs, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                     pa.array(left, pa.string() if digest else pa.binary())], ["r1", "r2", "spans", "kept"])

    return rows.select("r1", "r2", "_text", "spans").mapInArrow(
        cut, f"r1 long, r2 long, spans array<struct<start:long,end:long>>, kept {'string' if digest else 'binary'}")
