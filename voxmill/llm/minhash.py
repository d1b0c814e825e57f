"""Near-duplicates by MinHash: universal hash minima, banding, verification, star components."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxmill.llm.common import bit_salt, each_salt, quoted, salt_bits, spread_join, stored
from voxmill.llm.words import blocks, hashed_words, mixed

#: 28 bands of 4 minima: a pair at a similarity of 0.8 shares no band once in 2.5 million cases.
BANDS, ROWS = 28, 4
#: A candidate whose signatures agree by less cannot reach 0.8: that is six standard deviations off.
LEAST_AGREEMENT = 0.8 - 6 * (0.8 * 0.2 / (BANDS * ROWS)) ** 0.5
#: Classes, and shingles, of a block of an unresolved family; columns of a matrix.
BLOCK_MEMBERS, BLOCK_ITEMS, COLUMNS = 512, 1 << 20, 4096

_draw = np.random.Generator(np.random.PCG64(20240607))
_A = _draw.integers(1, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _draw.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2)
_PLACES = [np.uint64(int(x) | 1) for x in _draw.integers(1, 1 << 63, 64, dtype=np.uint64)]


def shingle_sets(texts: list[bytes], size: int) -> list[np.ndarray]:
    """Of each text, the distinct hashes of its shingles of ``size`` words, in order. A shorter text
    has its whole sequence as one; a text without words has none."""
    words, at = hashed_words(texts)
    if len(words) >= size:
        n = len(words) - size + 1
        grams = words[:n] * _PLACES[0]
        for k in range(1, size):
            grams += words[k:k + n] * _PLACES[k % 64]
        grams = mixed(grams)
    sets = []
    for begin, end in zip(at[:-1], at[1:], strict=True):
        if end - begin >= size:
            own = np.sort(grams[begin:end - size + 1])
            sets.append(own[np.concatenate([[True], own[1:] != own[:-1]])])
        elif end > begin:
            whole = words[begin:end]
            total = sum((int(w) * int(_PLACES[k]) for k, w in enumerate(whole)), 977 * len(whole))
            sets.append(mixed(np.array([total & (2**64 - 1)], np.uint64)))
        else:
            sets.append(np.empty(0, np.uint64))
    return sets


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """Per non-empty set, the minimum of each universal hash a * x + b (its upper 32 bits)."""
    values = np.concatenate(sets)
    begins = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]])
    out = np.empty((len(sets), BANDS * ROWS), np.uint32)
    hashed = np.empty_like(values)
    for k in range(BANDS * ROWS):
        np.multiply(values, _A[k], out=hashed)
        hashed += _B[k]
        out[:, k] = np.minimum.reduceat(hashed, begins) >> np.uint64(32)
    return out


def _identity(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(_id, _key, _text): the row's id, and a hash of id and text by which it is found again."""
    value = quoted(text).cast("string")
    return docs.select(quoted(key).alias("_id"), F.xxhash64(quoted(key), value).alias("_key"),
                       value.alias("_text"))


def features(docs: DataFrame, key: str, text: str, size: int) -> DataFrame:
    """(_id, _key, n, d1, d2, sig): number of shingles, digest of the set, signature."""
    rows = _identity(docs, key, text)

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, texts in blocks(batch.column(2)):
                sets = shingle_sets(texts, size)
                full = [i for i, s in enumerate(sets) if len(s)]
                sig: list[bytes | None] = [None] * len(sets)
                if full:
                    for i, row in zip(full, signatures([sets[i] for i in full]), strict=True):
                        sig[i] = row.tobytes()
                digests = np.frombuffer(b"".join(
                    hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets), np.int64)
                part = batch.slice(start, len(texts))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array([len(s) for s in sets], pa.int64()),
                     pa.array(digests[0::2]), pa.array(digests[1::2]), pa.array(sig, pa.binary())],
                    ["_id", "_key", "n", "d1", "d2", "sig"])

    kind = rows.schema["_id"].dataType.simpleString()
    return rows.mapInArrow(compute, f"_id {kind}, _key long, n long, d1 long, d2 long, sig binary")


def _sets_of(docs: DataFrame, key: str, text: str, size: int, wanted: DataFrame) -> DataFrame:
    """(node, items): the full shingle sets of the wanted classes, each from one of its rows."""
    rows = _identity(docs, key, text).join(wanted.select("node", "_key", "d1", "d2"), "_key").select(
        "node", "d1", "d2", "_text")

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, texts in blocks(batch.column(3)):
                items = [s.tobytes() for s in shingle_sets(texts, size)]
                digests = [hashlib.blake2b(s, digest_size=16).digest() for s in items]
                part = batch.slice(start, len(texts))
                own = np.array([part.column(1).to_pylist(), part.column(2).to_pylist()], np.int64)
                right = [d == own[:, i].tobytes() for i, d in enumerate(digests)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(items, pa.binary())], ["node", "items"]).filter(pa.array(right))

    return rows.mapInArrow(compute, "node long, items binary").dropDuplicates(["node"])


def _agreeing(pairs: DataFrame) -> DataFrame:
    """(a, b, agreement) of the pairs (a, b, sig, other) whose signatures agree well enough."""
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint32).reshape(
                -1, BANDS * ROWS) for i in (2, 3))
            share = (left == right).mean(axis=1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(share)], ["a", "b", "agreement"]).filter(
                pa.array(share >= LEAST_AGREEMENT))

    return pairs.select("a", "b", "sig", "other").mapInArrow(compare, "a long, b long, agreement double")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) with 100 * |intersection| >= percent * |union| of their full sets."""
    first = spread_join(pairs.select("a", "b"), sets.select(F.col("node").alias("a"), F.col("items").alias("x")),
                        ["a"], "b")
    both = spread_join(first, sets.select(F.col("node").alias("b"), F.col("items").alias("y")), ["b"], "a")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
                    linked.append(False)
                    continue
                common = len(np.intersect1d(x, y, assume_unique=True))
                linked.append(100 * common >= percent * (len(x) + len(y) - common))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(
                pa.array(linked, pa.bool_()))

    return both.select("a", "b", "x", "y").mapInArrow(compare, "a long, b long")


def _least(edges: DataFrame) -> DataFrame:
    """Each edge (u, v) with the smallest neighbour m of u; a hot u is spread by v."""
    salted = edges.withColumn("_salt", bit_salt("v"))
    least = salted.groupBy("u").agg(F.min("v").alias("m"), salt_bits().alias("_bits")).withColumn(
        "_salt", each_salt()).drop("_bits")
    return salted.join(least, ["u", "_salt"]).drop("_salt")


def components(links: DataFrame) -> DataFrame:
    """(node, root) of all linked nodes, root the smallest of its component.

    Alternating stars: large-star ties the larger neighbours of a node to its smallest one,
    small-star the smaller ones, until every component is a star around its smallest node. Each
    round is written to the shared folder.
    """
    edges = stored(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where(
        "u <> v").distinct(), "edges")
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _least(both).where("v > u").select(
            F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct()
        small = _least(large)
        small = small.select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"),
                             F.col("m").alias("v"))
        after = stored(small.distinct(), "edges")
        mark = [F.count("*"), F.sum(F.hash("u", "v").cast("long"))]
        if edges.agg(*mark).first() == after.agg(*mark).first():
            roots = after.select(F.col("v").alias("node")).distinct().withColumn("root", F.col("node"))
            return after.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
        edges = after


def _across(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between the components that meet in a unit: a spanning forest of each block pair.

    ``members``: unit, node, root, items (how many shingles). A unit is cut into blocks; the full
    sets of each pair of blocks are multiplied as two matrices, so work is bounded per task, all
    intersections are exact, and a pair of blocks returns fewer rows than it has members.
    """
    sizes = members.groupBy("unit").agg(salt_bits().alias("_bits"), F.greatest(
        F.ceil(F.count("*") / BLOCK_MEMBERS), F.ceil(F.sum("items") / BLOCK_ITEMS)).cast("int").alias("_m"))
    dealt = members.join(sizes.withColumn("_salt", each_salt()).drop("_bits"), ["unit", "_salt"]).withColumn(
        "_own", F.pmod(F.xxhash64("node"), F.col("_m")).cast("int"))
    pairs = F.expr("transform(sequence(0, _m - 1), j -> struct(least(_own, j) as i, greatest(_own, j) as j))")
    dealt = dealt.join(sets, "node").withColumn("_pair", F.explode(pairs))

    def compare(group: pa.Table) -> pa.Table:
        root, block = group.column("root").to_numpy(), group.column("_own").to_numpy()
        pair = group.column("_pair")[0].as_py()
        found = [np.frombuffer(x, np.uint64) for x in group.column("items").to_pylist()]
        links = linked_roots(found, root, np.flatnonzero(block == pair["i"]), np.flatnonzero(block == pair["j"]), percent)
        return pa.table({"a": pa.array([x for x, _ in links], pa.int64()), "b": pa.array([y for _, y in links], pa.int64())})

    return dealt.select("unit", "node", "root", "_own", "_pair", sets["items"]).groupBy("unit", "_pair").applyInArrow(
        compare, "a long, b long")


def linked_roots(
    sets: list[np.ndarray], root: np.ndarray, left: np.ndarray, right: np.ndarray, percent: int,
) -> list[tuple[int, int]]:
    """A spanning forest over components, of the links between sets ``left`` and sets ``right``."""
    sizes = np.array([len(s) for s in sets])
    _, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    member = np.repeat(np.arange(len(sets)), sizes)
    # Items of a single set are in no intersection; the others get consecutive columns.
    number = np.cumsum(count > 1) - 1
    shared = count[column] > 1
    column, member = number[column[shared]], member[shared]
    common = np.zeros((len(left), len(right)), np.float32)
    order = np.argsort(column, kind="stable")
    column, member = column[order], member[order]
    for first in range(0, int(number[-1]) + 1 if len(number) else 0, COLUMNS):
        part = slice(*np.searchsorted(column, [first, first + COLUMNS]))
        matrix = np.zeros((len(sets), COLUMNS), np.float32)
        matrix[member[part], column[part] - first] = 1
        common += matrix[left] @ matrix[right].T
    either = sizes[left][:, None] + sizes[right][None, :] - common
    names, place = np.unique(root, return_inverse=True)
    i, j = np.nonzero((100 * common >= percent * either) & (root[left][:, None] != root[right][None, :]))
    near = np.zeros((len(names), len(names)), bool)
    near[place[left[i]], place[right[j]]] = True
    near |= near.T
    new, forest = np.ones(len(names), bool), []
    for start in range(len(names)):
        if not new[start]:
            continue
        new[start], reached = False, [start]
        while reached:
            at = reached.pop()
            for other in np.flatnonzero(near[at] & new).tolist():
                new[other] = False
                forest.append((int(names[at]), int(names[other])))
                reached.append(other)
    return forest


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 5, percent: int = 80,
    max_family: int = 20_000,
) -> DataFrame:
    """(_id, _key, n_shingles, component_id, kept) of every row of ``docs``.

    Rows are linked when the sets of their word shingles (words of other than ASCII white space,
    A-Z lowered) have 100 * |intersection| >= ``percent`` * |union|; ``component_id`` is the smallest
    id reachable by links, and the row with that id is ``kept``.

    Rows with equal sets are one class, and classes are what is compared. Classes that agree in a
    band share a bucket. A bucket first gives each member's pair with the smallest one; of those
    with agreeing signatures a member's best is confirmed on the full sets, and components are
    found. Buckets whose members lie in several components stay open: those that share members
    are one family, whose full sets are compared in blocks, across components. In a family of over
    ``max_family`` classes each bucket is compared by itself. So no bucket is expanded into pairs,
    and none is capped: two classes that share a band end up compared or connected.

    A null or empty text has no shingles and links with nothing. Rows that share an id are kept or
    dropped together; a null id never names a component that has another one. Very long texts give
    all their shingles. An empty table gives an empty one; other columns are not read, whatever they
    are called.
    """
    base = stored(features(docs, key, text, size), "features")
    salted = base.where("n > 0").withColumn("_salt", bit_salt("_key"))
    front = F.min(F.struct(F.col("_id").isNull().alias("none"), "_id", "_key", "n", "sig")).alias("_front")
    classes = stored(salted.groupBy("d1", "d2").agg(front, salt_bits().alias("_bits")).select(
        F.monotonically_increasing_id().alias("node"), "d1", "d2", "_bits", "_front.*"), "classes")
    width = 4 * ROWS
    rows = classes.select("node", F.explode(F.expr(
        f"transform(sequence(0, {BANDS - 1}), k -> xxhash64(k, substring(sig, k * {width} + 1, {width})))")).alias("_b"))
    salted = rows.withColumn("_salt", bit_salt("node"))
    buckets = salted.groupBy("_b").agg(
        F.min("node").alias("_pivot"), F.count("*").alias("_n"), salt_bits().alias("_bits")).where("_n > 1")
    members = stored(salted.join(buckets.withColumn("_salt", each_salt()).drop("_bits"), ["_b", "_salt"]).select(
        "_b", "node", "_pivot", "_n"), "buckets")
    nodes = members.select("node").distinct()
    colliding = stored(classes.join(nodes, "node").select("node", "_key", "d1", "d2", "n", "sig"), "colliding")
    sets = stored(_sets_of(docs, key, text, size, colliding), "sets")

    stars = members.where("node <> _pivot").select(F.col("_pivot").alias("a"), F.col("node").alias("b")).distinct()
    sigs = colliding.select("node", "sig")
    with_sig = spread_join(stars, sigs.withColumnRenamed("node", "a"), ["a"], "b")
    with_both = with_sig.join(sigs.select(F.col("node").alias("b"), F.col("sig").alias("other")), "b")
    best = _agreeing(with_both).groupBy("b").agg(
        F.max_by("a", F.struct("agreement", -F.col("a"))).alias("a"))
    tried = stored(best.select("a", "b"), "tried")
    links = stored(_confirmed(tried, sets, percent), "links")
    found = components(links)

    root = F.coalesce("root", "node")
    placed = stored(members.join(found, "node", "left").withColumn("root", root).join(
        colliding.select("node", F.col("n").alias("items")), "node"), "placed")
    mixed_up = placed.groupBy("_b").agg(F.min("root").alias("_low"), F.max("root").alias("_high")).where(
        "_low <> _high").select("_b")
    open_rows = stored(spread_join(placed, mixed_up, ["_b"], "node"), "open")
    if open_rows.limit(1).count():
        family = components(open_rows.select(F.col("_pivot").alias("a"), F.col("node").alias("b"))).withColumnRenamed(
            "root", "family")
        in_family = open_rows.join(family, "node")
        large = in_family.select("family", "node").distinct().groupBy("family").count().where(
            F.col("count") > max_family).select("family", F.lit(True).alias("large"))
        in_family = spread_join(in_family, large, ["family"], "node", "left")
        unit = F.when(F.col("large"), F.struct(F.lit(1).alias("kind"), F.col("_b").alias("name"))).otherwise(
            F.struct(F.lit(0).alias("kind"), F.col("family").alias("name")))
        units = in_family.select(unit.alias("unit"), "node", "root", "items").distinct().withColumn(
            "_salt", bit_salt("node"))
        more = stored(_across(units, sets, percent), "links")
        found = components(links.unionByName(more))

    of_class = classes.join(found, "node", "left").withColumn("root", root)
    lowest = of_class.groupBy("root").agg(F.min("_id").alias("component_id"))
    named = spread_join(of_class.select("node", "d1", "d2", "_bits", "root"), lowest, ["root"], "node")
    named = named.select("d1", "d2", "component_id", each_salt().alias("_salt"))
    joined = base.withColumn("_salt", F.when(F.col("n") > 0, bit_salt("_key"))).join(
        named, ["d1", "d2", "_salt"], "left")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("_id"))
    return joined.select("_id", "_key", F.col("n").alias("n_shingles"), component.alias("component_id"),
                         F.col("_id").eqNullSafe(component).alias("kept"))


def deduplicate(
    docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 5, percent: int = 80,
) -> DataFrame:
    """The rows of ``docs`` that stay, with its columns: one of each component of near-duplicates."""
    dropped = near_duplicates(docs, key, text, size, percent).where("not kept").select(
        F.col("_key").alias("_gone")).distinct()
    safe = [f"_c{i}" for i in range(len(docs.columns))]
    names = dict(zip(docs.columns, safe, strict=True))
    held = docs.toDF(*safe)
    own = F.xxhash64(F.col(names[key]), F.col(names[text]).cast("string"))
    return held.join(dropped, own == F.col("_gone"), "left_anti").toDF(*docs.columns)
