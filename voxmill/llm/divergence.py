"""Source divergence: how far the word use of one source is from another's, priced from the joint
tables of their count levels, which are products of one-hot level matrices."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voxmill.llm.common import quoted, stored, tasks_for
from voxmill.llm.words import LOWER, blocks, joined

#: Terms must occur in so many documents of their language.
LEAST_DOCUMENTS = 3
#: Shares are whole billionths.
UNIT = 1_000_000_000
#: Occurrences of terms, and texts, that a task counts before it passes them on; a longer text is
#: counted alone.
TERMS_HELD = 4_000_000
TEXTS_HELD = 1 << 16
#: Counts (a term in a source) that one block of terms has, about.
ROWS_PER_BLOCK = 200_000
#: Columns of a tile of the indicator matrix, and terms that are multiplied at a time. Sums stay far
#: below 2^24, up to which single-precision products of zeros and ones are exact.
TILE = 64
TERMS_AT_ONCE = 8192

#: Bytes of terms are letters, lowered, and all of a character beyond ASCII.
_IN_TERM = np.array([0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A or b >= 0x80 for b in range(256)])
_PARTIAL = "lang string, term string, documents long, counts array<struct<source: string, count: long>>"


def _terms(texts: list[bytes]) -> tuple[pa.DictionaryArray, np.ndarray]:
    """The terms of the texts, A-Z lowered, one after the other, and how many each text has."""
    data, at = joined(texts)
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = _IN_TERM[data]
    steps = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = steps[::2], steps[1::2]
    offsets = np.concatenate([[0], np.cumsum(ends - starts)])
    letters = LOWER[data[inside[1:-1]]]
    flat = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(letters)])
    return flat.dictionary_encode(), np.diff(np.searchsorted(starts, at))


def _summed(keys: pa.Table, found: list[pa.DictionaryArray], sizes: list[np.ndarray]) -> pa.RecordBatch:
    """_PARTIAL of texts with their (lang, source), the terms of all and how many each has. A term, its
    group and its text are one number each, packed into one, which is sorted."""
    langs, sources = (keys.column(c).combine_chunks().dictionary_encode() for c in (0, 1))
    group = langs.indices.to_numpy().astype(np.int64) * len(sources.dictionary) + sources.indices.to_numpy()
    groups, group = np.unique(group, return_inverse=True)
    lang, source = np.divmod(groups, len(sources.dictionary))
    terms = pa.chunked_array(found).unify_dictionaries()
    names, texts = terms.chunk(0).dictionary, len(group)
    owner = np.repeat(np.arange(texts), np.concatenate(sizes))
    packed = np.concatenate([c.indices.to_numpy() for c in terms.chunks]) * np.int64(len(groups))
    packed += group[owner]
    packed *= texts
    packed += owner
    packed.sort()
    new_text = np.diff(packed, prepend=-1) != 0
    packed //= texts
    first = np.flatnonzero(np.diff(packed, prepend=-1))  # of each term in each group
    counts = np.diff(np.append(first, len(packed)))
    documents = np.add.reduceat(new_text, first, dtype=np.int64) if len(first) else first
    term, of = np.divmod(packed[first], len(groups))
    row = np.flatnonzero((np.diff(term, prepend=-1) != 0) | (np.diff(lang[of], prepend=-1) != 0))
    each = pa.StructArray.from_arrays(
        [sources.dictionary.take(pa.array(source[of])), pa.array(counts)], ["source", "count"])
    return pa.RecordBatch.from_arrays([
        langs.dictionary.take(pa.array(lang[of[row]])),
        names.take(pa.array(term[row])).cast(pa.binary()).cast(pa.string()),
        pa.array(np.add.reduceat(documents, row) if len(row) else row),
        pa.ListArray.from_arrays(pa.array(np.append(row, len(of)).astype(np.int32)), each)],
        ["lang", "term", "documents", "counts"])


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """_PARTIAL of (lang, source, text), summed over as many texts as TERMS_HELD and TEXTS_HELD allow."""
    keys: list[pa.RecordBatch] = []
    found: list[pa.DictionaryArray] = []
    sizes: list[np.ndarray] = []

    def emptied() -> Iterator[pa.RecordBatch]:
        out = _summed(pa.Table.from_batches(keys), found, sizes)
        for held in (keys, found, sizes):
            held.clear()
        for at in range(0, out.num_rows, 1 << 15):
            yield out.slice(at, 1 << 15)

    for batch in batches:
        for start, texts in blocks(batch.column(2)):
            terms, size = _terms(texts)
            if found and (sum(map(len, found)) + len(terms) > TERMS_HELD or sum(map(len, sizes)) + len(texts) > TEXTS_HELD):
                yield from emptied()
            keys.append(batch.select([0, 1]).slice(start, len(texts)))
            found.append(terms)
            sizes.append(size)
    if found:
        yield from emptied()


def term_counts(
    docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text",
    least_documents: int = LEAST_DOCUMENTS,
) -> DataFrame:
    """(lang, source, term, count, lang_count, first): how often each kept term occurs in each source
    that has it, and in the whole language; ``first`` is true on one row per (lang, term).

    Counts are summed inside the tasks, a row for each term with the sources that have it; after one
    shuffle by (lang, term), rare terms go before the others' sources become rows. No task holds a
    language, a source or the rows of a frequent term.
    """
    rows = docs.select(*[F.coalesce(quoted(c).cast("string"), F.lit("")).alias(n)
                         for c, n in ((lang, "lang"), (source, "source"), (text, "text"))])
    term = Window.partitionBy("term", "lang")
    kept = rows.mapInArrow(_counted, _PARTIAL).repartition("lang", "term").select(
        "lang", "term", "counts", F.sum("documents").over(term).alias("_documents"),
        F.sum(F.aggregate("counts", F.lit(0).cast("long"), lambda n, c: n + c["count"])).over(term).alias("lang_count"),
        F.min(F.array_min("counts.source")).over(term).alias("_first"),
    ).where(F.col("_documents") >= least_documents)
    return kept.select("lang", "term", "lang_count", "_first", F.inline("counts")).groupBy(
        "lang", "source", "term").agg(
        F.sum("count").alias("count"), F.first("lang_count").alias("lang_count"),
        (F.first("_first") == F.col("source")).alias("first"))


def totals(counts: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, total, terms, lang_total) for every group, also one without a kept term."""
    by_source = counts.groupBy("lang", "source").agg(F.sum("count").alias("total"))
    by_lang = counts.groupBy("lang").agg(
        F.count_if("first").alias("terms"), F.sum("count").alias("lang_total"))
    zero = F.lit(0).cast("long")
    return groups.join(by_source, ["lang", "source"], "left").join(by_lang, "lang", "left").select(
        "lang", "source", *[F.coalesce(c, zero).alias(c) for c in ("total", "terms", "lang_total")])


def _ranges(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All places of the ranges, one range after the other, and the number of the range of each."""
    lengths = ends - starts
    owner = np.repeat(np.arange(len(starts)), lengths)
    before = np.cumsum(lengths) - lengths
    return np.arange(lengths.sum()) - before[owner] + starts[owner], owner


def one_hot_products(terms: np.ndarray, columns: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The entries above the diagonal of X^T X, as (row, column, value), where X has a one at each
    (term, column) given; exact. An entry may come in several parts, which add up.

    Columns are cut into tiles. For each pair of tiles that share terms, the indicators of those
    terms, TERMS_AT_ONCE at a time, are laid out as two dense blocks and multiplied.
    """
    order = np.lexsort((columns, terms))
    terms, columns = terms[order], columns[order]
    tile = columns // TILE
    # A run is a term's entries in one tile: one row of a dense block.
    new = np.ones(len(terms), bool)
    new[1:] = (terms[1:] != terms[:-1]) | (tile[1:] != tile[:-1])
    starts = np.append(np.flatnonzero(new), len(terms))
    run_tile, run_term = tile[starts[:-1]], terms[starts[:-1]]
    past = np.searchsorted(run_term, run_term, "right")  # where the runs of the same term end
    found: list[tuple[np.ndarray, ...]] = [(np.empty(0, np.int64),) * 3]

    def dense(t: int, runs: np.ndarray) -> np.ndarray:
        entries, row = _ranges(starts[runs], starts[runs + 1])
        block = np.zeros((len(runs), TILE), np.float32)
        block[row, columns[entries] - t * TILE] = 1
        return block

    by_tile = np.argsort(run_tile, kind="stable")
    edges = np.flatnonzero(np.diff(run_tile[by_tile], prepend=-1, append=-1))
    for start, end in zip(edges[:-1], edges[1:], strict=True):
        a = run_tile[by_tile[start]]
        for at in range(start, end, TERMS_AT_ONCE):
            left = by_tile[at:min(at + TERMS_AT_ONCE, end)]
            right, owner = _ranges(left, past[left])  # the term's runs in this tile and later ones
            by_other = np.argsort(run_tile[right], kind="stable")
            right, owner = right[by_other], owner[by_other]
            cuts = np.flatnonzero(np.diff(run_tile[right], prepend=-1, append=-1))
            for i, j in zip(cuts[:-1], cuts[1:], strict=True):
                b = run_tile[right[i]]
                product = dense(a, left[owner[i:j]]).T @ dense(b, right[i:j])
                row, column = np.nonzero(product)
                above = row + a * TILE < column + b * TILE
                row, column = row[above], column[above]
                found.append((row + a * TILE, column + b * TILE, product[row, column].astype(np.int64)))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


_JOINT = "lang string, source string, level long, other string, other_level long, n_terms long"


def _block_products(table: pa.Table) -> pa.Table:
    """The joint level counts of one block of terms, each pair of sources once."""
    terms, named = (table[c].combine_chunks().dictionary_encode() for c in ("term", "source"))
    terms = terms.indices.to_numpy()
    sources, place = np.unique(named.dictionary.to_numpy(zero_copy_only=False).astype(object), return_inverse=True)
    levels = table["count"].to_numpy()
    most = int(levels.max()) + 1
    keys, column = np.unique(place[named.indices.to_numpy()] * most + levels, return_inverse=True)
    columns = dict(zip("sc", np.divmod(keys, most)))
    i, j, n = one_hot_products(terms.astype(np.int64), column.astype(np.int64))
    pair = columns["s"][i] != columns["s"][j]  # a term has one level in a source
    i, j, n = i[pair], j[pair], n[pair]
    name = table["lang"][0].as_py()
    return pa.table({
        "lang": pa.array([name] * len(n), pa.string()),
        "source": pa.array(sources[columns["s"][i]], pa.string()), "level": columns["c"][i],
        "other": pa.array(sources[columns["s"][j]], pa.string()), "other_level": columns["c"][j],
        "n_terms": n})


def joint_levels(counts: DataFrame, totals: DataFrame) -> DataFrame:
    """(lang, source, level, other, other_level, n_terms): of the kept terms of a language, how many
    occur ``level`` times in ``source`` and ``other_level`` times in ``other``, for every ordered pair
    of its sources; the whole joint table, zeros included.

    Levels above zero come from one-hot products over blocks of terms, which are dealt by a hash and
    hold about ROWS_PER_BLOCK counts, and are summed. The zero levels are what the sums leave of each
    source's level counts and of the number of terms.
    """
    blocks = tasks_for(counts.count(), ROWS_PER_BLOCK)
    blocked = counts.select(
        "lang", "source", "term", "count", F.pmod(F.xxhash64("term"), F.lit(blocks)).alias("_block"))
    upper = blocked.repartition("lang", "_block").groupBy("lang", "_block").applyInArrow(_block_products, _JOINT).groupBy(
        "lang", "source", "level", "other", "other_level").agg(F.sum("n_terms").alias("n_terms"))
    upper = stored(upper, "joint-levels")
    both = upper.unionByName(upper.select(
        "lang", F.col("other").alias("source"), F.col("other_level").alias("level"),
        F.col("source").alias("other"), F.col("level").alias("other_level"), "n_terms"))
    pairs = totals.select("lang", "source", "terms").join(
        totals.select("lang", F.col("source").alias("other")), "lang").where("source <> other")
    levels = counts.groupBy("lang", "source", F.col("count").alias("level")).agg(F.count("*").alias("_all"))
    met = both.groupBy("lang", "source", "level", "other").agg(F.sum("n_terms").alias("_met"))
    # Terms with a level in the source and none in the other.
    alone = levels.join(pairs, ["lang", "source"]).join(
        met, ["lang", "source", "level", "other"], "left").select(
        "lang", "source", "level", "other", F.lit(0).cast("long").alias("other_level"),
        (F.col("_all") - F.coalesce("_met", F.lit(0))).alias("n_terms")).where("n_terms > 0")
    turned = alone.select("lang", F.col("other").alias("source"), F.col("other_level").alias("level"),
                          F.col("source").alias("other"), F.col("level").alias("other_level"), "n_terms")
    some = both.unionByName(alone).unionByName(turned)
    seen = some.groupBy("lang", "source", "other").agg(F.sum("n_terms").alias("_seen"))
    neither = pairs.join(seen, ["lang", "source", "other"], "left").select(
        "lang", "source", F.lit(0).cast("long").alias("level"), "other",
        F.lit(0).cast("long").alias("other_level"),
        (F.col("terms") - F.coalesce("_seen", F.lit(0))).alias("n_terms")).where("n_terms > 0")
    return some.unionByName(neither)


def share(count: Column | str, total: Column | str, terms: Column | str) -> Column:
    """The smoothed share of a term, in whole billionths and at least one."""
    count, total, terms = (F.col(c) if isinstance(c, str) else c for c in (count, total, terms))
    return F.lit(1).cast("long") + F.call_function("div", F.lit(UNIT).cast("long") * (count + 1), total + terms)


def price(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def _ranked(rows: DataFrame, part: str, only: int | None = None) -> DataFrame:
    place = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item")))
    ranked = rows.select("lang", "source", F.lit(part).alias("part"), "item", "value", place.alias("rank"))
    return ranked if only is None else ranked.where(F.col("rank") <= only)


def divergence_audit(
    docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text",
    least_documents: int = LEAST_DOCUMENTS, top_terms: int = 200,
) -> DataFrame:
    """(lang, source, part, item, value, rank): of each source of each language, how far it is from
    every other source (part ``pair``), and the terms it uses most beyond the language's share (part
    ``term``, the ``top_terms`` first).

    A term is a run of letters and of characters beyond ASCII, A-Z lowered; a language keeps those in
    ``least_documents`` of its documents. A group's share of a term is p = 1 + floor(10^9 * (count + 1)
    / (N + V)), and the price of p against q is floor((p - q)^2 / q). A pair's value is the sum of the
    prices over all kept terms, found as joint level counts times the price of the two levels.
    All arithmetic is on whole numbers.

    A null language, source or text counts as empty; a group without terms is listed with its pairs,
    with value 0 where its language keeps no term. Repeated rows count as documents of their own.
    Very long texts are counted whole. An empty table gives an empty result; other columns of
    ``docs``, whatever their names, are not read.
    """
    counts = stored(term_counts(docs, lang, source, text, least_documents), "term-counts")
    groups = docs.select(F.coalesce(quoted(lang).cast("string"), F.lit("")).alias("lang"),
                         F.coalesce(quoted(source).cast("string"), F.lit("")).alias("source")).distinct()
    sums = stored(totals(counts, groups), "group-totals")
    joint = joint_levels(counts, sums)
    other = sums.select("lang", F.col("source").alias("other"), F.col("total").alias("other_total"))
    value = price(share("level", "total", "terms"), share("other_level", "other_total", "terms"))
    priced = joint.join(sums, ["lang", "source"]).join(other, ["lang", "other"]).groupBy(
        "lang", "source", "other").agg(
        F.sum((F.col("n_terms") * value).cast("decimal(38,0)")).cast("long").alias("_value"))
    # A language without kept terms has pairs, too.
    pairs = sums.select("lang", "source").join(
        sums.select("lang", F.col("source").alias("other")), "lang").where("source <> other")
    pairs = pairs.join(priced, ["lang", "source", "other"], "left").select(
        "lang", "source", F.col("other").alias("item"),
        F.coalesce("_value", F.lit(0).cast("long")).alias("value"))
    p, q = share("count", "total", "terms"), share("lang_count", "lang_total", "terms")
    terms = counts.join(sums, ["lang", "source"]).where(p > q).select(
        "lang", "source", F.col("term").alias("item"), price(p, q).alias("value"))
    return _ranked(pairs, "pair").unionByName(_ranked(terms, "term", top_terms))
