"""Secret scans through a trigram index: candidates by Boolean trigram queries, then the rule itself."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from re import _constants as ops
from re import _parser as parser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from voxmill.llm.common import quoted
from voxmill.llm.words import LOWER, blocks, joined

#: Beginnings of a rule that are spelled out; with more, the run of characters is cut there.
MAX_SPELLINGS = 64


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern`` whose ``group`` has at least ``least`` characters."""

    kind: str
    pattern: str
    least: int = 0
    group: int = 0


# The three base rules, then the formats of well-known credentials.
BASE_RULES = (
    Rule("assign", r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"""
         r"""|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6, 2),
    Rule("access", "AKIA[A-Z0-9]+", 20),
    Rule("hex", "[0-9a-f]{24,}", 24),
)
MORE_RULES = (
    Rule("private_key", "-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", "gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", "xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", "AIza[A-Za-z0-9_-]{35,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("url_login", r"://[A-Za-z0-9_.~-]+:[A-Za-z0-9_.~!*-]+@"),
)
RULES = BASE_RULES + MORE_RULES

#: A query: for each clause, one of its alternatives must have all its trigrams in the text.
Query = list[list[frozenset[bytes]]]


def _spellings(op, arg) -> set[str] | None:
    """All strings a part of a pattern can match, A-Z lowered; None where they are too many."""
    if op is ops.LITERAL:
        return {chr(arg).lower()}
    if op is ops.AT:
        return {""}
    if op is ops.IN and all(o is ops.LITERAL for o, _ in arg):
        return {chr(a).lower() for _, a in arg} if len(arg) <= 8 else None
    if op is ops.SUBPATTERN:
        return _all_spellings(arg[-1])
    if op is ops.BRANCH:
        found = [_all_spellings(branch) for branch in arg[1]]
        return None if None in found else set().union(*found)
    if op is ops.MAX_REPEAT and arg[1] == 1:
        inner = _all_spellings(arg[2])
        return None if inner is None else inner | ({""} if arg[0] == 0 else set())
    return None


def _all_spellings(parts) -> set[str] | None:
    whole = {""}
    for op, arg in parts:
        own = _spellings(op, arg)
        if own is None or len(whole) * len(own) > MAX_SPELLINGS:
            return None
        whole = {a + b for a in whole for b in own}
    return whole


def _clause(run: set[str]) -> Query:
    """The trigrams that each spelling of a run implies, without alternatives that others imply."""
    sets = {frozenset(s.encode()[i:i + 3] for i in range(len(s.encode()) - 2)) for s in run}
    if frozenset() in sets:
        return []
    return [sorted((s for s in sets if not any(o < s for o in sets)), key=sorted)]


def trigram_query(pattern: str) -> Query:
    """What any match of ``pattern`` must contain; empty if it has no mandatory trigram."""
    def mandatory(parts) -> Query:
        clauses, run = [], {""}
        for op, arg in parts:
            own = _spellings(op, arg)
            if own is not None and len(run) * len(own) <= MAX_SPELLINGS:
                run = {a + b for a in run for b in own}
                continue
            clauses += _clause(run)
            run = {""}
            if op is ops.SUBPATTERN:
                clauses += mandatory(arg[-1])
            elif op is ops.MAX_REPEAT and arg[0] > 0:
                clauses += mandatory(arg[2])
        return clauses + _clause(run)

    return mandatory(parser.parse(pattern))


class TrigramIndex:
    """Postings of the trigrams that the rules ask for, over the texts of one block."""

    def __init__(self, queries: list[Query]):
        grams = sorted({g for q in queries for clause in q for option in clause for g in option})
        self.place = {g: i for i, g in enumerate(grams)}
        self.wanted = np.zeros(1 << 24, np.uint8)
        for g, i in self.place.items():
            self.wanted[int.from_bytes(g, "big")] = i + 1
        if len(grams) > 255:
            raise ValueError("the rules need more than 255 trigrams")

    def postings(self, texts: list[bytes]) -> np.ndarray:
        """A row of bits per trigram: which texts hold it."""
        data, at = joined(texts)
        data = LOWER[data].astype(np.uint32)
        codes = (data[:-2] << np.uint32(16)) | (data[1:-1] << np.uint32(8)) | data[2:]
        hits = self.wanted[codes]
        places = np.flatnonzero(hits)
        found = np.zeros((len(self.place), len(texts)), bool)
        found[hits[places].astype(np.int64) - 1, np.searchsorted(at, places, "right") - 1] = True
        return found

    def candidates(self, query: Query, postings: np.ndarray) -> np.ndarray:
        """The texts whose postings satisfy the query."""
        kept = np.ones(postings.shape[1], bool)
        for clause in query:
            either = np.zeros_like(kept)
            for option in clause:
                either |= postings[[self.place[g] for g in option]].all(axis=0)
            kept &= either
        return np.flatnonzero(kept)


def find_secrets(
    docs: DataFrame, key: str = "doc_id", text: str = "text", rules: tuple[Rule, ...] = RULES,
) -> DataFrame:
    """(key, spans) of every row: the matches of all rules as (kind, start, end) in code points, end
    exclusive, by start and then by the rules' order.

    Each block of rows is indexed as it streams by: postings of the trigrams that the rules cannot
    do without. A rule's Boolean query intersects them, and the rule's pattern verifies the texts
    left; a rule without mandatory trigrams scans every text. Nothing is shuffled, and memory is
    one block. Matches of a rule do not overlap; those too short are dropped. A null or empty text
    has no spans; repeated rows are scanned one by one, very long texts whole; an empty table gives an
    empty one; other columns are not read, whatever they are called.
    """
    queries = [trigram_query(r.pattern) for r in rules]
    rows = docs.select(quoted(key).alias("_id"), quoted(text).cast("string").alias("_text"))
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, patterns = TrigramIndex(queries), [re.compile(r.pattern) for r in rules]
        for batch in batches:
            for start, texts in blocks(batch.column(1)):
                found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
                postings = index.postings(texts)
                decoded: dict[int, str] = {}
                for order, (rule, pattern, query) in enumerate(zip(rules, patterns, queries, strict=True)):
                    for i in index.candidates(query, postings):
                        if i not in decoded:
                            decoded[i] = texts[i].decode()
                        for m in pattern.finditer(decoded[i]):
                            if len(m[rule.group]) >= rule.least:
                                found[i].append((m.start(), order, m.end()))
                spans = [[{"kind": rules[order].kind, "start": a, "end": b} for a, order, b in sorted(x)]
                         for x in found]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, len(texts)), pa.array(spans, span)], ["_id", "spans"])

    kind = rows.schema["_id"].dataType.simpleString()
    return rows.mapInArrow(
        scan, f"_id {kind}, spans array<struct<kind:string,start:int,end:int>>").withColumnRenamed("_id", key)
