"""Aspect columns: lexicon taggers, taxonomy lookups, list parsing, names."""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import reduce
from itertools import chain

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voxmill.functions import lexicons as L, numbers
from voxmill.functions.binding import bind

_EDGE = r"[\p{L}\p{N}_]"


def whole_words(alternatives) -> str:
    """One pattern for all alternatives, bounded by Unicode word edges."""
    return f"(?<!{_EDGE})(?:{'|'.join(alternatives)})(?!{_EDGE})"


def spelled_out(pattern: str) -> list[str]:
    """The words and phrases a lexicon pattern stands for."""
    out = []
    for term in re.findall(r"(?:[^|()]|\([^()]*\)\??)+", pattern):
        group = re.search(r"\(([^()]*)\)(\??)", term)
        if not group:
            out.append(term)
            continue
        endings = group[1].split("|") + ([""] if group[2] else [])
        for ending in endings:
            out += spelled_out(term[:group.start()] + ending + term[group.end():])
    return list(dict.fromkeys(out))


def _terms(patterns) -> tuple[list[str], list[str]]:
    """Single words and phrases (anything with a blank or a hyphen) of some patterns."""
    terms = dict.fromkeys(t for p in patterns for t in spelled_out(p))
    words = [t for t in terms if re.fullmatch(r"\w+", t)]
    return words, [t for t in terms if t not in words]


def _first_words(phrases) -> list[str]:
    return list(dict.fromkeys(re.match(r"\w+", p)[0] for p in phrases))


def _constant(words) -> Column:
    return F.split(F.lit(" ".join(words)), " ")


def _with_hits(text: Column, domain: Column, lexicon: dict,
               body: Callable[[Column], Column]) -> Column:
    """``body`` over a (lowered, hits, domain) struct. The text is lowered and split once; ``hits`` are
    its words that occur in the lexicon at all, found by one hash lookup per word. What follows
    works on that usually short list instead of scanning the text for every aspect."""
    words, phrases = _terms([p for patterns in lexicon.values() for p in patterns])
    known = list(dict.fromkeys(words + _first_words(phrases)))
    lowered = F.lower(F.coalesce(text, F.lit("")))

    def narrow(low):
        found = F.regexp_extract_all(low, F.lit(_EDGE + "+"), F.lit(0))
        return F.struct(
            low.alias("lowered"), F.filter(found, lambda w: w.isin(known)).alias("hits"),
            domain.alias("domain"))

    return bind(bind(lowered, narrow), body)


def _no_aspects() -> Column:
    return F.array().cast("array<string>")


def _mentions(w: Column, patterns) -> Column:
    """True when a word or phrase of the patterns occurs as whole words."""
    words, phrases = _terms(patterns)
    conditions = []
    if words:
        conditions.append(F.arrays_overlap(w["hits"], _constant(words)))
    if phrases:
        written = reduce(lambda a, b: a | b, [F.contains(w["lowered"], F.lit(p)) for p in phrases])
        conditions.append(
            F.arrays_overlap(w["hits"], _constant(_first_words(phrases)))
            & written & w["lowered"].rlike(whole_words(phrases)))
    return reduce(lambda a, b: a | b, conditions)


def taxonomy(spark: SparkSession) -> DataFrame:
    """(domain, aspect, ord): at most a few dozen rows."""
    rows = [
        (domain, aspect, i)
        for domain, aspects in L.TAXONOMY.items() for i, aspect in enumerate(aspects)
    ]
    return spark.createDataFrame(rows, "domain string, aspect string, ord int")


def candidate_aspects(domain: Column, unknown: str = "union") -> Column:
    """The domain's aspects; an empty domain means Electronics, an unknown one ``unknown``."""
    name = F.initcap(F.coalesce(domain, F.lit("")))
    electronics = F.array(*[F.lit(a) for a in L.TAXONOMY["Electronics"]])
    fashion = F.array(*[F.lit(a) for a in L.TAXONOMY["Fashion"]])
    other = {
        "union": F.array_union(electronics, fashion),
        "Electronics": electronics,
        "Fashion": fashion,
    }[unknown]
    return (
        F.when(name.isin("Electronics", ""), electronics).when(name == "Fashion", fashion)
        .otherwise(other)
    )


def _domain_flags(domain: Column, unknown: str) -> Column:
    """(elec, fash): which list a review's aspects come from; unknown domains use ``unknown``."""
    name = F.initcap(F.coalesce(domain, F.lit("")))
    if unknown == "Electronics":
        fash = name == "Fashion"
    else:
        fash = name != "Electronics"
    return F.struct((~fash).alias("elec"), fash.alias("fash"))


def _allowed(aspect: str, w: Column) -> Column:
    in_elec, in_fash = (aspect in L.TAXONOMY[d] for d in ("Electronics", "Fashion"))
    if in_elec and in_fash:
        return F.lit(True)
    return w["domain"]["elec"] if in_elec else w["domain"]["fash"]


def _contains_any(lowered: Column, words) -> Column:
    return reduce(lambda a, b: a | b, [F.contains(lowered, F.lit(w)) for w in words])


def tag_aspects(text: Column, domain: Column) -> Column:
    """Aspects of the domain the text mentions, in taxonomy order; a text that mentions none
    but holds a strongly negative word counts as ``quality``."""
    def tag(w):
        found = F.array_compact(F.array(*[
            F.when(_allowed(a, w) & _mentions(w, L.REVIEW_LEXICON[a]), F.lit(a))
            for a in L.ASPECTS]))
        found = F.when(F.size(w["hits"]) > 0, found).otherwise(_no_aspects())
        return F.struct(found.alias("found"), w["lowered"].alias("lowered"))

    def fall_back(t):
        return F.when(
            (F.size(t["found"]) == 0) & _contains_any(t["lowered"], L.REVIEW_FALLBACK_WORDS),
            F.array(F.lit("quality"))).otherwise(t["found"])

    flags = _domain_flags(domain, "Electronics")
    return bind(_with_hits(text, flags, L.REVIEW_LEXICON, tag), fall_back)


def annotate_aspects(text: Column, domain: Column) -> Column:
    """First labels for an annotation set: never empty, ``quality`` by default."""
    def tag(w):
        hit = {a: _allowed(a, w) & _mentions(w, L.ANNOTATION_LEXICON[a])
               for a in L.ASPECTS}
        hit["quality"] = hit["quality"] | _contains_any(w["lowered"], L.ANNOTATION_QUALITY_WORDS)
        return F.array_compact(F.array(*[F.when(hit[a], F.lit(a)) for a in L.ASPECTS]))

    def default(found):
        return F.when(F.size(found) == 0, F.array(F.lit("quality"))).otherwise(found)

    flags = _domain_flags(domain, "Fashion")
    return bind(_with_hits(text, flags, L.ANNOTATION_LEXICON, tag), default)


def lexicon_scores(text: Column, domain: Column) -> Column:
    """Score map of the domain's aspects: the share of an aspect's pattern groups that hit."""
    def score(w, aspect):
        groups = L.REVIEW_LEXICON[aspect]
        hits = [F.when(_mentions(w, [g]), 1).otherwise(0) for g in groups]
        return reduce(lambda a, b: a + b, hits) / F.lit(float(len(groups)))

    def entries(w):
        return F.array_compact(F.array(*[
            F.when(_allowed(a, w),
                   F.struct(F.lit(a).alias("aspect"), score(w, a).alias("score")))
            for a in L.ASPECTS]))

    flags = _domain_flags(domain, "Electronics")
    return F.map_from_entries(_with_hits(text, flags, L.REVIEW_LEXICON, entries))


def select_by_threshold(scores: Column, threshold: float) -> Column:
    """Labels scoring at least ``threshold``; the comparison uses the unrounded score."""
    return F.map_keys(F.map_filter(scores, lambda _, v: v >= threshold))


def rounded_scores(scores: Column) -> Column:
    return F.transform_values(scores, lambda _, v: numbers.rounded(v, 4))


def parse_aspects(value: Column, is_array: bool = False) -> Column:
    """Split at ``;`` ``,`` ``|``, trim, lower-case, drop empties; null becomes an empty list."""
    items = value if is_array else F.split(value, "[;,|]")
    items = F.transform(items, lambda x: F.lower(F.trim(x)))
    return F.coalesce(F.filter(items, lambda x: x != ""), F.array().cast("array<string>"))


def _literal_map(mapping: dict) -> Column:
    return F.create_map(*[F.lit(v) for v in chain.from_iterable(mapping.items())])


def _title_case(aspect: Column) -> Column:
    return F.initcap(F.replace(aspect, F.lit("_"), F.lit(" ")))


def display_name(aspect: Column) -> Column:
    return F.coalesce(_literal_map(L.DISPLAY_NAMES)[aspect], _title_case(aspect))


def verbalize(aspect: Column) -> Column:
    return F.coalesce(_literal_map(L.VERBALIZATIONS)[aspect], aspect)


def unverbalize(phrase: Column) -> Column:
    inverse = {v: k for k, v in L.VERBALIZATIONS.items()}
    return F.coalesce(_literal_map(inverse)[phrase], phrase)


def query_intent(question: Column) -> Column:
    """complaints or praises when only one kind of signal word occurs, else general."""
    lowered = F.lower(question)
    complaint = lowered.rlike(whole_words(L.COMPLAINT_SIGNALS))
    praise = lowered.rlike(whole_words(L.PRAISE_SIGNALS))
    return (
        F.when(complaint & ~praise, "complaints").when(praise & ~complaint, "praises")
        .otherwise("general")
    )
