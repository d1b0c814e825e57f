"""Text columns: HTML cleanup, whitespace, lengths, joined feature text."""

from __future__ import annotations

import html
import json
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from voxmill.config import MAX_CHARS
from voxmill.functions.binding import bind

# Unicode whitespace written out, so the meaning does not depend on the regex engine's flags.
WHITESPACE = r"[\t-\r\x1c-\x20\x{85}\p{Z}]"
WHITESPACE_CHARS = "".join(
    chr(n) for n in (*range(0x9, 0xE), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680,
                     *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000))
NON_WHITESPACE = r"[^\t-\r\x1c-\x20\x{85}\p{Z}]"
WORD_CHAR = r"[\p{L}\p{N}_]"

_REFERENCE = r"&(#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"


def _map(entries: dict) -> Column:
    """A constant map; as one literal it stays small in the plan and is folded once."""
    return F.from_json(F.lit(json.dumps(entries)), "map<string,string>")


def _decode_number(ref: Column) -> Column:
    """Decode ``&#65;`` / ``&#x41;``: legacy C1 codes, surrogates and non-characters included."""
    is_hex = ref.rlike("^&#[xX]")
    digits = F.regexp_replace(ref, "^&#[xX]?|;$", "")
    digits = F.regexp_replace(digits, "^0+(?=.)", "")
    small = F.length(digits) <= 8
    code = F.when(small & is_hex, F.conv(digits, 16, 10).cast("long")).when(
        small, digits.try_cast("long"))
    code = F.coalesce(code, F.lit(0x110000))
    # How browsers and html.unescape read the C1 range; taken from the standard library.
    c1 = _map({str(n): html.unescape(f"&#{n};") for n in range(0x80, 0xA0)})
    as_text = F.decode(
        F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
    drop = (
        code.between(0x1, 0x8) | code.between(0xE, 0x1F) | code.between(0x7F, 0x9F)
        | code.between(0xFDD0, 0xFDEF) | (code == 0xB)
        | (code.bitwiseAND(F.lit(0xFFFE)) == 0xFFFE)
    )
    return (
        F.when((code == 0) | code.between(0xD800, 0xDFFF) | (code > 0x10FFFF), F.lit("�"))
        .when(code == 0x0D, F.lit("\r"))
        .when(code.between(0x80, 0x9F), c1[code.cast("string")])
        .when(drop, F.lit(""))
        .otherwise(as_text)
    )


def _decode_reference(ref: Column) -> Column:
    legacy = sorted((n for n in html5 if not n.endswith(";")), key=len, reverse=True)
    prefix = F.regexp_extract(ref, "^&(" + "|".join(legacy) + ")", 0)
    entities = _map({"&" + name: char for name, char in html5.items()})
    named = entities[ref]
    by_prefix = F.when(
        prefix != "",
        F.concat(entities[prefix], F.substring(ref, F.length(prefix) + 1, F.length(ref))))
    return F.when(ref.startswith("&#"), _decode_number(ref)).otherwise(
        F.coalesce(named, by_prefix, ref))


def unescape_entities(text: Column) -> Column:
    """Resolve HTML character references once each; rows without ``&`` pass through."""
    parts = F.split(text, _REFERENCE)
    refs = F.regexp_extract_all(text, F.lit(_REFERENCE), F.lit(0))
    decoded = F.concat(F.transform(refs, _decode_reference), F.array(F.lit("")))
    rebuilt = F.array_join(F.zip_with(parts, decoded, lambda a, b: F.concat(a, b)), "")
    return F.when(F.contains(text, F.lit("&")), rebuilt).otherwise(text)


def strip_html(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(unescape_entities(text), F.lit("")), "<[^>]+>", " ")


def normalize_whitespace(text: Column) -> Column:
    text = F.coalesce(text, F.lit(""))
    return F.trim(F.regexp_replace(text, WHITESPACE + "+", " "))


def cap_length(text: Column, max_chars: int = MAX_CHARS) -> Column:
    def cap(t):
        return F.when(
            F.length(t) > max_chars,
            F.rtrim(F.substring(t, 1, max_chars), F.lit(WHITESPACE_CHARS))).otherwise(t)

    return bind(F.coalesce(text, F.lit("")), cap)


def clean_text(text: Column, max_chars: int | None = None) -> Column:
    """Unescape, strip tags, collapse whitespace; cap only where ``max_chars`` is given."""
    cleaned = normalize_whitespace(strip_html(text))
    return cleaned if max_chars is None else cap_length(cleaned, max_chars)


def is_blank(text: Column) -> Column:
    return text.isNull() | ~text.rlike(NON_WHITESPACE)


def strip(text: Column) -> Column:
    return F.btrim(F.coalesce(text, F.lit("")), F.lit(WHITESPACE_CHARS))


def char_count(text: Column) -> Column:
    return F.length(text)


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(NON_WHITESPACE + "+"))


def full_text(title: Column, text: Column) -> Column:
    """``title. text``; an empty title adds nothing."""
    lead = bind(strip(title), lambda t: F.when(t != "", F.concat(t, F.lit(". "))).otherwise(""))
    return F.concat(lead, strip(text))


def full_text_once(title: Column, text: Column) -> Column:
    """As :func:`full_text`, but a text that already starts with the title stays alone."""
    title, text = strip(title), strip(text)
    return F.when(
        (title != "") & ~F.startswith(text, title), F.concat(title, F.lit(". "), text)
    ).otherwise(text)


def ellipsize(text: Column, limit: int, keep: int) -> Column:
    """Texts longer than ``limit`` become their first ``keep`` characters and dots."""
    return F.when(
        F.length(text) > limit, F.concat(F.substring(text, 1, keep), F.lit("..."))
    ).otherwise(text)


def word_tokens(text: Column) -> Column:
    """Lower-case tokens of at least two word characters."""
    return F.regexp_extract_all(F.lower(text), F.lit(WORD_CHAR + "{2,}"), F.lit(0))


def word_runs(text: Column) -> Column:
    """The runs of word characters in lower case, single ones and empty strings between them: of these
    ``word_tokens`` gives the ones of two characters or more. Splitting costs a third of matching."""
    return F.split(F.lower(text), f"[^{WORD_CHAR[1:]}+")


def one_and_two_grams(tokens: Column) -> Column:
    """Tokens and neighbouring pairs; the tokens are found once, however often they are named here."""
    def grams(t):
        pairs = F.zip_with(
            F.slice(t, 1, F.greatest(F.size(t) - 1, F.lit(0))),
            F.slice(t, 2, F.greatest(F.size(t) - 1, F.lit(0))),
            lambda a, b: F.concat(a, F.lit(" "), b),
        )
        return F.concat(t, pairs)

    return bind(tokens, grams)


def first_word(text: Column) -> Column:
    return F.regexp_extract(text, f"^{WHITESPACE}*({NON_WHITESPACE}+)", 1)
