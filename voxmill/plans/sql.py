"""SQL fragments shared by the check queries (DuckDB dialect)."""

from __future__ import annotations

from voxmill.functions import lexicons as L

WS = r"[\t-\r\x1c-\x20\x{85}\p{Z}]"
NWS = r"[^\t-\r\x1c-\x20\x{85}\p{Z}]"
EDGE = r"[^\p{L}\p{N}_]"


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def label(rating: str) -> str:
    return (f"CASE WHEN {rating} <= 2 THEN 'negative' WHEN {rating} = 3 THEN 'neutral' "
            f"WHEN {rating} >= 4 THEN 'positive' END")


def squeeze(e: str) -> str:
    return f"trim(regexp_replace(coalesce({e}, ''), '{WS}+', ' ', 'g'))"


def unescape(e: str) -> str:
    """The references the test pages hold; they count with and without their semicolon."""
    pairs = [("&lt", "<"), ("&gt", ">"), ("&quot", '"'), ("&copy", "©"), ("&middot", "·"),
             ("&nbsp", " "), ("&amp", "&")]
    for name, char in pairs:
        e = f"regexp_replace({e}, '{name};?', '{char}', 'g')"
    return e


def clean(e: str, cap: int | None = None) -> str:
    inner = squeeze(f"regexp_replace({unescape(e)}, '<[^>]+>', ' ', 'g')")
    return f"rtrim(left({inner}, {cap}))" if cap else inner


def words(e: str) -> str:
    return f"len(regexp_extract_all({e}, '{NWS}+'))"


def strip(e: str) -> str:
    return f"regexp_replace(coalesce({e}, ''), '^{WS}+|{WS}+$', '', 'g')"


def full_text(title: str = "title", text: str = "text") -> str:
    return (f"(CASE WHEN {strip(title)} <> '' THEN {strip(title)} || '. ' ELSE '' END || "
            f"{strip(text)})")


def has_word(e: str, alternatives) -> str:
    body = "|".join(alternatives)
    return f"regexp_matches({e}, {quoted(f'(?:^|{EDGE})(?:{body})(?:$|{EDGE})')})"


def _domain(aspect: str, domain: str, unknown: str) -> str:
    in_elec = aspect in L.TAXONOMY["Electronics"]
    in_fash = aspect in L.TAXONOMY["Fashion"]
    if in_elec and in_fash:
        return "TRUE"
    if unknown == "Electronics":
        return f"{domain} <> 'Fashion'" if in_elec else f"{domain} = 'Fashion'"
    return f"{domain} = 'Electronics'" if in_elec else f"{domain} <> 'Electronics'"


def _listed(conditions: dict[str, str]) -> str:
    cells = ", ".join(f"CASE WHEN {c} THEN '{a}' END" for a, c in conditions.items())
    return f"list_filter([{cells}], lambda x: x IS NOT NULL)"


def tags(text: str, domain: str) -> str:
    found = _listed({
        a: f"({_domain(a, domain, 'Electronics')}) AND "
           f"{has_word(f'lower({text})', L.REVIEW_LEXICON[a])}" for a in L.ASPECTS})
    bad = f"regexp_matches(lower({text}), '{'|'.join(L.REVIEW_FALLBACK_WORDS)}')"
    return f"CASE WHEN len({found}) = 0 AND {bad} THEN ['quality'] ELSE {found} END"


def annotated(text: str, domain: str) -> str:
    hit = {a: f"({_domain(a, domain, 'Fashion')}) AND "
              f"{has_word(f'lower({text})', L.ANNOTATION_LEXICON[a])}" for a in L.ASPECTS}
    forced = f"regexp_matches(lower({text}), '{'|'.join(L.ANNOTATION_QUALITY_WORDS)}')"
    hit["quality"] = f"({hit['quality']}) OR {forced}"
    found = _listed(hit)
    return f"CASE WHEN len({found}) = 0 THEN ['quality'] ELSE {found} END"


def score(aspect: str, text: str) -> str:
    groups = L.REVIEW_LEXICON[aspect]
    hits = " + ".join(
        f"CASE WHEN {has_word(f'lower({text})', [g])} THEN 1 ELSE 0 END" for g in groups)
    return f"(({hits}) / {float(len(groups))})"


def display(aspect: str) -> str:
    cases = " ".join(f"WHEN '{a}' THEN {quoted(n)}" for a, n in L.DISPLAY_NAMES.items())
    return f"CASE {aspect} {cases} END"


DOC = f"""doc_reviews AS (
  SELECT *, {label('rating')} AS sentiment FROM (
    SELECT d.doc_id AS row_id,
      (CASE WHEN l.toxic = 1 THEN 1 WHEN l.quality = 0 THEN 2 WHEN l.quality = 1 THEN 5
            ELSE 3 END)::DOUBLE AS rating,
      regexp_extract(d.text, '^{WS}*({NWS}+)', 1) AS title, d.text, d.source AS parent_asin,
      CASE WHEN d.lang = 'en' THEN 'Electronics' ELSE 'Fashion' END AS domain
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id))"""

_PART_DOMAIN = ("CASE WHEN p_type IN ('SMALL', 'MEDIUM', 'LARGE') THEN 'Fashion' "
                "ELSE 'Electronics' END")

ITEM = f"""item_reviews AS (
  SELECT *, {label('rating')} AS sentiment FROM (
    SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS review_key,
      l_orderkey * 8 + l_linenumber AS row_id,
      'P' || l_partkey AS parent_asin,
      (1 + (l_orderkey + 3 * l_linenumber) % 5)::DOUBLE AS rating,
      CASE l_returnflag WHEN 'R' THEN 'negative' WHEN 'N' THEN 'neutral' ELSE 'positive' END
        AS predicted_sentiment,
      p_name AS title, p_name || ' ' || lower(p_type) || ' ' || p_brand AS text,
      greatest(l_quantity - 30, 0)::BIGINT AS helpful_vote,
      l_linestatus = 'F' AS verified_purchase,
      {_PART_DOMAIN} AS domain
    FROM lineitem JOIN part ON l_partkey = p_partkey))"""

META = f"""metadata AS (
  SELECT p_partkey AS row_id, {_PART_DOMAIN} AS domain, 'P' || p_partkey AS parent_asin,
    p_name AS title, (1 + p_size % 5)::DOUBLE AS average_rating,
    p_retailprice::VARCHAR AS price, p_name || ' ' || p_brand AS description,
    p_type || '|' || p_brand AS categories, p_brand AS store
  FROM part)"""

#: Without the largest sizes, so that some products have no metadata.
GAPS = META.replace("FROM part)", "FROM part WHERE p_size <= 40)")

VEC = f"""vec_reviews AS (
  SELECT *, {label('rating')} AS sentiment FROM (
    SELECT vec_id AS row_id, 'V' || label AS parent_asin, embedding::DOUBLE[] AS vec,
      (1 + vec_id % 5)::DOUBLE AS rating FROM embeddings))"""

PRED = f"""{ITEM},
predictions AS (
  SELECT domain, review_key AS sample_id, sentiment AS y_true, 'flag' AS model,
    predicted_sentiment AS y_pred FROM item_reviews
  UNION ALL
  SELECT domain, review_key, sentiment, 'votes',
    CASE WHEN helpful_vote > 12 THEN 'negative' WHEN helpful_vote > 4 THEN 'neutral'
         ELSE 'positive' END FROM item_reviews
  UNION ALL
  SELECT domain, review_key, sentiment, 'near',
    CASE WHEN rating + helpful_vote % 2 <= 2 THEN 'negative'
         WHEN rating + helpful_vote % 2 <= 3 THEN 'neutral' ELSE 'positive' END
  FROM item_reviews)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"
