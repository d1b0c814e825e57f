"""The corpus queries ``opN_<name>``, each over its whole table, with the SQL they are checked by."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxmill.llm import (
    classifier, dialogues, divergence, exact, extraction, minhash, mixing, packing, repeats, rules, secrets, sharding,
    suffixtree,
)
from voxmill.llm.common import documents, stored

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(function):
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function

    return register


@query("""
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
  doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))""")
def op1_radix_dedup(spark, sf):
    docs = documents(spark, sf).select("doc_id", "text")
    return exact.exact_groups(docs, carry_text=False)


def _draw(key: str, salt: str) -> str:
    return (f"((('0x' || substr(md5({key} || ':' || {salt}), 1, 13))::BIGINT)::DOUBLE + 0.5)"
            " / 4503599627370496.0")


@query()
def op2_best_fit_packing(spark, sf):
    return packing.packed_placements(documents(spark, sf))


#: The hot source is brought down to the share of each other one.
MIX_WEIGHTS: dict[str, float] = {}


@query(f"""
WITH RECURSIVE sizes AS (
  SELECT source, sum(strlen(coalesce(text, '')))::DOUBLE AS bytes FROM documents GROUP BY source),
rates AS (
  SELECT source, 1.0 / (SELECT count(*) FROM sizes)::DOUBLE * 1.0 * (SELECT sum(bytes) FROM sizes)
    / bytes AS rate FROM sizes WHERE bytes > 0),
steps AS (
  SELECT source, rate, 0 AS k, exp(-rate) AS term, exp(-rate) AS total FROM rates
  UNION ALL
  SELECT source, rate, k + 1, term * rate / (k + 1), total + term * rate / (k + 1) FROM steps
  WHERE k < ceil(rate + 12 * sqrt(rate) + 40)),
inverse AS (SELECT source, any_value(rate) AS rate, list(total) AS totals FROM steps GROUP BY source),
counted AS (
  SELECT doc_id, d.source, rate,
    len(list_filter(totals, lambda x: x <= {_draw("coalesce(doc_id::VARCHAR, '')", "'mix:1'")})) AS n
  FROM documents d JOIN inverse i ON d.source IS NOT DISTINCT FROM i.source)
SELECT doc_id, source, unnest(range(n))::INTEGER AS copy, round(rate, 6) AS mix_rate FROM counted""")
def op3_mix_sources(spark, sf):
    """The corpus mixed so that every source gives the same share of its text."""
    docs = documents(spark, sf)
    mixed = mixing.mix(docs, weights=MIX_WEIGHTS)
    return mixed.select("doc_id", "source", "copy", F.round("mix_rate", 6).alias("mix_rate"))


_STOPS = ", ".join(f"'{w}'" for w in rules.STOP_WORDS)


@query(rf"""
WITH split AS (
  SELECT doc_id, coalesce(text, '') AS text,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]'))
      AS lines FROM documents),
places AS (SELECT doc_id, unnest(words) AS word, unnest(range(len(words))) AS i, len(words) AS n FROM split),
windows AS (
  SELECT doc_id, i, n, concat_ws(' ', word, {", ".join(f"lead(word, {k}) OVER w" for k in range(1, 8))}) AS win,
    lag(word) OVER w = word AS echo
  FROM places WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
repeated AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, win) AS c
    FROM windows WHERE i <= n - 8) WHERE c > 1),
covered AS (SELECT doc_id, count(DISTINCT i + k) AS c FROM repeated, range(8) t(k) GROUP BY doc_id),
echoes AS (SELECT doc_id, count(*) FILTER (echo) AS c FROM windows GROUP BY doc_id),
counts AS (
  SELECT s.doc_id, len(words) AS n_words,
    length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
    len(lines) - len(list_distinct(lines)) AS n_dup_lines,
    coalesce(c.c, 0)::BIGINT AS n_repeat_words, len(lines) AS n_lines,
    len(list_filter(words, lambda x: list_contains([{_STOPS}], lower(x)))) AS n_stop_words,
    coalesce(e.c, 0)::BIGINT AS n_echo_words
  FROM split s LEFT JOIN covered c USING (doc_id) LEFT JOIN echoes e USING (doc_id))
SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
  NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words)
  AND word_chars / n_words BETWEEN 2.0 AND 15.0 AND n_symbols / n_words <= 0.1
  AND n_echo_words / n_words <= 0.3 AND (n_words < 100 OR n_stop_words / n_words >= 0.02)
  AND n_dup_lines / n_lines <= 0.5 AS kept
FROM counts""")
def op4_quality_rules(spark, sf):
    docs = documents(spark, sf).select("doc_id", "text")
    return rules.quality_rules(docs).drop("text")


#: The checksum by its definition: a table of 256 remainders, then one step per byte.
_CRC = """xor(4294967295, list_reduce(
  list_transform(range(strlen(text)), lambda i: ('0x' || substr(hex(encode(text)), 2 * i + 1, 2))::BIGINT),
  lambda crc, byte: xor(crc >> 8, steps[(xor(crc, byte) & 255) + 1]),
  4294967295::BIGINT))"""


@query(f"""
WITH RECURSIVE bits AS (
  SELECT b, b AS r, 0 AS k FROM range(256) t(b) UNION ALL
  SELECT b, CASE WHEN r & 1 = 1 THEN xor(r >> 1, 3988292384) ELSE r >> 1 END, k + 1 FROM bits WHERE k < 8),
remainders AS (SELECT list(r ORDER BY b) AS steps FROM bits WHERE k = 8),
named AS (
  SELECT doc_id, coalesce(doc_id::VARCHAR, '') AS name, coalesce(text, '') AS text FROM documents),
scored AS (
  SELECT *, [{", ".join("-1.0 / ln(" + _draw("name", f"'{i}'") + ")" for i in range(17))}] AS scores,
    floor({_draw("name", "'slot'")} * ceil((SELECT count(*) FROM documents) / 20000.0))::INTEGER AS bucket
  FROM named),
dealt AS (
  SELECT *, (list_position(scores[1:16], list_max(scores[1:16])) - 1)::INTEGER AS shard,
    (list_position(scores, list_max(scores)) - 1)::INTEGER AS grown_shard,
    strlen(text) + 1 AS size FROM scored)
SELECT doc_id, size, 'key' AS law, shard, grown_shard, {_CRC} AS text_crc32,
  row_number() OVER (PARTITION BY shard ORDER BY bucket, doc_id NULLS FIRST) - 1 AS slot
FROM dealt, remainders""")
def op5_rendezvous_shards(spark, sf):
    docs = documents(spark, sf).select("doc_id", "text")
    return sharding.shard(docs).withColumn("law", F.lit("key"))


def _span_list(spans):
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


@query()
def op6_secret_scan(spark, sf):
    found = secrets.find_secrets(documents(spark, sf))
    of = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    base = F.filter("spans", lambda s: s["kind"].isin([r.kind for r in secrets.BASE_RULES]))
    return found.select(
        "doc_id", *[of(r.kind).alias(f"n_{r.kind}") for r in secrets.BASE_RULES],
        F.sha2(_span_list(base), 256).alias("base_sha256"), _span_list("spans").alias("spans"))


@query()
def op7_repeated_passages(spark, sf):
    return repeats.repeated_bytes(documents(spark, sf))


@query()
def op8_minhash_near_dedup(spark, sf):
    found = minhash.near_duplicates(documents(spark, sf), size=4)
    return found.withColumnRenamed("_id", "doc_id").drop("_key")


def _fold(column: str, folds: int):
    return F.crc32(F.col(column).cast("string")) % folds


@query()
def op9_suffix_tree_scores(spark, sf):
    """Learned from fold 1 to 9 of 10, applied to all."""
    scored = suffixtree.score(documents(spark, sf), train=_fold("doc_id", 10) != 0)
    return scored.select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known",
                         "train_tokens", "base_score", "score")


@query()
def op10_quality_classifier(spark, sf):
    """Learned from labelled rows outside fold 2 of 4, applied to all."""
    docs = documents(spark, sf)
    labels = spark.read.parquet(f"{sf}/labels.parquet").where(_fold("doc_id", 4) != 2)
    scored = classifier.score(docs, classifier.fit(docs, labels))
    return scored.select(
        "doc_id", F.coalesce(_fold("doc_id", 4) == 2, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"))



@query(f"""
WITH RECURSIVE bits AS (
  SELECT b, b AS r, 0 AS k FROM range(256) t(b) UNION ALL
  SELECT b, CASE WHEN r & 1 = 1 THEN xor(r >> 1, 3988292384) ELSE r >> 1 END, k + 1 FROM bits WHERE k < 8),
remainders AS (SELECT list(r ORDER BY b) AS steps FROM bits WHERE k = 8),
named AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS content,
    coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS text FROM conversations),
folded AS (SELECT * EXCLUDE (text, steps), {_CRC} % 20 AS fold FROM named, remainders),
damaged AS (
  SELECT conv_id, turn, CASE fold WHEN 4 THEN 'user' ELSE role END AS role,
    CASE fold WHEN 1 THEN '' WHEN 2 THEN regexp_replace(content, '[.!?]', '', 'g') ELSE content END AS text
  FROM folded, range(2) c(copy) WHERE fold <> 0 AND (copy = 0 OR fold = 3)),
ordered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id
    ORDER BY turn NULLS FIRST, role, sha256(length(role) || ':' || role || text)) AS i,
    rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS trimmed FROM damaged),
judged AS (
  SELECT *, left(role, 1) AS initial, left(lag(role) OVER w, 1) || left(role, 1) AS pair,
    CASE WHEN trimmed = '' THEN 'blank'
      WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
      WHEN right(trimmed, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault
  FROM ordered WINDOW w AS (PARTITION BY conv_id ORDER BY i)),
moves AS (SELECT * FROM (VALUES
  (0, 's', 1, 0, 'K', '', ''), (0, 'u', 2, 0, 'K', '', ''), (1, 'u', 2, 0, 'K', '', ''), (3, 'u', 2, 0, 'K', '', ''),
  (2, 'a', 3, 0, 'K', '', ''), (2, 'u', 2, 2, 'IK', 'assistant', ''), (0, 'a', 3, 2, 'IK', 'user', ''),
  (1, 'a', 3, 2, 'IK', 'user', ''), (3, 'a', 3, 2, 'IK', 'user', ''),
  (0, '', 2, 2, 'R', '', 'user'), (1, '', 2, 2, 'R', '', 'user'), (3, '', 2, 2, 'R', '', 'user'),
  (2, '', 3, 2, 'R', '', 'assistant'), (2, '', 2, 4, 'IR', 'assistant', 'user'), (0, '', 3, 4, 'IR', 'user', 'assistant'),
  (1, '', 3, 4, 'IR', 'user', 'assistant'), (3, '', 3, 4, 'IR', 'user', 'assistant'),
  (0, '', 0, 3, 'D', '', ''), (1, '', 1, 3, 'D', '', ''), (2, '', 2, 3, 'D', '', ''), (3, '', 3, 3, 'D', '', ''))
  m(q, needs, to_q, cost, edits, inserted, role)),
ways AS (
  SELECT conv_id, 0::BIGINT AS i, 0 AS q, {{'cost': 0::BIGINT, 'edits': '', 'lines': []::VARCHAR[]}} AS way
  FROM (SELECT DISTINCT conv_id FROM conversations)
  UNION ALL
  SELECT w.conv_id, w.i + 1, m.to_q, min({{
    'cost': w.way.cost + m.cost + (fault = 'truncated' AND edits <> 'D')::BIGINT,
    'edits': w.way.edits || m.edits,
    'lines': w.way.lines || CASE WHEN inserted = '' THEN []::VARCHAR[] ELSE [inserted || ':'] END
      || CASE WHEN edits = 'D' THEN []::VARCHAR[] ELSE [coalesce(nullif(m.role, ''), j.role) || ':' || text] END}})
  FROM ways w JOIN judged j ON j.conv_id IS NOT DISTINCT FROM w.conv_id AND j.i = w.i + 1
  JOIN moves m ON m.q = w.q AND (m.needs = '' OR m.needs = j.initial)
    AND (m.edits = 'D' OR fault NOT IN ('blank', 'duplicate'))
  GROUP BY w.conv_id, w.i, m.to_q),
ends AS (
  SELECT w.conv_id, min({{
    'cost': way.cost + CASE q WHEN 1 THEN 4 WHEN 2 THEN 2 ELSE 0 END,
    'edits': way.edits || CASE q WHEN 1 THEN 'II' WHEN 2 THEN 'I' ELSE '' END,
    'lines': way.lines || CASE q WHEN 1 THEN ['user:', 'assistant:'] WHEN 2 THEN ['assistant:']
      ELSE []::VARCHAR[] END}}) AS way
  FROM ways w JOIN (SELECT conv_id, max(i) AS i FROM ways GROUP BY conv_id) l
    ON l.conv_id IS NOT DISTINCT FROM w.conv_id AND l.i = w.i GROUP BY w.conv_id),
facts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM judged GROUP BY conv_id)
SELECT e.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, way.cost AS cost, way.edits AS audit,
  sha256(array_to_string(way.lines, chr(10))) AS repaired_sha256
FROM ends e LEFT JOIN facts f ON e.conv_id IS NOT DISTINCT FROM f.conv_id""")
def op11_conversation_repair(spark, sf):
    """Damaged conversations, repaired; also those of which the damage left nothing."""
    turns = spark.read.parquet(f"{sf}/conversations.parquet")
    bad = dialogues.damaged(turns)
    parts = stored(dialogues.repair(bad), "repaired")
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    pieces = [turns.select("conv_id"), dialogues.turn_gaps(bad),
              parts.select("conv_id", *counts[1:], F.struct("part", "audit").alias("audit")),
              dialogues.digests(parts)]
    whole = pieces[0]
    for piece in pieces[1:]:
        whole = whole.unionByName(piece, allowMissingColumns=True)
    edits = F.transform(F.array_sort(F.collect_list("audit")), lambda x: x["audit"])
    return whole.groupBy("conv_id").agg(
        *[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in counts],
        F.array_join(edits, "").alias("audit"),
        F.coalesce(F.max("sha256"), F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@query(rf"""
WITH docs AS (
  SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    coalesce(text, '') AS text FROM documents),
words AS (
  SELECT row, lang, source, unnest(regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'),
    '[a-z\x{{80}}-\x{{10FFFF}}]+')) AS term FROM docs),
kept AS (
  SELECT lang, term, count(*) AS n FROM words GROUP BY lang, term HAVING count(DISTINCT row) >= 3),
langs AS (SELECT lang, count(*) AS v, sum(n) AS n FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM docs),
counts AS (SELECT lang, source, term, count(*) AS c FROM words GROUP BY lang, source, term),
filled AS (
  SELECT g.lang, g.source, k.term, coalesce(c.c, 0) AS c, k.n AS lang_c, l.v, l.n AS lang_n,
    sum(coalesce(c.c, 0)) OVER (PARTITION BY g.lang, g.source) AS n
  FROM groups g JOIN kept k USING (lang) JOIN langs l USING (lang)
  LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
shares AS (
  SELECT lang, source, term, c, (1 + 1000000000::HUGEINT * (c + 1) // (n + v))::HUGEINT AS p,
    (1 + 1000000000::HUGEINT * (lang_c + 1) // (lang_n + v))::HUGEINT AS q FROM filled),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(x.value, 0)::BIGINT AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (
    SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
    FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
    GROUP BY ALL) x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source),
ranked AS (
  SELECT lang, source, 'pair' AS part, item, value FROM pairs UNION ALL
  SELECT lang, source, 'term', term, ((p - q) * (p - q) // q)::BIGINT FROM shares WHERE c > 0 AND p > q)
SELECT *, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INTEGER AS rank
FROM ranked QUALIFY part = 'pair' OR rank <= 200""")
def op13_source_divergence(spark, sf):
    return divergence.divergence_audit(documents(spark, sf))


@query()
def op12_main_text(spark, sf):
    found = extraction.extract(spark.read.parquet(f"{sf}/pages.parquet"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
