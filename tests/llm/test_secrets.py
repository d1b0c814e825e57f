import re

import pytest

from cases import documents, frame, rows, texts
from voxmill.llm import secrets


def brute(text, rule_set=secrets.RULES):
    found = []
    for order, rule in enumerate(rule_set):
        found += [(m.start(), order, rule.kind, m.end()) for m in re.finditer(rule.pattern, text or "")
                  if len(m[rule.group]) >= rule.least]
    return [(kind, a, b) for a, _, kind, b in sorted(found)]


CASES = [
    "PassWord: abc123 passwd='secret9' token==x12345 api_key =  ABCDEF apikey:\"zzzzzz\"",
    "ſecret: abcdef toKen: abcdef", "secret: short secret:\tabcdef", "漢字 token=abcdefg é " + "f" * 24,
    "AKIA" + "A" * 16, "AKIA" + "A" * 15, "AKIAAKIA" + "Z" * 40, "a" * 23, "a" * 24 + "g" + "b" * 30, "A" * 30,
    "-----BEGIN RSA PRIVATE KEY-----", "https://user:pa55@host/x", "ghp_" + "a1" * 20,
    "eyJhbGciOiJI.eyJzdWIiOiIx.SflKxwRJSMeK", "password" * 500 + "=abcdefg",
]


def test_spans_equal_brute_force(spark):
    pairs = list(enumerate(CASES + texts()))
    got = {r.doc_id: [tuple(s) for s in r.spans] for r in secrets.find_secrets(documents(spark, pairs)).collect()}
    assert got == {i: brute(t) for i, t in pairs}
    assert sum(map(len, got.values())) > 12


def test_base_patterns_equal_their_plain_form():
    plain = re.compile(r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    ours = re.compile(secrets.BASE_RULES[0].pattern)
    runs = re.compile("[0-9a-f]+")
    for text in CASES:
        assert [m.span() for m in plain.finditer(text)] == [m.span() for m in ours.finditer(text)]
        assert [m.span() for m in runs.finditer(text) if len(m[0]) >= 24] == [
            m.span() for m in re.finditer(secrets.BASE_RULES[2].pattern, text)]


@pytest.mark.parametrize("pattern, query", [
    ("abcd", [[{"abc", "bcd"}]]),
    ("(foo|barn)x?", [[{"foo"}, {"bar", "arn"}]]),
    ("abc[0-9]+def", [[{"abc"}], [{"def"}]]),
    ("[0-9a-f]{24,}", []),
    ("ab", []),
    ("(ab[cd])+", [[{"abc"}, {"abd"}]]),
    ("(abc)?def", [[{"def"}]]),
    ("(abc)*xyz", [[{"xyz"}]]),
])
def test_trigram_queries(pattern, query):
    got = [[{g.decode() for g in option} for option in clause] for clause in secrets.trigram_query(pattern)]
    assert sorted(map(str, [sorted(map(sorted, c)) for c in got])) == sorted(
        map(str, [sorted(map(sorted, c)) for c in query]))


def test_queries_never_lose_a_match():
    for rule in secrets.RULES:
        index = secrets.TrigramIndex([secrets.trigram_query(rule.pattern)])
        data = [t.encode() for t in CASES]
        candidates = set(index.candidates(secrets.trigram_query(rule.pattern), index.postings(data)).tolist())
        assert {i for i, t in enumerate(CASES) if re.search(rule.pattern, t)} <= candidates


def test_odd_rows_and_empty_table(spark):
    found = secrets.find_secrets(frame(spark)).collect()
    assert len(found) == len(rows())
    assert all(r.spans is not None for r in found)
    assert secrets.find_secrets(frame(spark, [])).count() == 0
