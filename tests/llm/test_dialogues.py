import hashlib
import itertools
import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from voxmill.llm import dialogues, queries

SCHEMA = "conv_id long, turn long, role string, text string"
NEXT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}
NAMES = {"u": "user", "a": "assistant"}


def ordered(turns):
    what = lambda r: hashlib.sha256(f"{len(r[0])}:{r[0]}{r[1]}".encode()).hexdigest()
    rows = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in turns]
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], what(r[1:])))


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        trimmed = text.strip(dialogues.BLANKS)
        out.append("blank" if not trimmed else "duplicate" if (role, text) in seen
                   else "truncated" if trimmed[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(rows, marks):
    """A plain search over (rows read, state of the role automaton), for one conversation."""
    best = {(0, 0): (0, "", ())}
    for i in range(len(rows) + 1):
        for _ in range(4):  # insertions at this place
            for state in range(4):
                if (i, state) in best:
                    cost, audit, lines = best[i, state]
                    for initial, name in NAMES.items():
                        to = NEXT.get((state, initial))
                        if to is not None:
                            way = (cost + 2, audit + "I", (*lines, name + ":"))
                            best[i, to] = min(best.get((i, to), way), way)
        if i == len(rows):
            break
        _, role, text = rows[i]
        for state in range(4):
            if (i, state) not in best:
                continue
            cost, audit, lines = best[i, state]
            found = [(state, (cost + 3, audit + "D", lines))]
            if marks[i] not in ("blank", "duplicate"):
                extra = int(marks[i] == "truncated")
                found.append((NEXT.get((state, role[:1])), (cost + extra, audit + "K", (*lines, f"{role}:{text}"))))
                found += [(NEXT.get((state, x)), (cost + 2 + extra, audit + "R", (*lines, f"{name}:{text}")))
                          for x, name in NAMES.items()]
            for to, way in found:
                if to is not None:
                    best[i + 1, to] = min(best.get((i + 1, to), way), way)
    return min(best[len(rows), s] for s in (0, 3) if (len(rows), s) in best)


def expected(turns):
    """turns: (conv, turn, role, text) after damage."""
    groups, out = defaultdict(list), {}
    for conv, *turn in turns:
        groups[conv].append(turn)
    for conv, some in groups.items():
        rows = ordered(some)
        marks = faults(rows)
        cost, audit, lines = cheapest(rows, marks)
        numbers = [t for t, _, _ in rows if t is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(rows))
        out[conv] = (gaps, *(marks.count(m) for m in ("blank", "duplicate", "truncated")), illegal, cost, audit,
                     hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def conversations(n, longest, seed):
    draw = random.Random(seed)
    texts = ["Yes.", "No!", "Why?", "cut off", " \t", "", None, "Well.  \n", "One. two", "é.", "?"]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None, "us"]
    out = []
    for conv in range(n):
        for turn in range(draw.randint(0, longest)):
            text = draw.choice(texts)
            out.append((conv, draw.choice([turn, turn, turn, turn // 2, None]), draw.choice(roles),
                        text if draw.random() < 0.5 or not text else f"{turn} {text}"))
    return out + [(None, 1, "user", "Null id."), (None, 2, "assistant", "Yes."), (7, 3, "user", "x" * 5000 + ".")]


def reports(parts, conv="conv_id"):
    whole = defaultdict(list)
    for r in parts.collect():
        whole[r[conv]].append(r)
    sha = {r[0]: r[1] for r in dialogues.digests(parts, conv).collect()}
    out = {}
    for conv_id, some in whole.items():
        some.sort(key=lambda r: r.part)
        assert [r.part for r in some] == list(range(len(some))) and {r.parts for r in some} == {len(some)}
        out[conv_id] = (*(sum(r[c] for r in some) for c in ("blank", "duplicate", "truncated", "illegal", "cost")),
                        "".join(r.audit for r in some), sha[conv_id])
    return out


@pytest.mark.parametrize("part_rows, part_bytes, tasks", [(2000, 1 << 22, 3), (3, 1 << 22, 5), (100, 8, 2), (1, 1, 8)])
def test_repair_equals_a_plain_search(spark, part_rows, part_bytes, tasks):
    turns = conversations(40, 14, part_rows)
    held = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", tasks)
    try:
        df = spark.createDataFrame(turns, SCHEMA).withColumns({"part": F.lit("x"), "_what": F.lit(1), "rows": F.lit(2)})
        got = reports(dialogues.repair(df, part_rows=part_rows, part_bytes=part_bytes))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", held)
    assert got == {c: x[1:] for c, x in expected(turns).items()}


def test_one_conversation_of_many_rows_is_spread(spark):
    turns = [(5, i, ("user", "assistant")[i % 2], f"{i}." if i % 11 else "same.") for i in range(3000)]
    turns += [(5, 10, "user", "again.")] * 50
    parts = dialogues.repair(spark.createDataFrame(turns, SCHEMA), part_rows=100)
    assert parts.count() >= 30
    assert reports(parts)[5] == expected(turns)[5][1:]


def test_gaps(spark):
    turns = [(1, 3, "user", "a"), (1, 7, "user", "a"), (1, 7, "user", "b"), (1, None, "user", "c"), (2, None, None, None)]
    got = {r[0]: r[1] for r in dialogues.turn_gaps(spark.createDataFrame(turns, SCHEMA)).collect()}
    assert got == {1: 3, 2: 0}


def damage(turns):
    import zlib
    for conv, turn, role, text in turns:
        show = lambda x: " " if x is None else str(x)
        fold = zlib.crc32(f"{show(conv)}:{show(turn)}".encode()) % 20
        role, text = show(role), show(text)
        if fold:
            row = (conv, turn, "user" if fold == 4 else role,
                   "" if fold == 1 else re.sub("[.!?]", "", text) if fold == 2 else text)
            yield from [row] * (2 if fold == 3 else 1)


def test_query_equals_brute_force(spark, tmp_path):
    turns = conversations(60, 12, 9) + [(1000, 0, "user", "x.")]
    assert not [r for r in damage([(i, 0, "", "") for i in range(2000, 2100)]) if r[0] is None]
    gone = next(i for i in range(3000, 4000) if not list(damage([(i, 0, "user", "Gone.")])))
    turns.append((gone, 0, "user", "Gone."))
    spark.createDataFrame(turns, SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r.conv_id: tuple(r[c] for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit",
                                           "repaired_sha256"))
           for r in queries.QUERIES["op11_conversation_repair"](spark, str(tmp_path)).collect()}
    want = expected(damage(turns))
    for conv in {t[0] for t in turns} - want.keys():
        want[conv] = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert gone in want and got == want


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert dialogues.repair(empty).count() == 0
    assert dialogues.digests(dialogues.repair(empty)).count() == 0


def test_a_grammar_with_endless_stacks_is_refused():
    with pytest.raises(ValueError, match="too many stacks"):
        dialogues.StackGraph({"C": ("", "P"), "P": ("T", "TP"), "T": ("ua",)}, "ua")


def test_an_ambiguous_grammar_gives_the_same_costs():
    plain = dialogues.Repairer(dialogues.StackGraph(dialogues.ROLE_GRAMMAR, "ua"))
    doubled = dialogues.Repairer(dialogues.StackGraph(
        {"C": ("", "P", "sP"), "P": ("T", "U", "PT", "PU"), "T": ("ua",), "U": ("ua",)}, "ua"))
    draw = random.Random(1)
    for _ in range(200):
        rows = [(draw.choice("suax"), draw.randint(0, 3), 1) for _ in range(draw.randint(0, 9))]
        ways = [r.finished(r.whole(rows, {0: (0, "", "")})) for r in (plain, doubled)]
        assert ways[0] == ways[1]
