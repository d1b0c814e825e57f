import re

from cases import WORDS, frame, rows
from voxmill.llm import rules


def measured(text):
    text = text or ""
    words = WORDS.findall(text)
    lines = [x for x in text.split("\n") if WORDS.search(x)]
    places = {}
    for i in range(len(words) - 7):
        places.setdefault(tuple(words[i:i + 8]), []).append(i)
    covered = {i + k for v in places.values() if len(v) > 1 for i in v for k in range(8)}
    n = len(words)
    return {
        "n_words": n, "word_chars": sum(map(len, words)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered), "n_lines": len(lines),
        "n_stop_words": sum(w.lower() in rules.STOP_WORDS for w in words),
        "n_echo_words": sum(a == b for a, b in zip(words, words[1:])),
        "base_failed": n < 20 or 100 * len(covered) > 30 * n}


def test_counts_equal_brute_force(spark):
    docs = frame(spark)
    found = rules.quality_rules(docs)
    assert set(found.columns) == set(docs.columns) | set(rules.MEASURED) | {"base_failed"}
    result = found.collect()
    assert len(result) == len(rows())
    for r in result:
        assert {k: r[k] for k in measured(r.text)} == measured(r.text)
        assert r.size == "big" and not (r.kept and r.base_failed)


def test_verdict(spark):
    good = "the river and the old mill of the town lie in a wide valley that is green for most of the year"
    cases = [(1, good + " " + good.upper()), (2, good + " $ # % & < > * | $ #"), (3, "blue blue blue blue blue " * 6),
             (4, " ".join("w%dq" % i for i in range(120))), (5, "\n".join([good] * 3 + ["another line of text"])),
             (6, " ".join("x" * 20 + str(i) for i in range(30))), (7, None), (8, "")]
    found = rules.quality_rules(spark.createDataFrame(cases, "doc_id long, text string"))
    assert {r.doc_id for r in found.where("kept").collect()} == {1}


def test_empty_table_and_plan(spark):
    found = rules.quality_rules(frame(spark, []))
    assert found.count() == 0
    plan = rules.quality_rules(frame(spark).select("doc_id", "text"))._jdf.queryExecution().optimizedPlan().toString()
    assert "Python" not in plan and "Window" not in plan and "Aggregate" not in plan
