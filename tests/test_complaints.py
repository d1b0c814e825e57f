import re

from conftest import rows
from pyspark.sql import functions as F

from voxmill.functions import aspects as asp, lexicons as L
from voxmill.operators import complaints, scoring


def test_taxonomy(spark):
    sizes = dict(asp.taxonomy(spark).groupBy("domain").count().collect())
    assert sizes == {"Electronics": 9, "Fashion": 10}


def test_candidates(spark):
    df = spark.createDataFrame([("electronics",), ("FASHION",), ("",), (None,), ("Toys",)], "d string")
    got = [len(r[0]) for r in df.select(asp.candidate_aspects(F.col("d"))).collect()]
    assert got == [9, 10, 9, 9, 13]


def test_parse_aspects(spark):
    df = spark.createDataFrame(
        [("battery; quality; performance",), ("size_fit, material",), ("A|b;;",), ("",), (None,)],
        "s string")
    got = [r[0] for r in df.select(asp.parse_aspects(F.col("s"))).collect()]
    assert got == [["battery", "quality", "performance"], ["size_fit", "material"], ["a", "b"],
                   [], []]
    df = spark.createDataFrame([([" A ", ""],)], "s array<string>")
    assert df.select(asp.parse_aspects(F.col("s"), True)).first()[0] == ["a"]


def plain_tags(text, domain):
    """What the lexicon says, one Python pattern at a time."""
    low = text.lower()
    names = L.TAXONOMY[domain]
    found = [a for a in names
             if any(re.search(rf"\b(?:{p})\b", low) for p in L.REVIEW_LEXICON[a])]
    if not found and any(w in low for w in L.REVIEW_FALLBACK_WORDS):
        return ["quality"]
    return found


TEXTS = [
    "The battery dies fast and the wi-fi drops; see through fabric.", "Really bad.",
    "Nothing to say", "It was on time but late, waste of money", "Éclair batterie 日本 die",
    "wifi_x battery_ 2battery", "run  time", "run time", "badly made junkyard", "FADED colors",
    "help desk refused. True to size!", "not the right color", "rip-off rip off ripoff",
    "opened box, crushed box", "stopped working after a week", "", "cheaply made poorly made",
]


def test_tagger_agrees_with_the_patterns(spark):
    data = [(i, t, d) for i, t in enumerate(TEXTS) for d in ("Electronics", "Fashion")]
    every = [w for p in L.REVIEW_LEXICON.values() for q in p for w in asp.spelled_out(q)]
    data += [(100 + i, f"x {w}, y", d) for i, w in enumerate(every)
             for d in ("Electronics", "Fashion")]
    df = spark.createDataFrame(data, "i int, t string, d string")
    got = df.select("t", "d", asp.tag_aspects(F.col("t"), F.col("d"))).collect()
    assert [r[2] for r in got] == [plain_tags(t, d) for _, t, d in data]


def test_annotation_tagger(spark):
    df = spark.createDataFrame([
        ("Great sound but it broke", "electronics"), ("meh", "Fashion"),
        ("cheaply sewn waist", "Fashion"), (None, "x")], "t string, d string")
    got = [r[0] for r in df.select(asp.annotate_aspects(F.col("t"), F.col("d"))).collect()]
    assert got == [["performance", "durability"], ["quality"], ["quality", "size_fit"],
                   ["quality"]]


def test_display_names(spark):
    df = spark.createDataFrame([("size_fit",), ("odd_name",)], "a string")
    got = [r[0] for r in df.select(asp.display_name(F.col("a"))).collect()]
    assert got == ["Size & Fit", "Odd Name"]
    names = spark.createDataFrame([(a,) for a in L.ASPECTS], "a string")
    back = names.select("a", asp.unverbalize(asp.verbalize(F.col("a"))).alias("b"))
    assert back.where("a <> b").isEmpty()


def test_threshold(spark):
    df = spark.sql("select map('a', 0.35D, 'b', 0.349999D, 'c', 0.91239D) as m")
    row = df.select(asp.select_by_threshold(F.col("m"), 0.35).alias("x"),
                    asp.rounded_scores(F.col("m")).alias("r")).first()
    assert row.x == ["a", "c"] and row.r == {"a": 0.35, "b": 0.35, "c": 0.9124}


def test_question_intents(spark):
    cases = [
        ("Why are customers unhappy with this product?", "complaints"),
        ("What are the biggest complaints and problems?", "complaints"),
        ("What do customers like about this product?", "praises"),
        ("What are the best features loved by buyers?", "praises"),
        ("How is the battery life compared to expectation?", "general"),
        ("Do people like it or hate it?", "general"), ("Unlikely?", "general")]
    df = spark.createDataFrame([(q,) for q, _ in cases], "q string")
    assert [r[0] for r in df.select(asp.query_intent(F.col("q"))).collect()] == [
        i for _, i in cases]


def test_frequencies(spark):
    df = spark.createDataFrame([
        ("Electronics", "battery; quality"), ("Electronics", "battery; performance; battery"),
        ("Fashion", "size_fit; material"), ("Fashion", "size_fit; quality")],
        "domain string, aspect_labels string")
    parsed = df.withColumn("aspects", asp.parse_aspects(F.col("aspect_labels")))
    got = {(r.domain, r.aspect): (r.n, r.total_reviews, r.frequency_pct)
           for r in complaints.aspect_frequencies(parsed).collect()}
    assert got[("Electronics", "battery")] == (2, 2, 100.0)
    assert got[("Fashion", "size_fit")] == (2, 2, 100.0)
    assert got[("All", "quality")] == (2, 4, 50.0)
    share = {r.domain: r.pct_multi for r in complaints.multi_aspect_share(parsed).collect()}
    assert share == {"Electronics": 100.0, "Fashion": 100.0}
    bars = complaints.annotation_statistics(df).where("aspect = 'battery'").first()
    assert bars.bar == "=" * 25


def test_multilabel_evaluation(spark):
    df = spark.createDataFrame([
        (["battery", "quality"], ["battery", "performance"]), (["size_fit"], ["size_fit"]),
        (["durability", "material"], ["durability", "material"])],
        "truth array<string>, predicted array<string>")
    summary, per_label = complaints.multilabel_evaluation(df, "truth", "predicted")
    s = summary.first()
    assert (s.sample_count, s.aspect_count, s.micro_precision, s.micro_recall, s.micro_f1,
            s.macro_f1) == (3, 6, 0.8, 0.8, 0.8, 0.6667)
    by = {r.label: r for r in per_label.collect()}
    assert by["size_fit"].f1 == 1.0 and by["battery"].precision == 1.0
    targets = spark.createDataFrame([("battery",), ("color",)], "label string")
    summary, per_label = complaints.multilabel_evaluation(df, "truth", "predicted", [], targets)
    assert summary.first().aspect_count == 2
    assert {r.label: r.f1 for r in per_label.collect()} == {"battery": 1.0, "color": 0.0}


def test_annotation_set(spark):
    data = [(i, "Electronics" if i % 2 else "Fashion", "negative" if i % 3 else "positive",
             "Bad", "Bad sound and a broken cable after one week " + str(i)) for i in range(60)]
    data.append((99, "Fashion", "negative", "t", "short"))
    df = spark.createDataFrame(
        data, "row_id long, domain string, sentiment string, title string, text string")
    got = complaints.annotation_set(df, per_domain=5).orderBy("review_id").collect()
    assert [r.review_id for r in got] == [f"{p}-{i:03d}" for p in ("ELEC", "FASH")
                                          for i in range(1, 6)]
    assert all(not r.text.startswith("Bad. Bad") for r in got)


def test_breakdown_ranks_and_ties(spark):
    df = spark.createDataFrame([
        ("P", "negative", ["b", "a"]), ("P", "negative", ["a", "a"]), ("P", "positive", ["z"]),
        ("P", "negative", ["c"]), ("Q", "negative", []), ("R", "positive", ["a"])],
        "parent_asin string, sentiment string, aspects array<string>")
    got = rows(complaints.complaint_breakdown(df),
               "parent_asin", "rank", "aspect", "n", "total_negatives", "percentage")
    assert got == [("P", 1, "a", 2, 3, 66.7), ("P", 2, "b", 1, 3, 33.3), ("P", 3, "c", 1, 3, 33.3)]


def test_batch_scorer(spark):
    def length_scorer():
        def score(texts, domains):
            return [{"long": float(len(t)), d: 3.0} for t, d in zip(texts, domains)]
        return score

    df = spark.createDataFrame([(1, "abcde", "x"), (2, "ab", "y")],
                               "row_id long, text string, domain string")
    label, score = scoring.best_label()
    got = scoring.score_texts(df, length_scorer).select("row_id", label, score)
    assert rows(got) == [(1, "long", 5.0), (2, "y", 3.0)]
    some = scoring.score_where(df, F.col("row_id") == 1, length_scorer)
    assert {r.row_id: len(r.scores) for r in some.collect()} == {1: 2, 2: 0}


def test_lexicon_scores_with_a_python_scorer(spark):
    """The pluggable path and the column expression give the same score maps."""
    lexicon, taxonomy = dict(L.REVIEW_LEXICON), dict(L.TAXONOMY)

    def factory():
        def score(texts, domains):
            return [{a: sum(bool(re.search(rf"\b(?:{p})\b", t.lower())) for p in lexicon[a])
                     / len(lexicon[a]) for a in taxonomy[d]} for t, d in zip(texts, domains)]
        return score

    data = [(i, t, "Fashion" if i % 2 else "Electronics") for i, t in enumerate(TEXTS)]
    df = spark.createDataFrame(data, "row_id long, text string, domain string")
    udf = {r.row_id: r.scores for r in scoring.score_texts(df, factory).collect()}
    col = {r[0]: r[1] for r in df.select(
        "row_id", asp.lexicon_scores(F.col("text"), F.col("domain"))).collect()}
    assert udf == col
