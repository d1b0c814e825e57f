import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from voxmill.functions import vectors
from voxmill.operators import answers, retrieval
from voxmill.sources import views


def make(spark, n=600, dims=8, seed=3):
    """A third of the reviews and of the queries belong to one product."""
    pick = np.random.default_rng(seed)
    reviews, queries = [], []
    for i in range(n):
        product = "HOT" if i % 3 == 0 else f"P{i % 40}"
        vec = pick.normal(size=dims).round(1).tolist()
        if i % 50 == 0:
            vec = [1.0] * dims  # equal vectors: ties go to the lower id
        rating = float(1 + i % 5)
        label = "negative" if rating <= 2 else "neutral" if rating == 3 else "positive"
        reviews.append((i, product, vec, rating, label, "negative" if i % 11 == 0 else None))
    questions = ["Why unhappy?", "What do people love?", "How is it?"]
    for i in range(60):
        product = "HOT" if i % 3 == 0 else f"P{i % 40}"
        queries.append((i, product, questions[i % 7 % 3], pick.normal(size=dims).tolist(),
                        int(1 + i % 9)))
    r = spark.createDataFrame(
        reviews, "row_id long, parent_asin string, vec array<double>, rating double, "
        "sentiment string, predicted_sentiment string")
    q = spark.createDataFrame(
        queries, "query_id long, parent_asin string, question string, vec array<double>, top_k int")
    return reviews, queries, retrieval.with_polarity_flags(r), retrieval.prepare_queries(q)


def brute_force(reviews, queries, prioritize=True):
    out = {}
    for qid, product, question, qv, k in queries:
        want = None
        if prioritize and "unhappy" in question:
            want = "negative"
        if prioritize and "love" in question:
            want = "positive"
        scored = []
        for rid, p, v, rating, label, predicted in reviews:
            if p != product:
                continue
            a, b = np.array(v), np.array(qv)
            sim = round(float(a @ b / np.linalg.norm(a) / np.linalg.norm(b)), 10)
            pref = want is not None and (
                label == want or predicted == want
                or (rating <= 2 if want == "negative" else rating >= 4))
            scored.append((not pref, -sim, rid))
        if scored:
            out[qid] = [rid for _, _, rid in sorted(scored)[:k]]
    return out


@pytest.mark.parametrize("blocks", [(50_000, 2_000), (37, 4)])
@pytest.mark.parametrize("prioritize", [True, False])
def test_matches_equal_brute_force(spark, blocks, prioritize):
    reviews, queries, r, q = make(spark)
    got = {}
    found = retrieval.top_matches(
        r, q, prioritize, review_block=blocks[0], query_block=blocks[1])
    for row in found.orderBy("query_id", "rank").collect():
        got.setdefault(row.query_id, []).append(row.row_id)
    assert got == brute_force(reviews, queries, prioritize)


def test_isolation_and_small_products(spark):
    _, queries, r, q = make(spark)
    matches = retrieval.top_matches(r, q)
    retrieved = retrieval.retrieved_reviews(matches, r, ["parent_asin", "rating", "sentiment"])
    audit = retrieval.isolation_audit(retrieved, q)
    assert audit.where("foreign_reviews > 0").isEmpty()
    sizes = dict(r.groupBy("parent_asin").count().collect())
    got = dict(audit.select("query_id", "reviews_retrieved").collect())
    for qid, product, _, _, k in queries:
        assert got.get(qid, 0) == min(k, sizes.get(product, 0))


def test_complaints_come_first(spark):
    _, _, r, q = make(spark)
    matches = retrieval.top_matches(r, q.where("intent = 'complaints' and parent_asin = 'HOT'"))
    assert matches.where("not preferred").isEmpty()


def test_unknown_product(spark):
    _, _, r, q = make(spark)
    odd = q.limit(1).withColumn("parent_asin", F.lit("GHOST"))
    with pytest.raises(ValueError, match="not found"):
        retrieval.check_products(odd, r)
    retrieval.check_products(q, r)
    assert retrieval.top_matches(r, odd).isEmpty()


def test_positions(spark):
    df = spark.createDataFrame([(10, "A"), (5, "A"), (7, "B"), (300, "A")],
                               "row_id long, parent_asin string")
    got = rows(retrieval.review_positions(df, parts=5), "row_id", "review_index")
    assert got == [(5, 0), (7, 0), (10, 1), (300, 2)]


def test_vector_expressions(spark):
    df = spark.createDataFrame([([3.0, 4.0], [4.0, 3.0]), ([0.0, 0.0], [1.0, 0.0])],
                               "a array<double>, b array<double>")
    got = [r[0] for r in df.select(vectors.inner_product(
        vectors.unit(F.col("a")), vectors.unit(F.col("b")))).collect()]
    assert got == pytest.approx([24 / 25, 0.0])


def test_text_vectors_have_unit_length(spark):
    df = spark.createDataFrame([("good sound good price",), ("good sound good price",), ("",)],
                               "t string")
    got = [r.vec for r in vectors.text_vectors(df, "t").select("vec").collect()]
    assert got[0] == got[1] and np.linalg.norm(got[0]) == pytest.approx(1.0)
    assert np.linalg.norm(got[2]) == 0.0


def answered(spark, question, **options):
    data = [
        (1, "Died", "The battery died " + "x" * 300, 1.0, "negative", None, ["battery"]),
        (2, "", "Too slow", 2.0, "negative", None, []),
        (3, "Nice", "Great sound", 5.0, "positive", "positive", ["performance"]),
        (4, "Ok", "It is ok", 3.0, "neutral", None, ["battery"]),
        (5, "Nice", "Great sound", 5.0, "positive", "positive", ["performance"]),
    ]
    reviews = spark.createDataFrame(
        data, "row_id long, title string, text string, rating double, sentiment string, "
        "predicted_sentiment string, aspects array<string>").withColumn("parent_asin", F.lit("P"))
    reviews = reviews.withColumn("vec", F.array(F.lit(1.0), F.col("row_id").cast("double")))
    queries = spark.createDataFrame(
        [(1, "P", question, [0.0, 1.0]), (2, "GHOST", question, [0.0, 1.0])],
        "query_id long, parent_asin string, question string, vec array<double>")
    info = spark.createDataFrame([("P", "Headphones", 3.2, 5)], "parent_asin string, title string, "
                                 "average_rating double, total_reviews long")
    out = answers.answer_questions(queries, reviews, info, 4, **options)
    return {r[0]: r for r in out.collect()}


def test_complaint_answer(spark):
    text = answered(spark, "Why are customers unhappy?")[1].answer
    lines = text.split("\n")
    assert lines[0] == 'Based on 4 relevant reviews for "Headphones" (ASIN: P):'
    assert "### 1. Sentiment Breakdown of Retrieved Reviews" in lines
    assert "- Negative: 2 (50%) | Neutral: 1 (25%) | Positive: 1 (25%)" in lines
    assert "- Product Catalog Rating: 3.2 / 5.0 (across 5 total reviews)" in lines
    assert "- **Battery & Charging**: cited in 2 review(s) (50.0%)" in lines
    assert "1. **General Quality**: Issue" in lines
    assert "2. **Battery & Charging**: Died" in lines
    quote = next(x for x in lines if x.startswith('2. *"The battery died'))
    assert quote.endswith('x..."*  ') and len(quote) == len('2. *""*  ') + 220
    assert "   — **Rating**: 1.0 / 5.0 | **Sentiment**: negative | **Aspects**: [Battery & Charging]" in lines


def test_praise_and_general_answers(spark):
    praise = answered(spark, "What do people love?")[1].answer.split("\n")
    assert "### 3. Key Customer Praises & Liked Features" in praise
    assert praise.count("1. **Performance & Functionality**: Nice") == 1  # repeats are merged
    assert not any(x.startswith("2. **Performance & Functionality**: Nice") for x in praise)
    general = answered(spark, "How is it?")[1].answer.split("\n")
    assert "### 3. Summary of Customer Observations" in general
    assert "1. **Performance & Functionality** (Rating: 5.0 / 5.0): Nice" in general


def test_no_reviews(spark):
    text = answered(spark, "How is it?")[2].answer
    assert text == ("No customer reviews found for product 'Unknown Product' (ASIN: GHOST). "
                    "Unable to provide feedback analysis.")


def test_generators_by_name(spark):
    assert answers.generator("no such model") is answers.grounded_answers
    assert answers.generator(" Grounded ") is answers.grounded_answers
    prompt = answered(spark, "Why unhappy?", generate="prompt",
                      extra={"prompt": answers.prompt_rows})[1].prompt
    assert '"id":"P","title":"Headphones","records":4' in prompt
    assert '{"id":3,"stars":5.0,"sentiment":"positive","aspects":["Performance' in prompt
    assert "x" * 300 in prompt  # whole texts, not snippets


def test_many_queries_of_a_product_do_not_copy_its_reviews(spark):
    keys = spark.range(3).select(F.lit("P").alias("parent_asin"))
    asked = spark.range(3000).select(F.lit("P").alias("parent_asin"))
    assert retrieval._block_counts(
        keys, asked, "parent_asin", retrieval.REVIEW_BLOCK, retrieval.QUERY_BLOCK).isEmpty()


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def without_own_broadcasts(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_texts_are_dealt_out_once(spark, without_own_broadcasts):
    """By query only: not by the product, which many queries share."""
    reviews = spark.createDataFrame(
        [(1, "P", "Nice", "Great sound", 5.0, "positive", None, ["battery"], 1), (1, "P", "Nice", "Great sound", 5.0,
         "positive", None, ["battery"], 2)], "row_id long, parent_asin string, title string, text string, "
        "rating double, sentiment string, predicted_sentiment string, aspects array<string>, rank int")
    queries = spark.createDataFrame([(1, "P", "How is it?", "general"), (2, "GHOST", "How is it?", "general")],
                                    "query_id long, parent_asin string, question string, intent string")
    info = spark.createDataFrame([("P", "Phones", 3.2, 5)], "parent_asin string, title string, "
                                 "average_rating double, total_reviews long")
    context = answers.contexts(reviews.withColumn("query_id", F.lit(1)), queries, info)
    assert "hashpartitioning(parent_asin" not in plan_of(context)
    got = {r.query_id: (r.product_title, r.retrieved_count, len(r.reviews or [])) for r in context.collect()}
    assert got == {1: ("Phones", 2, 2), 2: ("Unknown Product", 0, 0)}


def test_labels_come_to_the_texts(spark, without_own_broadcasts):
    docs = spark.createDataFrame([(1, "a b", "s", "en"), (2, "c", "s", "de"), (None, "d", "t", "en")],
                                 "doc_id long, text string, source string, lang string")
    marks = spark.createDataFrame([(1, 0, 0), (1, 1, 1), (None, 1, 1)], "doc_id long, quality int, toxic int")
    rated = views.doc_ratings(docs, marks)
    assert "SortMergeJoin" not in plan_of(rated)
    assert sorted((r.text, r.rating) for r in rated.collect()) == [("a b", 1.0), ("a b", 2.0), ("c", 3.0), ("d", 3.0)]
