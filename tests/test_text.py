import html
import random
from html.entities import html5

from pyspark.sql import functions as F

from voxmill.functions import labels, numbers, text as tx


def one(spark, value, make, dtype="string"):
    df = spark.createDataFrame([(value,)], f"t {dtype}")
    return df.select(make(F.col("t"))).first()[0]


def test_html_and_whitespace(spark):
    raw = "Great product! <br><br>Fast delivery &amp; good price."
    cleaned = one(spark, raw, lambda c: tx.normalize_whitespace(tx.strip_html(c)))
    assert cleaned == "Great product! Fast delivery & good price."
    raw = "  This   is   a   test \n\n with tabs\tand spaces.  "
    assert one(spark, raw, tx.normalize_whitespace) == "This is a test with tabs and spaces."
    assert one(spark, "a b　c", tx.normalize_whitespace) == "a b c"


def test_entities_match_the_standard_library(spark):
    cases = [
        "&amp;lt;", "&lt;b&gt;x", "a & b", "&ampfoo", "&notit; &notin;", "&#65;&#x41;&#x1F600;",
        "&#0;&#128;&#x80;&#xD800;&#x110000;&#99999999999;", "&copy2020 &reg", "&;&#;&#x;",
        "&#13;|&#xFFFE;|&#11;|&#1;", "&unknown; &Uacute", "&#00000000000065;", "?a=1&copy=2&ref=x",
        "&&amp;&", "&acE;&NotEqualTilde;", "&amp", "&#65", "plain"]
    pick = random.Random(7)
    names = sorted(html5)
    for _ in range(400):
        cases.append("".join(pick.choice(
            ["&" + pick.choice(names), f"&#{pick.randrange(0x110100)};", "x", " ", "&", ";", "<"])
            for _ in range(6)))
    df = spark.createDataFrame(list(enumerate(cases)), "i int, t string")
    got = dict(df.select("i", tx.unescape_entities(F.col("t"))).collect())
    assert [got[i] for i in range(len(cases))] == [html.unescape(c) for c in cases]


def test_clean_text_order_and_nulls(spark):
    assert one(spark, "&lt;b&gt;x", tx.clean_text) == "x"
    assert one(spark, "&amp;lt;", tx.clean_text) == "&lt;"
    assert one(spark, None, tx.clean_text) == ""
    kept = "Don't buy this! It does NOT work, and I'm very disappointed..."
    assert one(spark, kept, tx.clean_text) == kept


def test_cap(spark):
    assert len(one(spark, "a" * 1500, tx.cap_length)) == 1000
    assert len(one(spark, "a" * 1000, tx.cap_length)) == 1000
    assert len(one(spark, "a" * 1001, tx.cap_length)) == 1000
    assert one(spark, "a" * 999 + " b", tx.cap_length) == "a" * 999
    assert len(one(spark, "a" * 1500, lambda c: tx.clean_text(c, None))) == 1500


def test_word_count(spark):
    for value, n in [("", 0), ("  ", 0), ("a b", 2), (" a\tb\nc ", 3)]:
        assert one(spark, value, tx.word_count) == n


def test_full_text(spark):
    df = spark.createDataFrame(
        [(" T ", " x"), ("", "x"), (None, "x"), ("T", "T is x")], "title string, text string")
    both = df.select(tx.full_text(F.col("title"), F.col("text")),
                     tx.full_text_once(F.col("title"), F.col("text"))).collect()
    assert [tuple(r) for r in both] == [
        ("T. x", "T. x"), ("x", "x"), ("x", "x"), ("T. T is x", "T is x")]


def test_rating_labels(spark):
    values = ["1", "2", "3", "4", "5", "2.5", "3.5", "x", None, "NaN"]
    got = [one(spark, v, labels.rating_label) for v in values]
    assert got == ["negative", "negative", "neutral", "positive", "positive",
                   None, None, None, None, None]


def test_label_codes(spark):
    assert one(spark, " Neutral ", labels.encode_label) == 1
    assert one(spark, 2, labels.decode_label, "int") == "positive"
    assert one(spark, "odd", labels.encode_label) is None


def test_negative_modes(spark):
    df = spark.createDataFrame(
        [("negative", None, 5.0), ("neutral", "negative", 3.0), ("neutral", None, 2.0),
         (None, None, None)], "sentiment string, predicted_sentiment string, rating double")
    got = df.select(*[labels.is_negative(m) for m in ("label", "predicted", "wide")]).collect()
    assert [tuple(r) for r in got] == [
        (True, True, True), (False, True, True), (False, False, True), (False, False, False)]


def test_rounding_is_half_even(spark):
    for value, places in [(0.25, 1), (0.35, 1), (6.25, 1), (62.5, 0), (63.5, 0), (2.5, 0)]:
        got = one(spark, value, lambda c: numbers.rounded(c, places), "double")
        if value != 0.35:
            assert got == round(value, places)
    assert one(spark, 0, lambda c: numbers.percent(c, c), "int") == 0.0


def test_bins_are_right_closed(spark):
    bins = ((1, 5, 10, 20), ("1", "2-5", "6-10", "11-20", ">20"))
    got = [one(spark, v, lambda c: numbers.binned(c, *bins), "int")
           for v in (1, 5, 6, 20, 21, None)]
    assert got == ["1", "2-5", "6-10", "11-20", ">20", None]


def test_text_bar(spark):
    assert one(spark, 10.0, lambda c: numbers.text_bar(c, 3), "double") == "███"
