import itertools
import math

import numpy as np
import pytest

from voxmill.llm import extraction, queries
from voxmill.llm.blocks import LABEL, leaf_blocks
from voxmill.llm.layouts import labelled_pages

PROSE = "The quick brown fox jumps over the lazy dog, and then it sleeps. Nobody knows why it did so."


@pytest.fixture(scope="module")
def field():
    return extraction.trained_field()


def texts(page):
    return [b.text for b in leaf_blocks(page)]


@pytest.mark.parametrize("page, blocks", [
    ("", []), ("  \n ", []), ("plain &amp; simple", ["plain & simple"]),
    ("<p>one<p>two", ["one", "two"]), ("<p>a<br>b</p>", ["a b"]), ("<p>a<b>b</b>c</p>", ["abc"]),
    ("<p> a \n\t b&nbsp;c </p>", ["a b c"]), ("<div>x<p>y</p>z</div>", ["x", "y", "z"]),
    ("<ul><li>a<li>b<ul><li>c</ul></ul>d", ["a", "b", "c", "d"]),
    ("<script>if (a < b) '</p>'</script><p>t</p><style>p{}</style>", ["t"]),
    ("<p>a<script>x</script>b</p>", ["ab"]), ("<!-- <p>no</p> --><p>yes</p><!-- cut", ["yes"]),
    ("<p title=\"a > b\">in</p>", ["in"]), ("<p title='x>in</p>", ["in"]), ("<P CLASS=x>A</P>", ["A"]),
    ("a < b and c &lt; d", ["a < b and c < d"]), ("<title>t</title><textarea>u</textarea>v", ["v"]),
    ("<table><tr><td>1<td>2<tr><th>3</table>", ["1", "2", "3"]), ("&#233;&#x4e2d;&copy;&bogus;", ["é中©&bogus;"]),
    ("<p>cut <a href='", ["cut"]), ("</p></div>x</", ["x"]), ("<h2>a</h3>b", ["a", "b"]),
    ("<b><p>one</b> two</p>three", ["one two", "three"]),
])
def test_leaf_blocks(page, blocks):
    assert texts(page) == blocks


def test_paths_and_links():
    found = leaf_blocks('<body><nav id=m><a href=x>Home</a> and</nav><article class="big post"><p><b>one<p>two</article>z')
    assert [[e[0] for e in b.path] for b in found] == [
        ["body", "nav"], ["body", "article", "p", "b"], ["body", "article", "p"], ["body"]]
    assert found[0].path[1] == ("nav", "", "m", "") and found[1].path[1] == ("article", "big post", "", "")
    assert [b.linked for b in found] == [4, 0, 0, 0]


def test_labels_of_drawn_pages():
    page = f'<body><div {LABEL}="1">a<div {LABEL}="0"><p>b</div><p>c</div>d'
    assert [(b.text, b.label) for b in leaf_blocks(page)] == [("a", True), ("b", False), ("c", True), ("d", False)]
    assert labelled_pages(5, 3) == labelled_pages(5, 3) != labelled_pages(5, 4)


def best_by_trial(field, blocks):
    scores = extraction.Decoder(field).scores(blocks)

    def total(labels):
        out = scores[0] * labels[0] + field.start * labels[0]
        for i in range(1, len(labels)):
            out += scores[i] * labels[i]
            if labels[i] == labels[i - 1]:
                out += field.same[labels[i]] + field.near[labels[i]] * (blocks[i].path == blocks[i - 1].path)
        return out

    return max(itertools.product((0, 1), repeat=len(blocks)), key=total), total


def test_decoding_equals_trial_of_all_labels(field):
    for page in labelled_pages(60, 11):
        blocks = leaf_blocks(page)[:9]
        assert extraction.Decoder(field).labels(blocks) == [bool(x) for x in best_by_trial(field, blocks)[0]]


def test_training_finds_the_likelihood_by_trial(monkeypatch):
    """On tiny pages the likelihood over all labels is summed plainly; no small change raises it."""
    pages = [f'<p {LABEL}="1">{PROSE}</p><nav {LABEL}="0"><p>a<p>b</nav>', f'<nav {LABEL}="0">x</nav><p {LABEL}="1">{PROSE}',
             f'<p {LABEL}="1">{PROSE}</p><p {LABEL}="1">short</p>', f'<nav {LABEL}="0">y</nav>'] * 2
    penalty = 0.5
    field = extraction.train(pages, steps=1500, rate=0.1, penalty=penalty, least=1)

    def value(field):
        out = 0.0
        for page in pages:
            blocks = leaf_blocks(page)
            _, total = best_by_trial(field, blocks)
            out += total([int(b.label) for b in blocks]) - math.log(
                sum(math.exp(total(y)) for y in itertools.product((0, 1), repeat=len(blocks))))
        every = [*field.weights.values(), field.bias, field.start, *field.same, *field.near]
        return out - penalty / 2 * sum(v * v for v in every)

    top = value(field)
    changed = [extraction.Field({**field.weights, f: w + d}, field.bias, field.start, field.same, field.near)
               for f, w in field.weights.items() for d in (-0.05, 0.05)]
    changed += [extraction.Field(field.weights, field.bias + d, field.start, field.same, field.near) for d in (-0.05, 0.05)]
    changed += [extraction.Field(field.weights, field.bias, field.start, (field.same[0] + d, field.same[1]), field.near)
                for d in (-0.05, 0.05)]
    changed += [extraction.Field(field.weights, field.bias, field.start, field.same, (field.near[0], field.near[1] + d))
                for d in (-0.05, 0.05)]
    assert np.isfinite(top) and all(value(f) < top for f in changed)


def test_held_out_accuracy(field):
    decoder, right, blocks = extraction.Decoder(field), 0, 0
    for page in labelled_pages(300, 99):
        found = leaf_blocks(page)
        right += sum(b.label == x for b, x in zip(found, decoder.labels(found), strict=True))
        blocks += len(found)
    assert right / blocks > 0.99


WRITTEN = [
    (f"<html><body><header><a href=/>Site</a><p>A tagline here.</p></header><nav><a href=1>A</a><a href=2>B</a></nav>"
     f"<main><h1>Head</h1><p>{PROSE}</p><div class='advert'>{PROSE}</div><p>{PROSE}</p></main>"
     f"<aside><h3>More</h3><p>{PROSE}</p></aside><section id=comments><p>{PROSE}</p></section>"
     f"<footer>&copy; 2020</footer></body></html>", ["Head", PROSE, PROSE]),
    (f"<body><div class='cookie-banner'>{PROSE}</div><div class='content'><p>{PROSE}<p>{PROSE}"
     f"<form><label>Mail</label><input><button>Go</button></form></div><div id='sidebar'><p>{PROSE}</div>", [PROSE, PROSE]),
    (f"<p>{PROSE}</p><p>Short.</p><p>{PROSE}</p>", [PROSE, "Short.", PROSE]),
    (f"<article><h1>T</h1><p>{PROSE}</p></article><div class='comments'><article><p>{PROSE}</p></article></div>",
     ["T", PROSE]),
    ("<nav><ul><li><a href=/>Home</a></li></ul></nav><footer>&copy; x</footer>", []),
    (None, []), ("", []), ("<p></p><script>x</script>", []),
]


def test_written_pages(spark, field):
    data = [(i, f"u{i}", page, "t", 3) for i, (page, _) in enumerate(WRITTEN)]
    df = spark.createDataFrame(data, "page_id long, url string, html string, text string, n_kept int")
    got = {r.page_id: (r.url, r.text) for r in extraction.extract(df).collect()}
    assert got == {i: (f"u{i}", "\n".join(want)) for i, (_, want) in enumerate(WRITTEN)}
    long = "".join(f"<p>{i} {PROSE}</p>" for i in range(20_000))
    rows = [(1, None, f"<article>{long}</article>"), (1, None, f"<article>{long}</article>"), (None, "u", WRITTEN[0][0])]
    found = extraction.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert sorted(r.n_kept for r in found) == [3, 20_000, 20_000]
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert extraction.extract(empty).count() == 0


def test_query_keeps_the_articles_of_the_test_pages(spark):
    sf = "/root/testdata/sf0.001"
    got = {r.page_id: r for r in queries.QUERIES["op12_main_text"](spark, sf).collect()}
    pages = spark.read.parquet(f"{sf}/pages.parquet").collect()
    assert len(got) == len(pages)
    for page in pages:
        want = "\n".join(b.text for b in leaf_blocks(page.html) if any(e[0] == "article" for e in b.path))
        assert got[page.page_id].text == want and got[page.page_id].n_chars == len(want)
