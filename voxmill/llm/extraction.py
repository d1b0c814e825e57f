"""Main text of HTML pages by a linear-chain conditional random field over their leaf blocks."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxmill.llm.blocks import Block, leaf_blocks
from voxmill.llm.common import quoted
from voxmill.llm.layouts import labelled_pages

#: Pages that the field learns from, drawn by ``labelled_pages``.
TRAINING_PAGES = 800
#: Steps of gradient ascent, its rate, and the strength of the quadratic penalty.
STEPS, RATE, PENALTY = 120, 0.25, 0.2
#: A feature must occur in so many training blocks.
LEAST = 3
#: Different paths whose score a task remembers before it begins anew.
PATHS_HELD = 50_000

#: Elements that say nothing about the place of a block, unless they are named.
FORMAT_TAGS = frozenset("a abbr b big cite code del em font i ins kbd mark q s samp small span strong sub sup tt u var".split())
# Usual words in the names of page parts, and the elements made for them.
KINDS = {
    "comments": "comment comments commentlist replies reply disqus discussion responses",
    "ad": "ad ads advert adverts advertisement sponsor sponsored promo promotion promoted adsbox adunit adslot dfp outbrain",
    "notice": "cookie cookies consent gdpr notice alert popup modal overlay disclaimer toast paywall dialog alertdialog",
    "form": "form search searchbox login signup subscribe newsletter register",
    "social": "share social sharing follow",
    "nav": "nav navbar topnav menu navigation breadcrumb breadcrumbs pagination pager toc tabs",
    "footer": "footer colophon copyright legal contentinfo",
    "aside": "sidebar aside related recommended widget widgets trending popular rail complementary",
    "header": "header masthead topbar branding logo",
    "meta": "byline meta author dateline timestamp tags",
    "main": "article content main post entry story",
}
_KIND_OF_WORD = {word: kind for kind, words in reversed(KINDS.items()) for word in words.split()}
_RANK = {kind: i for i, kind in enumerate(KINDS)}
_KIND_OF_TAG = {"nav": "nav", "header": "header", "footer": "footer", "aside": "aside", "form": "form", "fieldset": "form",
                "button": "form", "select": "form", "dialog": "notice", "noscript": "notice", "article": "main",
                "main": "main"}
_NAME_PARTS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")
_CUES = re.compile(r"(?i)\b(cookies?|copyright|all rights reserved|subscribe|newsletter|sign (?:up|in)|log ?in|advertisement|"
                   r"sponsored|privacy policy|terms of use|comments?|reply|share|javascript|read more)\b|©")


def _name_parts(names: str) -> list[str]:
    return [p.lower() for p in _NAME_PARTS.findall(names)]


def path_features(path: tuple[tuple[str, str, str, str], ...]) -> set[str]:
    """Features of a block's ancestors: their tags, the words of their class, id and role, and the
    kinds of page parts they are, from the inside out."""
    out = {f"depth:{min(len(path), 8)}"}
    blocks = [e for e in path if e[0] not in FORMAT_TAGS or any(e[1:])]
    chain: list[str] = []
    for i, (tag, classes, name, role) in enumerate(reversed(blocks)):
        out.add(f"tag:{tag}")
        if i < 2:
            out.add(f"near:{i}:{tag}")
        words = _name_parts(f"{classes} {name} {role}")
        kinds = [_KIND_OF_WORD[w] for w in words if w in _KIND_OF_WORD]
        if tag not in ("html", "body") and (kinds or tag in _KIND_OF_TAG):
            kind = min([*kinds, *([_KIND_OF_TAG[tag]] if tag in _KIND_OF_TAG else [])], key=_RANK.get)
            if chain[-1:] != [kind]:
                chain.append(kind)
        for word in words:
            out.add(f"name:{word}")
            if i < 2:
                out.add(f"near-name:{word}")
    out |= {f"within:{kind}" for kind in chain}
    out |= {"chain:" + "<".join(chain[:3]), "innermost:" + (chain[0] if chain else "")}
    return out


def text_features(block: Block) -> list[str]:
    """Features of a block's own text: length, links, sentence ends, usual words of notices."""
    text = block.text
    n = len(text)
    linked = block.linked / n
    out = [f"length:{n.bit_length()}", f"links:{0 if not linked else 1 if linked < 0.4 else 2 if linked < 0.9 else 3}",
           f"end:{'.' if text[-1] in '.!?…:;”»' else 'x'}", f"stops:{min(text.count('. ') + text.count(', '), 3)}",
           f"bars:{min(text.count('|') + text.count('»') + text.count('·'), 2)}"]
    out += [f"cue:{m.lower()}" for m in {m[0] for m in _CUES.finditer(text)}] if n < 400 else []
    return out


@dataclass(frozen=True)
class Field:
    """Weights of the label "main" against "other": per feature, for two neighbours with the same
    label (``same``; ``near`` more if their ancestors are the same), and for ``start`` and ``bias``."""

    weights: dict[str, float]
    bias: float
    start: float
    same: tuple[float, float]
    near: tuple[float, float]


def _sequences(pages: list[str]):
    return [found for page in pages if (found := leaf_blocks(page))]


def train(
    pages: list[str], steps: int = STEPS, rate: float = RATE, penalty: float = PENALTY, least: int = LEAST,
) -> Field:
    """The field with the largest penalised likelihood of the labels of ``pages`` (see ``blocks.LABEL``).

    All pages are laid out as one array (page, place), so a step of the forward and backward sums
    serves all of them. Memory grows with ``pages``, which the caller bounds.
    """
    data = _sequences(pages)
    features = [[path_features(b.path) | set(text_features(b)) for b in page] for page in data]
    often = Counter(f for page in features for block in page for f in block)
    names = sorted(f for f, n in often.items() if n >= least)
    place = {f: i for i, f in enumerate(names)}
    width, n = max(map(len, data)), len(data)
    at = np.array([(p, i) for p, page in enumerate(data) for i in range(len(page))])
    x = np.zeros((len(at), len(names)), np.float32)
    for row, block in enumerate(b for page in features for b in page):
        x[row, [place[f] for f in block if f in place]] = 1
    y = np.zeros((n, width), np.int64)
    here = np.zeros((n, width), bool)
    alike = np.zeros((n, width), bool)
    for p, page in enumerate(data):
        here[p, :len(page)] = True
        y[p, :len(page)] = [b.label for b in page]
        alike[p, 1:len(page)] = [a.path == b.path for a, b in zip(page, page[1:], strict=False)]
    rows = at[:, 0], at[:, 1]
    pairs = here[:, 1:]
    theta = np.zeros(len(names) + 6)
    mean, spread = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1):
        w, (bias, start, *edge) = theta[:len(names)], theta[len(names):]
        score = np.zeros((n, width, 2))
        score[(*rows, 1)] = x @ w.astype(np.float32) + bias
        score[:, 0, 1] += start
        # The score of two neighbours: by label where it is the same, more if the paths are.
        link = np.zeros((n, width, 2, 2))
        for label in (0, 1):
            link[:, :, label, label] = edge[label] + edge[2 + label] * alike
        forward, backward = np.zeros((n, width, 2)), np.zeros((n, width, 2))
        forward[:, 0] = score[:, 0]
        for i in range(1, width):
            after = np.logaddexp(forward[:, i - 1, 0, None] + link[:, i, 0],
                                 forward[:, i - 1, 1, None] + link[:, i, 1]) + score[:, i]
            forward[:, i] = np.where(here[:, i, None], after, forward[:, i - 1])
        total = np.logaddexp(forward[:, -1, 0], forward[:, -1, 1])
        for i in range(width - 2, -1, -1):
            ahead = score[:, i + 1] + backward[:, i + 1]
            before = np.logaddexp(link[:, i + 1, :, 0] + ahead[:, 0, None], link[:, i + 1, :, 1] + ahead[:, 1, None])
            backward[:, i] = np.where(here[:, i + 1, None], before, 0)
        chance = np.exp(forward + backward - total[:, None, None]) * here[:, :, None]
        gradient = np.zeros_like(theta)
        wrong = (y - chance[:, :, 1])[rows]
        gradient[:len(names)] = wrong.astype(np.float32) @ x
        gradient[len(names)] = wrong.sum()
        gradient[len(names) + 1] = (y - chance[:, :, 1])[:, 0].sum()
        for label in (0, 1):
            both = np.exp(forward[:, :-1, label] + link[:, 1:, label, label] + score[:, 1:, label]
                          + backward[:, 1:, label] - total[:, None]) * pairs
            seen = (y[:, :-1] == label) & (y[:, 1:] == label) & pairs
            gradient[len(names) + 2 + label] = (seen - both).sum()
            gradient[len(names) + 4 + label] = ((seen - both) * alike[:, 1:]).sum()
        gradient -= penalty * theta
        mean = 0.9 * mean + 0.1 * gradient
        spread = 0.999 * spread + 0.001 * gradient**2
        theta = theta + rate * (1 - step / (steps + 1)) * (mean / (1 - 0.9**step)) / (
            np.sqrt(spread / (1 - 0.999**step)) + 1e-8)
    bias, start, a, b, c, d = map(float, theta[len(names):])
    return Field({f: float(v) for f, v in zip(names, theta, strict=False)}, bias, start, (a, b), (c, d))


@lru_cache(maxsize=2)
def trained_field(pages: int = TRAINING_PAGES, seed: int = 0) -> Field:
    return train(labelled_pages(pages, seed))


class Decoder:
    """The likeliest labels of a page's blocks, by Viterbi."""

    def __init__(self, field: Field):
        self.field = field
        self.paths: dict[tuple, float] = {}

    def scores(self, blocks: list[Block]) -> list[float]:
        weights, bias = self.field.weights, self.field.bias
        out = []
        for block in blocks:
            if (known := self.paths.get(block.path)) is None:
                if len(self.paths) >= PATHS_HELD:
                    self.paths.clear()
                known = self.paths[block.path] = bias + sum(
                    weights.get(f, 0.0) for f in sorted(path_features(block.path)))
            out.append(known + sum(weights.get(f, 0.0) for f in text_features(block)))
        return out

    def labels(self, blocks: list[Block]) -> list[bool]:
        if not blocks:
            return []
        scores = self.scores(blocks)
        (same0, same1), (near0, near1) = self.field.same, self.field.near
        other, main = 0.0, scores[0] + self.field.start
        back = []
        for i in range(1, len(blocks)):
            alike = blocks[i].path == blocks[i - 1].path
            stay0, stay1 = other + same0 + alike * near0, main + same1 + alike * near1
            back.append((main > stay0, stay1 >= other))
            other, main = max(stay0, main), max(stay1, other) + scores[i]
        label = main > other
        out = [label]
        for from_main0, from_main1 in reversed(back):
            label = from_main1 if label else from_main0
            out.append(label)
        return out[::-1]


def main_text(page: str, decoder: Decoder) -> tuple[str, int, int]:
    """The text of the page's main blocks, one a line, with the number of blocks and of those kept."""
    blocks = leaf_blocks(page)
    kept = [b.text for b, main in zip(blocks, decoder.labels(blocks), strict=True) if main]
    return "\n".join(kept), len(blocks), len(kept)


def extract(
    pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", field: Field | None = None,
) -> DataFrame:
    """(key, url, text, n_blocks, n_kept) of every row: the main text of the whole page, its blocks in
    order, one a line; white space inside a block is one blank, character references are decoded.

    A page is read into leaf blocks with their ancestors; a linear-chain conditional random field
    scores each block by ancestor tags and names and by its text, neighbours by whether they agree,
    and Viterbi gives the likeliest labels. The field is trained on ``TRAINING_PAGES`` drawn pages with
    labels, or given (``train``). Rows are independent: nothing is shuffled, and a task holds a batch.

    Null and empty pages have an empty text; so have pages without main text. Repeated rows are
    extracted one by one, very long pages whole. An empty table gives an empty one; other columns are
    not read, whatever they are called.
    """
    field = field or trained_field()
    kinds = [pages.select(quoted(c)).schema[0].dataType.simpleString() for c in (key, url)]
    rows = pages.select(quoted(key).alias("_id"), quoted(url).alias("_url"), quoted(html).cast("string").alias("_html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(field)
        for batch in batches:
            found = [main_text(page.as_py() or "", decoder) for page in batch.column(2)]
            texts, blocks, kept = zip(*found, strict=True) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(blocks, pa.int32()),
                 pa.array(kept, pa.int32())], ["_id", "_url", "text", "n_blocks", "n_kept"])

    found = rows.mapInArrow(run, f"_id {kinds[0]}, _url {kinds[1]}, text string, n_blocks int, n_kept int")
    return found.select(F.col("_id").alias(key), F.col("_url").alias(url), "text", "n_blocks", "n_kept")
