"""Labelled pages to learn from: drawn layouts of articles and what stands around them."""

from __future__ import annotations

import random
from html import escape

from voxmill.llm.blocks import LABEL

# Usual names of the parts of pages.
MAIN_NAMES = ("article article-body article-content article-text content main main-content post post-body post-content "
              "entry entry-content story story-body body-text page-content text single-post blog-post news-item "
              "content-area primary").split()
WRAPPERS = "wrapper container page site row col grid inner outer layout wrap section holder block box".split()
OTHER = {
    "nav": "nav menu navbar navigation main-menu topnav site-nav menu-bar breadcrumb breadcrumbs pagination pager tabs "
           "toc skip-links sub-menu nav-links",
    "header": "header site-header masthead top-bar page-header branding logo topbar banner-top head-bar",
    "footer": "footer site-footer page-footer bottom copyright colophon legal foot footer-links bottom-bar",
    "aside": "sidebar side aside related related-posts recommended widget widgets rail secondary more-stories trending "
             "popular read-next sidebar-right see-also archive tag-cloud author-box",
    "ad": "ad ads advert advertisement ad-banner sponsored sponsor promo promotion adsbox ad-slot ad-container banner "
          "adunit dfp-ad promoted ad-wrapper outbrain",
    "notice": "cookie cookie-notice cookie-banner consent gdpr notice alert popup modal overlay newsletter-popup "
              "announcement message warning disclaimer toast paywall privacy-notice cookies banner-notice",
    "form": "form search search-form login signup subscribe newsletter contact-form register comment-form searchbox",
    "comments": "comments comment-list comment disqus replies reply user-comments discussion comment-thread responses "
                "reader-comments comments-area commentlist",
    "social": "share social social-share sharing share-buttons follow-us like-buttons social-links",
    "meta": "byline meta post-meta author dateline timestamp tags entry-meta posted-on categories",
}
OTHER = {kind: names.split() for kind, names in OTHER.items()}
_LABELS = ("Home", "About", "Contact", "News", "Login", "Share", "Next", "Previous", "More", "Tweet", "Reply", "Sign up",
           "Search", "Menu", "Archive", "Read more", "Subscribe", "Privacy policy", "Terms of use")
_NOTICES = ("This site uses cookies.", "We use cookies to improve your experience.", "Accept all cookies",
            "Please enable JavaScript.", "You have reached your limit of free articles.")


class _Page:
    def __init__(self, draw: random.Random):
        self.draw = draw
        self.plain = False
        letters = "abcdefghiklmnoprstuvwzäéñöüß"
        self.syllables = ["".join(draw.choices(letters, k=draw.randint(1, 4))) for _ in range(30)]

    def one(self, some):
        return self.draw.choice(some)

    def maybe(self, chance: float) -> bool:
        return self.draw.random() < chance

    def words(self, least: int, most: int) -> str:
        out = ["".join(self.draw.choices(self.syllables, k=self.draw.randint(1, 4)))
               for _ in range(self.draw.randint(least, most))]
        if self.maybe(0.05):
            out = [w + self.one(["###", "%%%", "&&&", "***"]) for w in out]
        return escape(" ".join(out), quote=False)

    def sentence(self, least: int = 3, most: int = 25) -> str:
        text = self.words(least, most)
        return text[:1].upper() + text[1:] + self.one([".", ".", ".", ".", "?", "!", ""])

    def prose(self, least: int = 1, most: int = 7) -> str:
        return " ".join(self.sentence() for _ in range(self.draw.randint(least, most)))

    def inline(self, text: str) -> str:
        words = text.split(" ")
        for _ in range(self.draw.choice([0, 0, 0, 1, 2])):
            i = self.draw.randrange(len(words))
            words[i] = self.one(["<b>{}</b>", "<em>{}</em>", '<a href="/x">{}</a>', "<strong>{}</strong>", "{}<br>",
                                 "<code>{}</code>", "<span>{}</span>"]).format(words[i])
        return " ".join(words)

    def attributes(self, names: list[str]) -> str:
        name = self.one(names)
        if self.maybe(0.3):
            name = f"{self.one(['site', 'js', 'c', 'block', 'l'])}-{name}"
        if self.maybe(0.2):
            name = name.title().replace("-", "")
        return self.one([f' class="{name}"', f' class="{name}"', f' id="{name}"',
                         f' class="{name} {self.one(WRAPPERS)}"'])

    def links(self, tag: str = "li") -> str:
        items = [f'<a href="/{i}">{self.one([self.one(_LABELS), self.words(1, 3)])}</a>'
                 for i in range(self.draw.randint(2, 8))]
        if self.maybe(0.6):
            return "<ul>" + "".join(f"<{tag}>{x}</{tag}>" for x in items) + "</ul>"
        return self.one([" ", " | ", " &raquo; "]).join(items)

    def other(self, kind: str) -> str:
        named = {"nav": "nav", "header": "header", "footer": "footer", "aside": "aside", "form": "form"}.get(kind)
        if named and self.maybe(0.55):
            tag, attributes = named, self.attributes(OTHER[kind]) if self.maybe(0.4) else ""
        else:
            tag, attributes = self.one(["div", "div", "div", "section", "ul" if kind == "nav" else "div"]), self.attributes(
                OTHER[kind])
        if kind == "notice" and self.maybe(0.15):
            tag, attributes = self.one([("noscript", ""), ("dialog", ""), ("div", ' role="alert"'),
                                        ("div", ' role="dialog"')])
        if tag == "ul":
            inside = "".join(f'<li><a href="#">{self.words(1, 3)}</a></li>' for _ in range(self.draw.randint(2, 6)))
        elif kind in ("nav", "social"):
            inside = self.links()
        elif kind == "header":
            inside = self.one([f'<a href="/">{self.words(1, 3)}</a>', f"<h1>{self.words(1, 4)}</h1><p>{self.words(2, 6)}</p>",
                               f"<div>{self.sentence(2, 8)}</div>" + self.links()])
        elif kind == "footer":
            inside = self.one([f"&copy; {self.words(1, 3)}", f"<p>Copyright {self.words(2, 5)}. All rights reserved.</p>",
                               f"&copy; example.net &middot; {self.sentence()}", self.links(), self.prose(1, 2)])
        elif kind == "aside":
            inside = f"<h3>{self.words(1, 3)}</h3>" + self.one([self.links(), f"<p>{self.prose(1, 3)}</p>", self.links("p")])
        elif kind == "ad":
            inside = self.one([self.prose(1, 3), f"<p>{self.prose(1, 3)}</p>", f'<a href="http://x.example">{self.sentence()}</a>',
                               f"<span>Advertisement</span><p>{self.sentence()}</p>"])
        elif kind == "notice":
            inside = self.one([self.one(_NOTICES), f"<p>{self.prose(1, 2)}</p><button>{self.one(['OK', 'Accept'])}</button>",
                               f"<p>{self.one(_NOTICES)} {self.sentence()}</p>", self.prose(1, 2)])
        elif kind == "form":
            inside = (f"<label>{self.words(1, 3)}</label><input type=text name=q><textarea>{self.words(0, 5)}</textarea>"
                      f"<button>{self.one(_LABELS)}</button>")
            inside += self.one(["", f"<p>{self.sentence()}</p>", "<select><option>a<option>b</select>"])
            if tag != "form":
                inside = f"<form>{inside}</form>"
        elif kind == "comments":
            rows = [self.one([f'<div class="comment"><b>{self.words(1, 2)}</b><p>{self.prose(1, 4)}</p></div>',
                              f"<li><p>{self.prose(1, 4)}</p><a href=#>Reply</a></li>", f"<p>{self.prose(1, 4)}</p>",
                              f"<article><h4>{self.words(1, 2)}</h4><p>{self.prose(1, 3)}</p></article>"])
                    for _ in range(self.draw.randint(1, 5))]
            inside = self.one(["", f"<h2>{self.draw.randint(1, 99)} comments</h2>", "<h3>Comments</h3>"]) + "".join(rows)
        else:
            inside = self.one([self.words(2, 5), f"<span>By {self.words(1, 2)}</span> <time>12 May 2020</time>"])
        return f'<{tag}{attributes} {LABEL}="0">{inside}</{tag}>'

    def body_block(self) -> str:
        text = self.inline(self.prose())
        kind = self.draw.random()
        if kind < 0.68:
            return self.one([f"<p>{text}</p>", f"<p>{text}</p>", f"<p>{text}", f"<p><b>{text}<br></p>", f"<p><b>{text}<br>"])
        if kind < 0.76:
            return f"<h{self.draw.randint(2, 4)}>{self.words(1, 7)}</h{2}>"
        if kind < 0.84:
            items = "".join(f"<li>{self.inline(self.sentence())}</li>" for _ in range(self.draw.randint(2, 5)))
            return self.one(["<ul>{}</ul>", "<ol>{}</ol>"]).format(items)
        if kind < 0.88:
            return f"<blockquote>{self.one(['{}', '<p>{}</p>']).format(text)}</blockquote>"
        if kind < 0.91:
            return f"<figure><img src=x.png><figcaption>{self.sentence()}</figcaption></figure>"
        if kind < 0.94:
            cells = "".join(f"<tr><th>{self.words(1, 2)}</th><td>{self.words(1, 4)}</td></tr>" for _ in range(3))
            return f"<table>{cells}</table>"
        if kind < 0.96:
            return f"<pre><code>{self.words(3, 20)}</code></pre>"
        return f"<p>{self.words(1, 3)}</p>"

    def body(self) -> str:
        parts = [f"<h1>{self.words(1, 12)}</h1>"] if self.maybe(0.7) else []
        if parts and self.maybe(0.15):
            parts = [f"<header>{parts[0]}</header>"]
        for _ in range(self.draw.choice([1, 1, 2, 3, 4, 6, 9, 14, 25])):
            parts.append(self.body_block())
        for kind in self.draw.choices(["ad", "social", "meta", "aside", "form", "notice", "comments", "footer", "nav"],
                                      k=self.draw.choice([0, 0, 1, 2, 3])):
            place = len(parts) if kind in ("comments", "footer") else self.draw.randint(0, len(parts))
            parts.insert(place, self.other(kind))
        return "".join(parts)

    def main(self) -> str:
        tag, attributes = self.one([("article", ""), ("article", ""), ("main", ""), ("div", None), ("section", None),
                                    ("article", None), ("td", ""), ("body", "")])
        if attributes is None:
            attributes = self.attributes(MAIN_NAMES)
        inside = self.body()
        if tag == "body":
            if self.maybe(0.7):  # no element of its own
                self.plain = True
                return inside
            return f'<div {LABEL}="1">{inside}</div>'
        if tag == "td":
            return f'<table><tr><td {LABEL}="1">{inside}</td></tr></table>'
        if tag != "article" and self.maybe(0.3):
            return f'<{tag}{attributes}><article {LABEL}="1">{inside}</article></{tag}>'
        return f'<{tag}{attributes} {LABEL}="1">{inside}</{tag}>'

    def whole(self) -> str:
        before = [k for k, chance in (("notice", 0.3), ("header", 0.5), ("nav", 0.7), ("form", 0.2), ("ad", 0.5),
                                      ("aside", 0.2)) if self.maybe(chance)]
        after = [k for k, chance in (("social", 0.2), ("ad", 0.2), ("comments", 0.35), ("aside", 0.35), ("form", 0.2),
                                     ("nav", 0.2), ("footer", 0.75), ("notice", 0.15)) if self.maybe(chance)]
        if self.maybe(0.5):
            self.draw.shuffle(before)
        inside = "".join([*map(self.other, before), self.main(), *map(self.other, after)])
        for _ in range(self.draw.choice([0, 0, 1, 2])):
            inside = f"<div{self.attributes(WRAPPERS)}>{inside}</div>"
        head = f"<head><title>{self.words(2, 8)}</title><style>p{{margin:0}}</style><script>var t='</p>';</script></head>"
        body = f'<body {LABEL}="1">' if self.plain else "<body>"
        return f"<!DOCTYPE html><html>{head if self.maybe(0.9) else ''}{body}{inside}</body></html>"


def labelled_pages(n: int, seed: int = 0) -> list[str]:
    """``n`` pages whose main text is marked by the attribute ``blocks.LABEL`` ("1", or "0" for a
    part that is none). Same seed, same pages."""
    return [_Page(random.Random(f"{seed}:{i}")).whole() for i in range(n)]
