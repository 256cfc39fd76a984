"""Labelled pages for the extraction model: common page layouts with the label of each part.

The layouts are written out; words, lengths, the choice of parts and their order are drawn. An
element's data-label says whether its text belongs to the article; the model never reads it.
"""

from __future__ import annotations

import random

MAIN, OTHER = "main", "other"

# The element that holds an article, as attributes and tag. Fixed values.
ARTICLES = [
    "article", 'article class="post"', 'main id="content"', 'div class="article-body"', 'div class="entry-content"',
    'div id="content"', 'div class="post-content"', 'section class="story"', 'div class="main-text"', "section",
    'div class="storyBody"', "main", "div",
]
NAVIGATION = [
    "nav", 'nav class="navbar"', 'div class="menu"', 'div id="navigation"', 'div class="breadcrumbs"', 'ul class="nav"',
    'div class="tabs"', 'div class="pagination"',
]
HEADERS = ["header", 'div id="header"', 'div class="masthead"', 'div class="top-bar"', 'div class="logo"']
FOOTERS = ["footer", 'div id="footer"', 'div class="site-footer"', 'div class="copyright"', 'div role="contentinfo"']
SIDES = [
    "aside", 'aside class="sidebar"', 'div id="sidebar"', 'div class="widget"', 'div class="right-rail"',
    'div class="related"', 'div class="popular"',
]
ADVERTS = ['div class="ad"', 'div class="advert"', 'div id="ads"', 'aside class="sponsored"', 'div class="promo"', 'div class="banner"']
NOTICES = ['div class="cookie-notice"', 'div id="consent"', 'div class="alert"', 'div class="gdpr popup"', "dialog", 'div class="modal"']
FORMS = ["form", 'form class="newsletter"', 'div class="login"', 'form id="search"', 'div class="subscribe"']
COMMENTS = [
    'section id="comments"', 'div class="comments"', 'ol class="commentlist"', 'div class="comment"',
    'div class="discussion"', 'div id="disqus"',
]
SHARES = ['div class="share"', 'div class="social"', 'div class="follow"']

_SYLLABLES = "an ber con de el fi gra hu in jo ka lo mi ne or pa qui re sa tu un ve wi xa yo za".split()


class _Writer:
    def __init__(self, rng: random.Random):
        self.rng = rng

    def words(self, least: int, most: int) -> str:
        n = self.rng.randint(least, most)
        text = " ".join("".join(self.rng.choices(_SYLLABLES, k=self.rng.randint(1, 4))) for _ in range(n))
        return text.capitalize() + self.rng.choice([".", ".", ".", "", "!", "?"])

    def element(self, opening: str, inner: str) -> str:
        return f"<{opening}>{inner}</{opening.split()[0]}>"

    def paragraph(self) -> str:
        rng = self.rng
        text = rng.choice([self.words(1, 4), self.words(5, 20), self.words(20, 90), self.words(20, 90)])
        kind = rng.random()
        if kind < 0.08:
            return f"<p><b>{text}<br>"
        if kind < 0.16:
            return self.element("blockquote", self.element("p", text))
        if kind < 0.22:
            return self.element("ul", "".join(self.element("li", self.words(2, 15)) for _ in range(3)))
        if kind < 0.30:
            return self.element(rng.choice(["h2", "h3"]), self.words(2, 8))
        if kind < 0.34:
            cells = "".join(self.element("td", self.words(1, 4)) for _ in range(3))
            return self.element("table", self.element("tr", cells))
        if kind < 0.38:
            return self.element("figure", self.element("figcaption", self.words(4, 12)))
        if kind < 0.42:
            return self.element("pre", text)
        if kind < 0.52:
            return self.element("p", f'{text} <a href="/x">{self.words(1, 3)}</a> {self.words(3, 30)}')
        if kind < 0.58:
            return self.element("div", text)
        return self.element("p", text)

    def article(self, opening: str) -> str:
        rng = self.rng
        parts = [self.element("h1", self.words(3, 12))] if rng.random() < 0.8 else []
        for _ in range(rng.randint(1, 12)):
            parts.append(self.paragraph())
            if rng.random() < 0.1:
                parts.append(self.other(rng.choice([ADVERTS, SHARES, FORMS, SIDES, NOTICES])))
        return self.element(f'{opening} data-label="{MAIN}"', "".join(parts))

    def other(self, kinds: list[str]) -> str:
        rng = self.rng
        opening = rng.choice(kinds)
        if kinds is NAVIGATION or kinds is SHARES:
            item = "li" if rng.random() < 0.7 else "span"
            links = "".join(
                self.element(item, f'<a href="/{k}">{self.words(1, 3)}</a>') for k in range(rng.randint(2, 7))
            )
            inner = self.element("ul", links) if item == "li" else links
        elif kinds is FOOTERS and rng.random() < 0.7:
            inner = f"&copy; {self.words(1, 3)} &middot; {self.words(2, 20)}"
        elif kinds is FORMS:
            inner = f"<label>{self.words(1, 5)}</label><input>{self.element('button', self.words(1, 2))}"
            inner += self.element("p", self.words(3, 20)) if rng.random() < 0.4 else ""
        else:
            tag = rng.choice(["p", "p", "div", "h3", ""])
            texts = [self.words(2, rng.choice([6, 20, 60])) for _ in range(rng.randint(1, 4))]
            inner = "".join(self.element(tag, t) if tag else t + " " for t in texts)
        return self.element(f'{opening} data-label="{OTHER}"', inner)

    def bare(self) -> str:
        """A page without a frame: one part alone, a title and one part, or plain text."""
        rng = self.rng
        kind = rng.random()
        furniture = rng.choice([NAVIGATION, HEADERS, FOOTERS, SIDES, ADVERTS, NOTICES, FORMS, COMMENTS, SHARES])
        if kind < 0.3:
            text = self.words(*rng.choice([(3, 20), (20, 90)]))
            return f'<div data-label="{MAIN}">{text}</div>' if rng.random() < 0.5 else f'<html data-label="{MAIN}">{text}'
        if kind < 0.5:
            return self.other(furniture)
        text = self.element("p", self.words(*rng.choice([(3, 20), (20, 90)])))
        article = self.element(f'{rng.choice(ARTICLES)} data-label="{MAIN}"', text)
        if kind < 0.7:
            return article
        if kind < 0.85:
            title = f'<head><title data-label="{OTHER}">{self.words(3, 10)}</title></head>'
            return f"<html>{title}<body>{article}</body></html>"
        return f'<html><body data-label="{OTHER}">{self.other(furniture)}{article}</body></html>'

    def page(self) -> str:
        rng = self.rng
        before = [kinds for kinds, share in
                  [(NOTICES, 0.3), (HEADERS, 0.5), (NAVIGATION, 0.8), (ADVERTS, 0.5), (SIDES, 0.2), (FORMS, 0.2)]
                  if rng.random() < share]
        after = [kinds for kinds, share in
                 [(SHARES, 0.2), (COMMENTS, 0.5), (SIDES, 0.4), (ADVERTS, 0.2), (FORMS, 0.2), (NOTICES, 0.1),
                  (FOOTERS, 0.9)]
                 if rng.random() < share]
        title = self.words(3, 10)
        head = f'<head><title data-label="{OTHER}">{title}</title><style>p{{margin:0}}</style></head>'
        body = "".join(map(self.other, before)) + self.article(rng.choice(ARTICLES)) + "".join(map(self.other, after))
        return f'<!DOCTYPE html><html data-label="{OTHER}">{head}<body>{body}</body></html>'


# Every so many pages one is without a frame.
BARE_EVERY = 4


def labelled_pages(n: int, seed: int = 5) -> list[str]:
    writer = _Writer(random.Random(seed))
    return [writer.bare() if i % BARE_EVERY == BARE_EVERY - 1 else writer.page() for i in range(n)]
