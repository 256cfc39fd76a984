"""Leaf blocks of an HTML page with the features that the extraction model reads.

A block is the text between two boundaries of block elements; inline markup does not end it. Each
block knows its ancestors as a set of features: the tags, and the words in their class, id and
role that the model has a feature for. The set is a bit mask that an element inherits from its
parent, so that a block costs the same at any depth.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, replace
from html.parser import HTMLParser

# Math is part of its sentence, and what stands in for a missing player or script is text too.
INLINE = frozenset(
    "a abbr acronym audio b bdi bdo big canvas cite code data del dfn em font i ins kbd label maction math menclose "
    "merror mfrac mi mmultiscripts mn mo mover mpadded mphantom mroot mrow ms mspace msqrt mstyle msub msubsup msup "
    "mtable mtd mtext mtr munder munderover noscript object q rp rt ruby s samp semantics small span strike strong "
    "sub sup time tt u var video wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# No text of theirs is part of a page.
SILENT = frozenset("script style template svg iframe annotation annotation-xml".split())
CDATA = frozenset({"script", "style"})
# A slash closes these, which are not HTML themselves.
CLOSED_BY_SLASH = frozenset("svg math annotation annotation-xml".split())
# An opening tag ends an open element of these, up to the nearest container.
ENDED_BY_SIBLING = {
    "p": {"p"},
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "option": {"option"},
    "tr": {"tr", "td", "th"},
    "td": {"td", "th"},
    "th": {"td", "th"},
}
ENDS_PARAGRAPH = frozenset(
    "address article aside blockquote div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p "
    "pre section table ul".split()
)

TAGS = (
    "html head title body header nav main article section aside footer form fieldset button select textarea label "
    "dialog details div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tr td th blockquote pre figure "
    "figcaption address"
).split()
# Words of class, id, role and aria-label that tell what an element is for.
WORDS = (
    "ad ads advert advertisement adsense sponsor sponsored promo promoted banner article post entry story content "
    "main body text nav navbar navigation menu breadcrumb breadcrumbs crumbs toolbar tabs header masthead top logo "
    "brand footer bottom copyright legal sidebar side rail widget widgets aside complementary comment comments "
    "commentlist discussion disqus reply replies respond reviews cookie cookies consent gdpr notice alert message popup "
    "modal overlay dialog share sharing social follow related recommended more popular trending teaser newsletter "
    "subscribe signup login register search form pagination pager paging tags author byline meta contentinfo skip "
    "hidden print donate shop cart"
).split()
TEXT_FEATURES = (
    "bias words_3 words_10 words_25 words_more links_none links_some links_most links_all sentence copyright "
    "capitals digits first only"
).split()

PATH_FEATURES = [f"in:{t}" for t in TAGS] + [f"word:{w}" for w in WORDS]
OWN_FEATURES = [f"own:{t}" for t in TAGS]
FEATURES = [*PATH_FEATURES, *OWN_FEATURES, *(f"text:{t}" for t in TEXT_FEATURES)]

_TAG_BIT = {t: 1 << k for k, t in enumerate(TAGS)}
_WORD_BIT = {w: 1 << (len(TAGS) + k) for k, w in enumerate(WORDS)}
_OWN_BIT = {t: 1 << (len(PATH_FEATURES) + k) for k, t in enumerate(TAGS)}
_TEXT_BIT = {t: 1 << (len(PATH_FEATURES) + len(OWN_FEATURES) + k) for k, t in enumerate(TEXT_FEATURES)}
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


@dataclass(frozen=True)
class Block:
    text: str
    features: int  # bit mask over FEATURES
    label: str | None  # of a labelled page, else null


def _text_features(text: str, link_chars: int, first: bool) -> int:
    n = text.count(" ") + 1
    bits = _TEXT_BIT["bias"]
    bits |= _TEXT_BIT["words_3" if n <= 3 else "words_10" if n <= 10 else "words_25" if n <= 25 else "words_more"]
    share = link_chars / len(text)
    bits |= _TEXT_BIT[
        "links_none" if share == 0 else "links_some" if share < 0.4 else "links_most" if share < 0.9 else "links_all"
    ]
    if text[-1] in ".!?:;\"'”»…":
        bits |= _TEXT_BIT["sentence"]
    if "©" in text or "copyright" in text.lower():
        bits |= _TEXT_BIT["copyright"]
    if text.isupper():
        bits |= _TEXT_BIT["capitals"]
    if any(map(str.isdigit, text)):
        bits |= _TEXT_BIT["digits"]
    if first:
        bits |= _TEXT_BIT["first"]
    return bits


class _Reader(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.blocks: list[Block] = []
        self.open: list[tuple[str, int, str | None]] = [("", 0, None)]  # tag, inherited mask, label
        self.counts: Counter[str] = Counter()  # open elements by tag
        self.parts: list[str] = []
        self.links = 0
        self.link_chars = 0
        self.silent: list[str] = []  # the open elements from a silent one on

    def flush(self) -> None:
        if self.parts:
            text = " ".join("".join(self.parts).split())
            if text:
                tag, mask, label = self.open[-1]
                features = mask | _OWN_BIT.get(tag, 0)
                features |= _text_features(text, min(self.link_chars, len(text)), not self.blocks)
                self.blocks.append(Block(text, features, label))
            self.parts = []
        self.link_chars = 0

    def pop(self) -> str:
        tag = self.open.pop()[0]
        self.counts[tag] -= 1
        return tag

    def is_open(self, tag: str) -> bool:
        return self.counts[tag] > 0 or (tag == "a" and self.links > 0)

    def close_sibling(self, tag: str) -> None:
        ended = ENDED_BY_SIBLING.get(tag, set()) | ({"p"} if tag in ENDS_PARAGRAPH else set())
        if ended and self.open[-1][0] in ended:
            self.pop()
            if tag == "tr" and self.open[-1][0] == "tr":
                self.pop()

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if self.silent:
            if tag not in VOID:
                self.silent.append(tag)
            return
        if tag in SILENT:
            self.silent.append(tag)
        elif tag in INLINE:
            self.links += tag == "a"
        elif tag in VOID:
            self.parts.append(" ")
            if tag == "hr":
                self.flush()
        else:
            self.flush()
            self.close_sibling(tag)
            _, mask, label = self.open[-1]
            mask |= _TAG_BIT.get(tag, 0)
            for name, value in attrs:
                if value and name in ("class", "id", "role", "aria-label"):
                    for part in _PARTS.findall(value):
                        mask |= _WORD_BIT.get(part.lower(), 0)
                elif name == "data-label":
                    label = value
            self.open.append((tag, mask, label))
            self.counts[tag] += 1

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        # A slash does not close an element in HTML, but those of other languages inside of it.
        if tag in CLOSED_BY_SLASH or self.silent:
            return
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        if self.silent:
            if tag in self.silent:
                while self.silent.pop() != tag:
                    pass
                return
            # The end of an element around a silent one ends that as well, but in a script or style.
            if self.silent[0] in CDATA or not self.is_open(tag):
                return
            self.silent = []
        if tag in INLINE:
            self.links -= tag == "a" and self.links > 0
            return
        if tag in VOID:
            return
        self.flush()
        # A stray end tag closes nothing.
        if self.counts[tag]:
            while self.pop() != tag:
                pass

    def handle_data(self, data: str) -> None:
        if not self.silent:
            self.parts.append(data)
            if self.links:
                self.link_chars += len(data.strip())


def blocks_of(html: str | None) -> list[Block]:
    reader = _Reader()
    if html:
        reader.feed(html)
        reader.close()
        reader.flush()
    if len(reader.blocks) == 1:
        block = reader.blocks[0]
        return [replace(block, features=block.features | _TEXT_BIT["only"])]
    return reader.blocks
