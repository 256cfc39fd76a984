import itertools
import re
from html import unescape

import numpy as np
import pytest

from millrace.llm import extraction
from millrace.llm.extraction import Field, default_field, extractor, main_text, viterbi
from millrace.llm.labelled_pages import MAIN, labelled_pages
from millrace.llm.page_blocks import FEATURES, Block, blocks_of


@pytest.fixture(scope="module")
def model():
    return default_field()


def test_held_out_pages(model):
    right = total = 0
    for page in labelled_pages(150, seed=99):
        blocks = blocks_of(page)
        right += sum((b.label == MAIN) == keep for b, keep in zip(blocks, viterbi(model, blocks)))
        total += len(blocks)
    assert right / total >= 0.98


def test_pages_of_the_table(spark, model):
    """The pages keep their article in one element; its text is what must come out."""
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    for row in pages.select("html", extractor(model)("html").alias("text")).collect():
        article = re.search(r"<article>(.*?)(?:</article>|$)", row["html"], re.S).group(1)
        plain = unescape(re.sub(r"</?b>", "", re.sub(r"</?(?:p|h1|br)>", " ", article)))
        assert row["text"] == " ".join(plain.split())


def test_parts_around_an_article(model):
    page = """<html><head><title>Not this</title><script>var a = "<p>no</p>";</script></head><body>
    <header><div class="logo">Site name</div></header>
    <div class="cookie-notice"><p>We use cookies for a number of purposes.</p><button>Accept</button></div>
    <nav><ul><li><a href="/">Home</a><li><a href="/b">About</a></ul></nav>
    <article><h1>Title &amp; more</h1><p>First   <i>paragraph</i> of the
    story&nbsp;here.<p>Second one, <a href="/x">with a link</a> inside of it.
    <ul><li>Point one.</li><li>Point two.</li></ul></article>
    <section id="comments"><div class="comment"><p>I liked this article a lot, thank you.</p></div></section>
    <aside class="sidebar"><p>Read also this other story.</p></aside>
    <form><label>Mail</label><input></form><footer>&copy; 2020 Site</footer></body></html>"""
    assert main_text(model, page) == (
        "Title & more First paragraph of the story here. Second one, with a link inside of it. Point one. Point two."
    )


@pytest.mark.parametrize(
    "page", [None, "", " ", "<html>", "<p", "<script>x", "<!-- a", "</div></p>", "<nav><a>x</a></nav>", "&", "<" * 2000]
)
def test_pages_without_main_text_do_not_fail(model, page):
    assert isinstance(main_text(model, page), str)


def test_deep_and_long_pages(model):
    assert main_text(model, "<div>" * 30_000 + "<b>" * 30_000 + "text" + "</p>" * 1000) in ("", "text")
    page = "<article>" + "<p>A sentence of the story that goes on.</p>" * 20_000 + "</article>"
    assert main_text(model, page).count("story") == 20_000


def test_empty_table(spark, model):
    assert spark.createDataFrame([], "html string").select(extractor(model)("html")).collect() == []


def test_long_attributes_are_read_whole():
    long = "px-4 " * 100
    plain, behind = (blocks_of(f'<div class="{c}"><p>Some words.</p></div>')[0] for c in (long, long + "sidebar"))
    assert behind.features != plain.features
    assert behind.features == blocks_of(f'<div class="sidebar {long}"><p>Some words.</p></div>')[0].features


ARTICLE = "<article><h1>A title</h1><p>First paragraph of the story, which goes on.</p><p>Second one.</p></article>"
PLAIN = "A title First paragraph of the story, which goes on. Second one."


@pytest.mark.parametrize(
    "before",
    [
        '<svg class="i"/>', '<svg viewBox="0"><path d="M0"/><title>icon</title></svg>', "<math/>", "<div><noscript></div>",
        "<div><svg><g></div>", '<a href="/"><svg><g></a>', "<video src=x></video>", "<object data=x></object>",
        "<template><p>hidden</p></template>", "<script>var a = '</div>';</script>", "<style>p{}</style>",
        '<iframe src="x"></iframe>', "<div><iframe></div>", "<canvas></canvas>",
    ],
)
def test_elements_without_text_do_not_swallow_a_page(model, before):
    assert main_text(model, f"<body>{before}{ARTICLE}</body>") == PLAIN
    inside = ARTICLE.replace("<p>Second", f"{before}<p>Second")
    assert main_text(model, f"<body>{inside}</body>") == PLAIN


def test_formulas_and_fallbacks_are_text(model):
    page = """<body><article><p>The area is <math><mi>a</mi><mo>=</mo><mi>r</mi><annotation>no</annotation></math> and
    it grows.</p><noscript><p>Text for readers without scripts, in the story.</p></noscript>
    <p>See <object data="x">the drawn map of the town</object> below.</p></article></body>"""
    assert main_text(model, page) == (
        "The area is a=r and it grows. Text for readers without scripts, in the story. See the drawn map of the town below."
    )


@pytest.mark.parametrize(
    "page",
    [
        "<body><article><p>{}</p></article>", '<div id="content"><p>{}</p></div>', "{}", "<p>{}", "<html><body>{}</body></html>",
        "<html><head><title>Some name</title></head><body><article><p>{}</p></article></body></html>",
        '<body><nav><ul><li><a href="/">Home</a><li><a href="/b">About</a></ul></nav><article><p>{}</p></article></body>',
    ],
)
def test_pages_of_one_block(model, page):
    text = "One paragraph of some twenty words that tells what happened in the town on the last day of the old year."
    assert main_text(model, page.format(text)) == text


@pytest.mark.parametrize(
    "page",
    ['<nav><a href="/">Home</a> <a href="/b">About</a></nav>', "<footer>&copy; 2020 Site</footer>", '<div class="cookie-notice">We use cookies.</div>'],
)
def test_furniture_alone_is_no_article(model, page):
    assert main_text(model, page) == ""


def test_viterbi_finds_the_best_of_all_paths():
    rng = np.random.default_rng(4)
    for n in range(1, 9):
        for _ in range(30):
            field = Field(rng.normal(size=len(FEATURES)), rng.normal(size=(2, 2)), rng.normal(size=2))
            blocks = [Block("x", int.from_bytes(rng.bytes(len(FEATURES) // 8), "little"), None) for _ in range(n)]

            def score(path):
                total = field.first[path[0]] + sum(field.follow[a, b] for a, b in zip(path, path[1:]))
                return total + sum(field.score(b.features) for b, y in zip(blocks, path) if y)

            best = max(itertools.product([0, 1], repeat=n), key=score)
            assert viterbi(field, blocks) == [bool(y) for y in best]


def test_gradient_equals_differences():
    rng = np.random.default_rng(6)
    x, y = (rng.random((5, len(FEATURES))) < 0.1).astype(float), np.array([0, 1, 1, 0, 1])
    weights, follow, first = rng.normal(size=len(FEATURES)) / 3, rng.normal(size=(2, 2)), rng.normal(size=2)

    def likelihood(w, f, s):
        def score(path):
            return s[path[0]] + sum(f[a, b] for a, b in zip(path, path[1:])) + sum((x[t] @ w) * v for t, v in enumerate(path))

        return score(y) - np.logaddexp.reduce([score(p) for p in itertools.product([0, 1], repeat=len(y))])

    slopes = extraction._gradient(x, y, weights, follow, first)
    for values, slope in zip((weights, follow, first), slopes):
        for at in list(np.ndindex(values.shape))[:12]:
            kept, h = values[at], 1e-5
            values[at] = kept + h
            up = likelihood(weights, follow, first)
            values[at] = kept - h
            down = likelihood(weights, follow, first)
            values[at] = kept
            assert slope[at] == pytest.approx((up - down) / (2 * h), abs=1e-4)


def test_repeated_rows_and_clashing_columns(spark, model):
    rows = [(1, ARTICLE, "a", 1), (1, ARTICLE, "b", 2), (2, None, None, 3), (None, ARTICLE, "text", 4), (3, "", "", 5)]
    pages = spark.createDataFrame(rows, "page_id bigint, html string, text string, blocks int")
    found = pages.withColumn("main", extractor(model)("html")).collect()
    assert [r["main"] for r in sorted(found, key=lambda r: r["blocks"])] == [PLAIN, PLAIN, "", PLAIN, ""]
    assert [r["text"] for r in sorted(found, key=lambda r: r["blocks"])] == [r[2] for r in rows]


def test_a_digit_anywhere_in_a_block_is_seen():
    long = "word " * 40
    assert blocks_of(f"<p>{long} 7</p>")[0].features != blocks_of(f"<p>{long} x</p>")[0].features
