"""Main text of pages as they are, of other layouts, and of broken markup."""

import html
import re

import pytest

from panelcast.llm import html_extract as H

SCHEMA = "page_id long, url string, html string"


def plain_article(page):
    found = re.search(r"<article>(.*?)</article>", page or "", re.S)
    if not found:
        return ""
    spaced = re.sub(r"<(/?(p|h1|div|li|br))\b[^>]*>", " ", found[1])
    return " ".join(html.unescape(re.sub(r"<[^>]+>", "", spaced)).split())


@pytest.fixture(scope="module")
def pages(spark):
    return spark.read.parquet("/root/testdata/sf0.01/pages.parquet")


@pytest.fixture(scope="module")
def trees(pages):
    return H.fit(pages)


def extract(spark, trees, texts):
    table = spark.createDataFrame([(k, f"u{k}", t) for k, t in enumerate(texts)], SCHEMA)
    return [r.text for r in H.extract(table, trees).orderBy("page_id").collect()]


def test_corpus(pages, trees):
    got = {r.page_id: r.text for r in H.extract(pages, trees).collect()}
    want = {r.page_id: plain_article(r.html) for r in pages.collect()}
    assert got == want


def test_blocks_that_were_not_learned_from(pages, trees):
    assert H.agreement(pages, trees) >= 0.97


STORY = "".join(f"<p>This is sentence number {k} of the story. It goes on for a while, and it <b>nev</b>er ends &amp; more.</p>"
                for k in range(8))
STORY_TEXT = " ".join(f"This is sentence number {k} of the story. It goes on for a while, and it never ends & more." for k in range(8))


@pytest.mark.parametrize("before, after", [
    ("<header><h2>My site</h2><a href='/'>Home</a></header><div class='content'><article>",
     "<div class='comments'><p>Nice one, thanks for it.</p><p>I do not agree with you at all.</p></div></article></div>"),
    ("<div id=sidebar><ul><li><a href=1>One</a><li><a href=2>Two</a></ul></div><div class='post'>",
     "</div><aside><p>Related: other stories</p></aside><footer>&copy; 2020 All rights reserved</footer>"),
    ("<div class='cookie-notice'><p>We use cookies. Please accept them.</p></div><form><p>Search the site</p></form><main><section>",
     "</section></main><div class='comment-list'><div class='comment'><p>First! What a story this is.</p></div></div>"),
])
def test_other_layouts(spark, trees, before, after):
    page = f"<html><body>{before}{STORY}{after}<script>x='<p>no</p>'</script></body></html>"
    assert extract(spark, trees, [page]) == [STORY_TEXT]


def test_odd_pages(spark, trees):
    deep = "<div>" * 3000 + "x" + "</div>" * 3000
    long = "<article>" + STORY * 3000 + "</article>"
    got = extract(spark, trees, [None, "", "   ", "<", "<!-- open", "</p></div>", "<p", deep, long, "<script>only", "\x00<b>"])
    assert got[:3] == ["", "", ""] and len(got) == 11
    assert got[8] == " ".join([STORY_TEXT] * 3000)


def test_empty_table_and_clashing_columns(spark, trees, pages):
    assert H.extract(pages.where("false"), trees).count() == 0
    assert H.fit(pages.where("false")) == []
    from pyspark.sql import functions as F

    named = pages.limit(3).withColumns({"text": F.lit("clash"), "n_chars": F.lit(1)})
    assert H.extract(named, trees).columns == ["page_id", "url", "text"]


def test_nothing_learned_keeps_dense_blocks(spark):
    page = f"<div class='menu'><p>{STORY}</p></div><h2>Title</h2>{STORY}<footer><p>All of this is ours. Keep your hands off it.</p></footer>"
    assert extract(spark, [], ["<p>words</p>", page]) == ["", "Title " + STORY_TEXT]


def div_page(k, wrap="{}"):
    story = "".join(f"<p>Sentence {i} of page {k} tells more than the one before it, and then it stops.</p>" for i in range(3 + k % 5))
    return wrap.format(
        f"<div class='menu'><a href=/>Home</a> <a href=/n>News</a></div><div class='post'><h1>Page {k}</h1>{story}</div>"
        f"<div class='comments'><p>I liked page {k} a lot, thanks. Please write more of it.</p></div>"
        "<div class='footer'>© All rights reserved</div>"), f"Page {k} " + " ".join(re.findall("<p>(.*?)</p>", story))


def test_table_without_named_articles(spark):
    texts, want = zip(*[div_page(k) for k in range(60)])
    table = spark.createDataFrame([(k, f"u{k}", t) for k, t in enumerate(texts)], SCHEMA)
    learned = H.fit(table)
    assert learned
    got = extract(spark, learned, texts)
    assert sum(g == w for g, w in zip(got, want)) >= 0.9 * len(want)
    assert extract(spark, [], texts) == list(want)


def test_form_around_the_page(spark, trees):
    inner = f"<article><h1>Head</h1>{STORY}</article>"
    search = "<form><p>Search all of this site for words. Type them here.</p><input></form>"
    login = "<form id=f><label>Name</label><input><select><option>One</select><button>Go</button></form>"
    got = extract(spark, trees, [
        f"<body><form id=aspnet><input type=hidden>{inner}<select><option>One</select></form></body>",
        f"<body>{search}{inner}{login}</body>",
        f"<body><article><p>Short one.</p></article><form>{STORY}</form></body>",
        f"<body>{login}</body>",
    ])
    assert got == ["Head " + STORY_TEXT, "Head " + STORY_TEXT, "Short one.", ""]


def test_training_pages_without_named_article():
    assert H.examples("<div><p>One two.</p></div>", 1) == []
    page = H.examples(f"<div>{STORY}</div><p>© us</p><div class=menu><p>Home</p></div>", 1)[0]
    assert [b.source for b in H.in_order(page)] == [True, True] + [True] * 8 + [None, False, False]
    assert len(H.examples(f"<article>{STORY}</article>", 1)) == 3


def test_parse_closes_what_markup_leaves_open():
    root = H.parse("<ul><li>a<li>b</ul><p>c<p>d<div>e</div>f<br>g &lt;h&gt;<!-- no --><style>p{}</style>")
    found = [t for b in H.in_order(root) for _, t in H.texts_of(b)]
    assert sorted(found) == ["a", "b", "c", "d", "e", "f g <h>"]


def test_an_unclosed_head_ends_where_blocks_begin(spark, trees):
    page = f"<html><head><meta charset=x><title>t</title><style>p{{}}</style><body><article>{STORY}</article>"
    assert extract(spark, trees, [page]) == [STORY_TEXT]


def test_decoding_never_keeps_a_block_of_a_dropped_one():
    root = H.parse("<div><p>a</p><div><p>b</p></div></div><div><p>c</p></div>")
    blocks = H.in_order(root)
    odds = [0, -1.0, 3.0, -5.0, 2.0, -4.0, 3.0]
    keep = H.decode(blocks, odds)
    assert keep == [True, True, True, False, False, False, False]
    assert H.text_of(root, {id(b) for b, k in zip(blocks, keep) if k}) == "a"
