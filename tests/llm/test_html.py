import html as entities
import re

import pytest
from pyspark.sql import functions as F

from pulsegrid.llm import html
from pulsegrid.llm.html_pages import PAGES


@pytest.fixture(scope="module")
def tree():
    return html.fit_tree(*html.labelled_rows(PAGES))


def texts(page):
    return [b.text for b in html.blocks_of(page)]


@pytest.mark.parametrize("page,want", [
    ("<p>a<p>b<br>c</p>d", ["a", "b c", "d"]),
    ("<p>x &amp;lt; &#233;&nbsp;&copy;\n\t y</p>", ["x &lt; é © y"]),
    ("a <b>bold</b>ly <i>put</i>", ["a boldly put"]),
    ("<script>var t='</p>'; if (a<b) {}</script><style>p>a{}</style>z", ["z"]),
    ("<!-- <p>no</p> --><p>yes<!-- open", ["yes"]),
    ("1 < 2 and <3 <p title='a>b'>in</p>", ["1 < 2 and <3", "in"]),
    ("<ul><li>one<li>two<ul><li>in</ul><li>three</ul>", ["one", "two", "in", "three"]),
    ("<p hidden>no</p><div style='display: none'><p>no</p></div><p>yes</p></div></section>", ["yes"]),
    ("<title>no</title><textarea>no</textarea><SCRIPT>no</SCRIPT><p>yes", ["yes"]),
    ("<p a=\"broken>text</p><p>more</p>", ["text", "more"]),
    ("", []), ("   \n", []), ("<p></p><br>", []), ("plain", ["plain"]),
])
def test_blocks(page, want):
    assert texts(page) == want


def test_block_features():
    blocks = html.blocks_of("<nav><a href=1>all</a></nav><article><p>half <a>half</a></p></article><div class='adBox sideBar'>x</div><div class='bread'>y</div>")
    assert [(b.boilerplate, b.content, b.names) for b in blocks] == [(1, 0, 0), (0, 1, 0), (0, 0, 1), (0, 0, 0)]
    rows = html.features([blocks, [], blocks])
    assert rows.shape == (8, len(html.FEATURES))
    assert (rows[:4] == html.features([blocks])).all() and (rows[4:] == rows[:4]).all()
    assert rows[0, 1] == 1.0 and 0.3 < rows[1, 1] < 0.5 and rows[1, html.FEATURES.index("link_density_before")] == 1.0


def test_tree_on_pages_it_has_not_seen():
    """Leave one page out: most of its blocks are judged right."""
    right = total = 0
    for i, page in enumerate(PAGES):
        rows, labels = html.labelled_rows([page])
        tree = html.fit_tree(*html.labelled_rows(PAGES[:i] + PAGES[i + 1 :]))
        right += (tree.content(rows) == (labels > 0.5)).sum()
        total += len(labels)
    assert right / total > 0.85


@pytest.mark.parametrize("part", [
    "<nav><p>Some long text in a menu that looks like any other text</p></nav>", "<div class='cookie-banner'><p>We use cookies to count visits of our pages.</p></div>",
    "<aside><p>More on this topic can be found in last week's edition.</p></aside>", "<form><p>Tell us what you think of this.</p><input></form>",
    "<section id='comments'><p>I think that this is quite wrong, and here is why.</p></section>", "<div class='ad'>Buy one and get one more for free.</div>",
    "<footer><p>All rights reserved.</p></footer>", "<header><p>The paper for all of the county</p></header>", "<div class='sidebar'><ul><li>One thing</li></ul></div>",
    "<div id='notice'><p>Our shop stays closed on Monday.</p></div>",
])
def test_boilerplate_goes(tree, part):
    body = "<h1>Head</h1><p>Yes.</p><p>A longer text that says a little more about it.</p>"
    want = "Head\nYes.\nA longer text that says a little more about it."
    for page in (f"{part}<article>{body}</article>", f"<article>{body}</article>{part}", f"<main>{body}</main>{part}</body>", f"<article>{body}{part}</article>"):
        if page.startswith("<article>") and page.endswith("</article>") and "<header>" in part:
            continue
        assert html.main_texts([page], tree) == [want]


def test_odd_pages(spark, tree):
    long = "<article>" + "<p>one more short line</p>" * 20_000 + "</article>"
    rows = [(1, "u", None), (2, None, ""), (2, None, ""), (None, "u", "<article><p>a</p></article>"), (3, "u", long), (4, "u", "<" * 5000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    got = {(r.page_id, r.url): r for r in html.extract_main_text(pages, tree).collect()}
    assert got[1, "u"].text == got[2, None].text == "" and got[None, "u"].text == "a"
    assert got[3, "u"].n_chars == 20_000 * len("one more short line\n") - 1
    assert html.extract_main_text(pages, tree).count() == len(rows)
    assert html.extract_main_text(pages.limit(0), tree).count() == 0


def test_query_takes_articles_of_given_pages(spark):
    from pulsegrid.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    rows = QUERIES["op2_main_text"](spark, sf).collect()
    assert len(rows) == len(pages)
    for r in rows:
        article = re.search(r"<article>(.*?)(?:</article>|<footer|\Z)", pages[r.page_id], re.S)[1]
        parts = [" ".join(entities.unescape(re.sub(r"<[^>]+>", " ", p)).split()) for p in re.split(r"</?(?:p|h1)>", article)]
        assert r.text == "\n".join(p for p in parts if p) and r.n_chars == len(r.text)


@pytest.mark.parametrize("attributes, hides", [
    ('title="the hidden door"', False), ('class="flex hidden md:block"', False), ("data-x='a hidden b'", False), ("class=hidden", False),
    ('title="display: none is CSS"', False), ('title="aria-hidden=true"', False), ('style="x-display:none"', False), ('aria-hidden="false"', False),
    ('data-hidden="1"', False), ("hidden", True), ('class="a"hidden', True), ('id=x HIDDEN=""', True), ('hidden="hidden" class="b"', True),
    ('title="it is hidden" hidden', True), ('style="color:red; DISPLAY : none!important"', True), ("style=display:none", True), ("aria-hidden=true", True),
])
def test_only_hiding_attributes_hide(attributes, hides):
    assert texts(f"<div {attributes}><p>inside</p></div><p>after</p>") == ([] if hides else ["inside"]) + ["after"]


OPEN_ENDS = {
    '<p>for sure</p><div class="x never ends': "for sure", "<p>a</p><script> var x = 1;": "a", "<p>a</p><!-- a > b c": "a", "<p>a</p><title>b > c": "a",
    "<p>a</p><!-- x -->tail": "a|tail", "<p>a</p><script>x</script\n>tail": "a|tail", "<p>a</p><!doctype x>tail": "a|tail", "a < b": "a < b", "a > b <c": "a > b",
    "<p>a</p><!-->b": "a",
}


@pytest.mark.parametrize("page", OPEN_ENDS)
def test_markup_without_an_end_is_no_text(page):
    assert "|".join(b.text for b in html.blocks_of(page)) == OPEN_ENDS[page]


@pytest.mark.parametrize("part,times", [("<div>x<p>", 100_000), ("<li>x", 150_000), ("<span>x", 140_000), ("<b x ", 200_000), ('<a "', 250_000), ("<!-- ", 200_000), ("x</b></div>", 90_000), ("<i><div>x</i>", 75_000)])
def test_a_hostile_page_of_a_megabyte_takes_seconds(part, times):
    import time

    start = time.time()
    html.blocks_of(part * times)
    assert time.time() - start < 15
