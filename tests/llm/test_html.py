"""Main text of pages and the minimum cut behind it."""

import html
import random
import re

from lakestay.llm import html_extraction
from lakestay.llm.html_extraction import main_text, read_blocks
from lakestay.llm.max_flow import minimum_cut
from lakestay.llm.entries import QUERIES
from tests.llm.common import FOLDER

LONG = "This paragraph says enough to be taken for the text of an article, and then goes on."


def cost(labels, scores, edges):
    own = sum(-s if s < 0 else 0 for s, x in zip(scores, labels) if x) + sum(s for s, x in zip(scores, labels) if not x and s > 0)
    return own + sum(w for i, j, w in edges if labels[i] != labels[j])


def test_minimum_cut_is_the_cheapest_of_all_labellings():
    draw = random.Random(5)
    for _ in range(300):
        n = draw.randint(0, 9)
        scores = [draw.randint(-9, 9) for _ in range(n)]
        edges = [(draw.randrange(n), draw.randrange(n), draw.randint(1, 9)) for _ in range(draw.randint(0, 14))] if n else []
        edges = [e for e in edges if e[0] != e[1]]
        least = min(cost([bool(k >> i & 1) for i in range(n)], scores, edges) for k in range(1 << n))
        assert cost(minimum_cut(scores, edges), scores, edges) == least


def test_long_chains_are_cut():
    n = 20_000
    scores = [(-1) ** (i // 50) * 3 for i in range(n)]
    labels = minimum_cut(scores, [(i, i + 1, 40) for i in range(n - 1)])
    assert cost(labels, scores, [(i, i + 1, 40) for i in range(n - 1)]) <= sum(s for s in scores if s > 0)


def test_parts_around_the_article_go():
    page = f"""<!DOCTYPE html><html><head><title>T</title><style>p {{}}</style></head><body class="has-sidebar">
    <header class="top"><a href="/">Home</a></header><nav><ul><li><a href=1>One</a><li><a href=2>Two</a></ul></nav>
    <!-- <p>not this</p> --><div class="ad">Buy this. {LONG}</div>
    <article><h1>Title &amp; more</h1><p><b>Short.<br><p>{LONG}</p><script>var a = "</p><p>no";</script>
    <div class='share-box'>Share it</div><blockquote>Said &#8220;so&#8221;&nbsp;twice</blockquote>
    <section id=comments><p>{LONG} I liked it.</p></section></article>
    <aside><p>{LONG}</p></aside><form action="x>y"><label>Mail</label><p>{LONG}</p></form>
    <div id="cookie-notice"><p>{LONG}</p></div><footer>&copy; me</footer></body></html>"""
    assert main_text(page).split("\n") == ["Title & more", "Short.", LONG, "Said “so” twice"]


def test_pages_without_signs_go_by_their_text():
    page = f"<div><a href=1>Start</a> <a href=2>News</a></div><div><p>{LONG}</p><p>{LONG}</p></div><div><a href=3>Next</a></div>"
    assert main_text(page) == f"{LONG}\n{LONG}"


def test_broken_and_odd_pages():
    for page in (None, "", "   ", "<", "<p", "</p>", "<!-- open", "<script>never closed", "<a href='x", "<p>" * 3000):
        assert main_text(page) == ""
    assert main_text(f"<article><p>a < b and {LONG}") == f"a < b and {LONG}"
    assert main_text(f"<article><p title=it's>{LONG}</p><p title=\"x>y\">{LONG}") == f"{LONG}\n{LONG}"
    assert main_text("<article>" + "<p>one word</p>" * 5000).count("\n") == 4999


def test_blocks_follow_implied_ends():
    page = "<ul><li>a<li>b <p>c</ul><table><tr><td>d<td>e</table><p>f<div>g</div>h"
    assert [b.text for b in read_blocks(page)] == list("abcdefgh")


def test_rows_of_all_kinds(spark):
    rows = [(1, "u", f"<article><p>{LONG}</article>", "x"), (None, None, None, "y"), (1, "u", "", "z"), (1, "u", "", "z")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, text string")
    got = sorted(html_extraction.extract(pages).collect(), key=str)
    want = [(1, "u", LONG, len(LONG)), (None, None, "", 0), (1, "u", "", 0), (1, "u", "", 0)]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert html_extraction.extract(pages.limit(0)).count() == 0


def article_text(page: str) -> str:
    """All text of the only article of a page of the supplied tables, by plain replacement."""
    inside = re.search(r"<article>(.*)</article>", re.sub(r"<!--.*?-->", "", page, flags=re.S), re.S)[1]
    inside = re.sub(r"(?s)<(script|style)\b.*?</\1>", "", inside)
    inside = re.sub(r"<br ?/?>", " ", inside)
    lines = re.split(r"</?(?:p|h\d|div|ul|ol|li|blockquote|section|table|tr|td|pre|figure|figcaption)\b[^>]*>", inside)
    lines = [" ".join(html.unescape(re.sub(r"</?[a-zA-Z][^>]*>", "", x)).split()) for x in lines]
    return "\n".join(x for x in lines if x)


def test_query_gives_every_page_its_article(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{FOLDER}/pages.parquet").collect()}
    rows = QUERIES["op2_html_extraction"](spark, FOLDER).collect()
    assert {r.page_id for r in rows} == set(pages)
    for r in rows:
        assert r.n_chars == len(r.text) and r.url == pages[r.page_id].url
        assert r.text == article_text(pages[r.page_id].html)


def test_letters_count_wherever_a_block_has_them():
    block = html_extraction.Block("1 " * 150 + LONG, html_extraction.CONTENT, "p", 0, 0.0)
    bare = block._replace(text="1 " * 150 + "2 " * 40 + "3.")
    assert html_extraction.block_score(block, False) == html_extraction.block_score(bare, False) + 60


def test_parts_of_the_article_stay_whatever_their_name():
    for part in (
        f'<article><p>{LONG}</p><section id="discussion"><h2>Discussion</h2><p>{LONG}</p></section></article>',
        f'<main><div class="book-reviews"><h2>Books</h2><p>{LONG}</p></div></main>',
        f'<div class="entry tag-search"><h2>Title</h2><p>{LONG}</p></div>',
        f'<div class="entry site-search"><h2>Title</h2><p>{LONG}</p></div>',
        "<div><p>It rained.</p><p>We stayed.</p><p>Then it was over.</p></div>",
        "<div>It rained.</div><div>We stayed.</div>",
    ):
        page = f"<body><nav><a href=1>Home</a></nav>{part}<footer>&copy; me</footer></body>"
        want = [x for x in re.split(r"<[^>]*>", part) if x]
        assert main_text(page).split("\n") == want, part


def test_several_entries_of_users_are_comments():
    entry = f'<div><span class="username">Ann</span><p>{LONG} I agree.</p></div>'
    page = f'<article><p>{LONG}</p><div class="discussion">{{}}</div></article>'
    assert main_text(page.format(entry * 3)) == LONG
    assert main_text(page.format(entry)).count("\n") == 2


def test_the_cut_overrules_the_sign_of_a_block():
    page = f"<div><p>{LONG}</p><p>Then came May.</p><p>{LONG}</p></div><div><p>Next</p></div><ul><li><a href=1>Up</a><li><a href=2>Top</a></ul>"
    blocks = read_blocks(page)
    own = [html_extraction.block_score(b, False) > 0 for b in blocks]
    assert own == [True, False, True, False, False, False]
    assert html_extraction.label(blocks) == [True, True, True, False, False, False]


def test_edges_weaken_with_the_elements_between_blocks():
    near = read_blocks("<div><p>a</p><p>b</p></div>")
    far = read_blocks("<div><div><div><p>a</p></div></div></div><div><div><div><p>b</p></div></div></div>")
    weight = [sum(w for _, _, w in html_extraction.smoothness(x)) for x in (near, far)]
    assert weight[0] == html_extraction._NEXT + html_extraction._SIBLING and 0 < weight[1] < weight[0] / 4


def test_lists_of_links_in_the_article_stay():
    items = "".join(f"<li><a href={i}>Work {i}</a>" for i in range(30))
    assert main_text(f"<article><p>{LONG}</p><ul>{items}</ul></article>").count("\n") == 30
    cells = "".join(f"<tr><td>{i}<td><a href=x>{i}</a>" for i in range(30))
    assert main_text(f"<article><p>{LONG}</p><table>{cells}</table></article>").count("\n") == 60
