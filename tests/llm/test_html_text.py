"""Main text of pages: the density method against a naive version, and pages of many shapes."""

import html.parser
import math
import random

import pytest

from tallyroll.llm import html_text
from tallyroll.llm.html_text import main_text

P = "A paragraph of the article that has some length, so that its density is that of running text, number {}."


def paragraphs(n, start=0):
    return "".join(f"<p>{P.format(k)}</p>" for k in range(start, start + n))


def lines(n, start=0):
    return "\n".join(P.format(k) for k in range(start, start + n))


@pytest.mark.parametrize("page,text", [
    (None, ""), ("", ""), (" \n ", ""), ("no markup at all", "no markup at all"), ("<p>one", "one"), ("<p", ""), ("<b>a</b> b<br>c", "a b c"),
    ("<p>a &amp b &#x41;&eacute;&nbsp; c&lt;</p>", "a & b Aé c<"), ("<p>a < b > c</p>", "a < b > c"), ("<!-- <p>no</p> --><p>yes</p><!-- open <p>no", "yes"),
    ("<script>var t = '</p><p>no</p>';</script><style>p{}</style><p>yes</p>", "yes"), ("<p>one<p>two<li>three<li>four", "one\ntwo\nthree\nfour"),
    ("<table><tr><td>a<td>b<tr><td>c</table>", "a b\nc"), ("<p>x</p><script>cut", "x"), ("<p title='a > b'>x</p><p title=\"open>y</p>", "x\ny"),
    ("<head><title>t</title></head><p>x</p>", "x"), ("<body hidden><p>x</p></body>", "x"), ("</p></div>x</body>y", "xy"), ("<p>a<div>b</div>c", "a\nb\nc"),
])
def test_markup(page, text):
    assert main_text(page or "") == text


JUNK = ["<nav><ul><li><a href=/>Home</a><li><a href=/a>About this site</a></ul></nav>", "<header><h2>Name of the site</h2><p>Its motto is quite long, longer than others.</p></header>",
        "<footer>&copy; all rights are reserved by someone.</footer>", "<aside><p>Text of a sidebar that runs on for a while and then some more.</p></aside>",
        '<div class="cookie-notice"><p>This site keeps cookies, as all of them do these days, for no good reason.</p></div>', '<div id="adSlot1">Buy one thing, get two things, pay for three.</div>',
        "<form action=/><label>Your name</label><input name=x><button>Send it now</button></form>", "<script>var a = '<p>text</p>';</script>", "<style>p { margin: 0 }</style>",
        '<section class="comments"><article class="comment"><p>' + "A reader has much to say about it all. " * 20 + "</p></article></section>",
        '<div role="alert">Something is the matter with your session.</div>', '<div style="display: none">Hidden words that no one should ever see.</div>',
        '<ul><li><a href=/1>One more story</a><li><a href=/2>Two more stories</a><li><a href=/3>Three more stories</a></ul>']


@pytest.mark.parametrize("open_,close", [("<article>", "</article>"), ("<main>", "</main>"), ('<div class="post">', "</div>"), ("<div><div>", "</div></div>"), ('<div class="with-sidebar"><div>', "</div></div>"), ("<article><div>", "</div>")])
def test_junk_goes_and_the_article_stays(open_, close):
    r = random.Random(len(open_))
    for n in (3, 12):
        around = [r.sample(JUNK, 4) for _ in range(2)]
        inner = [paragraphs(1, k) for k in range(n)]
        for junk in r.sample(JUNK, 3):
            inner.insert(r.randrange(len(inner)), junk)
        page = f"<html><body>{''.join(around[0])}{open_}<h1>The title</h1>{''.join(inner)}{close}{''.join(around[1])}</body></html>"
        assert main_text(page) == "The title\n" + lines(n), page


def test_short_and_long_blocks_stay():
    long = " ".join(f"word{k}" for k in range(50_000))
    page = f"<body><nav><a href=/>x</a></nav><article><h1>T</h1><p>So.</p><p>{long}</p><p>A.<p>{P.format(1)}<ul><li>one<li><a href=/>two</a></ul></article><div class=ad>{P.format(2)}</div></body>"
    assert main_text(page) == f"T\nSo.\n{long}\nA.\n{P.format(1)}\none\ntwo"


def test_an_article_shorter_than_the_advert():
    assert main_text(f'<body><div class="ad">{P.format(1)}</div><article><h1>So.</h1><p><b>So.<br></article><footer>{P.format(2)}</footer>') == "So.\nSo."


def test_sections_without_an_article_element():
    page = f"<body><div><h1>Title</h1><div>{paragraphs(5)}</div><div>{paragraphs(5, 5)}</div></div><div>short</div></body>"
    assert main_text(page) == "Title\n" + lines(10)


def test_deep_nesting_and_many_open_tags():
    assert main_text("<div>" * 30_000 + "x") == "x"
    assert main_text("<b>" * 20_000 + P.format(1) + "</b>" * 20_000) == P.format(1)


class Tree(html.parser.HTMLParser):
    """Nested lists [tag, items] of well-formed pages."""

    def __init__(self):
        super().__init__()
        self.root = ["html", []]
        self.stack = [self.root]

    def handle_starttag(self, tag, attrs):
        one = [tag, []]
        self.stack[-1][1].append(one)
        self.stack.append(one)

    def handle_endtag(self, tag):
        assert self.stack.pop()[0] == tag

    def handle_data(self, data):
        self.stack[-1][1].append(data)


def counts(x, link=False):
    """(C, T, LC, LT) of an element's subtree, by recursion."""
    link = link or x[0] == "a"
    c, t, lc, lt = 0, 0, 0, int(x[0] == "a")
    for i in x[1]:
        if isinstance(i, str):
            n = len("".join(i.split()))
            c, lc = c + n, lc + n * link
        else:
            own = counts(i, link)
            c, t, lc, lt = c + own[0], t + own[1] + 1, lc + own[2], lt + own[3]
    return c, t, lc, lt


def naive_density(x, body):
    c, t, lc, lt = counts(x)
    if not c:
        return 0.0
    base = math.log(c / max(1, c - lc) * max(1, lc) + body[2] / body[0] * c + math.e)
    return c / max(1, t) * max(0.0, math.log(c / max(1, lc) * max(1, t) / max(1, lt)) / math.log(base))


def test_densities_and_the_largest_sum_equal_a_naive_version():
    r = random.Random(5)

    def block(depth):
        if depth == 0 or r.random() < 0.4:
            words = " ".join("w" * r.randrange(1, 9) for _ in range(r.randrange(1, 30)))
            return f"<p>{words}" + ("<a>linked words</a>" if r.random() < 0.3 else "") + "</p>"
        return "<div>" + "".join(block(depth - 1) for _ in range(r.randrange(1, 5))) + "</div>"

    for _ in range(60):
        page = "<div>" + "".join(block(3) for _ in range(4)) + "</div>"
        tree = Tree()
        tree.feed(page)
        body, naive = counts(tree.root), []

        def walk(x):
            kids = [i for i in x[1] if not isinstance(i, str) and i[0] != "a"]
            total = sum(naive_density(k, body) for k in kids)
            if x[0] == "p":
                total = naive_density(x, body)
            naive.append((naive_density(x, body), total))
            for k in kids:
                walk(k)

        walk(tree.root)
        root = html_text.parse(page)
        blocks = html_text.set_densities(root)
        assert sorted(round(d, 6) for d, _ in naive) == sorted(round(x.density, 6) for x in blocks)
        assert math.isclose(max(s for _, s in naive), max(x.own for x in blocks), rel_tol=1e-9)


def test_whole_table(spark, sf):
    """On the given pages the article's markup tells what the text must be."""
    import html as h
    import re

    pages = spark.read.parquet(f"{sf}/pages.parquet")
    rows = html_text.extract(pages).collect()
    assert len(rows) == pages.count()
    sources = {r.page_id: r.html for r in pages.collect()}
    for r in rows:
        article = re.search(r"<article>(.*?)(</article>|<footer|$)", sources[r.page_id] or "", re.DOTALL)
        parts = re.split(r"</?(?:h1|p)>", article.group(1)) if article else []
        want = "\n".join(t for t in (" ".join(h.unescape(re.sub("<[^>]*>", " ", p)).split()) for p in parts) if t)
        assert r.text == want and r.n_chars == len(want)


def test_odd_rows(spark):
    rows = [(1, "u", None), (None, None, "<p>x</p>"), (2, "u", "<p>x</p>"), (2, "u", "<p>x</p>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'clash' AS text", "1 AS n_chars")
    found = sorted((tuple(r) for r in html_text.extract(df).collect()), key=repr)
    assert found == sorted([(1, "u", "", 0), (None, None, "x", 1), (2, "u", "x", 1), (2, "u", "x", 1)], key=repr)
    assert html_text.extract(df.limit(0)).collect() == []
