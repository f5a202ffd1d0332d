import html
import itertools
import math
import re
from collections import Counter

import pytest

from revspine.llm import queries
from revspine.llm.common import table
from revspine.llm.html_extract import _TOKEN, edge_groups, extract, extract_pages, features, fit, labels, main_text, marginals, parse, train

PAGES = "page_id long, url string, html string"


@pytest.fixture(scope="module")
def model(spark):
    return fit(table(spark, "/root/testdata/sf0.01", "pages"))


def plain(page):
    """The article of the test pages, by patterns that know their layout."""
    m = re.search(r"<article>(.*?)(</article>|$)", page or "", re.DOTALL)
    body = re.sub(r"<[^>]*$", "", re.sub(r"<!--.*?-->", "", m[1], flags=re.DOTALL)) if m else ""
    parts = (re.sub(r"<[^>]+>", lambda t: " " if t[0].startswith("<br") else "", p) for p in re.split(r"</?(?:p|h1)>", body))
    return "\n".join(line for line in (" ".join(html.unescape(p).split()) for p in parts) if line)


def test_query_matches_brute_force(spark):
    sf = "/root/testdata/sf0.1"
    pages = {r.page_id: r for r in table(spark, sf, "pages").collect()}
    got = queries.op9_html_extraction(spark, sf).collect()
    assert len(got) == len(pages)
    for r in got:
        assert (r.url, r.text, r.n_chars) == (pages[r.page_id].url, plain(pages[r.page_id].html), len(r.text))


def test_marginals_equal_enumeration(model):
    page = "<body><nav><ul><li><a href=x>home</a></ul></nav><div class=content><p>Some text of a page.<p>And more of it</div><footer>end"
    nodes, _ = parse(page)
    f, groups = features(nodes), edge_groups(nodes)
    weight = [math.exp(max(-6, min(6, sum(model["ratio"].get(n, {}).get(v, 0.0) for n, v in x)))) for x in f]
    total, yes = 0.0, [0.0] * len(nodes)
    for states in itertools.product((0, 1), repeat=len(nodes)):
        p = 0.001 if states[0] else 0.999
        for k, s in enumerate(states):
            p *= weight[k] if s else 1.0
            if k:
                p *= model["edge"][groups[k]][2 * states[nodes[k].parent] + s]
        total += p
        for k, s in enumerate(states):
            yes[k] += p * s
    assert all(abs(m - y / total) < 1e-9 for m, y in zip(marginals(nodes, model), yes, strict=True))


def test_parts_of_other_kinds_go(model):
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body><header>Site name</header><div id="cookie-notice">We use cookies</div>
    <article><header>Kicker</header><h1>A &amp; B</h1><p>First <b>bold</b>
      text, long enough &eacute; to be read.<p>Second<br>line <a href="?a>b">link</a>.<ul><li>one<li>two</ul>
    <script>var x = "<p>no</p>";</script><form><input>Subscribe</form><aside>Related</aside><div class="ad">Buy</div><table><tr><td>a<td>b</table>
    <section class="comments"><p>I like this article very much, thank you.</p></section></article><div class="sidebar"><p>Popular posts of the week</p></div><footer>&copy; x</footer></body></html>"""
    assert extract(page, model) == "A & B\nFirst bold text, long enough é to be read.\nSecond line link.\none\ntwo\na\nb"


def test_a_line_feed_between_inline_elements_is_a_space(model):
    page = "<body><article><p>See <a>one</a>\n<a>two</a> and <!-- x -->\n<b>more</b>\n<i>of it</i></p>\n<p>Next.</p></article>"
    assert extract(page, model) == "See one two and more of it\nNext."


@pytest.mark.parametrize("part,text", [('<svg class="x" viewBox="0 0 1 1"/>', ""), ("<math/>", ""), ("<button>Go ", "Go "), ("<select><option>Go ", "\nGo "), ("<canvas>", ""), ("<video src=x>", ""), ("<object data=x>Text instead.</object>", "Text instead."), ("<audio>Text instead.</audio>", "Text instead."),
                                       ("<math><mi>x</mi><mo>=</mo><mn>1</mn></math>", "x=1"), ("<button><div>Subscribe</div></button>", "\n"), ("<select><option>One<option>Two</select>", "\n")])
def test_embedded_parts_lose_no_article_text(model, part, text):
    page = f"<body><article><h1>Title</h1><p>The first paragraph, {part}with more of it.</p><p>And the second one.</p></article><button>Site</button></body>"
    body = "\n".join(line for x in f"The first paragraph, {text}with more of it.".split("\n") if (line := " ".join(x.split())))
    assert extract(page, model) == f"Title\n{body}\nAnd the second one."


def test_pages_without_marks(model):
    page = "<body><nav><a href=a>Home</a></nav><div class=content><h2>Title</h2><p>The first paragraph of a page without any article element.</p><p>The second one.</p></div><section class=comments><article class=comment><p>A comment by some reader, quite long.</p></article></section>"
    assert extract(page, model) == "Title\nThe first paragraph of a page without any article element.\nThe second one."


@pytest.mark.parametrize("page", [None, "", "<", "<p", "</p></b>", "<a <b <c", "<!-- open", "<script>never closed", "&#xffffffff; &bogus; &#0;", "<p " + "x" * 50000, "<div>" * 3000 + "deep" + "</div>" * 10, "<b>" * 2000, "a<p>b" * 5000, "\x00<p>�</p>", "<li><td><option>x", '<p class="unclosed>text</p>'])
def test_odd_pages_do_not_fail(model, page):
    assert isinstance(extract(page, model), str)


def test_labels_come_from_marks():
    nodes, _ = parse("<body><main><p>x</p><form>y</form></main><p>z")
    assert dict(zip([n.tag for n in nodes], labels(nodes), strict=True)) == {"#root": 0, "body": 0, "main": 1, "p": 0, "form": 0}
    assert labels(parse("<div>x</div>")[0]) is None


def test_tables(spark, model):
    rows = [(1, None, None), (None, "u", ""), (2, "v", "<article><p>Text of an article, here.</article>"), (2, "v", "<article><p>Text of an article, here.</article>")]
    df = spark.createDataFrame(rows, PAGES)
    got = sorted(map(tuple, extract_pages(df).collect()), key=repr)
    assert len(got) == 4 and sum(r[2] == "Text of an article, here." for r in got) == 2 and (1, None, "", 0) in got and (None, "u", "", 0) in got
    assert extract_pages(spark.createDataFrame([], PAGES)).count() == 0
    clash = main_text(df.selectExpr("*", "'x' AS text", "array(1) AS n_chars", "2 AS _h"), model)
    assert clash.columns == ["page_id", "url", "_h", "text", "n_chars"] and clash.count() == 4


def test_prior_counts_alone_decide():
    m = train(Counter())
    assert extract("<nav>menu</nav><article><p>text of it</p></article>", m) == "text of it"


def test_quotes_open_values_only_behind_an_equals_sign():
    page = """<html><body><article><p>one <a title=it's href=x>two</a> three.</p><p>It's four.</p><p><a href="x"">five</a> <b data-a='1>2'>six</b> <i a="x>y" b=c>seven</i></p></article></body></html>"""
    assert extract(page, train(Counter())) == "one two three.\nIt's four.\nfive six seven"
    assert len(list(_TOKEN.finditer("<a " + "x=\"" * 3000))) == 0  # an unclosed tag takes no exponential time
