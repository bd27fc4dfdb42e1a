"""URL rules and main-text extraction."""

import random
import re
from html import unescape

import pytest

from tillcast.llm import html_density, url_rules

from conftest_llm import SF, values


@pytest.fixture(scope="module")
def pages(spark):
    return spark.read.parquet(f"{SF}/pages.parquet")


def brute_host_path(url):
    if url is None or "://" not in url:
        return "", ""
    match = re.match(r"([^/?#]*)([^?#]*)", url[url.index("://") + 3 :], re.S)
    return re.sub("[A-Z]", lambda m: m[0].lower(), match[1]), match[2]


def brute_verdict(url, rules=url_rules.RULES):
    host, path = brute_host_path(url)
    fit = []
    for verdict, rule in rules:
        rule_host, _, rest = rule.partition("/")
        if ("." + host).endswith("." + rule_host) and path.startswith("/" + rest):
            fit.append((-len(rule), rule, verdict))
    _, rule, verdict = min(fit, default=(0, None, url_rules.DEFAULT))
    return host, path, rule, verdict


ODD_URLS = [
    None, "", "example.com/en/", "http://", "http://EXAMPLE.com/en/x", "http://www.example.com/en/x", "http://a.www.example.com/en/",
    "http://badexample.com/en/x", "http://example.com", "http://example.com?x=/en/", "http://example.com/EN/", "http://x.net/es/?a#b",
    "http://net/es/", "http://net/es", "http://evil.org/.example.com/en/", "http://evil.org/x.net/es/y", "https://x.com:80/en/",
    "http://ÄÉ.com/é?", "://com/", "a://b://example.com/en/", "http://example.com/en/" + "x" * 5000, "http://x.net/fr/#/en/",
    "http://com/", "http://.com/x", "http://x.net/es/\nq",
]


def test_urls_equal_brute_force(spark, pages):
    rows = [(r.page_id, r.url) for r in pages.collect()] + [(9000 + i, u) for i, u in enumerate(ODD_URLS)] * 2 + [(None, ODD_URLS[4])]
    df = spark.createDataFrame(rows, "page_id long, url string").selectExpr("*", "'x' as host", "'y' as verdict", "'z' as rule")
    want = [(i, *brute_verdict(u)) for i, u in rows]
    assert sorted(map(tuple, url_rules.judge_urls(df).collect()), key=str) == sorted(want, key=str)
    assert url_rules.judge_urls(df.limit(0)).count() == 0
    assert {r.verdict for r in url_rules.judge_urls(df, rules=()).collect()} == {"allow"}


def glob_regex(rule):
    host, _, path = rule.partition("/")
    glob = re.escape(f"*.{host}/{path}**").replace(r"\*\*", "(?s:.*)").replace(r"\*", "[^/]*").replace(r"\?", "[^/]")
    return re.compile(glob)


def test_automaton_equals_regular_expressions():
    random.seed(11)
    rules = ["a*b.com/", "a?b.com/x*y/", "com/**/z", "b.com/x/*.html", "c.d.com/" + "long" * 30, "com/?", "*.org/a"]
    rules += ["".join(random.choice("ab*?") for _ in range(4)) + ".com/" + random.choice("xy*") for _ in range(30)]
    automaton = url_rules.Automaton(rules)
    assert automaton.words > 4  # patterns cross word borders
    texts = [f".{''.join(random.choices('ab.', k=random.randrange(9)))}.com/{''.join(random.choices('xyz/', k=random.randrange(8)))}" for _ in range(400)]
    texts += [".aXb.com/x/q.html", ".c.d.com/" + "long" * 31, "", "/", ".com/a/b/z", ".x.org/ab"]
    hits = automaton.run([t.encode() for t in texts])
    assert [[bool(h) for h in row] for row in hits] == [[bool(glob_regex(r).fullmatch(t)) for r in rules] for t in texts]


def test_longest_rule_wins(spark):
    df = spark.createDataFrame([(1, "http://a.b.com/x/y")], "page_id long, url string")
    rules = (("block", "com/"), ("allow", "b.com/x/"), ("block", "b.com/"))
    assert tuple(url_rules.judge_urls(df, rules).first())[3:] == ("b.com/x/", "allow")


def article(html):
    body = html[html.index("<article>") + 9 : html.index("</article>")]
    lines = [" ".join(unescape(x).split()) for x in re.split(r"</?(?:p|h1|b|br)>", body)]
    return "\n".join(x for x in lines if x)


def test_pages_give_their_articles(pages):
    rows = pages.collect()
    got = {r.page_id: r for r in html_density.main_text(pages).collect()}
    assert all(got[r.page_id].text == article(r.html) for r in rows)
    assert all(r.n_chars == len(r.text) for r in got.values())


BLOG = """<html><head><title>t</title></head><body class="home menu"><header><h2>Site name</h2><nav><a href=/>Home</a></nav></header>
<div id="cookie-notice"><p>We use cookies. Read our long policy, it is very long and tells you all about cookies.</p></div>
<div class="wrap"><div class="content"><h1>Title &amp; more</h1><p class=lead>First  part
with <a href="#">a link</a> and <em>stress</em>.</p><ul><li>one<li>two</ul><form>Name <input name=q></form>
<div class="share-buttons"><a href=#>Share</a></div><table><tr><td>cell 1<td>cell 2</table><p>Last part of the article, which is longer.</p>
<section id="comments"><p>A reader's comment, as long as the article is, so that it weighs enough.</p></section></div>
<aside><p>Side text that is not short either, with many words in it.</p></aside></div>
<script>if (a < b) { document.write("<p>no</p>") }</script><footer><p>Imprint and more text of the footer.</p></footer></body></html>"""


@pytest.mark.parametrize("html, text", [
    (None, ""), ("", ""), ("   ", ""), ("plain &lt;text&gt;", "plain <text>"), ("<p>a<p>b<br>c</p> tail", "a\nb c\ntail"),
    ("<div>un<b>closed", "unclosed"), ("<!-- only --><style>p{}</style>", ""), ("<p>1 < 2 & 3</p>", "1 < 2 & 3"),
    ("<p>a&nbsp;b&#8364;&amp;amp;</p>", "a b€&amp;"), ("<article><h1>T</h1><p>x</article>", "T\nx"),
    ("<p hidden>no</p><p style='display: none'>no</p><p>yes", "yes"), ("</p></div>x", "x"), ("<p title='a>b'>q</p>", "q"),
    (BLOG, "Title & more\nFirst part with a link and stress.\none\ntwo\ncell 1\ncell 2\nLast part of the article, which is longer."),
])
def test_extraction(html, text):
    assert html_density.extract(html) == text


def test_long_and_deep_pages():
    assert html_density.extract("<div>" * 5000 + "deep" + "</div>" * 5000) == "deep"
    words = " ".join(f"w{i}" for i in range(200_000))
    assert html_density.extract(f"<body><nav>n</nav><p>{words}</p>") == words


def test_extraction_of_rows(spark):
    rows = [(1, None, None), (2, "u", "<p>x</p>"), (2, "u", "<p>x</p>"), (None, "u", "")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 as text", "2 as n_chars")
    assert values(html_density.main_text(df)) == [(None, "u", "", 0), (1, None, "", 0), (2, "u", "x", 1), (2, "u", "x", 1)]
    assert html_density.main_text(df.limit(0)).count() == 0


def words(n, tag="w"):
    return " ".join(f"{tag}{i}" for i in range(n))


NAV = "<nav><ul><li><a href=/a>menu one</a></li><li><a href=/b>menu two</a></li></ul></nav>"
LONG = "".join(f"<p>{words(80, 'l')}</p>" for _ in range(5))


@pytest.mark.parametrize("body, kept, lost", [
    # A second section of shorter paragraphs.
    (f"<article><section>{LONG}</section><section>{''.join(f'<p>short{i} {words(15)}</p>' for i in range(3))}</section></article>", ["short0", "short2"], []),
    # A short lead and closing paragraph beside the content.
    (f"<p>lead words</p><div>{LONG}</div><p>closing words</p>", ["lead words", "closing words"], []),
    # A list of references inside the article.
    (f"<article>{LONG}<ul><li><a href=/r1>reference one</a></li><li><a href=/r2>reference two</a></li></ul></article>", ["reference two"], []),
    # Attributes are read by their whole names, and not inside values.
    (f"<article>{LONG}<p data-id='menu'>own words</p></article>", ["own words"], []),
    (f"<article>{LONG}<p title='role=banner'>own words</p></article>", ["own words"], []),
    (f"<article>{LONG}<p title=\"a > b\" CLASS = 'menu'>not here</p></article>", [], ["not here", "b"]),
    # An odd quote in a tag is no text.
    (f"<article>{LONG}<p>before</p><img alt=\"5' tall' src=a><p>after</p></article>", ["before", "after"], ["tall", "src"]),
    (f"<article><p class=\"x>odd</p>{LONG}</article>", ["odd"], ["class"]),
    # Lists of links outside articles are menus.
    (f"<div>{LONG}</div><ul><li><a href=/x>link one</a></li><li><a href=/y>link two</a></li></ul>", [], ["link one"]),
])
def test_articles_stay_whole(body, kept, lost):
    text = html_density.extract(f"<html><body>{NAV}{body}<footer>imprint</footer></body></html>")
    assert text.count("l79") == 5 and "menu one" not in text and "imprint" not in text
    assert all(k in text.split("\n") or any(line.startswith(k) for line in text.split("\n")) for k in kept), text
    assert not any(x in text for x in lost)


def test_long_runs_of_spaces_in_tags_take_linear_time():
    spaces = " " * 50_000
    assert html_density.extract(f"<article>{LONG}<p{spaces}'{spaces}>end</p></article>").endswith("end")


def test_densities_beside_a_naive_computation():
    """Characters, tags, link characters and links of every node counted anew, densities and sums by the formula."""
    import math

    html = f"<body><div><p>{words(30)} <a href=x>{words(3)}</a></p><p>{words(50)}</p></div><ul><li><a>one</a></li><li><a>two</a></li></ul></body>"
    root = html_density.parse(html)
    own_links = {}

    def remember(node):
        own_links[node] = (node.links, node.link_chars)
        for child in node.children():
            remember(child)

    remember(root)

    def count(node):
        chars = sum(len("".join(p.split())) for p in node.parts if isinstance(p, str))
        tags, (links, linked) = node.inner_tags, own_links[node]
        for child in node.children():
            c = count(child)
            chars, tags, linked, links = chars + c[0], tags + 1 + c[1], linked + c[2], links + c[3]
        return chars, tags, linked, links

    def density(node):
        (c, t, lc, lt), (cb, _, lcb, _) = count(node), count(root)
        if not c:
            return 0.0
        base = math.log(c / ((c - lc) or 1) * lc + lcb / cb * c + math.e)
        value = math.log(c / (lc or 1) * (t or 1) / (lt or 1))
        return c / (t or 1) * max(0.0, value / math.log(base) if base > 1 else value)

    want = {n: (density(n), sum(density(c) for c in n.children())) for n in own_links}
    nodes = html_density._count(root)
    assert len(nodes) == len(want) > 6
    for node in nodes:
        assert (node.density, node.sum) == pytest.approx(want[node])
