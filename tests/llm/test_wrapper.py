import random
import re
from html import unescape

from wayline.llm.dom import matching, parse
from wayline.llm.wrapper import Outline, main_text

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{x:"</p>"}</style><script>var a="<p>no</p>";</script></head><body>
<header><h1>Site</h1></header><nav><ul><li>Home<li>News</ul></nav><div class="ad">buy</div>
%s<aside>side</aside><form><p>name</p><input></form><div id="cookie-notice"><p>ok?</p></div><footer><p>foot</p></footer></body></html>"""

ARTICLE = """<article><header><h2>Head &amp; more</h2></header><!-- <p>no</p> --><p>One <b>bold</b>&nbsp;word<br>next<p>Two
 lines<ul><li>a<li>b &#233;</ul><div class="share">tweet</div><section class="comments"><article><p>reader</p></article></section></article>"""


def texts(spark, rows):
    pages = spark.createDataFrame([(*r, "h", 1) for r in rows], "page_id long, url string, html string, host string, salt int")
    return sorted(((r.page_id, r.url, r.text) for r in main_text(pages).collect()), key=str)


def test_an_article(spark):
    want = "Head & more\n\nOne bold word next\n\nTwo lines\n\na\n\nb é"
    rows = [(1, "http://a.example/1", PAGE % ARTICLE), (2, None, PAGE % ARTICLE), (3, "http://b.example/", None), (4, "x", ""), (5, "y", "no tags <3 &lt;"), (5, "y", "no tags <3 &lt;")]
    assert texts(spark, rows) == sorted([(1, "http://a.example/1", want), (2, None, want), (3, "http://b.example/", ""), (4, "x", ""), *[(5, "y", "no tags <3 <")] * 2], key=str)


def test_slots_without_an_article_element(spark):
    """The longest text is the same in all pages: the template's; what varies is the content."""
    page = "<body><div><p>%s</p><p>terms</p></div><div id=x><div><p>%s</p><p>end</p></div></div></body>"
    rows = [(i, "http://c.example/%d" % i, page % ("always the same words " * 30, f"news number {i} of the day")) for i in range(6)]
    assert texts(spark, rows) == [(i, url, f"news number {i} of the day\n\nend") for i, url, _ in rows]


def test_unclosed_tags_match_a_plain_reading(spark):
    draw = ["<p>a b", "<p><b>c<br>", "</i>d", "<h3>e</h3>", "<p>f &lt; g</p>", "<ul><li>h<li>i</ul>"]
    for shift in range(len(draw)):
        inner = "".join(draw[shift:] + draw[:shift])
        html = f"<body><nav><p>x</p></nav><article>{inner}</article><footer>y</footer>"
        parts = re.split(r"</?(?:p|h3|ul|li)>", inner)
        want = [t for t in (" ".join(unescape(re.sub(r"<[^>]*>", lambda m: " " if "br" in m[0] else "", x)).split()) for x in parts) if t]
        page = Outline(parse(html))
        at = next(i for i, (_, label) in enumerate(page.tree) if label == "article")
        assert page.text(at).split("\n\n") == want


def test_tree_matching():
    a = [(0, "b"), (1, "x"), (1, "y"), (2, "z"), (1, "w")]
    b = [(0, "b"), (1, "y"), (2, "z"), (2, "z"), (1, "q"), (1, "w")]
    assert matching(a, b) == {0: 0, 2: 1, 3: 2, 4: 5} or matching(a, b) == {0: 0, 2: 1, 3: 3, 4: 5}
    assert matching(a, a) == {i: i for i in range(5)}


def test_no_rows(spark):
    assert texts(spark, []) == []


def test_all_varying_parts_are_content(spark):
    """A body in two containers, with the template's text between and in one page a container of its own."""
    page = "<body><div id=top><p>template words</div><div id=lead><p>%s</div><div id=mid><p>template again</div><div id=body><p>%s</div>%s</body>"
    rows = [(i, "http://s.example/%d" % i, page % (f"lead {i} " * 3, f"body {i} " * 7, "<div id=more><p>more of it</div>" * (i == 4))) for i in range(6)]
    want = [(i, url, "\n\n".join([("lead %d " % i * 3).strip(), ("body %d " % i * 7).strip()] + ["more of it"] * (i == 4))) for i, url, _ in rows]
    assert texts(spark, rows) == want
    alone = page % ("lead " * 3, "body " * 7, "")
    assert texts(spark, [(1, "http://t.example/", alone)])[0][2] == "template words\n\nlead lead lead\n\ntemplate again\n\nbody body body body body body body"


def test_identical_pages_are_judged_like_one(spark):
    html = "<body><div id=a><p>one</div><div id=b><div id=c><p>two two</div><div id=d><p>three</div></div></body>"
    rows = [(i, "http://u.example/%d" % (i % 2), html) for i in (1, 1, 2, 3)]
    assert [r[2] for r in texts(spark, rows)] == ["one\n\ntwo two\n\nthree"] * 4


def test_copies_do_not_make_a_template(spark):
    """Two copies share a container that the third page lacks."""
    page = "<body><div id=a><p>%s</div>%s<div id=z><p>imprint</div></body>"
    rows = [(i, "http://v.example/%d" % i, page % (x, y)) for i, (x, y) in enumerate([("p", "<div id=b><p>own part</div>")] * 2 + [("q", "")])]
    assert [r[2] for r in texts(spark, rows)] == ["p\n\nown part"] * 2 + ["q"]


def test_sibling_articles(spark):
    for one, other in (("<article>", "</article>"), ("<div class=content>", "</div>")):
        page = f"<body><div id=x><p>site</div>{one}<p>%s</p>{other}<div id=y><p>rule</div>{one}<p>%s</p>{other}</body>"
        rows = [(i, "http://w.example/%d" % i, page % (f"first {i}", f"second {i}")) for i in range(3)]
        assert [r[2] for r in texts(spark, rows)] == [f"first {i}\n\nsecond {i}" for i in range(3)]
        assert texts(spark, rows[:1])[0][2] == "first 0\n\nsecond 0"


def most_pairs(a, b):
    """The size of the best matching, by trying every order-keeping choice of children."""
    from functools import cache

    def kids(tree):
        out, path = [[] for _ in tree], []
        for i, (depth, _) in enumerate(tree):
            del path[depth:]
            if path:
                out[path[-1]].append(i)
            path.append(i)
        return out

    of_a, of_b = kids(a), kids(b)

    @cache
    def best(x, y):
        if not x or not y:
            return 0
        options = [best(x[1:], y), best(x, y[1:])]
        if a[x[0]][1] == b[y[0]][1]:
            options.append(1 + best(tuple(of_a[x[0]]), tuple(of_b[y[0]])) + best(x[1:], y[1:]))
        return max(options)

    return 1 + best(tuple(of_a[0]), tuple(of_b[0]))


def test_tree_matching_finds_as_many_pairs_as_there_can_be():
    draw = random.Random(4)

    def tree(n):
        out, depth = [(0, "r")], 0
        for _ in range(n):
            depth = draw.randint(1, depth + 1)
            out.append((depth, draw.choice("xyz")))
        return out

    for _ in range(400):
        a = tree(draw.randint(0, 9))
        b = a[: draw.randint(1, len(a))] + [(1, draw.choice("xyz")) for _ in range(draw.randint(0, 3))] if draw.random() < 0.5 else tree(draw.randint(0, 9))
        found = matching(a, b)
        assert len(found) == most_pairs(a, b), (a, b)
        ups = lambda t, i: next((k for k in range(i - 1, -1, -1) if t[k][0] < t[i][0]), None)
        for i, j in found.items():
            if i or j:
                assert a[i] == b[j] and found[ups(a, i)] == ups(b, j)
        assert sorted(found.values()) == [found[i] for i in sorted(found)]  # the order of siblings is kept


def test_names_count_as_a_whole(spark):
    """Names that only contain a word of the list are no such parts; neither is what holds the main heading."""
    body = '<p class="alert-level">low</p><div class="share-price"><p>12</p></div><div class="comment-list"><p>reader</p></div><div class="ad ad-300x250"><p>buy</p></div>'
    for name in ("content no-sidebar", "ad-free", "entry has-comments"):
        html = f'<body><nav>x</nav><div class="{name}"><p>real article</p>{body}</div></body>'
        assert texts(spark, [(1, "http://n.example/", html)])[0][2] == "real article\n\nlow\n\n12"
    html = '<body><div class="widget"><h1>Title</h1><p>all of it</p></div><div class="widget"><p>other</p></div></body>'
    assert texts(spark, [(1, "http://n.example/", html)])[0][2] == "Title\n\nall of it"


def test_hostile_pages_end_in_time():
    from time import monotonic

    start = monotonic()
    n = 60_000
    for html in ("<a " * n, '<a "' * n, "<b " * n + '">', "<a '\"" * n + ">", "</x>" * n, "<div>" * n + "</p>" * n, "<div>" * n, "<" * n, "<!--" * n, "<b>" * n + "<p>" * n, '<a href="' * n + ">x"):
        Outline(parse(html))
    wide = [(0, "b"), *((1, f"x{i % 977}") for i in range(n // 10))]
    other = wide[:300] + [(1, "new")] + wide[301:]
    assert len(matching(wide, other)) == len(wide) - 1
    assert monotonic() - start < 30


def test_quotes_and_tags_without_an_end():
    text = lambda html: Outline(parse(html)).text(0)
    assert text('<p title="a > b">x</p>') == "x"
    assert text("<p>1 < 2 <b") == "1 < 2 <b"
    assert text('<p class="x>y</p>') == "y"


def test_a_page_built_in_a_form_keeps_its_text(spark):
    cases = {
        '<body><form id="aspnetForm"><nav><p>menu</p></nav><h1>t</h1><p>article</p></form></body>': "t\n\narticle",
        "<body><dialog><aside><h1>t</h1><p>article</p></aside></dialog></body>": "t\n\narticle",
        "<body><div><h1>a</h1><p>x</p><form><p>search</p></form></div></body>": "a\n\nx",
        "<body><form><p>no</p></form><h1>t</h1><p>y</p></body>": "t\n\ny",
    }
    rows = [(k, f"http://h{k}.example/", html) for k, html in enumerate(cases)]
    got = main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).orderBy("page_id").collect()
    assert [r.text for r in got] == list(cases.values())
