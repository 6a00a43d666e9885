import random
from collections import defaultdict
from xml.etree import ElementTree

from vecshoal.llm import html_text

PAGES = "page_id long, url string, html string"


def page(body, article=None):
    inner = f"<article>{article}</article>" if article is not None else ""
    return f"<!DOCTYPE html><html><head><title>t</title><style>p{{}}</style><script>var t='</p>';</script></head><body>{body}{inner}</body></html>"


def texts(spark, pages, **options):
    rows = [(n, p[0], p[1]) if isinstance(p, tuple) else (n, "http://h.example/x", p) for n, p in enumerate(pages)]
    return {r.page_id: r.text for r in html_text.extract(spark.createDataFrame(rows, PAGES), **options).collect()}


def test_article_pages(spark):
    nav = "<nav><ul><li><a href=x>a</a></li></ul></nav><div class='ad'>buy</div>"
    got = texts(spark, [
        page(nav + "<footer>f</footer>", "<h1>Ti &amp; tle</h1><p><b>One.<br><p>Two  \n three&nbsp;4 &lt;5 &am</p><form>x</form><div class=comments><p>c</p></div>"),
        page(nav, "<header><h1>H</h1></header><p>a<span>b</span>c <i>d</i></p><aside>s</aside><ul><li>q<li>r</ul>"),
        "<article><p>cut off <b>here",
        page(nav, ""),
    ])
    assert got == {0: "Ti & tle\nOne.\nTwo three 4 <5 &am", 1: "H\nabc d\nq\nr", 2: "cut off here", 3: ""}


def test_template_goes_by_host(spark):
    """Blocks without a telling name go where the host repeats them, and stay on another host."""
    pages = []
    for n in range(12):
        head, foot = "<div><p>Welcome to the site</p><p>All rights reserved</p></div>", "<div>Imprint of h</div>"
        pages.append((f"https://h.example/{n}", f"<body>{head}<div><p>Text number {n}</p><p>more {n * n}</p></div>{foot}</body>"))
    pages.append(("https://other.example:80/1", "<body><div><p>Welcome to the site</p><p>All rights reserved</p></div><p>Own</p></body>"))
    got = texts(spark, pages)
    assert got[3] == "Text number 3\nmore 9"
    assert got[12] == "Welcome to the site\nAll rights reserved\nOwn"


def test_passages_in_articles_are_never_template(spark):
    got = texts(spark, [page("<nav>n</nav>", f"<p>Licensed under X.</p><p>t{n}</p>") for n in range(8)])
    assert got[5] == "Licensed under X.\nt5"


def test_common_subtree_count_by_brute_force(spark):
    import itertools

    pieces = ["<p>alpha beta</p>", "<p>gamma</p>", "<div><p>delta</p></div>", "<p>own {}</p>"]
    pages = []
    for n, (a, b) in enumerate(itertools.product(pieces, pieces)):
        pages.append((f"http://s{n % 2}.example/", "<body>" + a.format(n) + b.format(n * 7) + "</body>"))
    got = texts(spark, pages, share=0.3, least_pages=2)
    for n, (url, html) in enumerate(pages):
        same = [h for u, h in pages if u == url]
        words = [p.split(">")[-1] for p in html.replace("</body>", "").split("</p>") if p.split(">")[-1]]
        often = lambda w: (c := sum(f">{w}</p>" in h for h in same)) >= 2 and c >= 0.3 * len(same)
        assert got[n] == "\n".join(w for w in words if not often(w))


def test_edges(spark):
    empty = spark.createDataFrame([], PAGES)
    assert html_text.extract(empty).count() == 0
    rows = [(1, None, None), (2, None, ""), (3, "", "<p>a"), (3, "", "<p>a"), (None, "x", "plain"), (5, "http://h/", "<" * 2000), (6, "http://h/", "<div>" * 3000 + "deep")]
    docs = spark.createDataFrame(rows, PAGES).selectExpr("*", "1 as text", "2 as blocks", "3 as _host", "4 as template")
    got = sorted((str(r.page_id), r.text) for r in html_text.extract(docs).collect())
    assert got == [("1", ""), ("2", ""), ("3", "a"), ("3", "a"), ("5", "<" * 2000), ("6", "deep"), ("None", "plain")]


def test_recurring_containers_inside_articles_go(spark):
    """A notice inside marked articles is told by its count; passages and the article's own containers stay."""
    notice = "<div><p>Read us every day</p><ul><li>by post</li></ul></div>"
    body = "<div><h2>Story</h2><p>Licensed under X.</p>{0}<p>own {1}</p></div><ul><li>salt</li><li>item {1}</li></ul>"
    got = texts(spark, [page("<div>Site</div>", body.format(notice, n)) for n in range(8)])
    assert got[5] == "Story\nLicensed under X.\nown 5\nsalt\nitem 5"


def test_pages_with_articles_are_counted(spark):
    """What surrounds articles is template on the host's pages without one; an article without text is no frame."""
    pages = [page("<div>Welcome to the site</div>", f"<p>t{n}</p>") for n in range(8)]
    got = texts(spark, [*pages, page("<div>Welcome to the site</div><p>front</p>"), page("<div>Welcome to the site</div><p>bare</p>", "<form>f</form>")])
    assert (got[2], got[8], got[9]) == ("t2", "front", "bare")


def test_subtrees_of_article_pages_are_hashed():
    blocks, units = html_text.page_blocks(page("<nav><ul><li>a</li></ul></nav><footer>f</footer>", "<p>t</p>"))
    assert [block["text"] for block in blocks] == ["t"] and [len(unit["subtrees"]) for unit in units] == [4, 1]


def test_copies_are_not_template(spark):
    """Repeated pages count as one, and an article of several pages as one; a host of copies keeps its text."""
    story = page("<div><p>One story</p><p>told twice</p></div>")
    pages = [("http://h.example/", page(f"<div><p>t{n}</p></div>")) for n in range(7)] + [("http://h.example/copy", story)] * 3
    pages += [("http://copies.example/", story)] * 5
    post = "<article><div><p>A post</p></div></article>"
    pages += [("http://blog.example/", f"<body>{post}<article><div><p>other {n}</p></div></article></body>") for n in range(5)]
    comments = "".join(f"<article><p>c{n}</p><div>Reply</div></article>" for n in range(5))
    pages.append(("http://one.example/", f"<body>{comments}</body>"))
    got = texts(spark, pages)
    assert {got[n] for n in range(7, 15)} == {"One story\ntold twice"}
    assert got[16] == "A post\nother 1"
    assert got[20].count("Reply") == 5


def test_many_pages_of_a_large_host(spark):
    """A notice on a small share of a large host's pages is template, whether marks are sent or dealt."""
    pages = [page(f"<p>own {n}</p>" + (f"<div>Notice {n % 10}</div>" if n < 120 else "")) for n in range(400)]
    got = texts(spark, pages, many_pages=12)
    assert got == {n: f"own {n}" for n in range(400)}
    assert texts(spark, pages[:60], many_pages=12)[3] == "own 3\nNotice 3"


def test_marks_dealt_by_row(spark, monkeypatch):
    pages = [page(f"<div>Head</div><p>own {n}</p>") for n in range(20)] + [page("", f"<p>a{n}</p>") for n in range(5)]
    want = texts(spark, pages)
    monkeypatch.setattr(html_text, "local_copy", lambda marks: None)
    monkeypatch.setattr("vecshoal.operators.joins.local_copy", lambda *of: None)
    assert texts(spark, pages) == want and want[3] == "own 3" and want[22] == "a2"


def test_names_are_whole_and_spare_the_article(spark):
    page = """<html><body><div class="site-header">menu text</div><article><h1>T</h1><section id="related-work"><p>one</p></section>
      <p class="header">two</p><div class="notice-of-award"><p>three</p></div><div class="ad">buy</div><div class="comment-list"><p>first!</p></div>
      <form>name</form><p class="load-balancing">End</p></article><div class="cookie-banner">ok</div></body></html>"""
    assert text_of(spark, page) == "T\none\ntwo\nthree\nEnd"
    bare = """<body><div class="site-header">menu</div><div class="notice-of-award"><p>kept</p></div><div class="notice">gone</div><p id="download">kept too</p></body>"""
    assert text_of(spark, bare) == "kept\nkept too"


def text_of(spark, page):
    return html_text.extract(spark.createDataFrame([(1, "http://one/a", page)], "page_id long, url string, html string")).first().text


def test_whole_extraction_by_brute_force(spark):
    """Random well-formed pages without an article: a tree walk over all pages of a host at once gives the same texts."""
    rng = random.Random(11)
    parts = [f"<div><p>part {n}</p><ul><li>a{n}</li><li>b{n}</li></ul></div>" for n in range(6)]

    def page(n):
        inside = [rng.choice(parts) if rng.random() < 0.5 else f"<div><p>own {n} {rng.randrange(9)}</p></div>" for _ in range(rng.randint(1, 6))]
        inside += ["<nav><p>menu</p></nav>"] * rng.randint(0, 1) + ['<div class="sidebar"><p>side</p></div>'] * rng.randint(0, 1)
        rng.shuffle(inside)
        return f"<html><body><section>{''.join(inside)}</section></body></html>"

    rows = [(n, f"http://h{n % 3}.org/{n}", page(n)) for n in range(60)]
    rows += [(100 + n, rows[n][1], rows[n][2]) for n in range(0, 60, 4)]

    def blocks(node, skip=lambda node: False):
        if skip(node):
            return []
        own = [" ".join(node.text.split())] if node.text and node.text.strip() else []
        return own + [text for child in node for text in blocks(child, skip)]

    def key(node):
        return node.tag, (node.text or "").strip(), tuple(map(key, node))

    trees = {n: ElementTree.fromstring(html) for n, _, html in rows}
    beside = lambda node: node.tag == "nav" or node.get("class") == "sidebar"
    seen, pages = defaultdict(set), defaultdict(set)
    for n, url, _ in rows:
        same = tuple(blocks(trees[n], beside))
        pages[url[:9]].add(same)
        for node in trees[n].iter():
            if node.tag not in ("html", "body") and blocks(node):
                seen[url[:9], key(node)].add(same)
    template = {k for k, some in seen.items() if len(some) >= 3 and len(some) >= 0.2 * len(pages[k[0]])}
    want = {n: "\n".join(blocks(trees[n], lambda node: beside(node) or (url[:9], key(node)) in template)) for n, url, _ in rows}
    docs = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    assert {r.page_id: r.text for r in html_text.extract(docs).collect()} == want
    assert any(want.values()) and any("part" not in text for text in want.values())
