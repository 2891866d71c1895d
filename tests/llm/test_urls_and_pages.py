"""URL rules and page texts."""

import math
import random
import time
import tracemalloc

from catalink.llm import site_style as S
from catalink.llm.queries import URL_RULES
from catalink.llm.url_rules import judge_urls


def brute(url, rules):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([i for i in map(rest.find, "/?#") if i >= 0], default=len(rest))
        host, tail = rest[:cut], rest[cut:]
        host = "".join(c.lower() if c.isascii() else c for c in host)
        path = tail[: min([i for i in map(tail.find, "?#") if i >= 0], default=len(tail))]
    best = ""
    verdict = "allow"
    for v, r in rules:
        h, p = r.split("/", 1)
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and len(r) > len(best):
            best, verdict = r, v
    return host, path, best or None, verdict


def test_rules(spark):
    urls = [None, "", "x", "http://", "http://COM/", "https://a.example.com/en/x?y#z", "https://www.example.com/en/", "ftp://b.net/es/q", "http://net/fr/", "http://net/fr", "http://bnet/es/", "http://a.com?/en/", "http://a.com#b/", "http://example.com:80/en/", "http://Ä.com/\nx", "a://b://c.com/"]
    draw = random.Random(2)
    urls += ["http://" + ".".join(draw.choice(["www", "example", "net", "com", "a"]) for _ in range(draw.randint(1, 60))) + "/" + "/".join(draw.choice(["en", "es", "fr", ""]) for _ in range(draw.randint(0, 5))) for _ in range(300)]
    more = (*URL_RULES, ("block", "a.com/e"), ("block", "www.a.com/en/es"))
    for rules in (URL_RULES, more):
        pages = spark.createDataFrame([(i, u, "h", 1) for i, u in enumerate([*urls, *urls[:3]])] + [(0, None, None, None)], "page_id long, url string, html string, rule int")
        got = judge_urls(pages, rules).collect()
        want = [(i, *brute(u, rules)) for i, u in enumerate([*urls, *urls[:3]])] + [(0, *brute(None, rules))]
        assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert judge_urls(pages.limit(0), URL_RULES).count() == 0


def text(source):
    return S.Page(source).main_text()


def test_single_pages():
    assert text("") == ""
    assert text("plain <3 x") == "plain <3 x"
    assert text("<p>a <b>b</b>c<div class='ad'>zz</div><p>d &amp; e&nbsp;f") == "a bc d & e f"
    assert text("<nav>n</nav><article>x<div id=comments>c</div><script>if(a<b)</script>y</article><footer>f</footer><p>z") == "x y"
    assert text("<div><p>t1<br>t2</p><ul><li>a<li>b</ul></div>") == "t1 t2 a b"
    assert text('<p title="x>y">q</p><a href="x') == "q"
    assert text("<!-- c --><title>t</title><main><h1>A</h1>\n<p>B\n C</p></main><aside>s</aside>") == "A B C"
    assert len(text("<article>" + "<p>word</p>" * 20000 + "</article>")) == 20000 * 5 - 1


def test_site_tree(spark):
    """A line that all pages of a host share goes; on a host of few pages, and where articles are copies, nothing goes."""
    page = lambda i, shared: f"<html><body><div class='top{i}'>{shared}</div><div class='body'><p>own text {i}</p></div></body></html>"
    rows = [(i, f"http://big.org/{i}", page(0, "Follow us everywhere").replace("own text 0", f"own text {i}")) for i in range(30)]
    rows += [(100 + i, f"http://small.org/{i}", page(0, "Follow us everywhere")) for i in range(3)]
    rows += [(200 + i, f"http://copies.org/{i}", f"<nav>{i}</nav><article><p>same article</p></article>") for i in range(40)]
    rows += [(300, None, None), (301, "http://big.org/", ""), (302, "http://big.org/", "only text")]
    pages = spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, nodes string, salt int")
    got = {r.page_id: r for r in S.extract_pages(pages).collect()}
    assert len(got) == len(rows)
    assert all(got[i].text == f"own text {i}" for i in range(30))
    assert all(got[100 + i].text == "Follow us everywhere own text 0" for i in range(3))
    assert all(got[200 + i].text == "same article" for i in range(40))
    assert (got[300].text, got[300].n_chars, got[301].text, got[302].text) == ("", 0, "", "only text")
    assert S.extract_pages(pages.limit(0)).count() == 0


def site(spark, sources):
    """The texts of pages of one host, in order."""
    rows = [(i, f"http://one.org/{i}", source) for i, source in enumerate(sources)]
    got = {r.page_id: r.text for r in S.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    return [got[i] for i in range(len(rows))]


def test_wrapper_with_fixed_line(spark):
    """A wrapper whose own text and children are the same on all pages loses that text, not what it holds."""
    outer = [f"<div id=page>\n<a href=#c>Skip to content</a><article><p>own text {i}</p></article></div>" for i in range(8)]
    assert site(spark, outer) == [f"own text {i}" for i in range(8)]
    inner = [f"<article><div class=entry>Share this<p>own text {i}</p></div></article>" for i in range(8)]
    assert site(spark, inner) == [f"own text {i}" for i in range(8)]
    plain = [f"<div id=page>Welcome<div class=text><p>own text {i}</p></div></div>" for i in range(8)]
    assert site(spark, plain) == [f"own text {i}" for i in range(8)]


def test_wrapper_with_boilerplate_word():
    """A class or id word doesn't mark what holds the article; inside the article and beside it, it does."""
    for names in ("class='site has-sidebar'", "class=content-sidebar-wrap", "id=header-fixed", "class=comments-open", "class=widget"):
        assert text(f"<div {names}><p>m</p><article>x<div class=ad>a</div></article><div class=sidebar>s</div></div>") == "x"
        assert text(f"<div {names}><div {names}><main><p>x</p></main></div></div>") == "x"
        assert text(f"<main><div {names}>y<article>x</article></div></main>") == "y x"
        assert text(f"<article>t</article><div {names}><main>x</main></div>") == "t x"
    assert text("<div class=has-sidebar>y <span class=ad>a</span><main>x</main></div>") == "x"
    assert text("<main><article>x</article><div id=comments><article>c</article></div></main>") == "x"
    assert text("<div class=has-sidebar><article>x<div class=related-posts><article>c</article></div></article></div>") == "x"
    assert text("<div role=navigation class=has-sidebar><article>x</article></div>y") == "y"


def test_repeated_block_among_siblings(spark):
    """A line that all pages repeat beside unique elements of the same path goes alone, also where it stands in the article itself."""
    paragraphs = [f"<article>{'<p>more text</p>' * (i == 3)}<p>own text {i}</p><p>Share this page</p>{f'<p>end {i}</p>' * (i % 3)}</article>" for i in range(20)]
    assert site(spark, paragraphs) == [" ".join(["more text"] * (i == 3) + [f"own text {i}"] + [f"end {i}"] * (i % 3)) for i in range(20)]
    items = [f"<div><ul><li>Home<li>own item {i}<li>Contact</ul><p>own text {i}</p></div>" for i in range(8)]
    assert site(spark, items) == [f"own item {i} own text {i}" for i in range(8)]
    direct = [f"<article>own text {i}<br>Share this page</article>" for i in range(8)]
    assert site(spark, direct) == [f"own text {i}" for i in range(8)]
    # too few pages, or a line that only two of three pages show
    assert site(spark, paragraphs[4:11])[0] == "own text 4 Share this page end 4"
    some = [f"<article><p>own text {i}</p>{'<p>Share this page</p>' * (i % 3 > 0)}</article>" for i in range(12)]
    assert site(spark, some)[1] == "own text 1 Share this page"


def test_inside_an_article(spark):
    """Headings, leads and notices of the article stay, adverts and comments in it go."""
    inner = "<header class='post-header'><h1>Title</h1></header><div class='article-header'><p>Lead.</p></div><p class='notice'>Mind.</p>"
    assert text(f"<article>{inner}<p>Body.</p><div class=ad>a</div><div id=comments>c</div></article><div class=notice>n</div>") == "Title Lead. Mind. Body."
    # the tree still removes a notice that all pages of a host repeat
    pages = [f"<article><h1>Title {i}</h1><p class=notice>Read the terms</p><p>Body {i}.</p></article>" for i in range(10)]
    assert site(spark, pages) == [f"Title {i} Body {i}." for i in range(10)]
    assert [text(p) for p in pages] == [f"Title {i} Read the terms Body {i}." for i in range(10)]


def test_names_are_taken_whole():
    """A word inside a class or id says nothing: headings, sections and paragraphs of the article stay."""
    page = "<article><h2 id='social-life'>Social life</h2><h2 id=related-work>Related work</h2><section id='share-of-gdp'>Share of GDP</section><p class='ad-hoc'>Ad hoc.</p></article>"
    assert text(page) == "Social life Related work Share of GDP Ad hoc."
    assert text("<body><div class='widget-content'><p>All of it.</p></div></body>") == "All of it."
    # names alone would leave nothing of this page, but an advert is none of its text
    assert text("<body><div class='widget'><p>All of it.</p><div class=ad>a</div></div></body>") == "All of it."
    assert text("<body><div class=ad>a</div></body>") == ""
    words = "Notice Share Social Related Comment Banner Header Footer Menu Login Skip Promo Sponsor Cookie Newsletter Sidebar Widget Popup Search Toolbar".split()
    ends = "theory life work policy of-states history in-art and-law models 1990".split()
    slugs = [f"{w.lower()}-{e}" for w in words for e in ends]
    inner = "".join(f"<h2 id='{s}' class='{s}'>{s}</h2><p id='{s}-text'>{s}.</p>" for s in slugs)
    assert len(slugs) == 200 and text(f"<main>{inner}</main>") == " ".join(f"{s} {s}." for s in slugs)
    outer = "".join(f"<div class='{c}'>no</div>" for c in ("site-footer", "main-nav", "left sidebar", "cookie-banner", "share-buttons", "ad-slot", "menu", "comment-list"))
    assert text(f"<body>{outer}<div><p>Yes.</p></div></body>") == "Yes."


def test_deep_pages():
    """A page of deeply nested elements takes time and memory in proportion."""
    for source in ("<div>" * 100_000 + "x", "<main>" * 100_000 + "x", "<div class=sidebar>" * 50_000 + "<article>x", "<b>" * 50_000 + "<p>x"):
        began = time.process_time()
        tracemalloc.start()
        page = S.Page(source)
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert page.main_text() == "x" and most < 200 << 20 and time.process_time() - began < 60
    many = text("<li><ul>" + "<div>" * 20_000 + "<li>a</li>" * 20_000)
    assert many == " ".join(["a"] * 20_000)


def test_importance_brute_force(spark):
    """The nodes and blocks to remove, from entropies over lists of all that each page shows."""
    draw = random.Random(4)
    menu = lambda: "".join(f"<li>{draw.choice(['Home', 'News', 'About'])}</li>" for _ in range(draw.randint(1, 3)))
    part = lambda i: draw.choice([f"<p>own {i}</p>", "<p>Share</p>", "<div class=w>Follow us</div>", f"<div class=v><span>Fixed</span><p>{i % 2}</p></div>"])
    rows = [(f"h{i % 3}", f"<body><ul>{menu()}</ul>{''.join(part(i) for _ in range(6))}<h2>Contact</h2></body>") for i in range(90)]
    want: dict[str, set[int]] = {}
    for host in {h for h, _ in rows}:
        shows: dict[tuple, dict] = {}
        for key, page in {S.path_hash(p.main_text()): p for p in (S.Page(s) for h, s in rows if h == host)}.items():
            for node, kind, value in page.style_rows():
                shows.setdefault((node, kind), {}).setdefault(key, []).append(value)
        entropy = lambda values: -sum(values.count(v) / len(values) * math.log(values.count(v) / len(values)) for v in set(values)) / math.log(len(values))
        for (node, kind), pages in shows.items():
            n = len(pages)
            if n < S.LEAST_PAGES:
                continue
            if kind == "c" and max(entropy([v for vs in shows[node, k].values() for v in vs]) for k in "pc" if len(shows[node, k]) >= S.LEAST_PAGES) < S.LEAST_IMPORTANCE:
                want.setdefault(host, set()).add(node)
            if kind == "b":
                on = shows[node, "n"]
                for block in {v for vs in pages.values() for v in vs}:
                    values = [block if block in pages.get(p, []) else ("own", p) for p in on]
                    if values.count(block) >= S.LEAST_PAGES and entropy(values) < S.LEAST_IMPORTANCE:
                        want.setdefault(host, set()).add(block)
    got = {r.host: set(r.nodes) for r in S.low_importance_nodes(spark.createDataFrame(rows, "host string, html string")).collect()}
    assert want and got == want
