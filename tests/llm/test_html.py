"""Main text extraction: markup rules, host repeats against brute force, whole test pages."""

import html
import random
import re

import numpy as np

from boxframe.llm import html_extract as H
from boxframe.llm import queries
from boxframe.llm.html_extract import ARTICLE, OPEN, OUTSIDE, Rules


def main_text(page):
    return [t for t, k in H.parse(page) if k != OUTSIDE]


def test_markup():
    page = """<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{}</style><script>var a="</p><article>no</article>";</script></head>
    <body class="has-sidebar"><header><h1>Site</h1></header><nav><ul><li>Home<li>About</ul></nav><!-- <p>gone</p> -->
    <div class="cookie-notice">We use cookies</div><div id="adBanner">Buy</div>
    <article><header><h1>Head&nbsp;line</h1></header><p>One <b>bo</b>ld&#33; &lt;tag&gt;<br>next
      line<p>Two<ul><li>a<li>b</ul><aside>Related</aside><form>Name <input></form><div class="comments"><p>First!</p></div>
    <table><tr><td>x<td>y</table><div style="display: none">hid</div><div hidden>hid</div><pre> a  b </pre>end</article>
    <footer>&copy; me</footer></body></html>"""
    assert main_text(page) == ["Head line", "One bold! <tag> next line", "Two", "a", "b", "x", "y", "a b", "end"]


def test_broken_markup():
    assert main_text("plain & simple &amp; <b>bold") == ["plain & simple & bold"]
    assert main_text("<nav><a>menu<article><p>kept</article>") == ["kept"]
    assert main_text("<aside><article>other</article></aside><p>own") == ["own"]
    assert main_text("</div></p><p>a</div></section>b<script>never closed <p>x") == ["a", "b"]
    assert main_text("<p>1 < 2 and <3</p><p title='a > b'>c</p>") == ["1 < 2 and <3", "c"]
    assert main_text("<main><p>in</p></main><p>out</p>") == ["in"]
    assert main_text("<div role=main>in</div><div role='navigation'>nav</div>") == ["in"]
    assert main_text("") == [] and main_text("<" * 2000)[:1] == ["<" * 2000]
    assert main_text("<![CDATA[x<y]]> z") == ["x<y z"]
    deep = "<div>" * 5000 + "deep" + "</div>" * 5000
    assert main_text(deep) == ["deep"]


def test_marks_do_not_drop_the_article():
    text = "<p>The text of the page is long enough to be most of it</p>"
    want = ["The text of the page is long enough to be most of it"]
    menu = "<div class='sidebar'><a>Home</a> <a>News</a> and some more</div>"
    for start, end in (("<main class='has-sidebar'>", "</main>"), ("<article class='post comments-open'>", "</article>"),
                       ("<div id='content' class='with-sidebar'>", "</div>"), ("<div id='content' class='withSidebar'>", "</div>"),
                       ("<div class='left-sidebar'>", "</div>"), ("<main class='sidebar'>", "</main>"), ("<div role=main class='menu'>", "</div>"),
                       ("<article class='sponsored'>", "</article>"), ("<main><p></p><article class='banner'>", "</article></main>")):
        assert main_text(f"<body>{menu}{start}{text}{menu}{end}{menu}</body>") == want, start
    assert main_text(f"<body><article class='sponsored'><p>ad</p></article><article>{text}</article></body>") == want
    assert main_text(f"<body><div>{text}</div><div class='comments'>{'<p>a reader</p>' * 50}</div></body>") == want
    assert main_text(f"<body><div>{text}</div><div class='related'>{'<p><a>Other text</a></p>' * 50}</div></body>") == want
    assert main_text(f"<article>{text}<article class='comment'>A reader</article></article>") == want
    assert main_text(f"<div hidden class='content'>{text}</div>") == []


def test_nothing_of_a_named_article_is_lost_by_a_name():
    a, b = "The first paragraph of the article is long enough.", "The last paragraph of the article is long enough too."
    kept = {'<h2 class="section-header">Methods</h2>': ["Methods"], '<div class="article-header"><h1>Title</h1></div>': ["Title"],
            '<table><tr class="header"><td>Year</td><td>Sum</td></tr></table>': ["Year", "Sum"], '<p class="related-work">Others</p>': ["Others"],
            '<p class="notice">Mind the gap</p>': ["Mind the gap"], '<section id="share-prices"><p>Up</p></section>': ["Up"],
            '<p id="header">Head</p>': ["Head"], '<blockquote class="comment">Quoted</blockquote>': ["Quoted"],
            '<p>One <span class="social">social</span> sentence</p>': ["One social sentence"], '<p>Let <math><mi>x</mi><mo>=</mo><mn>2</mn></math> be</p>': ["Let x=2 be"],
            '<xmp><b>not</b> &amp; markup</xmp>': ["<b>not</b> &amp; markup"], '<div class="notice">Errata</div>': ["Errata"]}
    for part, want in kept.items():
        assert main_text(f"<article><p>{a}</p>{part}<p>{b}</p></article>") == [a, *want, b], part
    gone = ['<div class="ad">Buy</div>', '<ul class="comments"><li>First!</li></ul>', "<nav>Menu</nav>", "<aside>Side</aside>", '<div hidden>x</div>',
            '<section id="comments"><p>First!</p></section>', '<div class="sidebar">Side</div>', '<div role="navigation">Menu</div>']
    for part in gone:
        assert main_text(f"<article><p>{a}</p>{part}<p>{b}</p></article>") == [a, b], part
    assert main_text(f"<div class='ad'>{a * 9}</div><article><p>{b}</p></article>") == [b]


def _rows(spark, change):
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet").collect()
    return [(r.page_id, r.url, change(r.html)) for r in pages], {r.page_id: article_of(r.html) for r in pages}


def article_of(page):
    """The article's blocks, cut out by the known template."""
    article = page[page.index("<article>") + 9 : page.index("</article>")]
    blocks = [" ".join(html.unescape(re.sub("<br>", " ", b).replace("<b>", "").replace("</b>", "")).split()) for b in re.split("</?(?:p|h1)>", article)]
    return "\n\n".join(b for b in blocks if b)


def test_pages_that_name_no_article(spark):
    """The test pages with ``article`` renamed: nearly all texts are the same (the rest: blocks at an edge that a fifth of a small host has)."""
    rows, want = _rows(spark, lambda p: p.replace("<article>", "<div>").replace("</article>", "</div>"))
    got = {r.page_id: r.text for r in H.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert len(got) == 2500
    assert sum(got[k] == want[k] for k in want) >= 2440


def test_repeats_decide_where_markup_is_silent(spark):
    """No tags or names tell: header, menu items, notice and footer go by repeats alone, on a small and on a large host."""
    rng = random.Random(8)
    words = [f"w{i}" for i in range(4000)]
    rows, want = [], {}
    for host, n in (("small.example", 60), ("large.example", 500)):
        for i in range(n):
            own = [" ".join(rng.choice(words) for _ in range(rng.randint(12, 40))) for _ in range(4)]
            own.insert(2, f"Line {i}")
            if i % 3 == 0:
                own.insert(2, f"Every third text of {host} quotes these words in its middle and they are part of it")
            menu = "".join(f"<div>{x}</div>" for x in (f"{host} news", "Home", "Sports", "About us"))
            foot = f"<div>All rights reserved by the owners of {host} and by nobody else</div><div>Imprint</div>"
            rows.append((len(rows), f"http://{host}/{i}", f"<body>{menu}<div>{'</div><div>'.join(own)}</div>{foot}</body>"))
            want[len(rows) - 1] = "\n\n".join(own)
    got = {r.page_id: r.text for r in H.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert got == want


def brute(pages, cells, rules):
    """Windows and their pages by dictionary."""
    streams = [[(w, k, b) for b, (t, k) in enumerate(p) for w in t.lower().split(" ")] for p in pages]
    contents = ["\n\n".join(t for t, k in p if k != OUTSIDE) or f"\0{i}" for i, p in enumerate(pages)]
    windows = {}
    for i, s in enumerate(streams):
        for a in range(len(s) - rules.run + 1):
            windows.setdefault((cells[i], *[w for w, _, _ in s[a : a + rules.run]]), []).append((i, a, s[a][1]))
    out = [[0] * len(p) for p in pages]
    marks = [[False] * len(s) for s in streams]
    for (cell, *_), found in windows.items():
        distinct = len({contents[i] for i, _, _ in found})
        size = len({contents[i] for i in range(len(pages)) if cells[i] == cell})
        template = 2 * sum(k == OUTSIDE for _, _, k in found) >= len(found)
        for i, a, k in found:
            if (distinct >= max(3, rules.open_pages * size) or distinct >= 2 and template) if k == OPEN else distinct >= max(5, rules.article_pages * size):
                marks[i][a : a + rules.run] = [True] * rules.run
    for i, s in enumerate(streams):
        for b in range(len(pages[i])):
            own = [m for m, (_, _, x) in zip(marks[i], s, strict=True) if x == b]
            out[i][b] = sum(own) / len(own) > rules.covered
    return out


def test_boilerplate_against_brute_force():
    rng = random.Random(5)
    for rules in (Rules(run=4), Rules(run=8, open_pages=0.5)):
        shared = [" ".join(rng.choice("abcdefgh") * 2 for _ in range(rng.randint(2, 14))) for _ in range(6)]
        pages = []
        for _ in range(40):
            page = []
            for _ in range(rng.randint(0, 6)):
                text = rng.choice(shared) if rng.random() < 0.5 else " ".join(rng.choice("abcdefghijklmnop") + rng.choice("xyz") for _ in range(rng.randint(1, 20)))
                page.append((text, rng.choice([ARTICLE, OPEN, OUTSIDE])))
            pages.append(page)
        pages += pages[:5] * 2
        cells = np.array([i % 3 for i in range(len(pages))])
        assert H.boilerplate(pages, cells, rules) == brute(pages, cells.tolist(), rules)


def test_host_repeats(spark):
    """Unmarked notices go, copies of an article and a passage shared by a few pages stay."""
    rng = random.Random(2)
    words = [f"w{i}" for i in range(3000)]
    notice = "By using this site you agree to our terms of use and privacy policy at all times"
    passage = " ".join(rng.choice(words) for _ in range(60))
    pages = []
    for i in range(60):
        own = [" ".join(rng.choice(words) for _ in range(40)) for _ in range(3)]
        if i < 6:
            own.insert(1, passage)
        if 40 <= i:
            own = ["copy " * 30, "the same article on many pages of this host and it must be kept whole everywhere"]
        blocks = "".join(f"<p>{x}</p>" for x in own)
        body = f"<article>{blocks}</article>" if i % 2 else f"<div>{blocks}</div>"
        pages.append((i, f"http://user@Host.example:80/{i}", f"<div>{notice}</div>{body}<div>{notice}</div>", own))
    df = spark.createDataFrame([p[:3] for p in pages] + [(100, None, None), (None, "", ""), (101, "no url", "<p>x</p>")] + [(102, "http://h/", "<p>twice</p>")] * 2,
                               "page_id bigint, url string, html string").withColumn("text", H.F.lit("clash"))
    got = H.extract(df).collect()
    assert len(got) == 65
    by = {r.page_id: r for r in got}
    for i, _, _, own in pages:
        assert by[i].text == "\n\n".join(" ".join(x.split()) for x in own), i
        assert by[i].n_chars == len(by[i].text)
    assert by[100].text == "" and by[None].text == "" and by[101].text == "x" and by[102].text == "twice"
    assert H.extract(df.limit(0)).count() == 0


def test_large_host_is_counted_whole(spark):
    """A notice on a tenth of a large host's pages goes, though few pages of every cell have it."""
    rng = random.Random(4)
    words = [f"w{i}" for i in range(3000)]
    notice = "Order before Friday and save ten percent on all seeds pots and garden tools"
    rare = "This quotation stands on a few pages of the host only and so it is text"
    pages = []
    for i in range(640):
        own = [" ".join(rng.choice(words) for _ in range(30)) for _ in range(2)] + [rare] * (i % 30 == 0)
        extra = f"<div>{notice}</div>" if i % 10 == 0 else ""
        pages.append((i, f"http://big.example/{i}", "".join(f"<p>{x}</p>" for x in own) + extra, "\n\n".join(own)))
    pages += [(1000 + i, f"http://big.example/copy{i}", "<p>one page of which the host has very many equal copies all over</p>",
               "one page of which the host has very many equal copies all over") for i in range(60)]
    df = spark.createDataFrame([p[:3] for p in pages], "page_id bigint, url string, html string")
    got = {r.page_id: r.text for r in H.extract(df).collect()}
    assert got == {p[0]: p[3] for p in pages}


def test_query(spark):
    """Articles of the test pages, cut out by their known template."""
    pages = {r.page_id: r.html for r in spark.read.parquet("/root/testdata/sf0.1/pages.parquet").collect()}
    got = queries.op10_html_text(spark, "/root/testdata/sf0.1").collect()
    assert len(got) == len(pages)
    assert all(r.text == article_of(pages[r.page_id]) for r in got)


def _large_host(n):
    """Pages of one host without any markup that tells: every tenth ends with a line of which nine tokens in a row are repeated."""
    rng = random.Random(11)
    words = [f"w{i}" for i in range(5000)]
    lines = [" ".join(rng.choice(words) for _ in range(9)) for _ in range(n // 50)]
    rows, want = [], {}
    for i in range(n):
        own = [" ".join(rng.choice(words) for _ in range(30)) for _ in range(2)]
        foot = f"<p>{lines[i // 50]} x{i} y{i} z{i}</p>" if n < 200 else f"<p>{lines[i % len(lines)]} x{i} y{i} z{i}</p>"
        rows.append((i, "http://one.example/", "".join(f"<p>{x}</p>" for x in own) + foot))
        want[i] = "\n\n".join(own)
    return rows, want


def test_results_do_not_hang_on_the_size_of_a_host(spark, monkeypatch):
    """Short repeats within blocks go on a host of any size, however its suffixes and pages are dealt."""
    small, large = _large_host(50), _large_host(600)
    schema = "page_id bigint, url string, html string"
    for rows, want in (small, large):
        assert {r.page_id: r.text for r in H.extract(spark.createDataFrame(rows, schema)).collect()} == want
    monkeypatch.setattr(H, "PART_PAGES", 100)
    dealt = H.extract(spark.createDataFrame(large[0], schema))
    assert {r.page_id: r.text for r in dealt.collect()} == large[1]


def test_repeats_that_are_not_broadcast(spark, monkeypatch):
    """Pages meet the repeats of their host by a shuffle, in shares, to the same rows."""
    rows, want = _large_host(600)
    rows += [(1000 + i, f"http://h{i % 7}.example/", f"<p>page {i} of a small host that has no repeats</p><p>x{i}</p>") for i in range(40)]
    rows += [(None, None, None), (2000, "", ""), (2000, "", "")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    once = sorted(H.extract(pages).collect(), key=str)
    monkeypatch.setattr(H, "KNOWN_BYTES", -1)
    monkeypatch.setattr(H, "SHARE_PAGES", 70)
    assert sorted(H.extract(pages).collect(), key=str) == once and len(once) == 643
    assert {r.page_id: r.text for r in once if r.page_id is not None and r.page_id < 1000} == want
