"""Main text of hand-written pages and of the test table."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from ticklake.llm import html_density as H

SF = "/root/testdata/sf0.001"


def test_cuts_boilerplate():
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
    <header><h2>Site</h2></header><nav><ul><li><a href="/">Home</a></li></ul></nav><div class="ad">Buy it now, buy it</div>
    <div class="cookie-notice">We use cookies on this site.</div>
    <main><article><h1>Head &amp; tail</h1><p>One <b>bold</b>&nbsp;<i>word</i>,<br>two   lines
    here.</p><p>Second <a href="/x">link</a> &lt;tag&gt; &#233;.<ul><li>first<li>second</ul>
    <blockquote>quoted words</blockquote><form><p>Name</p></form></article></main>
    <aside>Related pages</aside><section id="comments"><p>Great post, I think this is a long comment.</p></section>
    <footer>Copyright</footer></body></html>"""
    assert H.main_text(page).split("\n") == [
        "Head & tail", "One bold word, two lines here.", "Second link <tag> é.", "first", "second", "quoted words",
    ]


def test_density_picks_the_article():
    text = "<p>" + "many words of plain text without any link in them " * 5 + "</p>"
    links = "".join(f'<li><a href="/{i}">some link {i}</a></li>' for i in range(30))
    page = f"<body><div><ul>{links}</ul></div><div><div>{text * 4}</div></div><div><a href='/'>about us</a></div></body>"
    out = H.main_text(page)
    assert "some link" not in out and "about us" not in out and out.count("many words") == 20


def test_whole_texts_of_the_table(spark):
    rows = spark.read.parquet(f"{SF}/pages.parquet").collect()
    got = {r.page_id: r for r in H.op6_html_density(spark, SF).collect()}
    assert len(got) == len(rows)
    for page in rows:
        r = got[page.page_id]
        article = re.search(r"<article>(.*)</article>", page.html, re.S)
        if article:
            blocks = re.split(r"</?(?:h1|p)>", article[1])
            plain = [" ".join(__import__("html").unescape(re.sub(r"<br>", " ", re.sub(r"</?b>", "", b))).split()) for b in blocks]
            assert r.text == "\n".join(b for b in plain if b)
        assert r.n_chars == len(r.text) and r.url == page.url


def test_edges(spark):
    deep = "<div>" * 20_000 + "deep words" + "</div>" * 20_000
    pages = ["", None, "plain words", "<p>", "<script>x", "<p>un<b>closed", "<!-- c --><p>a</p>", deep, "<p class=ad>x</p>", "&amp;", "<p>a<hr>b</p>", "<"]
    df = spark.createDataFrame([(i, f"u{i}", p) for i, p in enumerate(pages)], "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    got = [r.text for r in H.extract(df).orderBy("page_id").collect()]
    assert got == ["", "", "plain words", "", "", "unclosed", "a", "deep words", "", "&", "a\nb", "<"]
    assert H.extract(df.limit(0)).count() == 0


def _paras(name, n, size):
    return "".join(f"<p>{f'{name}{i} word ' * (size // 8)}</p>" for i in range(n))


def test_whole_article_of_several_sections():
    two = f"<body><article><section>{_paras('a', 10, 500)}</section><section>{_paras('b', 8, 500)}</section></article></body>"
    assert len(H.main_text(two).split("\n")) == 18
    lead = f"<body><article><h1>Head</h1><p>{'lead words ' * 45}</p><div>{_paras('c', 20, 500)}</div></article></body>"
    out = H.main_text(lead).split("\n")
    assert len(out) == 22 and out[0] == "Head" and out[1].startswith("lead words")
    links = "".join(f'<li><a href="/{i}">some link {i}</a></li>' for i in range(30))
    bare = f"<body><div><h1>Head</h1>bare words here<div>{_paras('d', 9, 500)}</div><p>last</p><ul>{links}</ul></div></body>"
    out = H.main_text(bare).split("\n")
    assert out[:2] == ["Head", "bare words here"] and len(out) == 12 and out[-1] == "last"


def test_class_words_do_not_cut_what_wraps_the_text():
    text = _paras("a", 6, 300)
    for page in (
        f'<body><div class="layout header-fixed"><main>{text}</main></div></body>',
        f'<body><div class="page with sidebar"><article>{text}</article></div></body>',
        f'<body><my-app id="widget"><div class="no-sidebar">{text}</div></my-app></body>',
    ):
        assert len(H.main_text(page).split("\n")) == 6
    page = f'<body><article>{text}</article><section class="comments"><article>{_paras("x", 3, 100)}</article></section><p>a <span class="ad">buy</span> b</p></body>'
    out = H.main_text(page)
    assert "x0" not in out and "buy" not in out and "a5 word" in out


COMMENTS = "".join(f'<article class="comment-body"><p>comment {i} {"says a lot about it " * 20}</p></article>' for i in range(8))
PLAIN_COMMENTS = "".join(f"<div><p>comment {i} {'says a lot about it ' * 20}</p></div>" for i in range(12))


def test_comments_and_sidebars_go_from_pages_without_article():
    text = _paras("a", 6, 300)
    for rest in (
        f'<div id="comments">{COMMENTS}</div>', f'<div class="comments">{PLAIN_COMMENTS}</div>', COMMENTS,
        f'<div class="sidebar">{PLAIN_COMMENTS}</div>', f'<div class="sidebar"><article>{PLAIN_COMMENTS}</article></div>',
        f'<div id="respond"><article>{PLAIN_COMMENTS}</article></div>',
    ):
        for page in (
            f'<body><div class="content">{text}</div>{rest}</body>', f"<body><article>{text}</article>{rest}</body>",
            f'<body><div class="page with-sidebar"><div class="post">{text}</div>{rest}</div></body>',
            f"<body><main><div>{text}</div>{rest}</main></body>", f'<body class="comments-open"><div>{text}</div>{rest}</body>',
        ):
            out = H.main_text(page)
            assert "comment" not in out and len(out.split("\n")) == 6, page
    assert H.main_text(f'<body><div class="post comments-open">{text}</div></body>').count("\n") == 5


def test_unclosed_markup_takes_linear_time():
    import time

    for piece in ("<a ", "<!--", "</a ", "<!x", "<?x", "<a b='"):
        began = time.time()
        assert H.main_text("<p>words</p>" + piece * (1_000_000 // len(piece))) == "words"
        assert time.time() - began < 5
    assert H.main_text("<p>a<!-->b<!--->c<!-- x --!>d</p>1 < 2 <![CDATA[x]]>e") == "abcd\n1 < 2 e"
