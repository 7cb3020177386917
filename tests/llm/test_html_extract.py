from sievekit.llm import html_extract as H

PAGE = """<!DOCTYPE html><html><head><title>No title</title><style>p{x:1}</style><script>var a="</p><p>no";</script>
</head><body class="with-sidebar"><header><h2>Site header</h2></header><nav><ul><li><a href=x>Menu</a></li></ul></nav>
<div class="cookie-notice">We use cookies on this site, read more about them here and there and everywhere.</div>
<div id="content"><div class="ad">Buy now, it is a very long advert with a lot of text to read for everybody.</div>
<article><header><h1>Head&amp;line</h1></header><p>First   paragraph with
 some <b>bold</b> text &eacute;&#233;&nbsp;x.<p>Short.<ul><li>One<li>Two</ul><p>Last paragraph, a good deal
longer than the others are.<br>After a break.</p><form><p>Subscribe <input></p></form></article>
<section id="comments"><article class="comment"><p>What a nice article this is, I read it twice today.</p></article>
</section></div><aside><p>Side text</p></aside><footer>&copy; footer</footer></body></html>"""


def test_page():
    assert H.main_text(PAGE) == "\n\n".join([
        "Head&line", "First paragraph with some bold text éé x.", "Short.", "One", "Two",
        "Last paragraph, a good deal longer than the others are. After a break."])


def test_page_without_article():
    long = "A sentence that goes on for quite a while so that it counts as text. " * 4
    html = (f"<body><div class=menu><a>a</a><a>b</a></div><div><h1>Title</h1><p>{long}</p><p>Short.</p><p>{long}</p></div>"
            "<div><a href=1>x</a> <a href=2>y</a> <a href=3>z</a></div></body>")
    assert H.main_text(html) == f"Title\n\n{long.strip()}\n\nShort.\n\n{long.strip()}"


def test_odd_pages(spark):
    pages = ["", None, "   ", "plain text only", "<p>unclosed <b>bold", "<![foo", "a < b && c > d", "</p></div>x",
             "<article></article>", "<div>" * 3000 + "deep", "<p>" + "word " * 200_000, "<nav>only menu</nav>", "<"]
    df = spark.createDataFrame([(1, h, "old") for h in pages] * 2, "page_id long, html string, text string")
    got = [r.text for r in H.extract(df).orderBy("text").collect()]
    assert len(got) == 2 * len(pages) and None not in got
    assert H.main_text("plain text only") == "plain text only"
    assert H.main_text("<p>unclosed <b>bold") == "unclosed bold"
    assert H.main_text("<nav>only menu</nav>") == ""
    assert len(H.main_text(pages[10])) == 5 * 200_000 - 1
    assert H.extract(df.limit(0)).count() == 0


def test_every_short_block_of_an_article_is_kept():
    blocks = ["Title", "A.", "x" * 400, "B.", "y" * 300, "C.", "D.", "E.", "F."]
    html = "<body><div class=ad>" + "advert " * 50 + "</div><article>" + "".join(f"<p>{b}</p>" for b in blocks) + "</article>"
    assert H.main_text(html) == "\n\n".join(blocks)


def test_smoothing_and_clusters():
    import numpy as np
    assert np.allclose(H.smoothed(np.ones(7)), 1)
    got = H.content_lines([5, 4, 200, 300, 10, 250, 3, 4, 2, 3], [3, 3, 1, 1, 1, 1, 3, 3, 3, 3])
    assert got[2:6].all() and not got[8:].any()


def test_form_around_the_page_is_no_form_in_it():
    html = "<body><form><p>field</p><main><h1>T</h1><p>Body text.</p><form><p>inner</p></form></main></form></body>"
    assert H.main_text(html) == "T\n\nBody text."
    nested = "<form><nav><article><p>teaser</p></article></nav></form><article><p>kept</p></article>"
    assert H.main_text(nested) == "kept"


def test_deep_nesting_is_linear():
    import time
    import tracemalloc
    begin = time.perf_counter()
    assert H.main_text("<article>" + "<div>a" * 100_000).count("a") == 100_000
    H.main_text("<div>a" * 100_000 + "</span>" * 100_000)
    assert time.perf_counter() - begin < 20
    tracemalloc.start()
    H.page_lines("<div>a" * 50_000)
    assert tracemalloc.get_traced_memory()[1] < 100e6
    tracemalloc.stop()


def test_formula_in_an_article_stays():
    page = "<article><p>The sum <math><mi>a</mi> + <mi>b</mi></math> is used below, as said before.</p></article>"
    assert H.main_text(page) == "The sum a + b is used below, as said before."
