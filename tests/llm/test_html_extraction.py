import html
import re
import time

import pytest

from axonweave.llm.html_extraction import extract, main_text

CASES = [
    ("", ""),
    ("plain < 5 &amp; text", "plain < 5 & text"),
    ('<div class="sidebar">x</div><p>Hello &amp;  bye\n<b>now</b></p> tail', "Hello & bye now\ntail"),
    ("<article><header><h1>T</h1></header><p>one<p>two <i>in</i>line<div>three</div><footer>f</footer></article><p>out, of it, all.</p>", "T\none\ntwo inline\nthree"),
    ('<p title="a>b">x</p><script>if(a</b>1)</script>y<!-- <p>no</p> -->', "x\ny"),
    ("<p>&nbsp;c &#233; &copy 1 &am", "c é © 1 &am"),
    ("<script>never closed <p>x</p>", ""),
    ("<ul><li>a<li>b</ul><form><p>q</p></form>", "a\nb"),
    ("<html><head><title>T</title><style>x</style><meta charset=x><body><p>Hello there.<p>And more.", "Hello there.\nAnd more."),
    ("<head><link rel=x><article><p>One.</p></article>", "One."),
    ("<head><title>T</title>Text, all of it.", "Text, all of it."),
    ("<head><title>T</title></head><p>x", "x"),
    (
        '<body><div><ul><li><a href="1">Home</a></li><li><a href="2">About</a></li></ul></div><div><h2>T</h2><p>Long text here, with many words, and more; it goes on.</p>'
        '<p>Short.</p></div><section id="comments"><p>nice post, really, yes.</p></section></body>',
        "T\nLong text here, with many words, and more; it goes on.\nShort.",
    ),
]


@pytest.mark.parametrize("page, want", CASES)
def test_cases(page, want):
    assert main_text(page) == want


def test_long_and_broken_pages_end():
    assert main_text("<p>" * 3000 + "x") == "x"
    assert main_text("<b>" * 20_000 + "x") == "x"
    assert len(main_text("<p>word</p>" * 50_000)) == 5 * 50_000 - 1
    main_text('<a href="' * 2000)


def test_on_table(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r.page_id: r for r in extract(pages).collect()}
    for p in pages.collect():
        inside = re.search(r"<article>(.*?)</article>", p.html, re.S)[1]
        lines = (" ".join(html.unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", inside))
        assert got[p.page_id].text == "\n".join(x for x in lines if x)
        assert got[p.page_id].n_chars == len(got[p.page_id].text)


def test_null_and_empty(spark):
    pages = spark.createDataFrame([(1, None, None, 3), (1, None, None, 3), (2, "u", "", 4)], "page_id long, url string, html string, text int")
    assert sorted(map(tuple, extract(pages).collect()), key=str) == [(1, None, "", 0), (1, None, "", 0), (2, "u", "", 0)]
    assert extract(pages.limit(0)).collect() == []


LONG = [f"Paragraph {i} has many words, commas, and more; it goes on and on, for as long as the reader likes, and then ends." for i in range(6)]
BODY = "".join(f"<p>{x}</p>" for x in LONG)


@pytest.mark.parametrize("page, want", [
    # against an article: it holds teasers, the text is in a div
    (f"<body><div><h1>T</h1>{BODY}</div><article><h3>Next</h3><p>Read this too.</p></article></body>", ["T", *LONG]),
    # within an article: an unnamed advert and a link list
    (f"<article><h1>T</h1>{BODY}<div>Buy now</div>{BODY}<ul><li><a href='1'>One</a></li><li><a href='2'>Two</a></li></ul></article>", ["T", *LONG, *LONG]),
    # a class word above an article
    (f"<div class='layout has-sidebar'><article>{BODY}</article></div>", LONG),
    (f"<div class='layout has-sidebar'><main>{BODY}<div class='sidebar'>x</div></main></div>", LONG),
    (f"<article>{BODY}</article><div class='comments'><article><p>Nice, thanks.</p></article></div>", LONG),
    (f"<nav><article>{BODY}</article></nav><p>Left, over.</p>", ["Left, over."]),
])
def test_ratios_decide(page, want):
    assert main_text(page) == "\n".join(want)


@pytest.mark.parametrize("page, want", [
    ("<div><a href='/'>Home</a></div><div><h1>T</h1><p>Short text.</p></div><div>Copyright 2024 The House of Names. All rights reserved.</div>", ["T", "Short text."]),
    # parts that hold the whole page are wrappers, whatever they are called
    (f"<body><div class='post-ad'><h1>T</h1>{BODY}</div><div class='sidebar'><p>x, y, and z.</p></div></body>", ["T", *LONG]),
    (f"<body><form id='aspnetForm'><div><h1>T</h1>{BODY}</div><div><label>Name</label><input></div></form></body>", ["T", *LONG]),
    (f"<body><nav><a href='1'>One</a> <a href='2'>Two</a><article><h1>T</h1>{BODY}</article></body>", ["T", *LONG]),
    (f"<body><nav><a href='1'>One</a><div><h1>T</h1>{BODY}</div><footer><p>Left, over.</p></footer></body>", ["T", *LONG]),
    # and parts that do not are furniture
    (f"<body><div><h1>T</h1>{BODY}</div><form><p>Write to us, please.</p><p>Name.</p><p>Place.</p></form></body>", ["T", *LONG]),
    (f"<body><div><h1>T</h1>{BODY}</div><div class='comments'><h2>Said</h2>{BODY[:300]}</p></div></body>", ["T", *LONG]),
    (f"<body><div><h1>T</h1>{BODY}<aside><p>{LONG[0]}</div><p>{LONG[1]}</p></body>", ["T", *LONG, LONG[1]]),
    (f"<body><article><h1>T</h1><p>{LONG[0]}</p></article><section class='comments'>{BODY}</section></body>", ["T", LONG[0]]),
    (f"<body><article><h1>T</h1><p>{LONG[0]}</p></article><div class='comments'><article>{BODY}</article></div></body>", ["T", LONG[0]]),
    (f"<body><main><div class='post-ad'><h1>T</h1>{BODY}</div></main></body>", ["T", *LONG]),
    ("<div class='cookie-notice'><p>We use cookies.</p></div>", []),
    (f"<body><div style='display: none'><h1>N</h1>{BODY}</div><div><p>Short text.</p></div></body>", ["Short text."]),
    (f"<article>{BODY}<p>Copyright 2024 is what this is about.</p><div><a href='1'>A link, alone.</a></div></article>", [*LONG, "Copyright 2024 is what this is about."]),
])
def test_furniture_is_a_weight(page, want):
    assert main_text(page) == "\n".join(want)


def test_deep_nesting_is_linear():
    def seconds(page):
        began = time.time()
        main_text(page)
        return time.time() - began

    for make in (lambda n: "<div>" * n + "<p>some words, here.</p>" + "</div>" * n, lambda n: "<i>" * n + "</div>" * n, lambda n: "<i><div>" + "<b>" * n + "</i>" * n, lambda n: "<ul><li>" * n + "<p>text" * n):
        assert seconds(make(100_000)) < 20
    assert main_text("<div>" * 100_000 + "<p>some words, here.</p>") == "some words, here."
