"""Main text of twenty pages written by hand, with the truth beside each of them."""

import pytest

from kerbline.llm import html_text

P1 = "The old harbour was rebuilt last year, after a long debate about its cost and its use."
P2 = "Most of the money came from the city, which expects the new quay to pay for itself within ten years."
P3 = "Fishermen are less sure: they say that the berths are too dear, and that the ice house is still missing."
HEAD = "A harbour is rebuilt"
NAV = "<ul><li><a href='/'>Home</a></li><li><a href='/news'>News</a></li><li><a href='/about'>About us</a></li></ul>"
FOOT = "<p>Copyright 2024 Harbour News.</p><a href='/terms'>Terms</a> <a href='/privacy'>Privacy</a>"
LIST = ["Drink water.", "Sleep well.", "Walk a little every day."]
ITEMS = "".join(f"<li>{x}</li>" for x in LIST)

PAGES = {
    "article with nav and footer": (
        f"<html><head><title>Harbour</title></head><body><nav>{NAV}</nav><article><h1>{HEAD}</h1><p>{P1}</p><p>{P2}</p></article><footer>{FOOT}</footer></body></html>",
        [HEAD, P1, P2],
    ),
    "list in an article": (
        f"<body><nav>{NAV}</nav><article><h1>{HEAD}</h1><p>{P1}</p><ul>{ITEMS}</ul><p>{P2}</p></article><footer>{FOOT}</footer></body>",
        [HEAD, P1, *LIST, P2],
    ),
    "numbered list in main": (
        f"<body><header>{NAV}</header><main><h1>{HEAD}</h1><p>{P1}</p><ol>{ITEMS}</ol><p>{P3}</p></main><footer>{FOOT}</footer></body>",
        [HEAD, P1, *LIST, P3],
    ),
    "quotation": (
        f"<body><nav>{NAV}</nav><article><h1>{HEAD}</h1><p>{P1}</p><blockquote>{P3}</blockquote><p>{P2}</p></article><footer>{FOOT}</footer></body>",
        [HEAD, P1, P3, P2],
    ),
    "quotation with paragraphs": (
        f"<body><nav>{NAV}</nav><main><p>{P1}</p><blockquote><p>{P3}</p><p>{P2}</p></blockquote></main><footer>{FOOT}</footer></body>",
        [P1, P3, P2],
    ),
    "headings between": (
        f"<body><nav>{NAV}</nav><article><h1>{HEAD}</h1><p>{P1}</p><h2>Who pays</h2><p>{P2}</p><h2>Who does not</h2><p>{P3}</p></article><footer>{FOOT}</footer></body>",
        [HEAD, P1, "Who pays", P2, "Who does not", P3],
    ),
    "plain divs named content": (
        f"<body><div id='menu'>{NAV}</div><div class='content'><h1>{HEAD}</h1><div>{P1}</div><div>{P2}</div></div><div class='footer'>{FOOT}</div></body>",
        [HEAD, P1, P2],
    ),
    "plain divs without names": (
        f"<body><div>{NAV}</div><div><h1>{HEAD}</h1><p>{P1}</p><p>{P2}</p><p>{P3}</p></div><div>{FOOT}</div></body>",
        [HEAD, P1, P2, P3],
    ),
    "sidebar": (
        f"<body><nav>{NAV}</nav><article><h1>{HEAD}</h1><p>{P1}</p><p>{P2}</p></article><aside class='sidebar'><h3>Popular</h3><ul><li><a href='/x'>Boats for sale</a></li><li><a href='/y'>Tide tables</a></li></ul></aside></body>",
        [HEAD, P1, P2],
    ),
    "reader comments": (
        f"<body><nav>{NAV}</nav><article><h1>{HEAD}</h1><p>{P1}</p><p>{P2}</p></article><div id='comments'><h3>2 comments</h3><p>I have seen it myself, and it looks very good indeed.</p><p>Too dear, as always.</p></div></body>",
        [HEAD, P1, P2],
    ),
    "cookie notice": (
        f"<body><div class='cookie-notice'><p>We use cookies to make this site better.</p><button>Accept</button></div><main><h1>{HEAD}</h1><p>{P1}</p><p>{P3}</p></main><footer>{FOOT}</footer></body>",
        [HEAD, P1, P3],
    ),
    "advert inside": (
        f"<body><nav>{NAV}</nav><article><h1>{HEAD}</h1><p>{P1}</p><div class='advert'><a href='/buy'>Buy a boat now, only today.</a></div><p>{P2}</p></article><footer>{FOOT}</footer></body>",
        [HEAD, P1, P2],
    ),
    "form after": (
        f"<body><header>{NAV}</header><article><h1>{HEAD}</h1><p>{P1}</p><p>{P2}</p></article><form class='newsletter'><label>Your address</label><input name='m'><button>Subscribe</button></form></body>",
        [HEAD, P1, P2],
    ),
    "scripts and styles": (
        f"<head><style>p {{ color: red }}</style></head><body><script>var a = '<p>no</p>';</script><article><h1>{HEAD}</h1><p>{P1}</p><script>track()</script><p>{P2}</p></article><noscript><p>Turn scripts on.</p></noscript></body>",
        [HEAD, P1, P2],
    ),
    "unclosed svg": (
        f"<body><nav>{NAV}</nav><article><h1>{HEAD}</h1><svg><path d='M0 0'><p>{P1}</p><p>{P2}</p></article></body>",
        [HEAD, P1, P2],
    ),
    "formula": (
        f"<body><nav>{NAV}</nav><article><h1>{HEAD}</h1><p>The cost was <math><mi>c</mi><mo>=</mo><mn>7</mn></math> million in all, and nobody was surprised by that.</p><p>{P2}</p></article></body>",
        [HEAD, "The cost was c=7 million in all, and nobody was surprised by that.", P2],
    ),
    "character references": (
        f"<body><nav>{NAV}</nav><article><h1>Harbour &amp; quay</h1><p>It cost &euro;5&nbsp;million &#8212; or more, as the city now says in public.</p><p>{P1}</p></article></body>",
        ["Harbour & quay", "It cost €5 million — or more, as the city now says in public.", P1],
    ),
    "preformatted text": (
        f"<body><nav>{NAV}</nav><article><h1>{HEAD}</h1><p>{P1}</p><pre>tide = 3\nberth = 4</pre><p>{P2}</p></article><footer>{FOOT}</footer></body>",
        [HEAD, P1, "tide = 3 berth = 4", P2],
    ),
    "table": (
        f"<body><nav>{NAV}</nav><article><h1>{HEAD}</h1><p>{P1}</p><table><tr><td>Berths in the new harbour</td><td>forty of them</td></tr></table><p>{P2}</p></article><footer>{FOOT}</footer></body>",
        [HEAD, P1, "Berths in the new harbour", "forty of them", P2],
    ),
    "broken tags": (
        f"<body><nav>{NAV}</nav><article><h1>{HEAD}</h1><p>{P1}<p>{P2}<div>{P3}</article><footer>{FOOT}",
        [HEAD, P1, P2, P3],
    ),
    "nested sections": (
        f"<body><header>{NAV}</header><main><section><h2>{HEAD}</h2><div><p>{P1}</p></div></section><section><p>{P2}</p></section></main><footer>{FOOT}</footer></body>",
        [HEAD, P1, P2],
    ),
    "only a menu": (f"<body><nav>{NAV}</nav><footer>{FOOT}</footer></body>", []),
}


@pytest.fixture(scope="module")
def model(spark, sf_dir):
    return html_text.train(spark.read.parquet(f"{sf_dir.replace('0.001', '0.01')}/pages.parquet"))


@pytest.mark.parametrize("name", PAGES)
def test_main_text(model, name):
    page, truth = PAGES[name]
    assert html_text.main_texts(model, html_text.Reader(), [page]) == [" ".join(truth)]


def test_pages_without_article_or_main_are_labelled_by_their_looks(spark, sf_dir):
    """A corpus of plain divs: the model that it gives leaves menus and footers out."""
    rows = []
    for i in range(40):
        body = "".join(f"<p>{p}</p>" for p in (P1, P2, P3)[: 2 + i % 2])
        rows.append((i, f"<body><div class='menu'>{NAV}</div><div><h1>{HEAD}</h1>{body}</div><div class='footer'>{FOOT}</div></body>"))
    pages = spark.createDataFrame(rows, "page_id long, html string")
    found = html_text.blocks(rows[0][1])
    assert [t for (_, t, _), y in zip(found, html_text.labels_of(found)) if y] == [P1, P2]
    out = {r["page_id"]: r["text"] for r in html_text.extract(pages, html_text.train(pages, sample=40, variants=2)).collect()}
    assert all(P1 in t and P2 in t and "About us" not in t and "Copyright" not in t for t in out.values())
    assert html_text.main_texts(None, html_text.Reader(), [rows[0][1]]) == [f"{P1} {P2}"]


def test_long_pages_are_learned_from_if_there_are_no_others(spark):
    body = "".join(f"<p>{P1} {P2}</p>" for _ in range(200))
    page = f"<body><nav>{NAV}</nav><article>{body}</article><footer>{FOOT}</footer></body>"
    assert len(page) > html_text.SAMPLE_CHARS
    assert html_text.train(spark.createDataFrame([(1, page), (2, None)], "page_id long, html string"), variants=1) is not None
