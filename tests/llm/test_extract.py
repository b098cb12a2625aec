import random

import pytest

from fleetgauge.llm.extract import extract_pages, main_text

PAGE = (
    '<!DOCTYPE html><html lang="en"><head><meta charset="utf-8"><title>T</title><style>p{margin:0}</style>'
    '<script>var t="</p>";track(0);</script></head><body><nav><ul><li><a href="/a">Home</a></li></ul></nav><!-- ad 0 -->'
    '<div class="ad">Buy. Now, now, now, now, now.</div>%s<footer>&copy; host &middot; Words, and words.</footer></body></html>'
)


def test_article():
    body = "<article><h1>Head &amp; line</h1><p><b>One, two\n  three.<br><p>Second&nbsp;block, with <a href='/x'>a link</a>.</p></article>"
    assert main_text(PAGE % body) == "Head & line\nOne, two three.\nSecond block, with a link."
    assert main_text(PAGE % "<article><p>A</p></article>") == "A"
    assert main_text((PAGE % body)[:-80]) == main_text(PAGE % body)
    cut = "<article><p>First.</p><p>Tom &am"
    assert main_text((PAGE % cut).split("&am")[0] + "&am") == "First.\nTom &am"


def test_parts_left_out():
    body = (
        "<header><h2>Site, site</h2></header><aside>side, bar</aside><form><p>Your name, please.</p></form><noscript>no</noscript>"
        "<article><header><h1>Title</h1></header><p>Text, of the article.</p><div class='share-buttons'>Share</div>"
        "<div class='cookie-notice'>We use cookies, and more.</div><ul><li>one<li>two</ul><table><tr><td>c1<td>c2</table>"
        "<section id='comments'><p>First! Great, great, great.</p></section></article><div class='sidebar'><p>More, more, more.</p></div>"
    )
    assert main_text(PAGE % body) == "Title\nText, of the article.\none\ntwo\nc1\nc2"


def test_scored_container():
    rng = random.Random(1)
    words = ["lorem", "ipsum,", "dolor", "sit", "amet."]
    paragraphs = [" ".join(rng.choices(words, k=40)) for _ in range(5)]
    body = "<div><div class='x1'>" + "".join(f"<p>{p}</p>" for p in paragraphs) + "</div><div class='x2'><a href='#'>one</a> <a href='#'>two</a></div></div>"
    assert main_text(PAGE % body) == "\n".join(paragraphs)


def test_odd_html():
    assert main_text(None) == main_text("") == main_text("<p>") == main_text("<script>x") == main_text("<!-- x") == ""
    assert main_text("just text, here.") == "just text, here."
    assert main_text("<p>a<p>b</div></p>c") == "a\nb\nc"
    assert main_text("<div>" * 5000 + "deep" + "</div>" * 5000) == "deep"
    assert main_text("<p>" + "word " * 200_000) == ("word " * 200_000).strip()


def test_malformed_declarations():
    for odd in ("<![ endif]-->", "<![foo[>", "<![endif]-->", "<![if !IE]>", "<!-- x --!>", "<!-->", "<!--->", "<!>", "<!x y>", "<!DOCTYPE a 'b>"):
        assert main_text(f"<p>one</p>{odd}<p>two</p>").replace("-->", "").split() == ["one", "two"], odd
    assert main_text("<p>one</p><![CDATA[ two <p>three</p><p>four</p>").split()[-1] == "four"
    assert main_text("<p>one</p><!-- <p>two</p>") == main_text("<p>one</p><![foo") == "one"


def test_pages(spark):
    rows = [(1, "u", PAGE % "<article><p>A é</p></article>", "x"), (1, "u", None, "x"), (None, None, "", None)]
    got = extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string, text string")).collect()
    assert [tuple(r) for r in got] == [(1, "u", "A é", 3), (1, "u", "", 0), (None, None, "", 0)]
    assert extract_pages(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


DROPPED_INLINE = ["noscript", "template", "object", "button", "label", "select", "svg", "canvas", "video", "audio", "map", "iframe"]
PROSE = "Plain prose of some length, with commas, to be kept as it is."


@pytest.mark.parametrize("tag", DROPPED_INLINE)
@pytest.mark.parametrize("inner", ["<p>no</p>", "<div>no<p>no</p>no</div>", "<div>no", "no<ul><li>no</ul>no", "<article><h2>no</h2></article>"])
def test_dropped_elements_take_their_blocks_along(tag, inner):
    if tag == "iframe" and not inner.endswith(">"):
        return
    page = f"<article><p>{PROSE}</p><{tag}>{inner}</{tag}><p>One <{tag}>{inner}</{tag}>block, {PROSE}</p><p>{PROSE}</p></article>"
    assert main_text(page) == f"{PROSE}\nOne block, {PROSE}\n{PROSE}"


def test_what_is_never_closed_ends_with_its_parent():
    page = f"<article><p>{PROSE}</p><div><button><p>no</p></div><p>{PROSE}</p></article>"
    assert main_text(page) == f"{PROSE}\n{PROSE}"


def test_ids_made_of_headings_mark_nothing():
    page = f"<main><h2 id='search'>Search</h2><p id='legal'>{PROSE}</p><section id='related-work'><p>{PROSE}</p></section>"
    page += f"<ul id='sharing-data'><li id='share'>{PROSE}</li></ul><section id='comments'><p>no, {PROSE}</p></section><section id='related-2'><p>no</p></section></main>"
    assert main_text(page) == f"Search\n{PROSE}\n{PROSE}\n{PROSE}"
