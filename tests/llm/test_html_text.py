"""Pages made for the rules, and the given ones."""

import re
from html import unescape

import pytest

from agentlake.llm import entries, html_text
from agentlake.llm.rows import table

PROSE = "The river of the town is as old as the hills, and it was here that the first of them came to be with us."
MORE = "It is not that they have no words for this; it is that by the time you ask, the words are on to another place."


@pytest.mark.parametrize(
    "html, want",
    [
        ("", ""),
        (f"<article><h1>A &amp; B</h1><p><b>{PROSE}<br>x<p>&eacute;&nbsp; y</article>", f"A & B\n\n{PROSE} x\n\né y"),
        (f"<nav><ul><li><a href=/>the menu of the site</a></ul></nav><article><p>{PROSE}</p><div class='ad'>Buy the thing</div>"
         f"<p>short</p><section id=comments><p>{MORE}</p></section></article><footer>{MORE}</footer>", f"{PROSE}\n\nshort"),
        (f"<div class=sidebar>{MORE}</div><div class='post-content'><p>{PROSE}</p><p>ok</p><p>{MORE}</p></div><form>{MORE}</form>", f"{PROSE}\n\nok\n\n{MORE}"),
        (f"<body><h2>Title</h2><p>{PROSE} {PROSE}</p><ul><li><a>one</a><li><a>two</a></ul></body>", f"Title\n\n{PROSE} {PROSE}"),
        (f"<script>var t='</p>{MORE}';</script><style>p{{}}</style><!-- {MORE} --><main><p>{PROSE}</main><div role=alert>{MORE}</div>", PROSE),
        (f"<main><p>{PROSE}</p><pre>a\n b</pre></main><aside>{MORE}</aside><p cl", f"{PROSE}\n\na b"),
        ("<p>only a few words</p>", "only a few words"),
        (f"<article class='post comments-open'><p>{PROSE}</p></article>", PROSE),
        (f"<main class='site has-notice'><p>{PROSE}</p></main>", PROSE),
        (f"<div class='social-science story'><p>{PROSE} {PROSE}</p></div>", f"{PROSE} {PROSE}"),
        (f"<div id=search-for-truth><p>{PROSE} {PROSE}</p></div>", f"{PROSE} {PROSE}"),
        (f"<div class=legal-news><p>{PROSE} {PROSE}</p></div>", f"{PROSE} {PROSE}"),
        (f"<article><p>{PROSE}</p><section id=discussion><p>{MORE}</p></section><p id=market-share>{PROSE}</p></article>", f"{PROSE}\n\n{MORE}\n\n{PROSE}"),
        ("<article><h1><a href=/>A title</a></h1><p>See <a href=/>the long title of the study that was cited</a>.</p><ul><li><a>next</a></ul></article>",
         "A title\n\nSee the long title of the study that was cited."),
        (f"<article class=post><p>{PROSE}</p></article><article class='comment depth-1'><p>{MORE}</p></article>", PROSE),
        (f"<div class='post-comments'>{MORE}</div><div class='ad-300x250'>{MORE}</div><div id='cookieNotice'>{MORE}</div>"
         f"<div class='site-header top-bar'>{MORE}</div><div class='entry'><p>{PROSE} {PROSE}</p><div class='social-share-buttons'>{MORE}</div></div>",
         f"{PROSE} {PROSE}"),
    ],
)
def test_pages(html, want):
    assert html_text.main_text(html) == want


RUSSIAN = "Река города так же стара, как холмы вокруг него, и здесь первые люди решили остаться навсегда. " * 2
CHINESE = "这座城市的河流和周围的山一样古老，最早来到这里的人们决定在河边留下来，建起房屋，种下果树。" * 4
POLISH = "Rzeka płynąca przez miasto jest równie stara jak wzgórza, więc pierwsi mieszkańcy postanowili zostać właśnie tutaj. " * 2
SWAHILI = "Mto wa mji huu umekuwepo tangu zamani kama vilima vyake, watu wake wa kwanza waliamua kukaa hapa milele. " * 2
NAMES = "Acme Widgets, Blue Harbor Trading, Crown Bakery, Delta Motors, Eagle Optics, Forest Hardware, Golden Gate Tours, Hill Street Books, Iron Works"


@pytest.mark.parametrize("prose", [RUSSIAN, CHINESE, POLISH, SWAHILI])
def test_prose_without_listed_stop_words(prose):
    prose = prose.strip()
    page = f"<body><h1>1</h1><p>{prose}</p><p>2</p><p>{prose}</p><div class=sidebar>{prose}</div><p><a>{prose}</a></p></body>"
    assert html_text.main_text(page) == f"1\n\n{prose}\n\n2\n\n{prose}"


def test_names_on_a_page_of_a_listed_language_stay_out():
    assert html_text.main_text(f"<p>{PROSE} {PROSE}</p><p>{MORE} {MORE}</p><p>{NAMES}</p>") == f"{PROSE} {PROSE}\n\n{MORE} {MORE}"
    # another language beside it is not judged by these words
    assert html_text.main_text(f"<p>{PROSE} {PROSE}</p><p>{POLISH.strip()}</p>") == f"{PROSE} {PROSE}\n\n{POLISH.strip()}"


def test_a_page_of_short_blocks_only():
    lines = ["Roses are red", "Violets are blue", "Sugar is sweet", "And so are you", "Nobody else here", "Only short lines"]
    page = "".join(f"<p>{x}</p>" for x in lines) + "<p><a>one</a> <a>two</a></p><div class=nav>Site map</div>"
    assert html_text.main_text(page) == "\n\n".join(lines)


@pytest.mark.parametrize("first", [True, False])
def test_a_long_run_of_short_blocks_beside_one_decided(first):
    long, steps = f"{PROSE} {PROSE}", [f"Step {k}" for k in range(9)]
    blocks = [*steps, long] if first else [long, *steps]
    page = "<div class=menu>Home</div>" + "".join(f"<p>{x}</p>" for x in blocks) + "<div class=footer>Imprint</div>"
    assert html_text.main_text(page) == "\n\n".join(blocks)


def plain(page: str) -> str:
    """The given pages put the article into one element, of paragraphs and a heading; nothing of the extractor is used."""
    article = re.search(r"<article>(.*?)(</article>|\Z)", page, re.S)
    if not article:
        return ""
    blocks = re.split(r"</?(?:p|h1)>", re.sub(r"<[a-zA-Z/!?][^<>]*\Z", "", article[1]))
    return "\n\n".join(t for b in blocks if (t := " ".join(unescape(re.sub(r"</?[a-z][^>]*>", "", b.replace("<br>", " "))).split())))


def test_pages_without_an_article_element(spark, sf):
    """The given pages with the element replaced by a plain one: prose stays, menus, adverts and footers go."""
    same = total = 0
    for r in table(spark, sf, "pages").collect():
        want = plain(r.html or "")
        found = html_text.main_text((r.html or "").replace("<article>", "<div>").replace("</article>", "</div>"))
        total += 1
        same += found == want
        assert len(found) >= 0.9 * len(want) or len(want) < 200
    assert same >= 0.9 * total


def test_query(spark, sf):
    pages = {r.page_id: r for r in table(spark, sf, "pages").collect()}
    out = entries.QUERIES["op10_main_text"](spark, sf).collect()
    assert sorted(r.page_id for r in out) == sorted(pages)
    for r in out:
        assert r.text == plain(pages[r.page_id].html or "")
        assert r.n_chars == len(r.text) and r.url == pages[r.page_id].url


def test_odd_rows(spark):
    rows = [(1, None, "x"), (1, "", "x"), (None, f"<main>{PROSE}</main>", "x"), (2, "<div>" * 20_000 + PROSE * 3, "x"), (3, "<" * 5_000 + "&" * 5_000, "x")]
    pages = spark.createDataFrame(rows, "page_id long, html string, text string")
    out = {r.page_id: r.text for r in html_text.extract(pages, "page_id").collect()}
    assert out[None] == PROSE and out[1] == "" and out[2] == PROSE * 3
    assert html_text.extract(pages.limit(0), "page_id").count() == 0
