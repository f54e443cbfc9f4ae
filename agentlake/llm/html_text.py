"""Main text of web pages by two-pass block rules.

A page is read into blocks of text. The first pass decides blocks by what they are part of (menus, forms, notices and the
like are out), by the share of their text that is links, and by stop-word density and length; short blocks, and blocks the
measures say little about, stay open. Few stop words speak against a block only where its language has some in the list;
else a long block with few links is in. In the second pass an open block takes the label of its nearest decided neighbours,
or of the only one, at any distance; inside an article element with no decided block, open blocks are in, and so they are
on a page where no block is decided by its words.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from agentlake.llm.rows import texts

#: Frequent words of some languages; their share tells prose from lists of names and labels.
STOP_WORDS = frozenset(
    """the of and to in is that it for was on are as with be by this from or an at not have but which you his they he she we
    der die und das den von zu mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach
    le la les de des et en un une du est que dans qui pour par sur pas au ne se ce plus avec son il elle sont
    el los las del y que se por con para una su al lo como más o pero sus ya este no
    il di che è per non una sono con del della da si nel più anche come
    o os as do da em um uma para com não por mais dos foi ao ele das
    het een van en ik te dat op zijn niet aan met als voor""".split()
)

#: Share of links above which a block is out; below ``SHORT`` characters a block is open; one of ``LONG`` characters is in
#: with few stop words, a shorter one with many; the densities that count as few and as many.
LINKS, SHORT, LONG, FEW, MANY = 0.33, 70, 140, 0.12, 0.25

#: Elements whose text is never part of an article.
OUT = frozenset("script style noscript template head title nav footer aside form button select option textarea input iframe svg canvas menu dialog object".split())
#: Elements that end a block where they begin and end.
BLOCKS = frozenset(
    """address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6
    header hr html li main menu nav ol optgroup p pre section summary table tbody td tfoot th thead title tr ul caption""".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
ARTICLE = frozenset(["article", "main"])
ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog menu menubar toolbar form".split())
#: Words that mark what is not the article, where a class name or id says nothing else; the second set only where no part of
#: any marks content. An article element is put out by a class name that is one of ``OTHERS`` alone.
MARKS = frozenset(
    """ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion cookie cookies consent gdpr notice notices popup
    modal overlay newsletter subscribe signup comment comments commentlist disqus reply replies respond share sharing
    social related recommended recommendations breadcrumb breadcrumbs pagination pager paywall alert""".split()
)
LAYOUT = frozenset("nav navbar navigation menu sidebar side footer header masthead topbar toolbar widget widgets banner copyright legal login search".split())
CONTENT = frozenset("content article main post entry story body text".split())
OTHERS = frozenset("ad advert advertisement comment comments promo reply sponsored".split())
#: Words beside a mark that leave it one: names of places, parts and looks.
NEUTRAL = frozenset(
    """area bar block body bottom box button buttons center col column container element field fixed form global group heading hidden holder
    icon icons inner item items js left link links list main mobile module outer page pane panel primary region right row secondary
    section site slot sticky text thread title top unit wrap wrapper zone""".split()
)
#: An end tag is implied for an open element by the start of one of these.
CLOSES = {"p": BLOCKS - {"title"}, "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]), "tr": frozenset(["tr"]),
          "td": frozenset(["td", "th", "tr"]), "th": frozenset(["td", "th", "tr"]), "option": frozenset(["option"]), "head": frozenset(["body"])}
#: Open elements that an implied end does not reach beyond.
FENCES = frozenset("table ul ol dl div section article main aside nav header footer form body html td th".split())

_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_CUT = re.compile(r"<[a-zA-Z/!?][^<>]*\Z")
_WORD = re.compile(r"\w+")
#: A letter that no language of ``STOP_WORDS`` is written with.
_OTHER = re.compile(r"[^\W\d_a-zßàáâãäæçèéêëìíîïñòóôõöùúûüÿœĳºª]")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


class _Blocks(HTMLParser):
    """``blocks``: ``[text, length in links, heading, region]``; region 0 is outside of any article element."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack: list[tuple[str, bool, int]] = []  # tag, out, region
        self.out, self.region, self.regions, self.links = False, 0, 0, 0
        self.blocks: list[list] = []
        self.now: list[str] = []
        self.linked, self.heading = 0, False

    def _flush(self):
        text = " ".join("".join(self.now).split())
        if text:
            self.blocks.append([text, self.linked, self.heading, self.region])
        self.now, self.linked = [], 0

    def _is_out(self, tag: str, attrs: list) -> bool:
        if tag in OUT or tag == "header" and not self.region:
            return True
        if tag in ("html", "body"):
            return False
        names: list[set[str]] = []
        for name, value in attrs:
            if name in ("class", "id"):
                names += [{x.lower() for x in _PART.findall(token) if len(x) > 1} for token in (value or "").split()]
            elif name == "role" and (value or "").lower() in ROLES or name == "hidden" or name == "aria-hidden" and value == "true":
                return True
            elif name == "style" and _HIDDEN.search(value or ""):
                return True
        # a name is a mark where all its words are marks or say no more than where or what an element is
        content = any(parts & CONTENT for parts in names)
        if tag in ARTICLE:
            return tag != "main" and not content and any(len(parts) == 1 and parts <= OTHERS for parts in names)
        if any(parts & MARKS and parts <= MARKS | LAYOUT | CONTENT | NEUTRAL for parts in names):
            return True
        return not content and any(parts & LAYOUT and parts <= LAYOUT | NEUTRAL and not (self.region and "header" in parts) for parts in names)

    def _pop(self, to: int):
        while len(self.stack) > to:
            tag, _, _ = self.stack.pop()
            if tag in BLOCKS:
                self._flush()
            self.links -= tag == "a"
        self.out, self.region = self.stack[-1][1:] if self.stack else (False, 0)
        self.heading = any(t[0] in "h1 h2 h3 h4 h5 h6".split() for t in self.stack[-3:])

    def handle_starttag(self, tag, attrs):
        # ends that this start implies
        for k in range(len(self.stack) - 1, max(-1, len(self.stack) - 30), -1):
            open_tag = self.stack[k][0]
            if tag in CLOSES.get(open_tag, ()):
                self._pop(k)
                break
            if open_tag in FENCES:
                break
        if tag in BLOCKS:
            self._flush()
        elif tag == "br":
            self.now.append("\n")
        if tag in VOID:
            return
        out = self.out or self._is_out(tag, attrs)
        region = self.region
        if not out and tag in ARTICLE and not region:
            self.regions += 1
            region = self.regions
        self.stack.append((tag, out, region))
        self.out, self.region = out, region
        self.links += tag == "a"
        self.heading = self.heading or tag in ("h1", "h2", "h3", "h4", "h5", "h6")

    def handle_startendtag(self, tag, attrs):
        if tag in BLOCKS:
            self._flush()
        elif tag == "br":
            self.now.append("\n")

    def handle_endtag(self, tag):
        for k in range(len(self.stack) - 1, -1, -1):
            if self.stack[k][0] == tag:
                self._pop(k)
                return
        if tag in BLOCKS:
            self._flush()

    def handle_data(self, data):
        if not self.out:
            self.now.append(data)
            if self.links:
                self.linked += len("".join(data.split()))


def _is_links(text: str, linked: int) -> bool:
    return linked > LINKS * max(1, len(text.replace(" ", "")))


def _other(found: list[str]) -> bool:
    """Whether a tenth of the words have letters of other languages than the listed ones."""
    return 10 * sum(bool(_OTHER.search(w)) for w in found) >= len(found)


def _listed(blocks: list[list]) -> bool:
    """Whether stop words are as frequent on the page as in a language of the list."""
    n = stop = 0
    for text, linked, *_ in blocks:
        found = [] if _is_links(text, linked) else _WORD.findall(text.lower())
        if found and not _other(found):
            n += len(found)
            stop += sum(w in STOP_WORDS for w in found)
    return stop >= FEW * n


def _decide(text: str, linked: int, heading: bool, region: int, listed: bool = True) -> bool | None:
    """In, out, or open; ``listed`` says whether few stop words are evidence on this page.

    Inside an article a sentence may hold a link of any length, and a heading may be one; what is links alone is out.
    """
    if region:
        if not heading and linked >= len(text.replace(" ", "")):
            return False
    elif _is_links(text, linked):
        return False
    found = _WORD.findall(text.lower())
    if not found:
        return None
    density = sum(w in STOP_WORDS for w in found) / len(found)
    if len(text) >= SHORT and density >= MANY or len(text) >= (SHORT if region else LONG) and density >= FEW:
        return True
    if len(text) >= LONG and density < FEW and not region and (not listed or _other(found)):
        return True
    if len(text) >= LONG and density < FEW / 2 and not region:
        return False
    return None


def main_text(html: str) -> str:
    """The main text: blocks in page order, joined by an empty line; empty if there is none."""
    parser = _Blocks()
    parser.feed(_CUT.sub("", html))
    parser.close()
    parser._flush()
    blocks = parser.blocks
    regions = any(region for *_, region in blocks)
    listed = regions or _listed(blocks)
    label = [_decide(t, linked, heading, region, listed) for t, linked, heading, region in blocks]
    if not regions and not any(x is not None and not _is_links(t, linked) for x, (t, linked, *_) in zip(label, blocks)):
        # no words decide anything: the open blocks are the text
        return "\n\n".join(t for x, (t, *_) in zip(label, blocks) if x is None)
    # where there is an article element, what stands outside of all is not the article
    if regions:
        label = [x if region else False for x, (*_, region) in zip(label, blocks)]
    before: list[tuple[int, bool] | None] = []
    seen: dict[int, tuple[int, bool]] = {}
    for i, (*_, region) in enumerate(blocks):
        before.append(seen.get(region))
        if label[i] is not None:
            seen[region] = (i, label[i])
    after: list[tuple[int, bool] | None] = [None] * len(blocks)
    seen = {}
    for i in range(len(blocks) - 1, -1, -1):
        region = blocks[i][3]
        after[i] = seen.get(region)
        if label[i] is not None:
            seen[region] = (i, label[i])
    out = []
    for i, (text, _, heading, region) in enumerate(blocks):
        keep = label[i]
        if keep is None:
            a, b = before[i], after[i]
            if region:  # links aside, an article is whole
                keep = True
            elif a and b:
                # between two labels, the nearer one; a heading goes with what follows
                keep = a[1] if a[1] == b[1] else (b if heading or b[0] - i < i - a[0] else a)[1]
            else:
                near = b or a
                keep = bool(near and near[1])
        if keep:
            out.append(text)
    return "\n\n".join(out)


@F.arrow_udf(StringType())
def _main_text(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in batches:
        yield pa.array([main_text(t.as_py()) for t in batch], pa.string())


def extract(pages: DataFrame, *keep: str, html: str = "html") -> DataFrame:
    """``keep, text, n_chars`` of every row; no shuffle.

    Null and empty pages have an empty text. Repeated rows are read each; an empty table gives an empty one; columns that
    are not in ``keep`` do not matter.
    """
    out = texts(pages, *keep, text=html).select(*keep, _main_text("text").alias("text"))
    return out.withColumn("n_chars", F.length("text").cast("long"))
