"""Main text of web pages by two passes of block rules.

A page is cut into blocks at block-level tags. The first pass looks at each block alone: blocks in containers that name
themselves menus, adverts or the like and blocks of links are bad, long blocks with enough stop words are good, and short
or middling blocks stay open. In the second pass open blocks take the label of the nearest decided blocks around them,
within their own article where the page marks one.

Words of a class, id or role are only hints. They say nothing of an article or main element that is not inside another,
and a container they point at is let off if it holds nearly all good text of the page, or most of it and the main heading:
then it wraps the page, as a class like `with-left-sidebar` does.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listora.llm.arrow_batches import pieces

LINKED = 0.2  # share of a block's characters in links that makes it bad
SHORT = 70  # characters
LONG = 200  # characters
STOPS_LOW, STOPS_HIGH = 0.08, 0.16  # share of stop words

# The most frequent function words of the languages the pages are in.
STOP_WORDS = frozenset(
    "a an and are as at be been but by for from had has have he her his i in is it its not of on or she that the their "
    "they this to was we were which will with you "
    "au aux avec ce ces cette dans de des du elle en est et il ils je la le les leur lui mais ne nous on ou par pas plus "
    "pour que qui sa se ses son sont sur un une vous "
    "aber als am auch auf aus bei das dass dem den der des die durch ein eine einem einen einer er es für hat ich im "
    "in ist mit nach nicht noch nur oder sich sie sind über um und von vor war wie wir zu zum zur "
    "al como con del el ella ellos ese esta este fue han hay las lo los más me mi muy no nos o para pero por porque "
    "sin sobre su sus también te todo una uno y ya".split()
)
# Element names and the words that containers of boilerplate go by.
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr "
    "ul".split()
)
CONTAINERS = frozenset(
    "article aside blockquote body button details dialog div dl fieldset figure footer form header li main menu nav "
    "object ol p section select svg table td template tr ul canvas label datalist".split()
)
RAW = frozenset("iframe noembed noframes noscript script style textarea title xmp".split())
BOILERPLATE_TAGS = frozenset("aside button canvas datalist dialog footer label menu nav object select svg template".split())
MAIN_TAGS = frozenset(("article", "main"))
BOILERPLATE_WORDS = frozenset(
    "ad ads advert adverts advertisement adsense alert banner breadcrumb breadcrumbs byline captcha comment comments "
    "consent cookie cookies copyright disclaimer disqus footer footnav gdpr header login masthead menu menubar modal nav "
    "navbar navigation newsletter notice notices notification pager pagination popup promo promoted promotion recommended "
    "related reply replies respond search share sharing sidebar signup skip social sponsor sponsored subscribe tags "
    "teaser toolbar tooltip topbar widget widgets".split()
)

# Words of containers that are let off for nothing but a main heading.
REMARK_WORDS = frozenset("captcha comment comments consent cookie cookies disqus gdpr login modal popup replies reply respond".split())
NEARLY_ALL, MOST = 0.9, 0.5  # shares of the page's good text

_PLAIN_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*+)([^>"']*+)>""")
_NAME = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
_BARE = re.compile(r"""(?:[^>=]++|=(?!\s*+["']))*+""")
_QUOTE = re.compile(r"""=\s*+(["'])""")
_HINTING = re.compile(r"\b(?:class|id|role|hidden|style)\s*$", re.I)
_HINTS = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_HIDDEN = re.compile(r"""\bhidden\b(?!\s*=\s*["']?(?:false|until))|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.I)
_HINT_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
_WORD = re.compile(r"[^\W\d_]+")


@dataclass
class Block:
    text: str
    linked: int  # characters in links
    bad: bool  # by its container
    in_form: bool
    main: int  # number of its article, 0 outside any
    hinted: tuple[int, ...] = ()  # numbers of the containers around it that hints point at


@dataclass
class Hinted:
    """A container that its class, id or role points at."""

    remark: bool
    heading: bool = False  # holds a main heading


def _is_boilerplate(name: str, attributes: str, in_main: bool) -> bool:
    """By the element itself, or since it is not shown."""
    if name in BOILERPLATE_TAGS or name == "header" and not in_main:
        return True
    return bool(attributes) and name not in ("body", "html") and bool(_HIDDEN.search(attributes))


def _hint(name: str, attributes: str, in_main: bool) -> Hinted | None:
    if not attributes or name in ("body", "html") or name in MAIN_TAGS and not in_main:
        return None
    for found in _HINTS.finditer(attributes):
        before = ""
        for word in _HINT_WORD.findall(next(filter(None, found.groups()), "")):
            word = word.lower()
            if word in BOILERPLATE_WORDS and before not in ("has", "with", "no", "without") and not (in_main and word == "header"):
                return Hinted(word in REMARK_WORDS)
            before = word
    return None


def _attributes(source: str, at: int) -> tuple[str, int]:
    """Attributes from here to the tag's end, quoted values only of those that give hints, and where the tag ends.

    A quoted value ends at its closing quote, however far. If there is none, the tag ends at the next `>`; a tag that
    the page's end cuts off ends there.
    """
    parts = []
    while True:
        bare = _BARE.match(source, at).end()
        parts.append(source[at:bare])
        if bare == len(source):
            return "", bare
        if source[bare] == ">":
            return "".join(parts), bare + 1
        quote = _QUOTE.match(source, bare)
        close = source.find(quote[1], quote.end())
        if close < 0:
            end = source.find(">", quote.end())
            return "".join(parts), len(source) if end < 0 else end + 1
        parts.append(source[bare : close + 1] if _HINTING.search(parts[-1]) else '=""')
        at = close + 1


_NOTHING = ("", False, False, 0, ())


class _Page:
    """Blocks of one page, in order."""

    def __init__(self, source: str):
        self.blocks: list[Block] = []
        self.open: list[tuple[str, bool, bool, int, tuple[int, ...]]] = []  # name, bad, in a form, article, hinted
        self.hinted: list[Hinted] = []
        self.parts: list[str] = []
        self.linked = self.links = self.articles = self.breaks = 0
        self._read(source)
        self._end_block()
        self._weigh_hints()

    def _weigh_hints(self) -> None:
        """Blocks in a hinted container are bad, unless it turns out to wrap the page."""
        good = [len(block.text) if _alone(block, False) else 0 for block in self.blocks]
        held = [0] * len(self.hinted)
        for block, size in zip(self.blocks, good, strict=True):
            for number in block.hinted:
                held[number] += size
        whole = sum(good)
        bad = [
            not (whole and (one.heading and size >= MOST * whole or not one.remark and size >= NEARLY_ALL * whole))
            for one, size in zip(self.hinted, held, strict=True)
        ]
        for block in self.blocks:
            block.bad = block.bad or any(bad[number] for number in block.hinted)

    def _read(self, source: str) -> None:
        at, size = 0, len(source)
        while at < size:
            tag = source.find("<", at)
            if tag < 0:
                self._text(source[at:])
                return
            if tag > at:
                self._text(source[at:tag])
            after = source[tag + 1 : tag + 2]
            if source.startswith("<!--", tag):
                end = source.find("-->", tag + 2)
                at = size if end < 0 else end + 3
            elif after in ("!", "?"):
                end = source.find(">", tag)
                at = size if end < 0 else end + 1
            elif after == "/" or after.isalpha():
                at = self._tag(source, tag)
            else:
                self._text("<")
                at = tag + 1

    def _tag(self, source: str, tag: int) -> int:
        found = _PLAIN_TAG.match(source, tag)
        if found:
            attributes, at = found[3], found.end()
        else:
            found = _NAME.match(source, tag)
            if not found:  # a stray `</`
                end = source.find(">", tag)
                return len(source) if end < 0 else end + 1
            attributes, at = _attributes(source, found.end())
        closing, name = found[1] == "/", found[2].lower()
        if name in RAW and not closing:
            end = re.compile(f"</{name}[\\s/>]", re.I).search(source, at)
            if not end:
                return len(source)
            close = source.find(">", end.start())
            return len(source) if close < 0 else close + 1
        if name == "a":
            self.links = max(0, self.links - 1) if closing else 1
        elif name == "br":
            self.parts.append(" ")
            self.breaks += 1
            if self.breaks == 2:
                self._end_block()
            return at
        if name in BLOCKS or name in CONTAINERS:
            if name in BLOCKS:
                self._end_block()
                if name == "h1" and not closing and self.open and not self.open[-1][1]:
                    for number in self.open[-1][4]:
                        self.hinted[number].heading = True
                if name != "a":
                    self.links = 0
            if name in CONTAINERS:
                self._close(name) if closing else self._enter(name, attributes)
        return at

    def _enter(self, name: str, attributes: str) -> None:
        if name in ("p", "li", "td", "tr") and any(x[0] == name for x in self.open[-3:]):
            self._close(name)  # these end where the next of their kind begins
        _, bad, in_form, main, hinted = self.open[-1] if self.open else _NOTHING
        hint = _hint(name, attributes, main > 0)
        if name in MAIN_TAGS and not main and not bad:
            self.articles += 1
            main = self.articles
        bad = bad or _is_boilerplate(name, attributes, main > 0)
        if hint and not bad:
            hinted = (*hinted, len(self.hinted))
            self.hinted.append(hint)
        self.open.append((name, bad, in_form or name == "form", main, hinted))

    def _close(self, name: str) -> None:
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == name:
                del self.open[i:]
                return
            if name == "p" and self.open[i][0] != "p":
                return  # a paragraph does not end what it stands in

    def _text(self, text: str) -> None:
        if text and not text.isspace():
            self.breaks = 0
        self.parts.append(text)
        if self.links:
            self.linked += len(" ".join(html.unescape(text).split()))

    def _end_block(self) -> None:
        text = " ".join(html.unescape("".join(self.parts)).split())
        if text:
            _, bad, in_form, main, hinted = self.open[-1] if self.open else _NOTHING
            self.blocks.append(Block(text, self.linked, bad, in_form, main, hinted))
        self.parts, self.linked, self.breaks = [], 0, 0


def _alone(block: Block, forms_too: bool) -> bool | None:
    """First pass: True for good, False for bad, None for open."""
    length = len(block.text)
    if block.bad or block.in_form and not forms_too or block.linked > LINKED * length:
        return False
    if "©" in block.text and length < LONG:
        return False
    if length < SHORT:
        return False if block.linked else None
    found = _WORD.findall(block.text.lower())
    stops = sum(word in STOP_WORDS for word in found) / max(1, len(found))
    if stops >= STOPS_HIGH:
        return True if length > LONG else None
    return None if stops >= STOPS_LOW or block.main else False


def _labels(blocks: list[Block], forms_too: bool) -> list[bool]:
    """Second pass: open blocks take the label of the nearest decided block of their article (or outside any).

    Where both sides are as near and differ, and where nothing is decided, the article counts as good. Blocks that stand
    in a bad container are passed over as neighbours: they say nothing about what surrounds them.
    """
    first = [_alone(block, forms_too) for block in blocks]
    out = [bool(label) for label in first]
    groups: dict[int, list[int]] = {}
    for i, block in enumerate(blocks):
        if not block.bad:
            groups.setdefault(block.main, []).append(i)
    for main, places in groups.items():
        before: list[int | None] = []
        last = None
        for n, i in enumerate(places):
            before.append(last)
            last = n if first[i] is not None else last
        last = None
        for n in range(len(places) - 1, -1, -1):
            i, left = places[n], before[n]
            if first[i] is not None:
                last = n
                continue
            if left is None and last is None:
                out[i] = main > 0
            elif left is None or last is not None and last - n < n - left:
                out[i] = bool(first[places[last]])
            elif last is None or n - left < last - n:
                out[i] = bool(first[places[left]])
            else:
                ends = bool(first[places[left]]), bool(first[places[last]])
                out[i] = any(ends) if main else all(ends)
    return out


def main_text(source: str) -> str:
    """Good blocks in page order, joined by a line feed; a page that is all one form is read as if it were none."""
    blocks = _Page(source).blocks
    for forms_too in (False, True):
        good = [block.text for block, label in zip(blocks, _labels(blocks, forms_too), strict=True) if label]
        if good or not any(block.in_form for block in blocks):
            break
    return "\n".join(good)


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in pieces(batch, "html"):
            texts = [main_text(source.as_py() or "") for source in piece.column("html")]
            yield pa.RecordBatch.from_arrays(
                [piece.column("page_id"), piece.column("url"), pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )


def page_texts(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars (code points) of every page, from its whole html.

    A null or empty page, and one without main text, has an empty text. One row for each row in, repeated or not, in one
    pass without a shuffle; null ids and urls stay null. Other columns are left out. An empty table gives no rows.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html")
    return rows.mapInArrow(_extracted, "page_id long, url string, text string, n_chars long")
