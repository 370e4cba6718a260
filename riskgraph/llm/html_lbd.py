"""Main text of web pages by line-block distribution.

1. Strip markup: a page becomes lines, one for each block element's own text
   (character references decoded, white space inside it one space). Scripts,
   styles and other unseen elements go; so do elements that by tag, role, class
   or id are menus, headers, footers, sidebars, notices, adverts, forms or
   reader comments. What goes leaves ``WINDOW`` blank lines, the edges of
   layout elements (div, table, list, ...) leave one each, and a line that is
   mostly links counts as blank.
2. Sum text lengths over windows of ``WINDOW`` lines. A *surge* is where the
   sum rises from zero, a *dive* where it is back at zero.
3. Keep the text between a surge and its dive if the sum climbs above
   ``PEAK`` in between, or above half of the page's highest sum on short pages.

On a page whose ``article`` or ``main`` elements hold at least one in ``MAIN_SHARE``
characters of its lines' text (a teaser's stub does not), lines outside them count as blank, and inside them neither layout edges nor removed elements
leave blank lines, so an article is one stretch.

Blocks of the text are joined by two line feeds, in page order, uncapped.

Defined cases: null or empty html gives an empty text; unclosed elements end
with their parent or the page; an unclosed comment, script or style hides the
rest; rows that repeat a page_id each get a row; an empty table gives an empty
result; extra columns are ignored; pages of any length are read whole.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from riskgraph.llm.common import strings

WINDOW = 3
PEAK = 86
MAIN_SHARE = 8

_PIECE = re.compile(
    r"<!--.*?(?:--!?>|\Z)"
    r"|<!\[CDATA\[.*?(?:\]\]>|\Z)"
    r"|<[!?][^>]*>?"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*'|[\"'])*?)(?:>|\Z)", re.S)
_ATTR = re.compile(r"([a-zA-Z_:][-\w:.]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+)))?")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe xmp noembed noframes".split())
#: Searched in the page itself: a lower-cased copy can be longer (U+0130).
_RAW_END = {tag: re.compile(f"</{tag}", re.I | re.A) for tag in RAW}
UNSEEN = RAW | frozenset("head svg math object canvas audio video map select option button datalist dialog".split())
BOILERPLATE = frozenset("nav footer aside form menu fieldset".split())
LAYOUT = frozenset("""html body div section table thead tbody tfoot tr ul ol dl main article header footer nav aside form
fieldset center frameset menu details""".split())
LINE = LAYOUT | frozenset("""p h1 h2 h3 h4 h5 h6 li dt dd td th caption blockquote pre figure figcaption address hr
summary hgroup legend""".split())
#: These close an open element of the same kind (within their layout element).
AUTO = {"p": {"p"}, "li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "tr": {"tr", "td", "th", "p"},
        "td": {"td", "th", "p"}, "th": {"td", "th", "p"}}
MAIN = frozenset(("article", "main"))
ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog menu menubar toolbar".split())
NAMES = frozenset("""ad ads adv advert adverts advertisement advertisements adsense banner sponsor sponsors sponsored promo
promos promotion sidebar sidebars aside rail nav navbar navigation navi menu menus submenu breadcrumb breadcrumbs pagination
pager footer masthead topbar toolbar comment comments commentlist disqus reply replies respond discussion cookie cookies
consent gdpr notice notices notification notifications alert popup modal overlay newsletter subscribe subscription signup
login share sharing social related recommended recommendations widget widgets copyright skip""".split())
_WORDS = re.compile(r"[a-z]+|[A-Z][a-z]*")


#: A class such as "has-sidebar" names what the element around it has.
NOT_OWN = frozenset("has with no without".split())
#: A class of its own that says that an element is the text, whatever the others say.
OWN = frozenset("entry hentry article story".split())


def _is_boilerplate(tag: str, attrs: str, inside_main: bool, by_name: bool) -> bool:
    if tag in BOILERPLATE or (tag == "header" and not inside_main):
        return True
    if not attrs or tag in ("html", "body"):
        return False
    for m in _ATTR.finditer(attrs):
        name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if name in ("class", "id"):
            words = {w.lower() for w in _WORDS.findall(value)}
            if by_name and tag not in MAIN and not words & NOT_OWN and not OWN & set(value.lower().split()) and (words & NAMES or ("header" in words and not inside_main)):
                return True
        elif name == "role" and tag not in MAIN and value.strip().lower() in ROLES:
            return True
        elif name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            return True
        elif name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return True
    return False


class _Lines:
    """Lines of a page: (text, counted length, inside article or main)."""

    def __init__(self) -> None:
        self.lines: list[tuple[str, int, bool]] = []
        self.parts: list[str] = []
        self.link = 0

    def end(self, blanks: int, main: bool) -> None:
        if self.parts:
            text = " ".join("".join(self.parts).split())
            if text:
                self.lines.append((text, 0 if 2 * self.link > len(text) else len(text), main))
            self.parts, self.link = [], 0
        if not main:
            self.lines += [("", 0, False)] * blanks


class _Open:
    """The open elements, (tag, dropped since here, main since here, link) each,
    and where each tag stands among them, so that no step walks over them all."""

    def __init__(self) -> None:
        self.stack: list[tuple[str, bool, bool, bool]] = []
        self.where: dict[str, list[int]] = {}
        self.layout: list[int] = [-1]           # of layout elements
        self.not_row: list[int] = [-1]          # of those other than tr

    def push(self, element: tuple[str, bool, bool, bool]) -> None:
        tag, k = element[0], len(self.stack)
        self.where.setdefault(tag, []).append(k)
        if tag in LAYOUT:
            self.layout.append(k)
            if tag != "tr":
                self.not_row.append(k)
        self.stack.append(element)

    def last(self, *tags: str) -> int:
        """The innermost open element of the tags, -1 if there is none."""
        return max((self.where[t][-1] for t in tags if self.where.get(t)), default=-1)

    def cut(self, k: int) -> list[str]:
        """Takes the elements from number ``k`` on away; their tags."""
        gone = [s[0] for s in self.stack[k:]]
        for tag in gone:
            self.where[tag].pop()
            if tag in LAYOUT:
                self.layout.pop()
                if tag != "tr":
                    self.not_row.pop()
        del self.stack[k:]
        return gone


def page_lines(page: str, by_name: bool = True) -> list[tuple[str, int, bool]]:
    out, opened = _Lines(), _Open()
    stack = opened.stack
    at = 0

    def state() -> tuple:
        return stack[-1] if stack else ("", False, False, False)

    def text(a: int, z: int) -> None:
        _, dropped, _, link = state()
        if a < z and not dropped:
            said = html.unescape(page[a:z])
            out.parts.append(said)
            if link:
                out.link += len(" ".join(said.split()))

    def close(k: int) -> None:
        """Close the open elements from number ``k`` on."""
        main = stack[k][2]
        parent_dropped = k > 0 and stack[k - 1][1]
        gone = stack[k][1] and not parent_dropped
        layout = stack[k][0] in LAYOUT
        if any(tag in LINE for tag in opened.cut(k)) and not parent_dropped:
            out.end(WINDOW if gone else int(layout), main)

    while (m := _PIECE.search(page, at)) is not None:
        text(at, m.start())
        at = m.end()
        if not m[2]:
            continue
        tag = m[2].lower()
        if m[1]:
            k, edge = opened.last(tag), -1 if tag in LAYOUT else opened.last(*MAIN, "td", "th")
            if k >= 0 and k >= edge:
                close(k)
            elif k < 0 and edge < 0 and tag in LINE and not state()[1]:
                out.end(0, state()[2])
            continue
        if tag == "br":
            if not state()[1]:
                out.parts.append(" ")
            continue
        if tag in RAW:                  # its content is no markup
            ends = _RAW_END[tag].search(page, at)
            end = ends.start() if ends else -1
            at = len(page) if end < 0 else end
            if not m[0].endswith("/>") or end >= 0:
                close_at = page.find(">", at)
                at = len(page) if end < 0 or close_at < 0 else close_at + 1
            continue
        for other in AUTO.get(tag, ()):
            k = opened.last(other)
            if k > (opened.not_row if tag == "tr" else opened.layout)[-1]:
                close(k)
        if tag in LINE and tag != "p" and opened.last("p") > opened.layout[-1]:     # a block ends an open paragraph
            close(opened.last("p"))
        _, dropped, main, link = state()
        gone = not dropped and (tag in UNSEEN or _is_boilerplate(tag, m[3], main, by_name))
        main = main or (tag in MAIN and not dropped and not gone)
        if tag in LINE and not dropped:
            out.end(WINDOW if gone else int(tag in LAYOUT), main or state()[2])
        if tag not in VOID and not m[0].endswith("/>"):
            opened.push((tag, dropped or gone, main, link or tag == "a"))
    text(at, len(page))
    out.end(0, state()[2])
    return out.lines


def main_text(page: str | None, window: int = WINDOW, peak: int = PEAK) -> str:
    """The kept text; where names of classes and ids would take away all of
    it (a page-wide wrapper may bear any name), they are not asked."""
    return _kept(page_lines(page or ""), window, peak) or _kept(page_lines(page or "", False), window, peak)


def _kept(lines: list[tuple[str, int, bool]], window: int, peak: int) -> str:
    counted = sum(n for _, n, _ in lines)
    if 0 < counted <= MAIN_SHARE * sum(len(text) for text, _, main in lines if main):
        lines = [(text, len(text), True) if main else ("", 0, False) for text, _, main in lines]
    length = np.array([n for _, n, _ in lines], np.int64)
    if not length.any():
        return ""
    sums = np.convolve(length, np.ones(window, np.int64))       # sums[i]: lines i-window+1 .. i
    need = min(peak, int(sums.max()) / 2)
    kept, a = [], None
    for i, s in enumerate([*sums.tolist(), 0]):
        if s and a is None:
            a = i                                               # surge
        elif not s and a is not None:                           # dive
            if sums[a:i].max() > need:
                kept += [text for text, n, _ in lines[a:i] if n]
            a = None
    return "\n\n".join(kept)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for a in range(0, b.num_rows, 500):
            part = b.slice(a, 500)
            texts = [main_text(p).encode("utf-8", "replace").decode() for p in strings(part.column("html"))]
            yield pa.RecordBatch.from_arrays(
                [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame) -> DataFrame:
    """``(page_id, url, text, n_chars)`` for every row of ``pages``."""
    kind = pages.schema["page_id"].dataType.simpleString()
    return pages.select("page_id", "url", "html").mapInArrow(
        _extract, f"page_id {kind}, url string, text string, n_chars long")
