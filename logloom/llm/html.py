"""Text of web pages, laid out as a browser would show it.

A tree builder closes what tags imply (a paragraph before a block, an item before
the next, cells and rows of a table), so start and end events nest. What a
browser doesn't show is left out: hidden elements, a closed ``dialog``, a closed
``details`` but for its summary, the ``hidden`` attribute and inline styles, where
``visibility`` is inherited and may be turned on again inside. All other text is
kept, that of drawings, formulas and choices, too. White space collapses except in preformatted text, blocks
stand on lines of their own, list items carry their mark and depth, and cells of
a table are padded to columns (of up to ``WIDEST`` characters; a longer cell is
printed whole and only its own row loses alignment).

Null or empty pages give an empty text; null keys and repeated rows are kept; an
empty table gives an empty result. The work is linear in the page, and no depth
of nesting is too deep.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame

WIDEST = 48

VOID = set("area base br col embed hr img input link meta source track wbr".split())
HIDDEN = set("head script style template noscript title datalist object iframe audio video canvas defs desc metadata annotation".split())
SPACED = set("p h1 h2 h3 h4 h5 h6 ul ol dl table blockquote pre figure fieldset hr".split())
BLOCKS = SPACED | set(
    "address article aside body center details dialog dd div dt footer form header html legend li main nav section summary tr td th caption figcaption".split()
)
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SECTIONS = {"thead", "tbody", "tfoot"}
SCOPES = {"li": {"ul", "ol"}, "dt": {"dl"}, "dd": {"dl"}, "option": {"select"}}
CELLS = {"table"}
UNSEEN = re.compile(r"(?:^|;)\s*display\s*:\s*none", re.I)
VEILED = re.compile(r"(?:^|;)\s*visibility\s*:\s*(hidden|collapse|visible)", re.I)
SPACE = re.compile(r"[ \t\n\r\f]+")


class _Box:
    """Lines of a block context: the page, or one cell."""

    def __init__(self):
        self.lines, self.line, self.gap, self.space, self.prefix = [], [], 0, False, ""

    def text(self, text: str) -> None:
        self.flush_gap()
        self.line.append(text)

    def flush_gap(self) -> None:
        if self.gap and self.lines:
            self.lines.extend([""] * (self.gap - 1))
        self.gap = 0

    def end(self, blank: bool = False) -> None:
        if self.line:
            self.lines.append("".join(self.line).rstrip(" "))
            self.line = []
            self.gap = 1
        self.space = False
        if blank and self.lines:
            self.gap = 2

    def add(self, lines: list[str]) -> None:
        self.end(True)
        self.flush_gap()
        self.lines.extend(lines)
        self.gap = 2


class _Renderer(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack, self.places, self.hidden, self.veiled, self.pre = [], {}, 0, False, 0
        self.boxes, self.tables, self.lists = [_Box()], [], []

    # tree building

    def _close_to(self, depth: int) -> None:
        while len(self.stack) > depth:
            self._leave(*self.stack.pop())

    def _last(self, tags) -> int:
        return max((at[-1] for t in tags if (at := self.places.get(t))), default=-1)

    def _innermost(self, tags, stop) -> int:
        """Where the innermost of ``tags`` is open, if none of ``stop`` is within it."""
        at = self._last(tags)
        return at if at > self._last(stop) or at >= 0 and self.stack[at][0] in stop and at == self._last(stop) else -1

    def handle_starttag(self, tag, attrs):
        if tag == "body" or (tag in BLOCKS and tag != "html"):
            at = self._innermost({"head"}, set())
            if at >= 0:
                self._close_to(at)
        if tag in BLOCKS and tag not in ("td", "th", "tr"):
            at = self._innermost({"p"}, {"td", "th", "table", "div", "li"})
            if at >= 0:
                self._close_to(at)
        closes = CLOSES.get(tag, SECTIONS | {"tr", "td", "th"} if tag in SECTIONS else None)
        while closes and (at := self._innermost(closes, SCOPES.get(tag, CELLS))) >= 0:
            self._close_to(at)
        if tag in ("td", "th") and self.tables and self._innermost({"tr"}, CELLS) < 0:
            self.handle_starttag("tr", [])
        if tag in VOID:
            if not self.hidden:
                if tag == "br":
                    box = self.boxes[-1]
                    if box.line:
                        box.end()
                    else:
                        box.gap = min(box.gap + 1, 2) if box.lines else 0
                elif tag == "hr":
                    self.boxes[-1].end(True)
            return
        given = dict(attrs)
        style = given.get("style") or ""
        unseen = int(tag in HIDDEN or "hidden" in given or bool(UNSEEN.search(style)))
        if tag == "dialog" and "open" not in given:
            unseen = 1
        if tag == "summary" and not unseen and self.stack and self.stack[-1][3]:
            unseen = -1  # the summary of a closed details is shown
        closed = tag == "details" and "open" not in given
        self.stack.append((tag, unseen, self.veiled, closed))
        for name in (tag, "#block") if tag in BLOCKS else (tag,):
            self.places.setdefault(name, []).append(len(self.stack) - 1)
        veiled = VEILED.findall(style)
        if veiled:
            self.veiled = veiled[-1].lower() != "visible"
        self.hidden += unseen
        if not self.hidden:
            self._enter(tag, given)
        self.hidden += closed

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        if tag == "br":
            return self.handle_starttag("br", [])
        stop = CELLS if tag not in ("table", "body", "html") else set()
        if tag not in BLOCKS:  # an inline end does not close blocks
            stop = ("#block",)
        at = self._innermost({tag}, stop)
        if at >= 0:
            self._close_to(at)

    # rendering

    def _enter(self, tag, given):
        box = self.boxes[-1]
        if tag == "table":
            box.end(True)
            self.tables.append([])
        elif tag == "tr" and self.tables:
            self.tables[-1].append([])
        elif tag in ("td", "th") and self.tables:
            self.boxes.append(_Box())
        elif tag in BLOCKS:
            box.end(tag in SPACED and not (tag in ("ul", "ol") and self.lists))
            if tag in ("ul", "ol"):
                start = given.get("start") or ""
                self.lists.append([tag, int(start) if start.isdecimal() else 1])
            elif tag == "li":
                kind = self.lists[-1] if self.lists else ["ul", 1]
                mark = f"{kind[1]}. " if kind[0] == "ol" else "- "
                kind[1] += 1
                if not self.veiled:
                    box.text("  " * min(max(len(self.lists) - 1, 0), 8) + mark)
            elif tag == "pre":
                self.pre += 1

    def _leave(self, tag, unseen, veiled, closed):
        for name in (tag, "#block") if tag in BLOCKS else (tag,):
            self.places[name].pop()
        self.hidden -= closed
        shown = not self.hidden
        self.hidden -= unseen
        self.veiled = veiled
        if not shown:
            return
        box = self.boxes[-1]
        if tag in ("td", "th") and self.tables and len(self.boxes) > 1:
            box.end()
            self.boxes.pop()
            if not self.tables[-1]:
                self.tables[-1].append([])
            self.tables[-1][-1].append(box.lines)
        elif tag == "table" and self.tables:
            lines = _grid(self.tables.pop())
            if lines:
                box.add(lines)
        elif tag in BLOCKS:
            box.end(tag in SPACED and not (tag in ("ul", "ol") and len(self.lists) > 1))
            if tag in ("ul", "ol") and self.lists:
                self.lists.pop()
            elif tag == "pre":
                self.pre -= 1

    def handle_data(self, data):
        if self.hidden or self.veiled:
            return
        box = self.boxes[-1]
        if self.pre:
            for n, line in enumerate(data.split("\n")):
                if n:
                    if box.line:
                        box.end()
                    else:
                        box.gap = max(box.gap, 1)
                if line:
                    box.text(line)
            return
        for n, word in enumerate(SPACE.split(data)):
            if n:
                box.space = True
            if word:
                if box.space and box.line and not box.line[-1].endswith(" "):
                    box.text(" ")
                box.text(word)
                box.space = False


def _grid(rows: list) -> list[str]:
    widths = {}
    for row in rows:
        for n, cell in enumerate(row):
            widths[n] = max(widths.get(n, 0), max((len(x) for x in cell if len(x) <= WIDEST), default=0))
    out = []
    for row in rows:
        for k in range(max((len(cell) for cell in row), default=0)):
            line = [(cell[k] if k < len(cell) else "").ljust(widths[n]) for n, cell in enumerate(row)]
            out.append("  ".join(line).rstrip(" "))
    return out


def page_text(html: str | None) -> str:
    page = _Renderer()
    page.feed(html or "")
    page.close()
    page._close_to(0)
    page.boxes[0].end()
    return "\n".join(page.boxes[0].lines)


def _texts(batches: Iterator[pa.RecordBatch]):
    for batch in batches:
        texts = [page_text(x.as_py()) for x in batch["html"]]
        yield pa.RecordBatch.from_arrays([batch["page_id"], pa.array(texts, pa.string())], ["page_id", "text"])


def extract_text(pages: DataFrame) -> DataFrame:
    """(page_id, text), one row per row of ``pages`` (page_id, html)."""
    rows = pages.selectExpr("CAST(page_id AS BIGINT) AS page_id", "CAST(html AS STRING) AS html")
    return rows.mapInArrow(_texts, "page_id bigint, text string")
