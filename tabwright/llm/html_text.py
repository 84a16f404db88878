"""Visible text of HTML pages, laid out: blocks apart, lists marked and indented, table cells aligned.

A tokenizer feeds a tree builder that closes what the next tag implies (paragraphs, list items, cells and the like). A
renderer walks the tree, leaves out what is not shown, and lays out the rest: inline text is collapsed and joined, blocks
stand on lines of their own with blank lines around paragraphs, headings, lists and tables, list items carry a bullet or
their number, and the cells of a table are padded to their columns' widths, long ones folded.
"""

from __future__ import annotations

import html
import re
import textwrap
from collections.abc import Generator, Iterator
from dataclasses import dataclass, field
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwright.llm.shipping import ship

ROWS_AT_ONCE = 500
TEXT_AT_ONCE = 1 << 26  # characters of text after which a batch is sent
WIDEST = 200  # the most that a column of a table is padded to
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
UNSEEN = frozenset("head script style template noscript iframe object audio video canvas svg math datalist title noembed noframes".split())
BLOCK = frozenset("address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul".split())
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl table pre blockquote hr figure form fieldset article section".split())
# What a start tag ends: the open elements it closes, and the ones that such a search does not leave.
_PARAGRAPH_ENDS = BLOCK - frozenset("body dd dt html legend li optgroup option summary tbody td tfoot th thead tr".split())
_CELL = frozenset({"td", "th"})
_IN_TABLE = _CELL | {"table"}
_ROWS = frozenset({"thead", "tbody", "tfoot"})
_BEFORE_ROWS = frozenset({"caption", "colgroup"})
CLOSES = {
    "li": (frozenset({"li"}), frozenset({"ul", "ol", "menu", "table"})),
    "dt": (frozenset({"dt", "dd"}), frozenset({"dl", "table"})),
    "dd": (frozenset({"dt", "dd"}), frozenset({"dl", "table"})),
    "td": (_CELL | _BEFORE_ROWS, frozenset({"table", "tr"})),
    "th": (_CELL | _BEFORE_ROWS, frozenset({"table", "tr"})),
    "tr": (_CELL | {"tr"} | _BEFORE_ROWS, frozenset({"table"}) | _ROWS),
    "thead": (_CELL | {"tr"} | _BEFORE_ROWS | _ROWS, frozenset({"table"})),
    "tbody": (_CELL | {"tr"} | _BEFORE_ROWS | _ROWS, frozenset({"table"})),
    "tfoot": (_CELL | {"tr"} | _BEFORE_ROWS | _ROWS, frozenset({"table"})),
    "colgroup": (_BEFORE_ROWS, frozenset({"table"})),
    "option": (frozenset({"option"}), frozenset({"select", "datalist"})),
    "optgroup": (frozenset({"option", "optgroup"}), frozenset({"select"})),
    "body": (frozenset({"head"}), frozenset()),
}
_SCOPE = frozenset({"table", "td", "th", "caption", "html", "template", "button", "object"})
# Attributes as browsers cut them: a quote opens a value only behind "="; one that nothing closes holds the rest of the page.
# Nothing is tried twice, so time is linear.
_VALUE = r"(?:\"([^\"]*+)(?:\"|\Z)|'([^']*+)(?:'|\Z)|([^\s>\"'][^\s>]*+))"
_ONE = r"([^\s/>][^\s/>=]*+)(?:\s*+=\s*+" + _VALUE + r"?+)?+"
_ATTRIBUTE = re.compile(_ONE, re.S)
_ALL = r"(?:[\s/]++|" + re.sub(r"(?<!\\)\((?!\?)", "(?:", _ONE) + r")*+"
_TAG = re.compile(r"<(?:!--(?:>|->|.*?(?:--!?>|\Z))|[!?][^>]*(?:>|\Z)|(/?)([A-Za-z][^\s/>]*+)(" + _ALL + r")(?:>|\Z))", re.S)
_BLANKS = re.compile(r"[ \t\n\r\f]+")
_NOT_SHOWN = re.compile(r"(?:^|;)\s*display\s*:\s*none\b", re.I)
_VISIBILITY = re.compile(r"(?:^|;)\s*visibility\s*:\s*(\w+)", re.I)


@dataclass
class Element:
    name: str
    attributes: dict[str, str] = field(default_factory=dict)
    children: list = field(default_factory=list)

Step = Generator["Step", list[str] | None, list[str] | None]


def parse(page: str) -> Element:
    """The tree of a page, or of any text; end tags without a start are dropped, open elements end with the page."""
    root = Element("#root")
    stack = [root]
    places: dict[str, list[int]] = {}  # where in the stack the open elements of a name are

    def text(piece: str) -> None:
        if piece:
            stack[-1].children.append(html.unescape(piece) if "&" in piece else piece)

    def highest(names: frozenset) -> int:
        return max((places[n][-1] for n in names if places.get(n)), default=0)

    def cut(depth: int) -> None:
        while len(stack) > depth:
            places[stack.pop().name].pop()

    def close_implied(closed: frozenset, kept: frozenset) -> None:
        while (top := highest(closed)) and top > highest(kept):
            cut(top)
            if stack[-1].name not in closed:
                return

    at = 0
    while True:
        found = _TAG.search(page, at)
        if not found:
            text(page[at:])
            return root
        text(page[at : found.start()])
        at = found.end()
        end, name = found.group(1), (found.group(2) or "").lower()
        if not name:
            continue
        if end:
            if name == "p" and not places.get("p"):
                stack[-1].children.append(Element("p"))
            top = places[name][-1] if places.get(name) else 0
            if top and (name in ("table", "body", "html") or top >= highest(_IN_TABLE)):
                cut(top)
            continue
        if name in _PARAGRAPH_ENDS:
            close_implied(frozenset({"p"}), _SCOPE)
        if name in CLOSES:
            close_implied(*CLOSES[name])
        if name in BLOCK and name != "html":
            close_implied(frozenset({"head"}), frozenset())
        raw = found.group(3)
        attributes: dict[str, str] = {}
        for m in _ATTRIBUTE.finditer(raw):
            attributes.setdefault(m[1].lower(), html.unescape(m[2] or m[3] or m[4] or ""))  # the first of a name counts
        element = Element(name, attributes)
        stack[-1].children.append(element)
        if name in RAW:
            stop = re.compile(f"</{re.escape(name)}(?=[\\s/>])", re.I).search(page, at)
            inner = page[at : stop.start()] if stop else page[at:]
            element.children.append(html.unescape(inner) if name in ("textarea", "title") else inner)
            past = page.find(">", stop.end()) if stop else -1
            at = past + 1 if past >= 0 else len(page)
        elif name not in VOID:
            places.setdefault(name, []).append(len(stack))
            stack.append(element)


def _settle_visibility(root: Element) -> None:
    """Take out what is invisible: the text and the empty elements under ``visibility: hidden``, up to descendants that
    are made visible again."""
    order, open_ = [], [(root, False)]
    while open_:
        e, hidden = open_.pop()
        said = _VISIBILITY.findall(e.attributes.get("style", "")) if e.attributes else ()
        hidden = said[-1].lower() in ("hidden", "collapse") if said else hidden
        order.append((e, hidden))
        open_ += [(c, hidden) for c in e.children if not isinstance(c, str)]
    gone: set[int] = set()
    for e, hidden in reversed(order):
        e.children = [c for c in e.children if (not hidden if isinstance(c, str) else id(c) not in gone)]
        if hidden and not e.children:
            gone.add(id(e))


def _unseen(e: Element) -> bool:
    if e.name in UNSEEN or "hidden" in e.attributes or (e.name == "dialog" and "open" not in e.attributes):
        return True
    if e.name == "input" and e.attributes.get("type", "").lower() == "hidden":
        return True
    return bool(e.attributes) and _NOT_SHOWN.search(e.attributes.get("style", "")) is not None


class _Layout:
    """Lines so far, the line that is being filled, and whether a blank line is due."""

    def __init__(self, kept: bool = False):
        self.lines: list[str] = []
        self.line: list[str] = []
        self.kept = kept  # white space as it stands

    def text(self, piece: str) -> None:
        if self.kept:
            first, *more = piece.replace("\r\n", "\n").split("\n")
            self.line.append(first)
            for x in more:
                self.end(always=True)
                self.line.append(x)
            return
        piece = _BLANKS.sub(" ", piece)
        if piece[:1] == " " and (not self.line or self.line[-1][-1:] in (" ", "")):
            piece = piece[1:]
        if piece:
            self.line.append(piece)

    def end(self, always: bool = False) -> None:
        line = "".join(self.line)
        self.line = []
        line = line if self.kept else line.strip(" ")
        if line or always:
            self.lines.append(line)

    def gap(self) -> None:
        self.end()
        if self.lines and self.lines[-1]:
            self.lines.append("")

    def put(self, lines: list[str]) -> None:
        self.end()
        for x in lines:
            if x or (self.lines and self.lines[-1]):
                self.lines.append(x)


def _finished(step: Step) -> list[str]:
    """What a step returns, run with a stack of its own: a step yields the steps it needs, so no depth is too deep."""
    stack, value = [step], None
    while stack:
        try:
            stack.append(stack[-1].send(value))
            value = None
        except StopIteration as done:
            stack.pop()
            value = done.value
    return value


def _block_lines(e: Element, kept: bool = False) -> Step:
    layout = _Layout(kept)
    yield _render_children(e, layout)
    layout.end()
    while layout.lines and not layout.lines[-1]:
        layout.lines.pop()
    while layout.lines and not layout.lines[0]:
        del layout.lines[0]
    return layout.lines


def _render_children(e: Element, layout: _Layout) -> Step:
    for child in e.children:
        if isinstance(child, str):
            layout.text(child)
        elif not _unseen(child):
            yield _render(child, layout)


def _render(e: Element, layout: _Layout) -> Step:
    name = e.name
    if name == "br":
        layout.end(always=True)
    elif name == "img":
        layout.text(e.attributes.get("alt", ""))
    elif name == "input":
        layout.text(e.attributes.get("value", "") if e.attributes.get("type", "text").lower() in ("button", "submit", "reset", "text") else "")
    elif name == "table":
        layout.gap()
        layout.put((yield _table_lines(e)))
        layout.gap()
    elif name in ("ul", "ol", "menu"):
        layout.gap() if name != "menu" else layout.end()
        layout.put((yield _list_lines(e)))
        layout.gap()
    elif name == "pre" or name == "textarea":
        layout.gap()
        inner = Element(e.name, {}, list(e.children))
        if inner.children and isinstance(inner.children[0], str):
            inner.children[0] = inner.children[0].removeprefix("\n")
        layout.lines += yield _block_lines(inner, kept=True)
        layout.gap()
    elif name == "details" and "open" not in e.attributes:  # closed: its summary is all there is to see
        layout.end()
        summary = next((c for c in e.children if not isinstance(c, str) and c.name == "summary"), None)
        if summary and not _unseen(summary):
            yield _render(summary, layout)
        layout.end()
    elif name == "dd" or name == "blockquote":
        layout.gap() if name in SPACED else layout.end()
        layout.put(["  " + x if x else x for x in (yield _block_lines(e))])
        layout.gap() if name in SPACED else layout.end()
    elif name in BLOCK:
        layout.gap() if name in SPACED else layout.end()
        yield _render_children(e, layout)
        layout.gap() if name in SPACED else layout.end()
    else:
        yield _render_children(e, layout)


def _number(text: str | None, default: int) -> int:
    try:
        return int(text or "")
    except ValueError:
        return default


def _list_lines(e: Element) -> Step:
    out: list[str] = []
    number = _number(e.attributes.get("start"), 1)
    for child in e.children:
        if isinstance(child, str):
            if child.strip(" \t\n\r\f"):
                out.append(_BLANKS.sub(" ", child).strip(" "))
            continue
        if _unseen(child):
            continue
        lines = [x for x in (yield _block_lines(child if child.name == "li" else Element("#any", {}, [child]))) if x]
        if child.name != "li":
            out += ["  " + x for x in lines]
            continue
        if e.name == "ol":
            number = _number(child.attributes.get("value"), number)
            mark, number = f"{number}. ", number + 1
        else:
            mark = "- "
        out.append((mark + (lines[0] if lines else "")).rstrip(" "))
        out += [" " * len(mark) + x for x in lines[1:]]
    return out


def _rows_of(e: Element) -> Iterator[tuple[Element, Element]]:
    """What stands in a table, each with the row group, or the table, that a rowspan cannot leave."""
    for child in e.children:
        if isinstance(child, str) or _unseen(child):
            continue
        if child.name in _ROWS:
            yield from _rows_of(child)
        else:
            yield e, child


def _folded(line: str) -> list[str]:
    """A line in pieces of at most ``WIDEST``, cut at blanks only; columns and kept white space stay as they are."""
    text = line.lstrip(" ")
    indent = line[: len(line) - len(text)]
    if len(line) <= WIDEST or "  " in text or "\t" in text:
        return [line]
    return [indent + x for x in textwrap.wrap(text, max(WIDEST - len(indent), WIDEST // 2), break_long_words=False, break_on_hyphens=False)]


def _table_lines(e: Element) -> Step:
    """Cells start where their column starts, whatever the table's size.

    A cell with another to its right is folded at ``WIDEST``; a line that cannot be folded has the rest of its physical
    line to itself, and the cells to its right go on below it. So a column is never padded beyond ``WIDEST``. Cells that
    span rows or columns hold their places; a column in which no cell starts takes no room.
    """
    out: list[str] = []
    rows: list[dict[int, list[str]]] = []  # a row's cells by the column they start in
    group, reaching = None, []  # cells of earlier rows: first column, column past them, row past them
    for within, row in _rows_of(e):
        if row.name != "tr":  # a caption, or what stands in a table without a row
            out += yield _block_lines(Element("#any", {}, [row]))
            continue
        if within is not group:
            group, reaching = within, []
        reaching = [x for x in reaching if x[2] > len(rows)]
        cells: dict[int, list[str]] = {}
        column = passed = 0
        further = []
        for cell in row.children:
            across = down = 1
            if isinstance(cell, str):
                lines = [_BLANKS.sub(" ", cell).strip(" ")]
                if not lines[0]:
                    continue
            elif _unseen(cell):
                continue
            else:
                lines = [x for x in (yield _block_lines(cell)) if x]
                across = max(1, _number(cell.attributes.get("colspan"), 1))
                down = _number(cell.attributes.get("rowspan"), 1)
            while passed < len(reaching) and reaching[passed][0] <= column:
                column = max(column, reaching[passed][1])
                passed += 1
            cells[column] = lines
            if down > 1 or down == 0:  # 0: to the end of the row group
                further.append((column, column + across, len(rows) + down if down else float("inf")))
            column += across
        if further:
            reaching = sorted(reaching + further)
        rows.append(cells)
    place = {c: k for k, c in enumerate(sorted({c for cells in rows for c in cells}))}
    widths = [0] * len(place)
    for cells in rows:
        last = max((c for c, lines in cells.items() if lines), default=0)
        for c, lines in cells.items():
            if c < last:
                cells[c] = lines = [x for line in lines for x in _folded(line)]
            widths[place[c]] = max(widths[place[c]], *(len(x) for x in lines if len(x) <= WIDEST), 0)
    starts = [0, *accumulate(w + 2 for w in widths)]
    for cells in rows:
        physical: list[list[tuple[int, str]]] = []
        taken: set[int] = set()  # physical lines that a line too wide for its column has to itself
        for c, lines in cells.items():
            k, at, wide = place[c], 0, []
            for x in lines:
                while at in taken:
                    at += 1
                while len(physical) <= at:
                    physical.append([])
                physical[at].append((starts[k], x))
                if len(x) > widths[k]:
                    wide.append(at)
                at += 1
            taken.update(wide)
        for pieces in physical:
            line = ""
            for start, x in pieces:
                line = line.ljust(start) + x
            if line.strip(" "):
                out.append(line.rstrip(" "))
    return out


def visible_text(page: str) -> str:
    """The page's visible text, laid out."""
    root = parse(page)
    if "visibility" in page.lower():
        _settle_visibility(root)
    return "\n".join(_finished(_block_lines(root)))


def extract(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """``(page_id, text)`` for every row.

    A null or empty page has the text "". Broken markup never fails: unknown or unclosed tags end with the page, stray end
    tags are dropped; elements nest as deep as the page has them, in time that grows with its length. Null ids pass through;
    repeated rows come out repeated; other columns are not read; an empty table gives no rows.
    """
    ship(pages.sparkSession)
    plain = pages.select(F.col(id_col).alias("page_id"), F.col(html_col).alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(at, ROWS_AT_ONCE)
                texts, held, sent = [], 0, 0
                for i, page in enumerate(part.column("html")):
                    texts.append(visible_text(page.as_py() or ""))
                    held += len(texts[-1])
                    if held >= TEXT_AT_ONCE or i == part.num_rows - 1:
                        yield pa.RecordBatch.from_arrays([part.column("page_id").slice(sent, len(texts)), pa.array(texts, pa.string())], ["page_id", "text"])
                        texts, held, sent = [], 0, i + 1

    return plain.mapInArrow(run, T.StructType([plain.schema["page_id"], T.StructField("text", T.StringType())]))
