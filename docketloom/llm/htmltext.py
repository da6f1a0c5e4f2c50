"""Layout-aware text of HTML pages.

A tokenizer splits markup from text; a tree builder puts in what the markup implies (ends of paragraphs, items, rows and
cells, table sections' ends, void elements) and closes what is open when an outer end tag comes; visibility rules leave out
what a browser wouldn't show; a renderer lays the rest out: blocks on lines of their own with blank lines around paragraphs,
headings and lists, list items with bullets or numbers and an indent for each level, preformatted text as it stands, and
table cells padded to their columns, with cells that span several. All visible text is emitted, whatever its density; formulas
and the texts of drawings too. The padding of a page's tables and the indents of its lines are together at most ``PADDING``
characters for each one of its HTML (and 4096); a table beyond that has its cells unpadded, those of several lines below one
another, and lines beyond that stand without indent. A span of a cell is clipped to the columns in which some cell of its table
starts, so tables cost as much as their cells, whatever spans they state.

Hidden: the head, scripts, styles, templates, fallback content of media and frames, ``hidden`` attributes, ``display:none`` and
``visibility:hidden`` in style attributes, closed ``details`` but for the summary, closed dialogs, hidden inputs, comments;
of drawings what isn't in a ``text`` or ``foreignObject``, of formulas their annotations.

Defined cases: null and empty pages give an empty text and title; text without markup is one block; broken markup never fails,
an unclosed comment or tag runs to the end; nesting beyond ``DEPTH`` becomes siblings there, as in browsers; repeated rows are
rendered each. Extra columns pass through :func:`extract`; ``title`` and ``text`` are replaced if they exist.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from html import unescape
from itertools import accumulate

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import unused

DEPTH = 200
PADDING = 2
#: Element classes of the HTML standard. Fixed values.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noembed noframes iframe".split())
HIDDEN = frozenset("head script style template title noscript iframe object audio video canvas datalist noembed noframes map param rp annotation annotation-xml desc metadata defs symbol clippath mask".split())
BLOCK = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li listing main menu nav ol optgroup option p pre section summary table caption ul xmp".split())
SPACED = frozenset("blockquote dl fieldset figure h1 h2 h3 h4 h5 h6 hr listing menu ol p pre table ul dir xmp".split())
ENDS_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul dd dt li listing summary".split())
#: What an opening tag ends, and the elements that it can't reach beyond.
ENDS = {
    "li": (("li",), ("ul", "ol", "menu", "dir", "table")),
    "dt": (("dt", "dd"), ("dl", "table")),
    "dd": (("dt", "dd"), ("dl", "table")),
    "option": (("option",), ("select", "datalist")),
    "optgroup": (("option", "optgroup"), ("select",)),
    "tr": (("tr", "td", "th", "caption"), ("table",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "tbody": (("tr", "td", "th", "thead", "tbody", "tfoot", "caption", "colgroup"), ("table",)),
    "thead": (("tr", "td", "th", "thead", "tbody", "tfoot", "caption", "colgroup"), ("table",)),
    "tfoot": (("tr", "td", "th", "thead", "tbody", "tfoot", "caption", "colgroup"), ("table",)),
    "body": (("head",), ()),
    "rt": (("rt", "rp"), ("ruby",)),
    "rp": (("rt", "rp"), ("ruby",)),
}
IN_HEAD = frozenset("base link meta title style script noscript template".split())
_TAG = re.compile(r"<(?:(!--)|(/?)([a-zA-Z][^\s/>]*)|([!?/]))")
_ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
_TAG_END = re.compile(r"""(?:=\s*"[^"]*"|=\s*'[^']*'|[^>])*+>""")
_BLANK = re.compile(r"[ \t\n\r\f]+")
_INVISIBLE = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse))\b", re.I)


class Node:
    __slots__ = ("attributes", "children", "name")

    def __init__(self, name: str, attributes: dict[str, str]):
        self.name, self.attributes, self.children = name, attributes, []


def tokens(html: str):
    """("text", text), ("open", name, attributes) or ("close", name) in order; comments and declarations are dropped."""
    at, n = 0, len(html)
    while at < n:
        m = _TAG.search(html, at)
        if not m:
            yield "text", html[at:], None
            return
        if m.start() > at:
            yield "text", html[at : m.start()], None
        if m[1]:
            end = html.find("-->", m.end())
            at = n if end < 0 else end + 3
            continue
        if m[4]:
            end = html.find(">", m.end())
            at = n if end < 0 else end + 1
            continue
        close = html.find(">", m.end())
        if close < 0:
            return
        body = html[m.end() : close]
        if '"' in body or "'" in body:
            e = _TAG_END.match(html, m.end())
            close = e.end() - 1 if e else close
            body = html[m.end() : close]
        at, name = close + 1, m[3].lower()
        if m[2]:
            yield "close", name, None
            continue
        yield "open", name, {a.lower(): unescape(b or c or d or "") for a, b, c, d in _ATTRIBUTE.findall(body)} if body else {}
        if name in RAW:
            e = re.compile(rf"</{name}(?=[\s/>])", re.I).search(html, at)
            stop = e.start() if e else n
            if stop > at:
                yield "raw", html[at:stop], name
            at = stop


def build(html: str) -> Node:
    root = Node("html", {})
    stack = [root]

    def close_to(names: tuple[str, ...] | frozenset, until: tuple[str, ...]) -> None:
        """Close up to the outermost open element of ``names`` that no element of ``until`` separates from here."""
        cut = None
        for k in range(len(stack) - 1, 0, -1):
            if stack[k].name in until:
                break
            if stack[k].name in names:
                cut = k
        if cut:
            del stack[cut:]

    for kind, value, extra in tokens(html):
        if kind == "open":
            if value in ("html",):
                continue
            if stack[-1].name == "head" and value not in IN_HEAD:
                stack.pop()
            if value in ENDS_P:
                close_to(("p",), ("table", "td", "th", "button", "object", "caption"))
            if value in ENDS:
                close_to(*ENDS[value])
            if value in ("td", "th") and stack[-1].name in ("table", "tbody", "thead", "tfoot"):
                row = Node("tr", {})
                stack[-1].children.append(row)
                stack.append(row)
            node = Node(value, extra)
            stack[-1].children.append(node)
            if value not in VOID and len(stack) < DEPTH:
                stack.append(node)
        elif kind == "close":
            if value == "p" and not any(x.name == "p" for x in stack):
                stack[-1].children.append(Node("p", {}))
            elif value == "br":
                stack[-1].children.append(Node("br", {}))
            else:
                stops = ("table",) if value in ("td", "th", "tr", "li", "p", "div", "span", "b", "i", "a") else ()
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k].name == value:
                        del stack[k:]
                        break
                    if stack[k].name in stops:
                        break
        else:
            if kind == "text" and stack[-1].name == "head" and value.strip():
                stack.pop()
            stack[-1].children.append(value if extra in ("script", "style") or "&" not in value else unescape(value))
    return root


def visible(node: Node) -> bool:
    if node.name in HIDDEN:
        return False
    a = node.attributes
    if not a:
        return node.name != "dialog"
    return not ("hidden" in a or ("style" in a and _INVISIBLE.search(a["style"])) or (node.name == "input" and a.get("type", "").lower() == "hidden") or (node.name == "dialog" and "open" not in a))


class Page:
    """Lines of one block of text as it is laid out. ``room`` is what its page may still pad and indent, shared by all its blocks."""

    def __init__(self, room: list[int]):
        self.room = room
        self.lines: list[str] = []
        self.line: list[str] = []
        self.space = self.gap = False
        self.indent, self.mark = "", ""
        self.items = self.rows = 0

    def word(self, text: str) -> None:
        pieces = _BLANK.split(text)
        if len(pieces) == 1 and not pieces[0]:
            return
        if not pieces[0]:
            self.space = bool(self.line)
        words = [p for p in pieces if p]
        if words:
            if self.space and self.line:
                self.line.append(" ")
            self.line.append(" ".join(words))
            self.space = False
        if len(pieces) > 1 and not pieces[-1]:
            self.space = bool(self.line)

    def end_line(self, gap: bool = False) -> None:
        if self.line:
            self._put("".join(self.line))
            self.line = []
        self.space = False
        self.gap |= gap

    def _put(self, text: str) -> None:
        if self.gap and self.lines:
            self.lines.append("")
        self.gap = False
        indent = self.indent if len(self.indent) <= self.room[0] else self.mark and " " * len(self.mark)
        self.room[0] -= len(indent)
        self.lines.append((indent[: len(indent) - len(self.mark)] + self.mark + text).rstrip() if self.mark else indent + text)
        self.mark = ""

    def whole(self, text: str) -> None:
        """A line as it stands."""
        self.end_line()
        self._put(text)

    def text(self) -> str:
        self.end_line()
        return "\n".join(self.lines)


def layout(node: Node, page: Page, preserve: bool = False, order: list | None = None) -> None:
    for child in node.children:
        if isinstance(child, str):
            if preserve:
                first, *rest = child.replace("\r\n", "\n").replace("\r", "\n").split("\n")
                page.line.append(first) if first else None
                for line in rest:
                    page._put("".join(page.line))
                    page.line = [line] if line else []
            else:
                page.word(child)
            continue
        name = child.name
        if not visible(child):
            continue
        if name == "br":
            if page.line:
                page.end_line()
            else:
                page.gap = bool(page.lines)
            continue
        if name == "svg":
            for part in drawn(child):
                page.word(" ")
                layout(part, page, preserve, order)
                page.word(" ")
            continue
        if name in ("table",):
            page.end_line(True)
            table(child, page)
            page.end_line(True)
            continue
        if name == "input":
            if child.attributes.get("type", "text").lower() in ("text", "submit", "button", "reset", "search", "email", "tel", "url", "number") and child.attributes.get("value"):
                page.word(f" {child.attributes['value']} ")
            continue
        if name not in BLOCK:
            layout(child, page, preserve or name == "textarea", order)
            continue
        spaced = name in SPACED and not (name in ("ul", "ol", "menu", "dir") and page.indent)
        page.end_line(spaced)
        if name == "li":
            own = order[-1] if order else None
            if own and own[0] is not None:
                number = int(child.attributes["value"]) if re.fullmatch(r"-?\d{1,9}", child.attributes.get("value", "")) else own[0]
                mark, own[0] = f"{number}. ", number + own[1]
            else:
                mark = "- "
            page.items += 1
            indent, page.indent, page.mark = page.indent, page.indent + " " * len(mark), mark
            layout(child, page, preserve, order)
            page.end_line()
            page.indent, page.mark = indent, ""
        elif name in ("ul", "menu", "dir", "ol"):
            start = child.attributes.get("start", "")
            back = "reversed" in child.attributes
            n = sum(1 for c in child.children if isinstance(c, Node) and c.name == "li")
            first = int(start) if re.fullmatch(r"-?\d{1,9}", start) else n if back else 1
            layout(child, page, preserve, [*(order or []), [first, -1 if back else 1] if name == "ol" else [None, 0]])
        elif name == "details" and "open" not in child.attributes:
            for c in child.children:
                if isinstance(c, Node) and c.name == "summary":
                    layout(c, page, preserve, order)
        elif name in ("dd", "blockquote"):
            indent, page.indent = page.indent, page.indent + "  "
            layout(child, page, preserve, order)
            page.end_line()
            page.indent = indent
        elif name in ("pre", "listing", "xmp"):
            if child.children and isinstance(child.children[0], str):
                child.children[0] = child.children[0].removeprefix("\r\n").removeprefix("\n")
            layout(child, page, True, order)
        else:
            layout(child, page, preserve, order)
        page.end_line(spaced)


def drawn(node: Node) -> list[Node]:
    """The elements of a drawing that show text."""
    out = []
    for c in node.children:
        if isinstance(c, Node) and visible(c):
            out += [c] if c.name in ("text", "foreignobject") else drawn(c)
    return out


SECTIONS = ("thead", "tbody", "tfoot")


def parts(node: Node) -> tuple[list[Node], list]:
    """(rows, what else is visible) of a table, through its sections and any element between them that holds rows."""
    rows: list[Node] = []
    rest: list = []
    for c in node.children:
        if isinstance(c, str):
            rest += [c] if c.strip() else []
        elif not visible(c) or c.name in ("colgroup", "col"):
            continue
        elif c.name == "tr":
            rows.append(c)
        elif c.name in SECTIONS or (c.name not in ("table", "caption") and holds_rows(c)):
            inner, stray = parts(c)
            rows += inner
            rest += stray
        else:
            rest.append(c)
    return rows, rest


def holds_rows(node: Node) -> bool:
    return any(isinstance(c, Node) and (c.name == "tr" or c.name in SECTIONS or c.name not in ("table", "td", "th") and holds_rows(c)) for c in node.children)


def _span(node: Node, name: str) -> int:
    value = node.attributes.get(name, "")
    return max(1, min(1000, int(value))) if value.isascii() and value.isdigit() and len(value) < 7 else 1


def table(node: Node, page: Page) -> None:
    """Rows of cells padded to their columns; a cell of several lines makes a row of several lines."""
    rows, rest = parts(node)
    for c in rest:  # captions and what stands between rows by mistake come first
        stray = Node("div", {})
        stray.children = [c]
        layout(stray, page)
        page.end_line()
    grid: list[list[tuple[int, int, list[str]]]] = []  # (column, columns, lines)
    busy: list[tuple[int, int, int]] = []  # (first column, behind the last, last row) of neighbours that reach down
    for n, row in enumerate(rows):
        cells, column, at, held = [], 0, 0, []
        for c in row.children:
            if isinstance(c, str):
                if not c.strip():
                    continue
                cell = Node("td", {})
                cell.children = [c]
                c = cell
            if not visible(c):
                continue
            while at < len(busy) and busy[at][0] <= column:
                column = max(column, busy[at][1]) if busy[at][2] >= n else column
                at += 1
            own = Page(page.room)
            layout(c, own)
            lines = own.text().split("\n")
            page.items, page.rows = page.items + own.items, page.rows + own.rows
            wide = _span(c, "colspan")
            cells.append((column, wide, lines))
            if (deep := _span(c, "rowspan")) > 1:
                near = held and held[-1][1:] == (column, n + deep - 1)
                held[-1 if near else len(held) :] = [(held[-1][0] if near else column, column + wide, n + deep - 1)]
            column += wide
        if held or n % 100 == 99:
            busy = sorted([x for x in busy if x[2] > n] + held)
        if any(any(lines) for _, _, lines in cells):
            grid.append(cells)
            page.rows += 1
    starts = sorted({column for cells in grid for column, _, _ in cells})
    number = {column: k for k, column in enumerate(starts)}
    grid = [[(number[column], bisect_left(starts, column + wide) - number[column], lines) for column, wide, lines in cells] for cells in grid]
    width = [0] * len(starts)
    for cells in grid:
        for column, wide, lines in cells:
            if wide == 1:
                width[column] = max(width[column], *map(len, lines))
    upto = [0, *accumulate(width)]
    for cells in grid:
        for column, wide, lines in cells:
            if wide > 1:  # what a cell needs beyond its columns is its last column's
                last = column + wide - 1
                short = max(map(len, lines)) - (upto[last] - upto[column]) - 3 * (wide - 1)
                width[last] = max(width[last], short)
    start = [0, *accumulate(w + 3 if w else 0 for w in width)]
    padding = 0
    for cells in grid:
        end = max(start[column] for column, _, lines in cells if any(lines))
        deep = max(len(lines) for _, _, lines in cells)
        padding += max(0, end * deep - sum(map(len, (x for _, _, lines in cells for x in lines))))
    if padding > page.room[0]:
        for cells in grid:
            told = [lines for _, _, lines in cells if any(lines)]
            if all(len(lines) == 1 for lines in told):
                page.whole(" | ".join(lines[0] for lines in told))
            else:
                for lines in told:
                    for line in lines:
                        page.whole(line)
        return
    page.room[0] -= padding
    for cells in grid:
        for n in range(max(len(lines) for _, _, lines in cells)):
            line = ""
            for column, _, lines in cells:
                place = start[column]
                if place:
                    line = line.ljust(place - 3) + " | "
                line += lines[n] if n < len(lines) else ""
            page.whole(line.rstrip())


_NAMES = ("title", "text", "items", "rows")


def render(html: str | None) -> tuple[str, str, int, int]:
    """(title, visible text, list items, table rows)."""
    root, page = build(html or ""), Page([PADDING * len(html or "") + 4096])
    layout(root, page)
    title = ""
    open_nodes = [root]
    while open_nodes:
        node = open_nodes.pop()
        if node.name == "title":
            title = _BLANK.sub(" ", "".join(c for c in node.children if isinstance(c, str))).strip()
            break
        open_nodes += [c for c in reversed(node.children) if isinstance(c, Node) and c.name != "svg"]
    return title, page.text(), page.items, page.rows


def extract(df: DataFrame, html: str = "html") -> DataFrame:
    """``df`` with title and text of the column ``html``, and n_items and n_rows, its list items and table rows."""

    @F.pandas_udf("struct<title:string,text:string,items:int,rows:int>")
    def rendered(pages: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([render(p) for p in pages], columns=_NAMES)

    own = unused("page", df)
    made = df.withColumn(own, rendered(F.col(html)))
    return made.withColumns({"title": F.col(f"{own}.title"), "text": F.col(f"{own}.text"), "n_items": F.col(f"{own}.items"), "n_rows": F.col(f"{own}.rows")}).drop(own)


def digest(pages: DataFrame) -> DataFrame:
    return extract(pages.select("page_id", "html")).select("page_id", "title", "text", F.length("text").alias("n_chars"), "n_items", "n_rows")
