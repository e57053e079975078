"""Visible text of HTML pages, laid out as a text browser would.

A tree builder reads tags with the usual forgiveness: tags that HTML lets authors leave out
are implied (a new paragraph ends the last, a cell opens its row), stray end tags are
ignored, open elements end with the page. Visibility rules then drop what is not shown:
head, scripts, styles and templates, ``hidden``, ``display: none``, ``visibility: hidden``,
closed details and dialogs, embedded media and canvas, and inside svg and math what is only
defined or annotated there. Each text of a drawing is a line, a formula the sequence of its
signs. The rest is emitted in blocks: blank lines around paragraphs,
headings, lists and tables, one line break around other blocks, markers and indents for
lists, preformatted text as it is, and table cells padded to aligned columns.

Pages are independent rows; there is no shuffle.

Defined cases: a null page has a null text, an empty one an empty text. Plain text without
tags is a page of one block. Tables inside more than ``TABLE_DEPTH`` others are laid out as
plain blocks. Repeated rows and rows without an id are read like any other; columns besides
page_id and html are ignored.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame

from tillgrain.llm.support import map_batches

TABLE_DEPTH = 8
MAX_SPAN = 100

# The element classes of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript iframe noembed noframes template".split())
NOT_SHOWN = frozenset("head script style noscript iframe noembed noframes template datalist object video audio canvas title meta link base".split())
# Inside svg and math, by the name of the outer element.
FOREIGN_NOT_SHOWN = {
    "svg": frozenset("title desc defs metadata symbol clippath mask marker pattern lineargradient radialgradient filter".split()),
    "math": frozenset("annotation annotation-xml mphantom".split()),
}
# HTML again inside these.
INTEGRATION = frozenset("foreignobject desc title annotation-xml mi mo mn ms mtext".split())
HEAD_ONLY = frozenset("base link meta script style template title noscript".split())
PARAGRAPHS = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl table blockquote pre figure fieldset hr menu xmp".split())
BLOCKS = PARAGRAPHS | frozenset("address article aside body caption center dd details dialog div dt figcaption footer form header html legend li main nav option optgroup section summary tr td th thead tbody tfoot".split())
ENDS_PARAGRAPH = BLOCKS - frozenset("body html caption dd dt legend li option optgroup tr td th thead tbody tfoot".split()) | frozenset(["dd", "dt", "li"])
# What a start tag ends, and the elements beyond which it does not reach.
IMPLIED_END = {
    "li": (("li",), ("ul", "ol", "menu", "table")),
    "dt": (("dt", "dd"), ("dl", "table")),
    "dd": (("dt", "dd"), ("dl", "table")),
    "option": (("option",), ("select", "datalist")),
    "optgroup": (("option", "optgroup"), ("select",)),
    "td": (("td", "th", "caption"), ("table",)),
    "th": (("td", "th", "caption"), ("table",)),
    "tr": (("tr", "td", "th", "caption"), ("table",)),
    "thead": (("thead", "tbody", "tfoot", "tr", "caption"), ("table",)),
    "tbody": (("thead", "tbody", "tfoot", "tr", "caption"), ("table",)),
    "tfoot": (("thead", "tbody", "tfoot", "tr", "caption"), ("table",)),
}
TABLE_PARTS = frozenset("table thead tbody tfoot tr".split())

_NAME = re.compile(r"[A-Za-z][^\s/>]*")
_STOP = re.compile(r"[>\"']")
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_BLANKS = re.compile(r"[ \t\n\r\f]+")
_NO_DISPLAY = re.compile(r"display\s*:\s*none", re.IGNORECASE)
_VISIBILITY = re.compile(r"visibility\s*:\s*(hidden|collapse|visible)", re.IGNORECASE)


@dataclass(slots=True)
class Node:
    tag: str
    attributes: dict[str, str]
    children: list[Node | str] = field(default_factory=list)
    foreign: str = ""


class _Builder:
    def __init__(self) -> None:
        self.root = Node("html", {})
        self.open = [self.root]
        self.count = {"html": 1}
        self.in_head = False

    def push(self, node: Node) -> None:
        self.open[-1].children.append(node)
        if node.tag not in VOID:
            self.open.append(node)
            self.count[node.tag] = self.count.get(node.tag, 0) + 1

    def pop(self) -> None:
        self.count[self.open.pop().tag] -= 1

    def close_through(self, tags: tuple[str, ...], fence: tuple[str, ...]) -> None:
        """End the outermost open element of these kinds inside the nearest fence."""
        if not any(self.count.get(t) for t in tags):
            return
        place = None
        for i in range(len(self.open) - 1, 0, -1):
            tag = self.open[i].tag
            if tag in fence:
                break
            if tag in tags:
                place = i
        while place is not None and len(self.open) > place:
            self.pop()

    def start(self, tag: str, attributes: dict[str, str]) -> None:
        if tag in ("html", "body"):
            self.leave_head()
            self.root.attributes.update(attributes)
            return
        if tag == "head":
            self.in_head = True
            return
        if self.in_head and tag in HEAD_ONLY:
            # Nothing in the head is shown; raw text has been skipped by the reader.
            return
        self.leave_head()
        if tag in ENDS_PARAGRAPH and self.count.get("p"):
            self.close_through(("p",), ("td", "th", "table", "button", "caption"))
        if tag in IMPLIED_END:
            self.close_through(*IMPLIED_END[tag])
        if tag in ("td", "th") and self.count.get("table") and self.open[-1].tag != "tr":
            self.push(Node("tr", {}))
        self.push(Node(tag, attributes, foreign=self.foreign(tag)))

    def foreign(self, tag: str) -> str:
        """``svg`` or ``math`` if an element that starts here belongs to one."""
        if tag in FOREIGN_NOT_SHOWN:
            return tag
        outer = self.open[-1]
        return outer.foreign if tag not in BLOCKS and outer.tag not in INTEGRATION else ""

    def end(self, tag: str) -> None:
        if tag == "head":
            self.leave_head()
        elif tag == "p" and not self.count.get("p"):
            self.push(Node("p", {}))
            self.pop()
        elif tag == "br":
            self.push(Node("br", {}))
        elif tag not in ("html", "body") and self.count.get(tag):
            fence = () if tag in TABLE_PARTS else ("td", "th", "caption") if tag not in ("td", "th", "caption") else ("table",)
            for i in range(len(self.open) - 1, 0, -1):
                if self.open[i].tag == tag:
                    while len(self.open) > i:
                        self.pop()
                    return
                if self.open[i].tag in fence:
                    return

    def leave_head(self) -> None:
        self.in_head = False

    def text(self, raw: str) -> None:
        if self.in_head:
            if not raw.strip():
                return
            self.leave_head()
        self.open[-1].children.append(entities.unescape(raw))

    def literal(self, raw: str) -> None:
        self.open[-1].children.append(raw)


def _attributes(raw: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for name, double, single, bare in _ATTRIBUTE.findall(raw):
        out.setdefault(name.lower(), entities.unescape(double or single or bare))
    return out


def parse(source: str) -> Node:
    """The tree of a page. One pass; text of raw elements is skipped to their end tag."""
    builder, at, size = _Builder(), 0, len(source)
    closed = {'"': True, "'": True}
    while at < size:
        sign = source.find("<", at)
        if sign < 0:
            builder.text(source[at:])
            break
        if sign > at:
            builder.text(source[at:sign])
        if source.startswith("<!--", sign):
            end = source.find("-->", sign + 4)
            at = size if end < 0 else end + 3
            continue
        following = source[sign + 1 : sign + 2]
        if following in ("!", "?"):
            end = source.find(">", sign)
            at = size if end < 0 else end + 1
            continue
        closing = following == "/"
        name = _NAME.match(source, sign + 1 + closing)
        if name is None:
            builder.text("<" if not closing else "")
            at = sign + 1 if not closing else (source.find(">", sign) + 1 or size)
            continue
        end = _tag_end(source, name.end(), closed)
        tag, inside = name[0].lower(), source[name.end() : end]
        at = end + 1
        if closing:
            builder.end(tag)
            continue
        builder.start(tag, _attributes(inside) if inside.strip(" \t\n\r\f/") else {})
        if inside.endswith("/") and tag not in VOID and builder.open[-1].tag == tag and builder.open[-1].foreign:
            builder.pop()
            continue
        if tag in RAW or tag in ("textarea", "title", "xmp"):
            stop = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|$)", re.IGNORECASE).search(source, at)
            body = source[at : stop.start() if stop else size]
            if tag == "textarea":
                builder.text(body)
            elif tag == "xmp":
                builder.literal(body)
            at = stop.start() if stop else size
    return builder.root


def _tag_end(source: str, at: int, closed: dict[str, bool]) -> int:
    """Place of the tag's ``>``, quoted ones aside. Quotes that never end do not count."""
    while (stop := _STOP.search(source, at)) is not None:
        mark = stop[0]
        if mark == ">":
            return stop.start()
        at = stop.end()
        if closed[mark]:
            end = source.find(mark, at)
            if end < 0:
                closed[mark] = False
            else:
                at = end + 1
    return len(source)


# -- layout ------------------------------------------------------------------------


class Flow:
    """Lines of one column of text; blank lines between blocks never add up."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.current: list[str] = []
        self.space = False
        self.margin = 0
        self.indents: list[str] = []
        self.marker = ""

    def inline(self, text: str) -> None:
        words = _BLANKS.sub(" ", text)
        if words.startswith(" "):
            self.space = True
        body = words.strip(" ")
        if not body:
            return
        if self.space and self.current:
            self.current.append(" ")
        self.current.append(body)
        self.space = words.endswith(" ")

    def exact(self, text: str) -> None:
        for k, line in enumerate(text.expandtabs(8).split("\n")):
            if k:
                self.line_break()
            if line:
                self.current.append(line)

    def line_break(self) -> None:
        self._emit("".join(self.current))
        self.current, self.space = [], False

    def block(self, blank: bool) -> None:
        if self.current:
            self.line_break()
        self.space = False
        if blank:
            self.margin = 1

    def _emit(self, line: str) -> None:
        if self.margin and self.lines:
            self.lines.append("")
        self.margin = 0
        indent = "".join(self.indents)
        if self.marker:
            indent = indent[: len(indent) - len(self.marker)] + self.marker
            self.marker = ""
        self.lines.append((indent + line).rstrip())

    def block_lines(self, lines: list[str]) -> None:
        for line in lines:
            self._emit(line)

    def result(self) -> list[str]:
        self.block(False)
        while self.lines and not self.lines[-1]:
            self.lines.pop()
        start = 0
        while start < len(self.lines) and not self.lines[start]:
            start += 1
        return self.lines[start:]


def _shown(node: Node, visible: bool) -> tuple[bool, bool]:
    """Whether the element has a box, and whether text right inside is visible."""
    a = node.attributes
    if node.tag in NOT_SHOWN or (node.foreign and node.tag in FOREIGN_NOT_SHOWN[node.foreign]):
        return False, False
    if a:
        if node.foreign == "svg":
            if a.get("display") == "none":
                return False, False
            if a.get("visibility") in ("hidden", "collapse", "visible"):
                visible = a["visibility"] == "visible"
        style = a.get("style", "")
        if "hidden" in a or (style and _NO_DISPLAY.search(style)):
            return False, False
        if node.tag == "dialog" and "open" not in a:
            return False, False
        if style and (found := _VISIBILITY.search(style)):
            visible = found[1].lower() == "visible"
    elif node.tag == "dialog":
        return False, False
    return True, visible


def layout(root: Node, visible: bool = True, depth: int = 0) -> list[str]:
    """Lines of an element's content. Walks with a stack of its own; only tables nest calls."""
    flow = Flow()
    # Entries: a node or text to enter, or a function to call when its parent is done.
    todo: list = [(child, visible, False) for child in reversed(root.children)]
    numbers: list[int | None] = []
    while todo:
        entry = todo.pop()
        if callable(entry):
            entry()
            continue
        item, visible, exact = entry
        if isinstance(item, str):
            if visible:
                (flow.exact if exact else flow.inline)(item)
            continue
        tag = item.tag
        box, visible = _shown(item, visible)
        if not box:
            continue
        if tag == "br":
            flow.line_break()
            continue
        if tag == "hr":
            flow.block(True)
            continue
        if tag == "input":
            if item.attributes.get("type", "").lower() in ("submit", "button", "reset") and visible:
                flow.inline(f" {item.attributes.get('value', '')} ")
            continue
        children = item.children
        if tag == "details" and "open" not in item.attributes:
            children = [c for c in children if isinstance(c, Node) and c.tag == "summary"]
        if tag == "table" and depth < TABLE_DEPTH:
            flow.block(True)
            flow.block_lines(_table(item, visible, depth))
            flow.block(True)
            continue
        if tag in BLOCKS:
            # Lists inside lists follow their item without a blank line.
            blank = tag in PARAGRAPHS and not (tag in ("ul", "ol", "menu") and numbers)
            flow.block(blank)
            todo.append(lambda blank=blank: flow.block(blank))
        elif tag == "text" and item.foreign == "svg":
            flow.block(False)
            todo.append(lambda: flow.block(False))
        if tag in ("ul", "ol", "menu"):
            start = item.attributes.get("start", "1") if tag == "ol" else None
            numbers.append(int(start) if start is not None and re.fullmatch(r"-?[0-9]{1,9}", start) else 1 if tag == "ol" else None)
            todo.append(numbers.pop)
        elif tag == "li":
            marker = "- "
            if numbers and numbers[-1] is not None:
                marker = f"{numbers[-1]}. "
                numbers[-1] += 1
            flow.indents.append(" " * len(marker))
            flow.marker = marker
            todo.append(lambda: (flow.block(False), flow.indents.pop(), setattr(flow, "marker", "")))
        elif tag in ("blockquote", "dd"):
            flow.indents.append("  ")
            todo.append(lambda: (flow.block(False), flow.indents.pop()))
        exact = exact or tag in ("pre", "textarea", "plaintext", "xmp")
        todo += [(child, visible, exact) for child in reversed(children)]
    return flow.result()


def _span(cell: Node, name: str) -> int:
    value = cell.attributes.get(name, "1")
    return max(1, min(MAX_SPAN, int(value))) if re.fullmatch("[0-9]{1,6}", value) else 1


def _table(table: Node, visible: bool, depth: int) -> list[str]:
    """Captions and other content, then rows of cells padded to the width of their column."""
    before: list[str] = []
    rows: list[list[tuple[int, list[str]]]] = []
    below: dict[int, int] = {}
    todo: list = [(child, visible) for child in reversed(table.children)]
    while todo:
        item, shown = todo.pop()
        if isinstance(item, str):
            if shown and item.strip():
                before.append(_BLANKS.sub(" ", item).strip())
            continue
        box, inside = _shown(item, shown)
        if not box:
            continue
        if item.tag in ("thead", "tbody", "tfoot"):
            todo += [(child, inside) for child in reversed(item.children)]
        elif item.tag == "tr":
            rows.append(_cells(item, inside, depth, below))
        else:
            before += layout(Node("div", {}, [item]), shown, depth + 1)
    widths: dict[int, int] = {}
    for row in rows:
        for column, lines in row:
            widths[column] = max([widths.get(column, 0), *map(len, lines)])
    out = before
    for row in rows:
        for k in range(max((len(lines) for _, lines in row), default=0)):
            own = {column: lines[k] for column, lines in row if k < len(lines)}
            line = "  ".join(own.get(c, "").ljust(widths[c]) for c in sorted(widths))
            if line.strip():
                out.append(line.rstrip())
    return out


def _cells(row: Node, visible: bool, depth: int, below: dict[int, int]) -> list[tuple[int, list[str]]]:
    """(column, lines) of the cells; spans of columns and of earlier rows take their places."""
    taken = {c for c, n in below.items() if n > 0}
    for c in taken:
        below[c] -= 1
    out, column = [], 0
    for item in row.children:
        if isinstance(item, str):
            if not item.strip():
                continue
            item = Node("td", {}, [item])
        box, inside = _shown(item, visible)
        if not box:
            continue
        while column in taken:
            column += 1
        out.append((column, layout(item, inside, depth + 1)))
        for c in range(column, column + _span(item, "colspan")):
            below[c] = max(below.get(c, 0), _span(item, "rowspan") - 1)
        column += _span(item, "colspan")
    return out


def visible_text(source: str) -> str:
    return "\n".join(layout(parse(source)))


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, text) of each page."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            texts = [None if h is None else visible_text(h) for h in batch.column(1).to_pylist()]
            yield {"page_id": batch.column(0), "text": pa.array(texts, pa.string())}

    return map_batches(pages.select("page_id", "html"), step, "page_id bigint, text string")
