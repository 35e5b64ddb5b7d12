"""HTML extraction: layout-aware rendering.

A tokenizer cuts the page into tags and text; a tree builder adds the tags that HTML leaves out
(``</p>`` before a block, ``</li>`` before the next item, cells and rows of tables) and drops end
tags without a start. Rendering walks the tree once: text that a reader would see comes out, in
order; white space is joined as in a browser; blocks stand on lines of their own, with an empty
line around paragraphs and headings; list items get a dash or a number and an indent; table cells
of one row share a line, padded so that columns line up.

Not visible: head, script, style, template and the like, comments, elements with ``hidden``,
``aria-hidden="true"`` or an inline style that hides them, hidden inputs and passwords. Where
``visibility`` hides an element, descendants that are visible again come out. Image texts (``alt``),
formulas, texts of drawings, the options of a choice, what a text control or button holds, and what
stands in for an ``object`` are visible.

Null and empty pages give the empty text. Unclosed or crossed tags never fail, and there is no limit
to nesting: neither building nor rendering recurses.
"""

from __future__ import annotations

import html as entities
import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.llm.words import pieces

#: Bytes of pages rendered at a time.
CHUNK_BYTES = 4 << 20

# The element groups of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INVISIBLE = frozenset(
    "head script style template noscript title iframe audio video canvas datalist"
    " defs desc metadata symbol clippath mask annotation annotation-xml".split()
)
#: Inside these a start tag may close itself.
FOREIGN = frozenset("svg math".split())
RAW_TEXT = frozenset("script style textarea title noscript iframe".split())
#: Inputs without a text of their own, and those whose text is not shown.
WORDLESS_INPUTS = frozenset("hidden password checkbox radio file image color range".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody text textarea tfoot thead tr ul".split()
)
SPACED = frozenset("blockquote dl figure h1 h2 h3 h4 h5 h6 ol p pre table ul menu".split())
#: An open p ends before each of these.
ENDS_P = BLOCKS - frozenset("body caption dd dt html legend li optgroup option summary tbody text textarea tfoot thead tr".split())
#: A start tag ends open elements of the second group, up to one of the third.
IMPLIED_ENDS = {
    "li": ("li", ("ul", "ol", "menu")),
    "dt": ("dt dd", ("dl",)),
    "dd": ("dt dd", ("dl",)),
    "option": ("option", ("select",)),
    "tr": ("tr td th caption", ("table",)),
    "td": ("td th", ("tr", "table")),
    "th": ("td th", ("tr", "table")),
    "thead": ("thead tbody tfoot tr td th caption", ("table",)),
    "tbody": ("thead tbody tfoot tr td th caption", ("table",)),
    "tfoot": ("thead tbody tfoot tr td th caption", ("table",)),
}
IMPLIED_ENDS = {tag: (frozenset(ends.split()), frozenset(limits)) for tag, (ends, limits) in IMPLIED_ENDS.items()}
#: An end tag does not reach beyond these.
SCOPE = frozenset("table td th caption html".split())

_TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<[!?][^>]*(?:>|\Z)|<(?P<end>/)?(?P<tag>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*'|[\"'])*?)(?:>|\Z)",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_SPACES = re.compile(r"[ \t\n\f\r]+")
_REMOVING = re.compile(r"(?:^|;)\s*display\s*:\s*none", re.IGNORECASE)
_VISIBILITY = re.compile(r"(?:^|;)\s*visibility\s*:\s*(hidden|collapse|visible)", re.IGNORECASE)


@dataclass
class Element:
    tag: str
    attributes: dict[str, str] = field(default_factory=dict)
    children: list = field(default_factory=list)


def _attributes(rest: str) -> dict[str, str]:
    if not rest or rest == "/":
        return {}
    out: dict[str, str] = {}
    for m in _ATTRIBUTE.finditer(rest):
        value = m[2] or m[3] or m[4] or ""
        out.setdefault(m[1].lower(), entities.unescape(value) if "&" in value else value)
    return out


class TreeBuilder:
    """Builds the element tree from tokens; ``open`` is the stack of unclosed elements."""

    def __init__(self) -> None:
        self.root = Element("html")
        self.open = [self.root]
        self.places: dict[str, list[int]] = {"html": [0]}  # of open elements by tag, so that no search walks the stack

    def text(self, data: str) -> None:
        if data:
            self.open[-1].children.append(entities.unescape(data) if "&" in data else data)

    def _nearest(self, tags: frozenset[str]) -> int:
        """Place of the innermost open element of these tags, or 0."""
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=0)

    def _cut(self, at: int) -> None:
        """End the element at this place of the stack and all inside it."""
        for element in self.open[at:]:
            self.places[element.tag].pop()
        del self.open[at:]

    def _close(self, names: frozenset[str], limits: frozenset[str]) -> None:
        """End the outermost open element of ``names`` above the nearest one of ``limits``."""
        limit, found = self._nearest(limits), []
        for name in names:
            places = self.places.get(name)
            if places and places[-1] > limit:
                found.append(places[bisect_right(places, limit)])
        if found:
            self._cut(min(found))

    def start(self, tag: str, rest: str) -> None:
        if tag in ("html", "body"):
            if tag == "body":
                self._close(frozenset(("head",)), frozenset())
            return
        if tag in ENDS_P or tag in BLOCKS:
            if self.open[-1].tag == "head":
                self._cut(len(self.open) - 1)
        if tag in ENDS_P:
            self._close(frozenset(("p",)), SCOPE)
        if tag in IMPLIED_ENDS:
            self._close(*IMPLIED_ENDS[tag])
        if tag in ("td", "th") and self.open[-1].tag in ("table", "thead", "tbody", "tfoot"):
            self._push(Element("tr"))
        element = Element(tag, _attributes(rest))
        if tag in VOID or (rest.endswith("/") and self._nearest(FOREIGN)):
            self.open[-1].children.append(element)
        else:
            self._push(element)

    def _push(self, element: Element) -> None:
        self.open[-1].children.append(element)
        self.places.setdefault(element.tag, []).append(len(self.open))
        self.open.append(element)

    def end(self, tag: str) -> None:
        if tag == "br":
            self.open[-1].children.append(Element("br"))
            return
        places = self.places.get(tag)
        if tag == "html" or not places:
            return
        if tag in ("table", "tr", "tbody", "thead", "tfoot") or places[-1] >= self._nearest(SCOPE):
            self._cut(places[-1])


def parse(page: str) -> Element:
    builder, at = TreeBuilder(), 0
    lower = None
    while True:
        m = _TOKEN.search(page, at)
        if m is None:
            builder.text(page[at:])
            return builder.root
        builder.text(page[at : m.start()])
        at = m.end()
        tag = m["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if m["end"]:
            builder.end(tag)
            continue
        builder.start(tag, m["rest"])
        if tag in RAW_TEXT:
            lower = lower if lower is not None else page.lower()
            stop = lower.find(f"</{tag}", at) if len(lower) == len(page) else page.find(f"</{tag}", at)
            stop = stop if stop >= 0 else len(page)
            if tag == "textarea":
                builder.text(page[at:stop].removeprefix("\n"))
            at = stop


def _is_hidden(element: Element) -> bool:
    attributes = element.attributes
    if not attributes:
        return False
    if "hidden" in attributes or attributes.get("aria-hidden", "").lower() == "true":
        return True
    return "style" in attributes and bool(_REMOVING.search(attributes["style"]))


def _whole(value: str, default: int, most: int) -> int:
    return min(int(value), most) if re.fullmatch("[0-9]{1,9}", value) else default


#: A step of rendering: it yields the steps inside it, which ``run`` takes in turn.
Step = Iterator["Step"]


def run(step: Step) -> None:
    """Take a step and all steps inside it, depth first, without recursion."""
    stack = [step]
    while stack:
        inner = next(stack[-1], None)
        if inner is None:
            stack.pop()
        else:
            stack.append(inner)


class Grid:
    """Rows of a table; cells that span rows hold their columns in the rows below."""

    def __init__(self) -> None:
        self.rows: list[list[list[str]]] = []
        self.held: dict[int, int] = {}  # column -> rows below that it is still held in

    def section(self) -> None:
        """No cell spans from one group of rows into the next."""
        self.held = {}

    def begin(self) -> None:
        self.row: list[list[str]] = []
        self.next: dict[int, int] = {k: n - 1 for k, n in self.held.items() if n > 1}

    def add(self, lines: list[str], columns: int = 1, below: int = 0) -> None:
        self._skip()
        for k in range(columns):
            if below:
                self.next[len(self.row)] = below
            self.row.append([] if k else lines)
            if k < columns - 1 and len(self.row) in self.held:
                break  # a span ends where a cell from above stands

    def _skip(self) -> None:
        while len(self.row) in self.held:
            self.row.append([])

    def end(self) -> None:
        if self.row:
            self.rows.append(self.row)
        self.held = self.next


class Renderer:
    """Collects lines; inline text waits in ``line`` until a block boundary ends it."""

    def __init__(self, unseen: bool = False) -> None:
        self.lines: list[str] = []
        self.line: list[str] = []
        self.blank_due = False
        self.indent = ""
        self.marker = ""
        self.pre = 0
        self.unseen = unseen  # inside an element that ``visibility`` hides

    def text(self, data: str) -> None:
        if self.unseen:
            return
        if self.pre:
            parts = data.split("\n")
            self.line.append(parts[0])
            for part in parts[1:]:
                self.break_line(keep=True)
                self.line.append(part)
            return
        self.line.append(_SPACES.sub(" ", data))

    def control(self, data: str) -> None:
        """The text of a control, apart from what stands beside it."""
        if data:
            self.text(f" {data} ")

    def break_line(self, keep: bool = False) -> None:
        """End the current line. keep: also if it is empty, as for br and in pre."""
        joined = "".join(self.line)
        self.line = []
        joined = joined.rstrip() if self.pre else re.sub(" {2,}", " ", joined).strip(" ")
        if not joined and not (keep and self.lines):
            return
        self._emit(joined)

    def _emit(self, text: str) -> None:
        if self.blank_due and self.lines and self.lines[-1] != "":
            self.lines.append("")
        self.blank_due = False
        if self.marker:
            head = self.indent[: len(self.indent) - len(self.marker)] + self.marker
            self.marker = ""
        else:
            head = self.indent
        self.lines.append((head + text).rstrip())

    def block(self, element: Element, spaced: bool) -> Step:
        self.break_line()
        self.blank_due |= spaced
        yield self.children(element)
        self.break_line()
        self.blank_due |= spaced

    def children(self, element: Element) -> Step:
        for child in element.children:
            if isinstance(child, str):
                self.text(child)
            elif child.tag not in INVISIBLE and not _is_hidden(child):
                yield self.element(child)

    def element(self, element: Element) -> Step:
        """An element that takes part in the layout; text in it is unseen while ``visibility`` says so."""
        outer = self._enter(element)
        yield self._inside(element)
        self.unseen = outer

    def _enter(self, element: Element) -> bool:
        outer = self.unseen
        if "style" in element.attributes:
            said = _VISIBILITY.findall(element.attributes["style"])
            if said:
                self.unseen = said[-1].lower() != "visible"
        return outer

    def _inside(self, element: Element) -> Step:
        tag = element.tag
        if tag == "br":
            self.break_line(keep=True)
        elif tag == "hr":
            self.break_line()
            self.blank_due = True
        elif tag == "img":
            self.text(element.attributes.get("alt", ""))
        elif tag == "input":
            if element.attributes.get("type", "text").lower() not in WORDLESS_INPUTS:
                self.control(element.attributes.get("value", ""))
        elif tag in ("ul", "ol", "menu"):
            yield self.list(element)
        elif tag == "table":
            yield self.table(element)
        elif tag in ("pre", "textarea"):
            self.break_line()
            self.pre += 1
            yield self.block(element, tag == "pre")
            self.pre -= 1
        elif tag in ("dd", "blockquote"):
            self.break_line()
            self.indent += "  "
            yield self.block(element, tag in SPACED)
            self.indent = self.indent[:-2]
        elif tag == "optgroup":
            self.break_line()
            self.text(element.attributes.get("label", ""))
            yield self.block(element, False)
        elif tag in BLOCKS:
            yield self.block(element, tag in SPACED)
        else:
            yield self.children(element)

    def list(self, element: Element) -> Step:
        self.break_line()
        nested = bool(self.indent) or bool(self.marker)
        self.blank_due |= not nested
        start = element.attributes.get("start", "1")
        number = int(start) if re.fullmatch(r"-?[0-9]{1,9}", start) else 1
        outer = self.indent
        for child in element.children:
            if isinstance(child, str):
                self.text(child)
                continue
            if child.tag in INVISIBLE or _is_hidden(child):
                continue
            if child.tag != "li":
                yield self.element(child)
                continue
            self.break_line()
            value = child.attributes.get("value", "")
            number = int(value) if re.fullmatch(r"-?[0-9]{1,9}", value) else number
            own = f"{number}. " if element.tag == "ol" else "- "
            number += 1
            unseen = self._enter(child)
            if self.marker:  # a list that begins an item: the outer marker stands alone
                self._emit("")
            self.marker, self.indent = "" if self.unseen else own, outer + " " * len(own)
            yield self.children(child)
            self.break_line()
            self.marker, self.indent, self.blank_due, self.unseen = "", outer, False, unseen
        self.break_line()
        self.blank_due |= not nested

    def table(self, element: Element) -> Step:
        self.break_line()
        self.blank_due = True
        grid = Grid()
        yield self._rows(element, grid)
        # A cell that spans columns or has several lines does not widen the columns before it.
        widths: list[int] = []
        for row in grid.rows:
            for k, cell in enumerate(row[:-1]):
                widths += [0] * (k + 1 - len(widths))
                widths[k] = max(widths[k], *(len(line) for line in cell), 0)
        for row in grid.rows:
            for at in range(max((len(cell) for cell in row), default=0)):
                parts = [cell[at] if at < len(cell) else "" for cell in row]
                line = "".join(part.ljust(widths[k]) + "  " if k < len(parts) - 1 else part for k, part in enumerate(parts))
                if line.strip():
                    self._emit(line.rstrip())
        self.blank_due = True

    def _rows(self, element: Element, grid: Grid) -> Step:
        for child in element.children:
            if isinstance(child, str):
                self._loose(child, grid)
            elif child.tag in INVISIBLE or _is_hidden(child):
                continue
            elif child.tag in ("thead", "tbody", "tfoot"):
                outer = self._enter(child)
                grid.section()
                yield self._rows(child, grid)
                grid.section()
                self.unseen = outer
            elif child.tag == "tr":
                outer = self._enter(child)
                yield self._cells(child, grid)
                self.unseen = outer
            else:
                lines: list[str] = []
                yield self._rendered(child, lines)
                if lines:
                    grid.rows.append([lines])

    def _loose(self, text: str, grid: Grid) -> None:
        if text.strip() and not self.unseen:
            grid.rows.append([[_SPACES.sub(" ", text).strip()]])

    def _cells(self, row: Element, grid: Grid) -> Step:
        grid.begin()
        for cell in row.children:
            if isinstance(cell, str):
                if cell.strip() and not self.unseen:
                    grid.add([_SPACES.sub(" ", cell).strip()])
            elif cell.tag not in INVISIBLE and not _is_hidden(cell):
                lines: list[str] = []
                yield self._rendered(cell, lines)
                below = _whole(cell.attributes.get("rowspan", "1"), 1, 65_534)
                grid.add(lines, max(_whole(cell.attributes.get("colspan", "1"), 1, 1000), 1), below - 1 if below else 65_534)
        grid.end()

    def _rendered(self, element: Element, lines: list[str]) -> Step:
        """The lines of an element that stands in a table."""
        inner = Renderer(self.unseen)
        if element.tag in ("td", "th", "caption"):
            inner._enter(element)
            yield inner.children(element)
        else:
            yield inner.element(element)
        inner.break_line()
        lines += [line for line in inner.lines if line]


def render(page: str | None) -> str:
    """All visible text of a page, laid out."""
    if not page:
        return ""
    out = Renderer()
    run(out.children(parse(page)))
    out.break_line()
    return "\n".join(out.lines).strip("\n")


def extract_text(pages: DataFrame, id_column: str = "page_id", html: str = "html") -> DataFrame:
    """The id and the rendered ``text`` of every row."""

    def rendered(batches):
        for batch in pieces(batches, 1, CHUNK_BYTES):
            texts = [render(page) for page in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], [id_column, "text"])

    rows = pages.select(F.col(id_column).cast("long").alias(id_column), F.col(html).alias("html"))
    return rows.mapInArrow(rendered, f"`{id_column}` long, text string")
