"""Visible text of web pages, laid out as a browser would in plain text.

A tree is built with the tags that HTML implies; elements that are not shown are left
out; blocks stand on lines of their own, paragraphs between empty lines, list items
behind their marks, and table cells in aligned columns.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetloom.llm.words import slices

# What starts with "<": a tag, a comment (two kinds end at once) or other markup.
_MARKUP = re.compile(r"<(?:(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*+)|(?P<comment>!--)|[!?/])")
_COMMENT_END = re.compile(r"(?<=<!--)-?>|--!?>")
_REST_OF_TAG = re.compile(
    r"(?P<attributes>(?:[\s/]++|[^\s/>][^\s/>=]*+(?:\s*+=\s*+(?:\"[^\"]*+\"|'[^']*+'|(?![\"'])[^\s>]++|(?=>)))?+)*+)>"
)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_NO_BOX = re.compile(r"(?:^|;)\s*display\s*:\s*none", re.I)
_VISIBILITY = re.compile(r"(?:^|;)\s*visibility\s*:\s*(visible|hidden|collapse)", re.I)
_SPACES = re.compile(r"[ \t\n\r\f]+")
# A slash at the end of a tag closes it, unless it is the end of a value without quotes.
_OPEN_VALUE = re.compile(r"=\s*[^\s\"'>][^\s\"'>]*\Z")
# References of a character by a number that no character has.
_ZEROS = re.compile(r"&#0+(?=[0-9])")
_NO_CHARACTER = re.compile(r"&#(?:[0-9]{8,}|[xX]0*[1-9a-fA-F][0-9a-fA-F]{7,});?")
# Columns line up while they are this wide together; wider tables have two spaces between cells only.
ALIGNED = 400
# A cell takes at most so many rows and columns, and lists are indented by so many characters at most.
MOST_DOWN, MOST_ACROSS, INDENTED = 100, 100, 40

# Fixed by the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
UNSEEN = frozenset("head title script style template noscript iframe noembed noframes datalist object audio video canvas svg math".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup html legend li main menu nav ol optgroup option p pre section select summary table ul".split()
)
SPACED = frozenset("blockquote dl fieldset figure h1 h2 h3 h4 h5 h6 menu ol p pre table ul".split())
CLOSES_P = BLOCKS - frozenset("body html option optgroup legend select".split()) | {"hr"}
IN_HEAD = frozenset("base basefont bgsound head html link meta noframes noscript script style template title".split())
# HTML that ends drawings and formulas, and elements of theirs that hold HTML.
BREAKOUT = frozenset(
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr "
    "ol p pre ruby s small span strong strike sub sup table tt u ul var".split()
)
HOLDS_HTML = frozenset("foreignobject desc title annotation-xml mi mo mn ms mtext".split())
# What a start tag closes, and which elements that reach stops at.
_TABLE = ("table",)
_CELLS = ("td", "th", "caption", *_TABLE)
IMPLIED_ENDS = {
    "li": (("li",), ("ul", "ol", "menu", *_CELLS)),
    "dt": (("dt", "dd"), ("dl", *_CELLS)),
    "dd": (("dt", "dd"), ("dl", *_CELLS)),
    "option": (("option",), ("select", "optgroup", *_CELLS)),
    "optgroup": (("option", "optgroup"), ("select", *_CELLS)),
    "tr": (("tr", "td", "th", "caption", "colgroup"), _TABLE),
    "td": (("td", "th"), ("tr", *_TABLE)),
    "th": (("td", "th"), ("tr", *_TABLE)),
    "tbody": (("thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup"), _TABLE),
    "thead": (("thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup"), _TABLE),
    "tfoot": (("thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup"), _TABLE),
    "caption": (("thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup"), _TABLE),
    "colgroup": (("thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup"), _TABLE),
}
# Where a part of a table may stand; all else in a table but outside its cells belongs before it.
_SECTIONS = ("tbody", "thead", "tfoot")
TABLE_PARENTS = {
    "tr": (*_SECTIONS, "table"), "td": ("tr",), "th": ("tr",),
    **dict.fromkeys((*_SECTIONS, "caption", "colgroup"), _TABLE),
}
TABLE_PARTS = frozenset(("table", *TABLE_PARENTS))
BETWEEN_CELLS = frozenset(("table", *_SECTIONS, "tr", "colgroup"))


class Node:
    __slots__ = ("attributes", "children", "foreign", "name")

    def __init__(self, name: str, attributes: dict[str, str], foreign: bool = False):
        self.name, self.attributes, self.children, self.foreign = name, attributes, [], foreign

    @property
    def boxed(self) -> bool:
        """Whether anything inside can be shown."""
        a = self.attributes
        if self.name in UNSEEN or "hidden" in a or _NO_BOX.search(a.get("style", "")):
            return False
        return self.name != "dialog" or "open" in a

    def visible(self, inherited: bool) -> bool:
        """Whether its text is seen; an element in a hidden one may be visible again."""
        said = _VISIBILITY.findall(self.attributes.get("style", ""))
        return said[-1].lower() == "visible" if said else inherited


def _unescape(text: str) -> str:
    return html.unescape(_NO_CHARACTER.sub("\ufffd", _ZEROS.sub("&#", text))) if "&" in text else text


def _attributes(text: str) -> dict[str, str]:
    if not text.strip(" \t\r\n/"):
        return {}
    found: dict[str, str] = {}
    for name, *values in _ATTRIBUTE.findall(text):
        found.setdefault(name.lower(), _unescape(next((v for v in values if v), "")))
    return found


class Tree:
    """A document's tree; ``open`` is the path from the root to the innermost open element.

    ``places`` has the places in ``open`` of the elements of each name, so the nearest one
    is known without a look at the others. The root is none of them.
    """

    def __init__(self, page: str):
        self.root = Node("html", {})
        self.open = [self.root]
        self.places: defaultdict[str, list[int]] = defaultdict(list)
        at = 0
        while found := _MARKUP.search(page, at):
            self.text(page[at : found.start()])
            at = found.end()
            name = (found["name"] or "").lower()
            if not name:
                end = _COMMENT_END.search(page, at) if found["comment"] else None
                at = end.end() if end else page.find(">", at) + 1 if not found["comment"] else 0
                if not at:
                    return  # it does not end before the page does
                continue
            rest = _REST_OF_TAG.match(page, at)
            if not rest:
                return
            at = rest.end()
            if found["end"]:
                self.end(name)
                continue
            raw = name in RAW and not self.open[-1].foreign
            attributes = rest["attributes"]
            self.start(name, _attributes(attributes), attributes.endswith("/") and not _OPEN_VALUE.search(attributes))
            if raw:
                close = re.compile(rf"</{re.escape(name)}\s*/?>|\Z", re.I).search(page, at)
                if name == "textarea":
                    self.text(page[at : close.start()])
                at = close.end()
                self.end(name)
        self.text(page[at:])

    def push(self, node: Node) -> None:
        self.places[node.name].append(len(self.open))
        self.open.append(node)

    def pop(self) -> None:
        self.places[self.open.pop().name].pop()

    def nearest(self, *names: str) -> int:
        """The place of the innermost open element of these names, 0 if there is none."""
        return max((self.places[n][-1] for n in names if self.places[n]), default=0)

    def text(self, text: str) -> None:
        if text:
            text = _unescape(text)
            if self.open[-1].name == "head" and text.strip(" \t\n\r\f"):
                self.pop()
            if self.open[-1].name in BETWEEN_CELLS and text.strip(" \t\n\r\f"):
                self.before_table(text)
            else:
                self.open[-1].children.append(text)

    def start(self, name: str, attributes: dict[str, str], closed: bool = False) -> None:
        if self.open[-1].foreign and name in BREAKOUT:
            while self.open[-1].foreign:
                self.pop()
        if name in ("svg", "math") or self.open[-1].foreign:
            if self.open[-1].name == "head":
                self.pop()
            node = Node(name, attributes, name not in HOLDS_HTML)
            self.put(node)
            if not closed:
                self.push(node)
            return
        if name == "head" and (len(self.open) > 1 or any(isinstance(c, Node) or c.strip(" \t\n\r\f") for c in self.root.children)):
            return  # only the first thing of a page can be its head
        if self.open[-1].name == "head" and name not in IN_HEAD:
            self.pop()
        if name in ("html", "body"):  # a second one only adds what it says about itself
            for node in self.open[:2]:
                if node.name == name:
                    node.attributes |= attributes
                    return
        if name in CLOSES_P:
            self.close(("p",), ("button", "td", "th", "caption", "table"))
        if name in IMPLIED_ENDS:
            self.close(*IMPLIED_ENDS[name])
        if name in ("table", "form") and self.between_cells():
            if name == "form":
                return
            self.end("table")
        if name in ("td", "th") and not self.within("tr"):
            self.start("tr", {})
        if name in TABLE_PARENTS and self.between_cells():
            while self.open[-1].name not in TABLE_PARENTS[name]:
                self.pop()
        node = Node(name, attributes)
        self.put(node)
        if name not in VOID:
            self.push(node)

    def put(self, node: Node) -> None:
        if self.open[-1].name in BETWEEN_CELLS and node.name not in TABLE_PARENTS and node.name != "col":
            self.before_table(node)
        else:
            self.open[-1].children.append(node)

    def before_table(self, child: Node | str) -> None:
        """Put in front of the innermost open table what has no place in it; a row outside of any table takes it."""
        for i in range(len(self.open) - 1, 0, -1):  # parts of a table: each closes the ones before it
            if self.open[i].name == "table":
                siblings = self.open[i - 1].children
                at = next(j for j in range(len(siblings) - 1, -1, -1) if siblings[j] is self.open[i])
                siblings.insert(at, child)
                return
            if self.open[i].name not in BETWEEN_CELLS:
                break
        self.open[-1].children.append(child)

    def between_cells(self) -> bool:
        """Whether a table is open and none of its cells, nor its caption."""
        table = self.nearest("table")
        return table > self.nearest("td", "th", "caption", "template")

    def within(self, name: str) -> bool:
        return self.nearest(name) > self.nearest("table")

    def close(self, names: tuple[str, ...], until: tuple[str, ...]) -> None:
        """Close up to the outermost open element of ``names`` below the nearest of ``until``."""
        top = self.nearest(*until)
        below = [p[bisect_right(p, top)] for n in names if (p := self.places[n]) and p[-1] > top]
        while below and len(self.open) > min(below):
            self.pop()

    def end(self, name: str) -> None:
        place = self.nearest(name)
        if place and place >= self.nearest("table", *(() if name in TABLE_PARTS else _CELLS)):
            while len(self.open) > place:
                self.pop()


class Page:
    """Lines of text; spaces within a line collapse, and one empty line parts paragraphs."""

    def __init__(self):
        self.lines: list[str] = []
        self.line: list[str] = []
        self.prefix = ""  # of the next line alone, such as a list item's mark
        self.gap = False

    def write(self, text: str) -> None:
        text = _SPACES.sub(" ", text)
        if not self.line or self.line[-1].endswith(" "):
            text = text.lstrip(" ")
        self.add(text)

    def add(self, text: str) -> None:
        if text:
            self.line.append(text)

    def end_line(self, always: bool = False) -> None:
        line = "".join(self.line).rstrip(" ")
        self.line = []
        if line or always:
            self.put(line)

    def put(self, line: str) -> None:
        if self.gap and self.lines and self.lines[-1]:
            self.lines.append("")
        self.gap = False
        self.lines.append((self.prefix + line).rstrip(" "))
        self.prefix = " " * len(self.prefix)

    def paragraph(self) -> None:
        self.end_line()
        self.gap = True


def _number(attributes: dict[str, str], name: str, least: int, most: int, default: int | None = None) -> int:
    found = re.match(r"\s*(-?\d{1,9})", attributes.get(name, ""))
    return max(least, min(most, int(found[1]))) if found else least if default is None else default


def _one_line(lines: list[str]) -> str:
    """Lines as one, spaces collapsed; most have single ones, so the text is only searched."""
    text = " ".join(filter(None, lines))
    if "  " in text or "\t" in text or "\r" in text or "\f" in text:
        text = _SPACES.sub(" ", text)
    return text.strip()


_LISTS = ("ul", "ol", "menu")
_ANY = 1 << 30
# A part of the walk: a request for an element's lines, answered by sending them.
_Lines = Iterator[tuple[Node, bool]]


def _rows(table: Node, visible: bool) -> Iterator[list[tuple[Node, bool]]]:
    stack = [(c, visible) for c in reversed(table.children)]
    while stack:
        child, seen = stack.pop()
        if isinstance(child, Node) and child.boxed:
            seen = child.visible(seen)
            if child.name == "tr":
                yield [(c, c.visible(seen)) for c in child.children if isinstance(c, Node) and c.name in ("td", "th") and c.boxed]
            elif child.name in ("tbody", "thead", "tfoot"):
                stack.extend((c, seen) for c in reversed(child.children))


def _table_lines(table: Node, visible: bool) -> _Lines:
    """Rows of cells in columns as wide as their widest cell, two spaces apart.

    A row is kept as the columns that have text. Columns that cells of earlier rows still
    take are runs of neighbours: where they begin and end, and in how many rows more.
    """
    grid: list[dict[int, str]] = []
    taken: list[tuple[int, int, int]] = []
    for row in _rows(table, visible):
        cells: dict[int, str] = {}
        column, ahead, new = 0, 0, []
        for node, seen in row:
            text = _one_line((yield node, seen)) if node.children else ""
            while ahead < len(taken) and taken[ahead][0] <= column:
                column = max(column, taken[ahead][1])
                ahead += 1
            across = _number(node.attributes, "colspan", 1, MOST_ACROSS)
            down = _number(node.attributes, "rowspan", 1, MOST_DOWN) - 1
            if text:
                cells[column] = text
            if down:
                new.append((column, column + across, down + 1))
            column += across
        if cells:
            grid.append(cells)
        taken = sorted((a, b, n - 1) for a, b, n in taken + new if n > 1)
    widths: dict[int, int] = {}
    for cells in grid:
        for column, text in cells.items():
            widths[column] = max(widths.get(column, 0), len(text))
    columns = sorted(widths)
    if sum(widths.values()) > ALIGNED:
        return ["  ".join(cells[c] for c in sorted(cells)) for cells in grid]
    return ["  ".join(cells.get(c, "").ljust(widths[c]) for c in columns).rstrip() for cells in grid]


def _lines_of(top: Node, visible: bool) -> _Lines:
    """The lines of an element's content, by a walk with a stack of its own."""
    page = Page()
    lists: list[list] = []  # kind, next number and step of every open list
    stack: list[tuple[str, object, bool]] = [("in", c, visible) for c in reversed(top.children)]
    preformatted = 0
    while stack:
        what, node, seen = stack.pop()
        if what == "out":
            name = node.name
            if name in _LISTS:
                lists.pop()
            if name == "li":
                page.end_line()
                page.prefix = node.attributes["\0prefix"]
            if name == "pre":
                preformatted -= 1
            if name in SPACED and not (name in _LISTS and lists):
                page.paragraph()
            else:
                page.end_line()
        elif isinstance(node, str):
            if not seen:
                continue
            if preformatted:
                first, *rest = node.split("\n")
                page.add(first)
                for line in rest:
                    page.end_line(always=True)
                    page.add(line)
            else:
                page.write(node)
        elif not node.boxed:
            continue
        elif node.name == "br":
            page.end_line(always=True)
        elif node.name == "hr":
            page.paragraph()
        elif node.name == "table":
            seen = node.visible(seen)
            page.paragraph()
            for caption in (c for c in node.children if isinstance(c, Node) and c.name == "caption" and c.boxed):
                page.put(_one_line((yield caption, caption.visible(seen))))
            for line in (yield from _table_lines(node, seen)):
                page.put(line)
            page.paragraph()
        else:
            seen = node.visible(seen)
            if node.name in BLOCKS:
                if node.name in SPACED and not (node.name in _LISTS and lists):
                    page.paragraph()
                else:
                    page.end_line()
                stack.append(("out", node, seen))
            if node.name in _LISTS:
                items = sum(isinstance(c, Node) and c.name == "li" and c.boxed for c in node.children)
                backwards = node.name == "ol" and "reversed" in node.attributes
                lists.append([node.name, _number(node.attributes, "start", -_ANY, _ANY, items if backwards else 1), -1 if backwards else 1])
            elif node.name == "li":
                mark = "- "
                if lists and lists[-1][0] == "ol":
                    number = _number(node.attributes, "value", -_ANY, _ANY, lists[-1][1])
                    mark, lists[-1][1] = f"{number}. ", number + lists[-1][2]
                node.attributes["\0prefix"] = page.prefix
                page.prefix = page.prefix[:INDENTED] + (mark if seen else "")
            elif node.name == "pre":
                preformatted += 1
            closed = node.name == "details" and "open" not in node.attributes
            stack.extend(("in", c, seen) for c in reversed(node.children) if not closed or isinstance(c, Node) and c.name == "summary")
    page.end_line()
    return page.lines


def _render(top: Node) -> list[str]:
    """The lines of an element; walks that wait for the lines of a cell stand on a stack, whatever the depth."""
    waiting, answer = [_lines_of(top, top.visible(True))], None
    while True:
        try:
            node, visible = waiting[-1].send(answer)
        except StopIteration as done:
            waiting.pop()
            answer = done.value
            if not waiting:
                return answer
        else:
            waiting.append(_lines_of(node, visible))
            answer = None


def visible_text(page: str) -> str:
    """The text that a reader of the page sees; an empty or null page gives an empty text."""
    lines = _render(Tree(page).root) if page else []
    return re.sub(r"\n{3,}", "\n\n", "\n".join(lines)).strip("\n")


def rendered(pages: DataFrame) -> DataFrame:
    """page_id and text of every row of ``pages``: null and empty pages have an empty text.

    Broken markup is read as HTML allows. Nesting of any depth needs no recursion, and the
    time grows with the page's length, but for tables in tables, whose text is handed on
    once a level. A page is handled by itself, so hot hosts and repeated rows need nothing.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("html")
            for first, last in slices(column):
                texts = [visible_text(page or "") for page in column.slice(first, last - first).to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column("page_id").slice(first, last - first), pa.array(texts, pa.string())], names=["page_id", "text"])

    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "html")
    return rows.mapInArrow(run, "page_id bigint, text string")
