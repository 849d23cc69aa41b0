"""Layout-aware text of HTML pages: a tree with implied tags, visibility rules, and rendering.

:func:`parse` builds the element tree as browsers do for the common cases:
void elements, end tags implied by what follows (``p``, ``li``, ``dt``, ``dd``,
``option``, table parts), raw text elements, and stray or missing end tags.
Quotes count only where an attribute's value begins; a quote without its other
half is a plain sign, and where quotes would leave a tag without an end, none
counts from there on.

:func:`render` gives all visible text: nothing from ``head`` but no title
either, no scripts, styles, templates, comments, closed ``details``, nor what
``hidden``, an inline style or the page's own style sheet hides. Of a sheet
count ``display`` and ``visibility`` in rules for a tag, a class, an id, or a
tag with one of these, outside of at-rules; ``visibility`` passes to the
children, which may show themselves again. A drop-down shows its selected (or
first) option, a list box all, an input its value.
White space collapses except in ``pre`` and ``textarea``. Blocks begin on lines
of their own, paragraphs, headings, lists and tables stand apart by an empty
line, ``br`` breaks a line. List items carry ``-`` or their number, nested
lists are indented (up to ``_INDENT`` characters). A table's rows are lines
whose cells are padded to the column's width (up to ``_PAD``) and parted by
`` | ``; a cell spanning columns takes the first, one spanning rows leaves its
place empty in the later ones (in the first ``_GRID`` columns). Tables more
than ``_NESTED`` deep are laid out as blocks.

Null and empty pages give empty text. Very deep and very long pages are read
without recursion, in time about linear in their length: these bounds are on
padding and never on text. Repeated rows and extra columns do not matter; an
empty table gives an empty result.
"""

from __future__ import annotations

import html
import re
import unicodedata
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset(("script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes"))
_UNSEEN = frozenset(
    "head script style template noscript noembed noframes iframe object audio video canvas svg math datalist "
    "title meta link base area param source track col colgroup".split()
)
_BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section "
    "summary table ul caption".split()
)
_APART = frozenset("blockquote dl figure h1 h2 h3 h4 h5 h6 hr ol p pre table ul menu".split())
_CELLS = frozenset(("td", "th"))
_SECTIONS = frozenset(("thead", "tbody", "tfoot"))
#: Open elements that a start tag closes, up to the nearest of the borders.
_CLOSES = {
    **{t: ({"p"}, {"table", "td", "th", "caption", "button", "object"}) for t in _BLOCK - {"body", "html", "option", "optgroup", "caption"}},
    "li": ({"p", "li"}, {"ul", "ol", "menu", "dir", "table", "td", "th"}),
    "dt": ({"p", "dt", "dd"}, {"dl", "table", "td", "th"}),
    "dd": ({"p", "dt", "dd"}, {"dl", "table", "td", "th"}),
    "option": ({"option"}, {"select", "datalist"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tr": ({"tr", "td", "th", "caption", "colgroup"}, {"table"}),
    **{t: ({"tr", "td", "th", "caption", "colgroup", *_SECTIONS}, {"table"}) for t in _SECTIONS},
    "body": ({"head"}, set()),
}
_HEAD_ONLY = frozenset("base link meta title style script noscript template head html body".split())

_TOKEN = re.compile(r"<!--(?:-?>|.*?(?:--!?>|\Z))|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)", re.S)
_STOP = re.compile(r"[=>]")
_BLANK = re.compile(r"\s*")
_VALUE = re.compile(r"[^\s>]*")
_ATTRIBUTE = re.compile(r"([^\s=/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_SPACES = re.compile(r"[ \t\n\r\f]+")
_DECLARATION = re.compile(r"(?:^|;)\s*(display|visibility)\s*:\s*([a-z-]+)\s*(!\s*important)?", re.I)
_SELECTOR = re.compile(r"([a-zA-Z][\w-]*|\*)?([.#][\w-]+)?")
_CSS_COMMENT = re.compile(r"/\*.*?(?:\*/|\Z)", re.S)
#: Inputs without a value that is shown.
_MUTE = frozenset("hidden checkbox radio password file image color range".split())

#: Bounds on padding: of indents, of a column or a spanning cell, columns with cells over rows, tables in tables.
_INDENT, _PAD, _GRID, _NESTED = 64, 250, 200, 32


@dataclass
class Node:
    tag: str
    attributes: dict[str, str] = field(default_factory=dict)
    children: list = field(default_factory=list)  # nodes and texts


def _attributes(raw: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for m in _ATTRIBUTE.finditer(raw):
        out.setdefault(m[1].lower(), html.unescape(m[2] or m[3] or m[4] or ""))
    return out


class _Stack:
    """Open elements, with the serial numbers of those of each tag, so that none is looked for one by one."""

    def __init__(self, root: Node):
        self.nodes, self.serials, self.next = [root], [0], 1
        self.places: dict[str, list[int]] = {}
        self.blocks: list[int] = []

    @property
    def top(self) -> Node:
        return self.nodes[-1]

    def push(self, node: Node) -> None:
        self.nodes.append(node)
        self.serials.append(self.next)
        self.places.setdefault(node.tag, []).append(self.next)
        if node.tag in _BLOCK:
            self.blocks.append(self.next)
        self.next += 1

    def pop(self) -> None:
        node = self.nodes.pop()
        self.serials.pop()
        self.places[node.tag].pop()
        if node.tag in _BLOCK:
            self.blocks.pop()

    def last(self, tag: str) -> int:
        """Serial number of the innermost open element of a tag; 0 if none is open."""
        return (self.places.get(tag) or (0,))[-1]

    def cut(self, serial: int) -> None:
        """Closes an element with all inside it."""
        while self.serials[-1] >= serial:
            self.pop()

    def drop(self, tag: str) -> None:
        """Closes the innermost element of a tag that is not a block, and nothing inside it."""
        i = bisect_left(self.serials, self.places[tag].pop())
        del self.nodes[i], self.serials[i]

    def close(self, names: set[str], borders: set[str]) -> None:
        """Closes the outermost element of ``names`` above the nearest border, with all inside it."""
        border = max(map(self.last, borders), default=0)
        inside = [found[k] for n in names if (found := self.places.get(n)) and (k := bisect_right(found, border)) < len(found)]
        if inside:
            self.cut(min(inside))


def _tag_end(page: str, at: int) -> int:
    """Where the tag's ``>`` is, outside of quoted values; -1 without one."""
    while stop := _STOP.search(page, at):
        at = stop.end()
        if stop[0] == ">":
            return at - 1
        at = _BLANK.match(page, at).end()
        quote = page[at : at + 1]
        if quote in ('"', "'"):
            at = page.find(quote, at + 1) + 1 or at + 1
        else:
            at = _VALUE.match(page, at).end()
    return -1


def parse(page: str) -> Node:
    root = Node("#root")
    stack = _Stack(root)
    at, n = 0, len(page)
    quotes = True
    last_end = page.rfind(">")
    while at < n:
        m = _TOKEN.search(page, at)
        if m and m[2] is not None and m.end() > last_end:
            m = None  # no tag ends from here on
        text = page[at : m.start() if m else n]
        if text:
            if stack.top.tag == "head" and text.strip():
                stack.pop()
            inside = stack.top.tag
            if inside in _SECTIONS or inside in ("table", "tr"):
                if text.strip():  # text between a table's parts goes before it
                    _before_table(stack).append(html.unescape(text))
            else:
                stack.top.children.append(html.unescape(text))
        if not m:
            break
        at = m.end()
        if m[2] is None:
            continue
        end = _tag_end(page, at) if quotes else -1
        if end < 0:
            quotes = False
            end = page.find(">", at)
        raw, at = page[at:end], end + 1
        tag = m[2].lower()
        if m[1]:
            _end(stack, tag)
            continue
        if stack.top.tag == "head" and tag not in _HEAD_ONLY:
            stack.pop()
        if tag in ("html", "body") and stack.last(tag):
            continue
        if tag in _CLOSES:
            stack.close(*_CLOSES[tag])
        _imply(stack, tag)
        node = Node(tag, _attributes(raw) if raw.strip() else {})
        stack.top.children.append(node)
        if tag in _VOID:
            continue
        if tag in _RAW:
            close = re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.I).search(page, at)
            raw = page[at : close.start() if close else n]
            node.children.append(html.unescape(raw) if tag in ("textarea", "title") else raw)
            at = close.end() if close else n
            continue
        stack.push(node)
    return root


def _before_table(stack: _Stack) -> list | _Insert:
    serial = stack.last("table")
    if not serial:
        return stack.top.children
    i = bisect_left(stack.serials, serial)
    return _Insert(stack.nodes[i - 1].children, stack.nodes[i])


class _Insert:
    """Appends in front of a node that is a list's member."""

    def __init__(self, children: list, before: Node):
        self.children, self.before = children, before

    def append(self, text: str) -> None:
        at = len(self.children) - 1
        while at > 0 and self.children[at] is not self.before:
            at -= 1
        self.children.insert(max(at, 0), text)


def _imply(stack: _Stack, tag: str) -> None:
    """Opens the row that a cell needs and the table part that a row needs."""
    if tag in _CELLS and stack.top.tag in ("table", *_SECTIONS):
        row = Node("tr")
        stack.top.children.append(row)
        stack.push(row)


def _end(stack: _Stack, tag: str) -> None:
    if tag == "br":
        stack.top.children.append(Node("br"))
        return
    inner = tag not in ("table", "body", "html", "tr", "caption") and tag not in _CELLS | _SECTIONS
    serial = stack.last(tag)
    if serial and not (inner and any(stack.last(b) > serial for b in ("table", "td", "th"))):
        style = tag not in _BLOCK | _CELLS | _SECTIONS | {"tr", "select"}
        if style and stack.blocks and stack.blocks[-1] > serial:
            stack.drop(tag)  # the end of a style inside a block does not end the block
        else:
            stack.cut(serial)
        return
    if tag == "p":  # a stray end tag stands for an empty paragraph
        stack.top.children.append(Node("p"))


class _Styles:
    """What a page's own style sheets say of display and visibility, by simple selector."""

    def __init__(self, root: Node):
        #: (tag, class or id, property) -> (rank, value); what comes later wins among equals
        self.rules: dict[tuple[str, str, str], tuple[tuple, str]] = {}
        todo: list = [root]
        while todo:
            node = todo.pop()
            if node.tag == "style":
                self._read("".join(c for c in node.children if isinstance(c, str)))
            todo.extend(c for c in reversed(node.children) if not isinstance(c, str))

    def _read(self, sheet: str) -> None:
        sheet = _CSS_COMMENT.sub(" ", sheet)
        depth, at, prelude, body = 0, 0, "", 0
        for m in re.finditer(r"[{}]", sheet):
            if m[0] == "{":
                depth += 1
                if depth == 1:
                    prelude, body = sheet[at : m.start()].rsplit(";", 1)[-1].strip(), m.end()
                continue
            if depth == 1 and prelude[:1] != "@":
                self._rule(prelude, sheet[body : m.start()])
            depth = max(0, depth - 1)
            at = m.end()

    def _rule(self, prelude: str, body: str) -> None:
        said = _DECLARATION.findall(body)
        for selector in prelude.split(",") if said else ():
            m = _SELECTOR.fullmatch(selector.strip())
            if not m or not m[0]:
                continue
            tag, part = (m[1] or "").lower().replace("*", ""), m[2] or ""
            for name, value, important in said:
                rank = (bool(important), False, part[:1] == "#", part[:1] == ".", bool(tag))
                key = (tag, part, name.lower())
                if key not in self.rules or self.rules[key][0] <= rank:
                    self.rules[key] = (rank, value.lower())

    def of(self, node: Node) -> dict[str, str]:
        """The node's own display and visibility."""
        best: dict[str, tuple[tuple, str]] = {}
        a = node.attributes
        if self.rules:
            parts = ["", *("." + c for c in a.get("class", "").split()), "#" + a.get("id", "").strip()]
            for name in ("display", "visibility"):
                for part in parts:
                    for tag in ("", node.tag):
                        rule = self.rules.get((tag, part, name))
                        if rule and (name not in best or best[name][0] <= rule[0]):
                            best[name] = rule
        for name, value, important in _DECLARATION.findall(a.get("style", "")):
            rank = (bool(important), True, False, False, False)
            if name.lower() not in best or best[name.lower()][0] <= rank:
                best[name.lower()] = (rank, value.lower())
        return {name: value for name, (_, value) in best.items()}


def _shown(node: Node, display: str | None) -> bool:
    a = node.attributes
    if node.tag in _UNSEEN or "hidden" in a or (node.tag == "dialog" and "open" not in a):
        return False
    return display != "none"


def _selected(node: Node) -> list:
    """The children of a drop-down's selected option, or else of its first."""
    options, todo = [], [node]
    while todo:
        here = todo.pop()
        if here.tag == "option":
            options.append(here)
        todo.extend(c for c in reversed(here.children) if not isinstance(c, str))
    chosen = [o for o in options if "selected" in o.attributes][-1:] or options[:1]
    return chosen[0].children if chosen else []


def _number(text: str, otherwise: int) -> int:
    return int(text) if re.fullmatch(r"-?[0-9]{1,9}", text) else otherwise


class _Flow:
    """Text under construction: lines, the open line, and the space and breaks that are due."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.line: list[str] = []
        self.space = False
        self.gap = 0  # empty lines due before the next text
        self.mark = ""  # the item's mark, before its first text

    def text(self, raw: str, indent: str, keep: bool) -> None:
        if keep:
            parts = raw.replace("\r\n", "\n").split("\n")
            for k, part in enumerate(parts):
                if k:
                    self.break_line(indent, force=True)
                if part:
                    self._put(part, indent)
            return
        words = _SPACES.sub(" ", raw)
        if words[:1] == " ":
            self.space = True
            words = words[1:]
        if not words:
            return
        trail = words[-1] == " "
        self._put(words[:-1] if trail else words, indent)
        self.space = trail

    def _put(self, text: str, indent: str) -> None:
        if not self.line:
            if self.lines and self.gap:
                self.lines.extend([""] * self.gap)
            self.gap = 0
            self.line.append(indent + self.mark)
            self.mark = ""
        elif self.space:
            self.line.append(" ")
        self.space = False
        self.line.append(text)

    def break_line(self, indent: str = "", force: bool = False) -> None:
        self.space = False
        if self.line:
            self.lines.append("".join(self.line).rstrip())
            self.line = []
        elif force and self.lines:
            self.lines.append("")

    def block(self, apart: bool) -> None:
        self.break_line()
        if apart:
            self.gap = 1

    def result(self) -> str:
        self.break_line()
        while self.lines and not self.lines[-1]:
            self.lines.pop()
        return "\n".join(self.lines)


def _width(text: str) -> int:
    return sum(2 if unicodedata.east_asian_width(c) in "WF" else not unicodedata.combining(c) for c in text) if not text.isascii() else len(text)


def _place(rows: list[list[tuple[str, int, int]]]) -> list[list[tuple[int, str, int]]]:
    """Rows of (column, text, columns spanned) from rows of (text, columns, rows spanned)."""
    out = []
    until: dict[int, int] = {}  # the row from which a column is free again
    for r, row in enumerate(rows):
        at, placed = 0, []
        for text, span, down in row:
            while until.get(at, 0) > r:
                at += 1
            placed.append((at, text, span))
            if down > 1:
                until.update((c, r + down) for c in range(at, min(at + span, _GRID)))
            at += span
        out.append(placed)
    return out


def _table(rows: list[list[tuple[str, int, int]]]) -> list[str]:
    """Lines of a table of (text, columns spanned, rows spanned) cells; rows without text go."""
    placed = [row for row in _place(rows) if any(text for _, text, _ in row)]
    widths: dict[int, int] = {}
    for row in placed:
        for at, text, span in row:
            if span == 1:
                widths[at] = max(widths.get(at, 0), min(_PAD, max(_width(x) for x in text.split("\n"))))
    columns = sorted(widths)
    total = list(accumulate((widths[c] for c in columns), initial=0))
    out = []
    for row in placed:
        cells, at = [], 0
        for column, text, span in row:
            a, b, c = (bisect_left(columns, x) for x in (at, column, column + span))
            cells += [([], widths[columns[k]]) for k in range(a, b)]  # under cells of earlier rows
            cells.append((text.split("\n"), min(_PAD, total[c] - total[b] + 3 * max(0, c - b - 1))))
            at = column + span
        for k in range(max((len(lines) for lines, _ in cells), default=0)):
            line = []
            for lines, room in cells:
                own = lines[k] if k < len(lines) else ""
                line.append(own + " " * max(0, room - _width(own)))
            out.append(" | ".join(line).rstrip())
    return out


def render(root: Node) -> str:
    """The visible text of a tree, without recursion."""
    styles = _Styles(root)
    flows = [_Flow()]
    tables: list[list[list[tuple[str, int, int]]] | None] = []  # None: too deep, laid out as blocks
    lists: list[list] = []  # [ordered, next number, indent of its items' text]
    seen = [True]  # visibility, which children inherit
    keep = 0
    todo: list = [(root, False)]
    while todo:
        node, leaving = todo.pop()
        flow = flows[-1]
        indent = lists[-1][2] if lists else ""
        if isinstance(node, str):
            if seen[-1]:
                flow.text(node, "" if flow.mark else indent, keep > 0)
            continue
        tag = node.tag
        if not leaving:
            style = styles.of(node) if styles.rules or "style" in node.attributes else {}
            if not _shown(node, style.get("display")):
                continue
            visibility = style.get("visibility", "inherit")
            now = seen[-1] if visibility == "inherit" else visibility not in ("hidden", "collapse")
            if tag == "br":
                flow.break_line(force=True)
                continue
            if tag == "input":
                value = node.attributes.get("value", "")
                if now and value and node.attributes.get("type", "text").strip().lower() not in _MUTE:
                    flow.text(value, "" if flow.mark else indent, False)
                continue
            seen.append(now)
            if tag in _CELLS and tables and tables[-1]:
                flows.append(_Flow())
                lists.append([False, 0, ""])
            elif tag == "tr" and tables and tables[-1] is not None:
                tables[-1].append([])
            elif tag == "table":
                flow.block(True)
                tables.append([] if len(tables) < _NESTED else None)
            elif tag in _CELLS or tag == "tr":
                flow.block(False)
            elif tag in _BLOCK:
                # an item's mark waits for its first text, so nothing breaks between them
                if not flow.mark:
                    flow.block(tag in _APART and not (tag in ("ul", "ol", "menu") and lists))
                if tag in ("ul", "ol", "menu", "dir"):
                    lists.append([tag == "ol", _number(node.attributes.get("start", ""), 1), indent])
                elif tag == "li":
                    top = lists[-1] if lists else [False, 1, ""]
                    top[1] = _number(node.attributes.get("value", ""), top[1])
                    mark = f"{top[1]}. " if top[0] else "- "
                    top[1] += 1
                    flow.mark = indent + mark
                    lists.append([False, 1, (indent + " " * len(mark))[:_INDENT]])
                elif tag in ("blockquote", "dd"):
                    lists.append([False, 1, (indent + "  ")[:_INDENT]])
            keep += tag in ("pre", "textarea")
            todo.append((node, True))
            children = node.children
            if tag == "select" and "multiple" not in node.attributes and _number(node.attributes.get("size", ""), 1) < 2:
                children = _selected(node)
            if tag == "details" and "open" not in node.attributes:
                children = [c for c in children if isinstance(c, Node) and c.tag == "summary"][:1]
            if tag == "pre" and children and isinstance(children[0], str) and children[0][:1] == "\n":
                children = [children[0][1:], *children[1:]]
            todo.extend((c, False) for c in reversed(children))
            continue
        seen.pop()
        keep -= tag in ("pre", "textarea")
        if tag in _CELLS and len(flows) > 1 and tables and tables[-1]:
            text = flows.pop().result()
            lists.pop()
            span, down = (_number(node.attributes.get(name, ""), 1) for name in ("colspan", "rowspan"))
            # 0 rows: to the table's end
            tables[-1][-1].append((text, min(1000, max(1, span)), min(65534, down) if down > 0 else 65534 if down == 0 else 1))
        elif tag == "table" and tables:
            outer = lists[-1][2] if lists else ""
            for line in _table(tables.pop() or []):
                flow.break_line()
                flow.text(line, outer, True)
            flow.block(True)
        elif tag in _CELLS or tag == "tr":
            flow.block(False)
        elif tag in _BLOCK:
            if tag in ("ul", "ol", "menu", "dir", "li", "blockquote", "dd"):
                lists.pop()
                if tag == "li":
                    flow.mark = ""
            flow.block(tag in _APART and not (tag in ("ul", "ol", "menu") and lists))
    return flows[0].result()


def extract(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", keep: tuple[str, ...] = ()) -> DataFrame:
    """(id_col, ``keep``, page_text, n_lines) of every page."""
    cols = pages.select(id_col, *keep, pages[html_col].alias("_html"))
    schema = cols.drop("_html").schema.add("page_text", "string").add("n_lines", "long")

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            source = batch.column(batch.schema.get_field_index("_html"))
            for a in range(0, batch.num_rows, 256):
                part = batch.slice(a, 256)
                texts = [render(parse(source[a + i].as_py() or "")) for i in range(part.num_rows)]
                rest = [part.column(i) for i, name in enumerate(part.schema.names) if name != "_html"]
                lines = pa.array([t.count("\n") + 1 if t else 0 for t in texts], pa.int64())
                yield pa.RecordBatch.from_arrays([*rest, pa.array(texts, pa.string()), lines], names=schema.names)

    return cols.mapInArrow(apply, schema)
