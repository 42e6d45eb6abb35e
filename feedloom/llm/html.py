"""Text of HTML pages, laid out as a browser would show it.

``parse`` builds a tree: implied end tags (``</p>`` before a block, ``</li>``,
``</td>`` and so on), implied table parts, void elements, raw-text elements,
stray end tags.  ``render`` walks it without recursion (except into table
cells) and emits all visible text: blocks on lines of their own with blank
lines around paragraphs, headings, lists, tables, quotes and preformatted
text; white space collapsed but in ``pre``; list markers with nesting;
table cells in columns.  Elements are hidden by their kind (head, script,
style, template ...), ``hidden``, ``display: none``, closed ``details`` and
``dialog``; ``visibility: hidden`` hides text until a descendant is visible,
through sections, rows and cells of tables too; ``collapse`` takes out a row or
section of a table.  Of drawings the text elements and foreign objects are
shown, of formulas everything but their annotations.

Scale: one pass that moves no rows; time is linear in the page (no pattern
can backtrack over it twice), memory is that of one batch of pages.

Defined results: a null or empty page has an empty text and title; markup
that never closes ends with the page; a column is padded to its widest cell
up to ``COLUMN`` characters; a longer line keeps its whole text, and the cells
right of it begin in the line below, at their columns; a cell of several columns
takes the place of the first;
tables nested deeper than ``NESTED`` are shown as plain lines, lists and
quotes are indented by at most ``INDENT`` characters; repeated rows
and null ids are kept; an empty table gives no rows; extra columns, whatever
their names, are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm.text import slices

COLUMN = 60
INDENT = 80
NESTED = 32

# Element kinds of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style xmp iframe noembed noframes noscript textarea title".split())
HIDDEN = frozenset("""head title script style template noscript iframe noembed noframes datalist audio video
                      canvas object param rp map""".split())
BLOCKS = frozenset("""address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption
                      figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup
                      option p pre search section summary table ul xmp caption tbody thead tfoot tr td th""".split())
SPACED = frozenset("blockquote dl figure h1 h2 h3 h4 h5 h6 hr ol p pre table ul menu dir fieldset xmp".split())
CLOSES_P = BLOCKS - frozenset("body caption html legend optgroup option tbody td tfoot th thead tr".split())
# What a start tag ends, if open, and the elements beyond which it doesn't look.
ENDS = {
    "li": (("li",), ("ul", "ol", "menu", "dir")),
    "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
    "option": (("option",), ("select", "datalist")), "optgroup": (("option", "optgroup"), ("select",)),
    "td": (("td", "th"), ("table",)), "th": (("td", "th"), ("table",)),
    "tr": (("tr", "caption", "colgroup"), ("table",)),
    "tbody": (("tbody", "thead", "tfoot", "caption", "colgroup"), ("table",)),
    "thead": (("tbody", "thead", "tfoot", "caption", "colgroup"), ("table",)),
    "tfoot": (("tbody", "thead", "tfoot", "caption", "colgroup"), ("table",)),
    "body": (("head",), ("html",)),
}
SCOPE = frozenset("table td th caption html button object".split())
# Start tags that end a drawing or formula, elements of these that hold ordinary
# text or markup, and parts of drawings and formulas that are never shown.
BREAKS = frozenset("""b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li
                      listing menu meta nobr ol p pre ruby s small span strong strike sub sup table tt u ul
                      var""".split())
INSIDE = frozenset("svg math foreignobject desc title mi mo mn ms mtext annotation-xml".split())
UNDRAWN = frozenset("""defs symbol desc metadata clippath mask pattern marker lineargradient radialgradient filter
                       annotation annotation-xml""".split())
SECTIONS = frozenset("tbody thead tfoot".split())

_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*)((?:=\s*"[^"]*+"|=\s*'[^']*+'|[^>])*+)>""")
_PLAIN = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*+)>")
_ATTR = re.compile(r"""([^\s=/"'>][^\s=/>]*)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]*))?""")
_DISPLAY = re.compile(r"(?<![\w-])display\s*:\s*([\w-]+)", re.I)
_VISIBILITY = re.compile(r"(?<![\w-])visibility\s*:\s*(hidden|collapse|visible)", re.I)
_SPACE = re.compile(r"[ \t\n\f\r]+")
_ENDS_RAW: dict[str, re.Pattern] = {}


class Node:
    __slots__ = ("tag", "attrs", "children")

    def __init__(self, tag: str, attrs: dict[str, str] | None = None):
        self.tag, self.attrs, self.children = tag, attrs or {}, []


def _attributes(text: str) -> dict[str, str]:
    if not text or text.isspace():
        return {}
    out: dict[str, str] = {}
    for m in _ATTR.finditer(text):
        value = m.group(2) or ""
        if value[:1] in ("'", '"'):
            value = value[1:-1]
        out.setdefault(m.group(1).lower(), unescape(value) if "&" in value else value)
    return out


class _Builder:
    def __init__(self):
        self.root = Node("html")
        self.open = [self.root]
        self.count: dict[str, int] = {}  # open elements by tag
        self.inside: list[int] = []  # stack places of open drawings, formulas and what holds markup in them

    def text(self, s: str) -> None:
        if s:
            self.open[-1].children.append(s)

    def _pop_to(self, at: int) -> None:
        for node in self.open[at:]:
            self.count[node.tag] -= 1
        del self.open[at:]
        while self.inside and self.inside[-1] >= at:
            self.inside.pop()

    def drawing(self) -> bool:
        """Whether a drawing or formula is open, and no part that holds markup."""
        return bool(self.inside) and self.open[self.inside[-1]].tag in ("svg", "math")

    def _find(self, tags, stops) -> int:
        """Stack place of the nearest of ``tags`` before any of ``stops``."""
        if not any(self.count.get(t) for t in tags):
            return 0
        for i in range(len(self.open) - 1, 0, -1):
            tag = self.open[i].tag
            if tag in tags:
                return i
            if tag in stops:
                break
        return 0

    def start(self, tag: str, attrs: dict[str, str], closed: bool) -> None:
        if tag in ("html",):
            self.root.attrs |= {k: v for k, v in attrs.items() if k not in self.root.attrs}
            return
        while tag in BREAKS and self.drawing():
            self._pop_to(self.inside[-1])
        if tag in CLOSES_P:
            at = self._find(("p",), SCOPE)
            if at:
                self._pop_to(at)
        if tag in ENDS:
            tags, stops = ENDS[tag]
            while at := self._find(tags, stops):
                self._pop_to(at)
                if tag not in ("tbody", "thead", "tfoot", "tr", "optgroup"):
                    break
        if tag in ("td", "th", "tr") and self._find(("table",), ()):
            near = next(n.tag for n in reversed(self.open) if n.tag in ("table", "tbody", "thead", "tfoot", "tr"))
            if near == "table":
                self._push(Node("tbody"))
            if tag != "tr" and near != "tr":
                self._push(Node("tr"))
        if tag in VOID or closed:
            self.open[-1].children.append(Node(tag, attrs))
        else:
            self._push(Node(tag, attrs))

    def _push(self, node: Node) -> None:
        self.open[-1].children.append(node)
        if node.tag in INSIDE:
            self.inside.append(len(self.open))
        self.open.append(node)
        self.count[node.tag] = self.count.get(node.tag, 0) + 1

    def end(self, tag: str) -> None:
        if tag == "br":
            self.start("br", {}, True)
            return
        if tag in ("body", "html") or tag in VOID:
            return  # text after </body> still belongs to the page
        if tag in BLOCKS or tag in HIDDEN or tag in ("table", "select", "button", "svg", "math"):
            stops = () if tag in ("table", "head") else ("table",) if tag in (
                "td", "th", "tr", "tbody", "thead", "tfoot", "caption") else SCOPE - {tag}
            at = self._find((tag,), stops)
        else:
            at = self._find((tag,), BLOCKS)  # an inline end tag doesn't close blocks
        if at:
            self._pop_to(at)
        elif tag == "p":
            self.start("p", {}, True)


def _raw_end(tag: str) -> re.Pattern:
    if tag not in _ENDS_RAW:
        _ENDS_RAW[tag] = re.compile(rf"</{tag}(?=[\s/>])[^>]*+>?", re.I)
    return _ENDS_RAW[tag]


def parse(page: str) -> Node:
    """The tree of a page."""
    b, pos, n, pattern = _Builder(), 0, len(page), _TAG
    while pos < n:
        at = page.find("<", pos)
        if at < 0:
            at = n
        if at > pos:
            piece = page[pos:at]
            b.text(unescape(piece) if "&" in piece else piece)
            pos = at
        if pos >= n:
            break
        after = page[pos + 1:pos + 2]
        if after == "!":
            if page.startswith("<!--", pos):
                shut = page.find("-->", pos + 2)  # "<!-->" is a whole comment
                pos = shut + 3 if shut >= 0 else n
            else:
                pos = page.find(">", pos) + 1 or n
            continue
        if after == "?" or (after == "/" and not page[pos + 2:pos + 3].isalpha()):
            pos = page.find(">", pos) + 1 or n
            continue
        if not after.isascii() or not after.isalpha() and after != "/":
            b.text("<")
            pos += 1
            continue
        m = pattern.match(page, pos)
        if m is None and pattern is _TAG:
            pattern = _PLAIN  # a quote that never closes: quotes no longer count
            m = pattern.match(page, pos)
        if m is None:
            break  # the tag never ends
        pos = m.end()
        tag = m.group(2).lower()
        if m.group(1):
            b.end(tag)
            continue
        rest = m.group(3)
        closed = rest.endswith("/") and (tag in ("svg", "math", "path") or b.drawing())
        b.start(tag, _attributes(rest), closed)
        if not closed and (tag in RAW or tag == "plaintext"):
            done = None if tag == "plaintext" else _raw_end(tag).search(page, pos)
            body = page[pos:done.start() if done else n]
            b.text(unescape(body) if tag in ("textarea", "title") and "&" in body else body)
            pos = done.end() if done else n
            b.end(tag)
    return b.root


def _hides(node: Node) -> bool:
    a = node.attrs
    if node.tag in HIDDEN or "hidden" in a or (node.tag == "dialog" and "open" not in a):
        return True
    style = a.get("style")
    return bool(style) and _last(_DISPLAY, style) == "none"


def _last(pattern: re.Pattern, style: str) -> str:
    """The last value of a property in a style: it is the one that counts."""
    found = pattern.findall(style)
    return found[-1].lower() if found else ""


def _visibility(node: Node) -> str:
    """visible, hidden, collapse, or nothing where the element doesn't say."""
    style = node.attrs.get("style")
    return _last(_VISIBILITY, style) if style else ""


def _shown(node: Node, around: bool) -> bool:
    said = _visibility(node)
    return said == "visible" if said else around


class _Page:
    """Lines so far, with the indent and markers of the open lists."""

    def __init__(self):
        self.lines: list[str] = []
        self.line: list[str] = []
        self.space = False   # a collapsed space is due before the next text
        self.gap = 0         # blank lines due before the next line
        self.indents = [""]
        self.marker = ""

    def indent(self, by: int) -> None:
        last = self.indents[-1]
        self.indents.append(last + " " * by if len(last) + by <= INDENT else last)

    def text(self, s: str) -> None:
        parts = _SPACE.sub(" ", s)
        lead, core, tail = parts[:1] == " ", parts.strip(" "), parts[-1:] == " "
        if not core:
            self.space = self.space or bool(self.line) and bool(parts)
            return
        if self.line and (self.space or lead):
            self.line.append(" ")
        self.line.append(core)
        self.space = tail

    def verbatim(self, s: str) -> None:
        first, *more = s.replace("\r\n", "\n").replace("\r", "\n").split("\n")
        self.line.append(first)
        for x in more:
            self.flush(keep=True)
            self.line.append(x)

    def flush(self, keep: bool = False) -> None:
        """End the line; ``keep`` also ends an empty one."""
        s = "".join(self.line)
        if s or keep or self.marker:
            if self.lines:
                self.lines.extend([""] * self.gap)
            indent = self.indents[-1]
            if self.marker:
                indent, self.marker = indent[:max(0, len(indent) - len(self.marker))] + self.marker, ""
            self.lines.append((indent + s).rstrip())
            self.gap = 0
        self.line, self.space = [], False

    def block(self, spaced: bool) -> None:
        if self.line:
            self.flush()
        if spaced and not self.marker:
            self.gap = max(self.gap, 1)


def _number(text: str | None, default: int, most: int) -> int:
    try:
        return min(max(int(text), 1), most) if text else default
    except ValueError:
        return default


def _as(item, shown: bool, around: bool):
    """An item that stands below an element of other visibility than ``around``."""
    if shown == around:
        return item
    node = Node("span", {"style": "visibility:" + ("visible" if shown else "hidden")})
    node.children.append(item)
    return node


def _rows(table: Node, shown: bool):
    """(what stands outside cells, rows of (cell, whether it is shown)) of a table.
    Parts without display are left out; of collapsed rows the cells are None for shown."""
    captions, rows, loose, stack = [], [], [], [(iter(table.children), shown, False)]
    while stack:
        children, seen, gone = stack[-1]
        child = next(children, None)
        if child is None:
            stack.pop()
        elif isinstance(child, str):
            if child.strip():
                loose.append(_as(child, seen, shown))
        elif _hides(child):
            continue
        elif child.tag == "caption":
            captions.append(_as(child, seen, shown))
        elif child.tag in SECTIONS:
            stack.append((iter(child.children), _shown(child, seen), gone or _visibility(child) == "collapse"))
        elif child.tag == "tr":
            row, out, cells = _shown(child, seen), gone or _visibility(child) == "collapse", []
            for c in child.children:
                if isinstance(c, Node) and c.tag in ("td", "th"):
                    if not _hides(c):
                        cells.append((c, None if out else _shown(c, row)))
                elif isinstance(c, Node) or c.strip():
                    loose.append(_as(c, row, shown))
            rows.append(cells)
        else:
            loose.append(_as(child, seen, shown))
    return [*loose, *captions], rows


def _table(page: _Page, table: Node, depth: int, shown: bool) -> None:
    outside = Node("div")
    outside.children, rows = _rows(table, shown)
    _walk(page, outside, depth, shown)
    page.block(False)
    laid, widths, taken = [], {}, {}
    for cells in rows:
        at, line = 0, []
        for cell, seen in cells:
            while taken.get(at, 0) > 0:
                at += 1
            across = _number(cell.attrs.get("colspan"), 1, 1000)
            down = _number(cell.attrs.get("rowspan"), 1, 65534)
            lines = [] if seen is None else _lines(cell, depth + 1, seen)
            line.append((at, lines))
            wide = max(map(len, lines), default=0)
            widths[at] = max(widths.get(at, 0), min(wide, COLUMN) if across == 1 else 0)
            if down > 1:
                for c in range(at, at + across):
                    taken[c] = down
            at += across
        laid.append(line)
        taken = {c: d - 1 for c, d in taken.items() if d > 1}
    begins, x = {}, 0
    for c in sorted(widths):
        begins[c] = x
        x += widths[c] + 2
    for line in laid:
        for k in range(max((len(lines) for _, lines in line), default=0)):
            s = ""
            for at, lines in line:
                if k < len(lines) and lines[k]:
                    if s and len(s) + 2 > begins[at]:  # a line longer than its column
                        page.line.append(s)
                        page.flush()
                        s = ""
                    s = s.ljust(begins[at]) + lines[k]
            if s:
                page.line.append(s)
                page.flush()


def _spaced(tag: str, parent: str) -> bool:
    """Whether blank lines set the element off; a list in an item has none."""
    return tag in SPACED and not (parent == "li" and tag in ("ul", "ol", "menu", "dir"))


def _lines(node: Node, depth: int, shown: bool = True) -> list[str]:
    page = _Page()
    _walk(page, node, depth, shown)
    page.flush()
    return page.lines


def _walk(page: _Page, top: Node, depth: int, shown: bool = True) -> None:
    """Emit the visible text below ``top``."""
    # Frames: children, tag, verbatim, shown, list counter [kind, next number, step] or None,
    # and "svg" among shapes, "text" in text or formulas.
    stack = [(iter(top.children), "", False, shown, None, "")]
    while stack:
        children, tag, pre, seen, counter, art = stack[-1]
        child = next(children, None)
        if child is None:
            stack.pop()
            if tag in BLOCKS:
                page.block(_spaced(tag, stack[-1][1] if stack else ""))
            if tag in ("ul", "ol", "menu", "dir", "li", "blockquote", "dd"):
                if tag == "li" and page.marker:
                    page.flush(keep=True)  # an item without text still has its marker
                page.indents.pop()
            elif tag in ("td", "th") or art and tag == "text":
                page.space = True
            continue
        if isinstance(child, str):
            if seen and art != "svg":
                page.verbatim(child) if pre else page.text(child)
            continue
        kind = child.tag
        if _hides(child):
            continue
        seen = _shown(child, seen)
        if kind == "svg":
            art = "svg"
        elif kind == "math":
            art = "text"
        elif art:
            said = child.attrs
            if kind in UNDRAWN or said.get("display") == "none":
                continue
            if "visibility" in said and not _visibility(child):
                seen = said["visibility"] == "visible"
            if kind == "text":
                page.space, art = bool(page.line), "text"
            elif kind == "foreignobject":
                art = ""
        if kind == "br":
            page.flush(keep=True)
            continue
        if kind == "wbr" or kind == "img":
            continue
        if kind == "input":
            if seen and child.attrs.get("type", "").lower() in ("submit", "button", "reset"):
                page.text(child.attrs.get("value", ""))
            continue
        if kind in BLOCKS and not (kind in ("td", "th") and tag == "tr"):
            page.block(_spaced(kind, tag))
        if kind == "table" and depth < NESTED:
            _table(page, child, depth, seen)
            page.block(True)
            continue
        number = None
        if kind in ("ol", "ul", "menu", "dir"):
            items = sum(1 for c in child.children if isinstance(c, Node) and c.tag == "li")
            back = kind == "ol" and "reversed" in child.attrs
            try:
                first = int(child.attrs.get("start", ""))
            except ValueError:
                first = items if back else 1
            number = [kind, first, -1 if back else 1]
            page.indent(0)
        elif kind == "li":
            marker = "- "
            if counter is not None and counter[0] == "ol":
                try:
                    counter[1] = int(child.attrs.get("value", ""))
                except ValueError:
                    pass
                marker = f"{counter[1]}. "
                counter[1] += counter[2]
            if page.marker:
                page.flush(keep=True)
            page.indent(len(marker))
            page.marker = marker if seen else ""
        elif kind in ("blockquote", "dd"):
            page.indent(2)
        elif kind == "details" and "open" not in child.attrs:
            inner = next((c for c in child.children if isinstance(c, Node) and c.tag == "summary"), None)
            stack.append((iter([inner] if inner else []), kind, pre, seen, None, art))
            continue
        elif kind in ("td", "th"):
            page.space = bool(page.line)
        nodes = child.children
        if kind in ("pre", "xmp", "textarea", "plaintext"):
            if nodes and isinstance(nodes[0], str) and nodes[0].startswith("\n"):
                nodes = [nodes[0][1:], *nodes[1:]]
            if nodes and isinstance(nodes[-1], str) and nodes[-1].endswith("\n"):
                nodes = [*nodes[:-1], nodes[-1][:-1]]
        stack.append((iter(nodes), kind, pre or kind in ("pre", "xmp", "textarea", "plaintext"), seen, number, art))


def render(tree: Node) -> str:
    return "\n".join(_lines(tree, 0))


def title(tree: Node) -> str:
    """Text of the first title element."""
    stack = [tree]
    while stack:
        node = stack.pop()
        if node.tag == "title":
            return _SPACE.sub(" ", "".join(c for c in node.children if isinstance(c, str))).strip()
        stack.extend(c for c in reversed(node.children) if isinstance(c, Node) and c.tag != "svg")
    return ""


def extract_text(df: DataFrame, id_col: str, html_col: str) -> DataFrame:
    """(id, title, text, n_lines) of every row."""
    kind = dict(df.select(id_col).dtypes)[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "html"):
                titles, texts, lines = [], [], []
                for page in batch.column(1).to_pylist():
                    tree = parse(page or "")
                    found = _lines(tree, 0)
                    titles.append(title(tree))
                    texts.append("\n".join(found))
                    lines.append(len(found))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(titles, pa.string()), pa.array(texts, pa.string()),
                     pa.array(lines, pa.int64())], names=["id", "title", "text", "n_lines"])

    return (df.select(F.col(id_col).alias("id"), F.col(html_col).cast("string").alias("html"))
            .mapInArrow(run, f"id {kind}, title string, text string, n_lines long"))
