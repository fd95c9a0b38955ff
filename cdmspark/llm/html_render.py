"""HTML pages to text as a reader sees it: a tree builder with implied tags, visibility rules,
and a renderer that keeps block spacing, lists, preformatted text and aligned table cells.

Pages are independent rows, so one pass with no shuffle does. A page is parsed and rendered
whole; both walks keep their own stacks, so depth has no limit, and time and memory are in
proportion to the page (columns of a table are aligned up to a width, beyond which text just
runs on). All visible text is emitted, navigation and footers included; nothing is scored away.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from cdmspark.llm.common import or_null, read_table, struct_of

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Content is text up to the end tag; the last two have character references.
RAW = frozenset("script style xmp iframe noembed noframes textarea title".split())
REFERENCES = frozenset(("textarea", "title"))
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
#: A start tag of these ends an open paragraph.
ENDS_P = HEADINGS | frozenset(
    "address article aside blockquote center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "header hgroup hr li main menu nav ol p pre search section summary table ul".split())
#: Not shown: no boxes of their own, or only shown by scripts or players.
HIDDEN = frozenset("head script style template noscript title iframe object video audio canvas noembed noframes "
                   "datalist rp".split())
#: Inputs that are buttons, with the label of one without a value, and those that show no text; all others are fields.
BUTTONS = {"submit": "Submit", "reset": "Reset", "button": ""}
TEXTLESS = frozenset("hidden password checkbox radio range color file image".split())
#: Start tags that end an open select.
ENDS_SELECT = frozenset(("select", "input", "textarea"))
#: Their elements end with "/>"; of an svg only text elements (and HTML inside it) show text.
FOREIGN = frozenset(("svg", "math"))
SVG_TEXT, HTML_INSIDE = frozenset(("text", "foreignobject")), frozenset(("foreignobject", "desc"))
SVG_HIDDEN = frozenset("defs desc metadata symbol clippath mask marker pattern".split())
#: HTML start tags that end an open svg or math.
BREAKS_OUT = HEADINGS | frozenset(
    "b big blockquote body br center code dd div dl dt em embed head hr i img li listing menu meta nobr ol p pre ruby s "
    "small span strong strike sub sup table tt u ul var".split())
#: Of a formula, other forms of what is shown already.
MATH_HIDDEN = frozenset(("annotation", "annotation-xml"))
#: Blocks with a blank line around them, and blocks on lines of their own.
SPACED = HEADINGS | frozenset("p ul ol dl blockquote pre table figure hr menu dir xmp".split())
BLOCK = SPACED | ENDS_P | frozenset("html body caption legend optgroup textarea".split())
CELLS, SECTIONS = frozenset(("td", "th")), frozenset(("thead", "tbody", "tfoot"))
#: What an end tag, or an implied end, does not look beyond.
WALLS = frozenset("table td th caption template button object html".split())
#: Start tag -> what it ends, and where the search for that stops.
IMPLIED = {
    "li": (frozenset(("li",)), frozenset(("ul", "ol", "menu", "dir")) | WALLS),
    "dt": (frozenset(("dt", "dd")), frozenset(("dl",)) | WALLS), "dd": (frozenset(("dt", "dd")), frozenset(("dl",)) | WALLS),
    "td": (CELLS, frozenset(("tr", "table"))), "th": (CELLS, frozenset(("tr", "table"))),
    "tr": (frozenset(("tr", "caption", "colgroup")), frozenset(("table",))),
    **{s: (SECTIONS | {"caption", "colgroup"}, frozenset(("table",))) for s in SECTIONS},
    "option": (frozenset(("option",)), frozenset(("select", "datalist", "optgroup"))),
    "optgroup": (frozenset(("optgroup",)), frozenset(("select", "datalist"))),
    "body": (frozenset(("head",)), frozenset()),
    **{h: (HEADINGS, WALLS | frozenset(("div", "section", "article"))) for h in HEADINGS},
}
#: Columns are aligned up to this many characters; no text is cut.
ALIGN = 40
SPAN_LIMIT = 1000

# A quote opens a value only after "="; any other is part of a name or an unquoted value.
_NAME, _IS = r"[^ \t\n\f\r/>][^ \t\n\f\r/>=]*+", r"[ \t\n\f\r]*+=[ \t\n\f\r]*+"
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
                    rf"|<(/?)([a-zA-Z][^\s/>]*)((?:[ \t\n\f\r/]++|{_NAME}(?:{_IS}(?:\"[^\"]*+\"?+|'[^']*+'?+"
                    r"|[^ \t\n\f\r>\"'][^ \t\n\f\r>]*+)?+)?+)*+)(?:>|\Z)", re.S)
_ATTR = re.compile(rf"({_NAME})(?:{_IS}(?:\"([^\"]*+)\"?+|'([^']*+)'?+|([^ \t\n\f\r>\"'][^ \t\n\f\r>]*+))?+)?+")
_SPACE = re.compile(r"[ \t\n\f\r]+")
_UNSEEN = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse))\s*(?:!important\s*)?(?:;|$)", re.I)


class Node:
    __slots__ = ("attrs", "kids", "tag")

    def __init__(self, tag: str, attrs: dict | None = None):
        self.tag, self.attrs, self.kids = tag, attrs or {}, []


def _attributes(raw: str) -> dict:
    if not raw or raw.isspace() or raw == "/":
        return {}
    out: dict = {}
    for m in _ATTR.finditer(raw):
        out.setdefault(m[1].lower(), html.unescape(m[2] or m[3] or m[4] or ""))
    return out


def _closed(raw: str) -> bool:
    """Whether the tag ends with "/>", the slash being no part of an unquoted value."""
    if raw[-1:] != "/":
        return False
    end = 0
    for m in _ATTR.finditer(raw):
        end = m.end()
    return end < len(raw)


def _svg_text(svg: Node) -> list:
    """The elements of an svg that show text, in their order."""
    found, todo = [], list(reversed(svg.kids))
    while todo:
        node = todo.pop()
        if isinstance(node, Node) and node.tag not in SVG_HIDDEN and visible(node):
            if node.tag in SVG_TEXT:
                found += [" ", node, " "]
            else:
                todo += reversed(node.kids)
    return found


def _choice(select: Node) -> list:
    """What a select shows: its last selected option, else the first that can be chosen; a list
    box (several choices, or a size over 1) shows all its groups and options, a line each."""
    size = select.attrs.get("size", "").strip()
    box = "multiple" in select.attrs or (size.isascii() and size.isdigit() and int(size[-9:]) > 1)
    lines, chosen, first, todo = [], None, None, [(k, False, True) for k in reversed(select.kids)]
    while todo:
        node, off, seen = todo.pop()
        if not isinstance(node, Node):
            continue
        label = node.attrs.get("label", "")
        off, seen = off or "disabled" in node.attrs, seen and visible(node)
        if node.tag == "option":
            shown = Node("option")
            shown.kids = [label] if label else node.kids
            if seen:
                line = Node("div")
                line.kids = [shown]
                lines.append(line)
            chosen = shown if "selected" in node.attrs else chosen
            first = first or (None if off else shown)
            continue
        if node.tag == "optgroup" and label and seen:
            line = Node("div")
            line.kids = [label]
            lines.append(line)
        if node.tag not in HIDDEN:
            todo += [(k, off, seen) for k in reversed(node.kids)]
    if box:
        return lines
    chosen = chosen or first
    return [" ", chosen, " "] if chosen else []


def _field(node: Node) -> str:
    """The text that an input shows: a button's label, a field's value or placeholder."""
    kind = node.attrs.get("type", "").strip().lower()
    if kind in TEXTLESS:
        return ""
    value = node.attrs.get("value", "")
    if kind in BUTTONS:
        return value if "value" in node.attrs else BUTTONS[kind]
    return value or node.attrs.get("placeholder", "")


class Builder:
    """Tree of a page, with missing end tags, rows and paragraphs implied."""

    def __init__(self):
        self.root = Node("html")
        self.open = [self.root]
        self.count = {"html": 1}
        self.realm: list[str] = []

    def _pop(self) -> None:
        tag = self.open.pop().tag
        self.count[tag] -= 1
        if tag in FOREIGN or tag in HTML_INSIDE:
            self.realm.pop()

    def _end(self, tags: frozenset, walls: frozenset) -> bool:
        """Ends the nearest open element of ``tags`` unless a wall stands before it."""
        if not any(self.count.get(t) for t in tags):
            return False
        for i in range(len(self.open) - 1, 0, -1):
            tag = self.open[i].tag
            if tag in tags:
                while len(self.open) > i:
                    self._pop()
                return True
            if tag in walls:
                return False
        return False

    def _push(self, node: Node) -> None:
        self.open[-1].kids.append(node)
        self.open.append(node)
        self.count[node.tag] = self.count.get(node.tag, 0) + 1
        if node.tag in FOREIGN or node.tag in HTML_INSIDE:
            self.realm.append(node.tag)

    def foreign(self) -> bool:
        """Whether the place is inside an svg or math, and not in HTML inside an svg."""
        return bool(self.realm) and self.realm[-1] in FOREIGN

    def start(self, tag: str, attrs: dict, closed: bool = False) -> None:
        while tag in BREAKS_OUT and self.foreign():
            self._end(FOREIGN, frozenset())
        if tag in ("html", "body") and (tag == "html" or self.count.get("body")):
            (self.root if tag == "html" else next(n for n in self.open if n.tag == "body")).attrs.update(attrs)
            return
        if tag in ENDS_SELECT and self.count.get("select") and self._end(frozenset(("select",)), WALLS) and tag == "select":
            return
        if tag == "optgroup":
            self._end(*IMPLIED["option"])
        if tag in ENDS_P and self.count.get("p"):
            self._end(frozenset(("p",)), WALLS)
        if tag in IMPLIED:
            if (tag in CELLS or tag == "tr" or tag in SECTIONS) and not self.count.get("table"):
                return  # a cell or row outside of any table is no element
            ends, walls = IMPLIED[tag]
            self._end(ends, walls)
            if tag in CELLS and self.open[-1].tag != "tr":
                self._end(frozenset(("caption", "colgroup")), frozenset(("table",)))
                if self.open[-1].tag in SECTIONS or self.open[-1].tag == "table":
                    self._push(Node("tr"))
        elif tag == "a" and self.count.get("a"):
            self._end(frozenset(("a",)), WALLS)
        if self.open[-1].tag == "head" and tag not in ("title", "meta", "link", "style", "script", "base", "noscript", "template"):
            self._pop()
        node = Node(tag, attrs)
        if tag in VOID or (closed and (tag in FOREIGN or self.foreign())):
            self.open[-1].kids.append(node)
        else:
            self._push(node)

    def end(self, tag: str) -> None:
        if tag == "br":
            self.open[-1].kids.append(Node("br"))
        elif tag == "p" and not self.count.get("p"):
            self.open[-1].kids.append(Node("p"))
        elif tag in HEADINGS:
            self._end(HEADINGS, WALLS)
        elif tag not in ("html", "body"):  # what follows still belongs to the page
            self._end(frozenset((tag,)), frozenset() if tag in WALLS or tag in SECTIONS or tag == "tr" else WALLS)

    def text(self, s: str) -> None:
        if s:
            if self.open[-1].tag == "head" and not s.isspace():
                self._pop()
            self.open[-1].kids.append(s)


def parse(page: str) -> Node:
    b, at, n = Builder(), 0, len(page)
    while at < n:
        m = _TOKEN.search(page, at)
        if m is None:
            b.text(html.unescape(page[at:]))
            break
        if m.start() > at:
            b.text(html.unescape(page[at:m.start()]))
        at = m.end()
        if m[2] is None:
            if m[0].startswith("<![CDATA["):
                b.text(m[0][9:].removesuffix("]]>"))
            continue
        tag = m[2].lower()
        if m[1]:
            b.end(tag)
            continue
        closed = _closed(m[3])
        b.start(tag, _attributes(m[3]), closed)
        if tag in RAW and not (closed and b.foreign()):
            close = re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.I).search(page, at)
            inner, at = (page[at:close.start()], close.end()) if close else (page[at:], n)
            b.text(html.unescape(inner) if tag in REFERENCES else inner)
            b.end(tag)
    return b.root


def visible(node: Node) -> bool:
    a = node.attrs
    if node.tag in HIDDEN or node.tag in MATH_HIDDEN or ("hidden" in a and a["hidden"].lower() != "until-found"):
        return False
    if node.tag == "dialog" and "open" not in a:
        return False
    return not ("style" in a and _UNSEEN.search(a["style"]))


class Flow:
    """Lines of a block container: collapsed spaces, blank lines between blocks, indents, markers."""

    def __init__(self):
        self.lines, self.line, self.gap, self.space = [], [], 0, False
        self.indent, self.marker = [], None

    def _prefix(self) -> str:
        if self.marker is None:
            return "".join(self.indent)
        head, self.marker = "".join(self.indent[:-1]) + self.marker, None
        return head

    def text(self, s: str) -> None:
        s = _SPACE.sub(" ", s)
        if s[:1] == " ":
            self.space, s = True, s[1:]
        if not s:
            return
        tail = s[-1] == " "
        if self.line:
            if self.space:
                self.line.append(" ")
        else:
            self._open()
        self.line.append(s[:-1] if tail else s)
        self.space = tail

    def _open(self) -> None:
        if self.lines:
            self.lines += [""] * self.gap
        self.gap = 0
        self.line.append(self._prefix())

    def pre(self, s: str) -> None:
        for i, part in enumerate(s.replace("\r\n", "\n").split("\n")):
            if i:
                if not self.line:
                    self._open()
                self.close()
            if part:
                if not self.line:
                    self._open()
                self.line.append(part)
        self.space = False

    def close(self) -> None:
        """Ends the line at hand, if there is one."""
        if self.line:
            self.lines.append("".join(self.line).rstrip(" "))
            self.line = []
        self.space = False

    def block(self, blank: bool) -> None:
        self.close()
        if blank:
            self.gap = 1

    def br(self) -> None:
        if not self.line:
            self._open()
        self.close()

    def done(self) -> list[str]:
        self.close()
        return self.lines


def _span(node: Node, name: str) -> int:
    value = node.attrs.get(name, "").strip()
    return min(max(int(value), 1), SPAN_LIMIT) if value.isascii() and value.isdigit() else 1


class Table:
    def __init__(self):
        self.rows: list[list] = []

    def row(self) -> None:
        self.rows.append([])

    def cell(self, node: Node, lines: list[str]) -> None:
        if not self.rows:
            self.row()
        self.rows[-1].append((_span(node, "colspan"), _span(node, "rowspan"), lines))

    def lay_out(self) -> list[str]:
        """Rows as lines; cells start in their column, two spaces apart, below spanning ones left free."""
        placed, busy, width = [], {}, {}
        for row in self.rows:
            col, out, free = 0, [], {c: n - 1 for c, n in busy.items() if n > 1}
            for cols, rows, lines in row:
                while busy.get(col):
                    col += 1
                out.append((col, lines))
                longest = max(map(len, lines), default=0)
                if cols == 1:
                    width[col] = max(width.get(col, 0), min(longest, ALIGN))
                if rows > 1:
                    free |= {c: rows - 1 for c in range(col, col + cols)}
                col += cols
            busy = free
            placed.append(out)
        used = sorted({c for out in placed for c, _ in out} | set(width))
        start, at = {}, 0
        for c in used:
            start[c] = at
            at += width.get(c, 0) + 2 if width.get(c) else 0
        lines = []
        for out in placed:
            for i in range(max((len(x) for _, x in out), default=0)):
                line = ""
                for c, cell in out:
                    if i < len(cell) and cell[i]:
                        pad = start[c] - len(line)
                        line += (" " * pad if pad > 0 else "  " if line else "") + cell[i]
                lines.append(line.rstrip())
        return [x for x in lines if x]


def render(root: Node) -> str:
    """Visible text of a tree."""
    flow = Flow()
    flows, tables, lists, pre = [], [], [], 0
    todo: list = [root]
    while todo:
        item = todo.pop()
        if isinstance(item, str):
            if pre:
                flow.pre(item)
            else:
                flow.text(item)
            continue
        if isinstance(item, tuple):  # an element's end
            node, tag = item[0], item[0].tag
            if tag in CELLS and tables:
                own, flow = flow.done(), flows.pop()
                tables[-1].cell(node, own)
            elif tag == "table":
                table, flow = tables.pop(), flow
                for line in table.lay_out():
                    flow.br() if not line else (flow._open(), flow.line.append(line), flow.close())
                flow.block(True)
            elif tag in ("li", "dd", "blockquote"):
                flow.block(tag == "blockquote")
                flow.indent.pop()
                flow.marker = None
            elif tag in ("ul", "ol", "menu", "dir"):
                lists.pop()
                flow.block(not lists)
            elif tag in ("pre", "xmp", "textarea"):
                pre -= 1
                flow.block(True)
            elif tag == "q":
                flow.text("\"")
            elif tag in BLOCK:
                flow.block(tag in SPACED)
            continue
        tag = item.tag
        if not visible(item):
            continue
        if tag == "br":
            flow.br()
            continue
        if tag == "hr":
            flow.block(True)
            continue
        if tag == "input":
            todo.append(f" {_field(item)} ")
            continue
        if tag in VOID:
            continue
        if tag == "table":
            flow.block(True)
            tables.append(Table())
        elif tag == "tr" and tables:
            tables[-1].row()
        elif tag in CELLS and tables:
            flows.append(flow)
            flow = Flow()
        elif tag in ("li", "dd", "blockquote"):
            flow.block(tag == "blockquote")
            mark = "  "
            if tag == "blockquote":
                mark = "> "
            elif tag == "li" and lists and lists[-1] is not None:
                value = item.attrs.get("value", "").strip()
                number = int(value) if value.isascii() and value.isdigit() and len(value) < 10 else lists[-1]
                lists[-1] = number + 1
                mark = f"{number}. "
            elif tag == "li":
                mark = "- "
            flow.indent.append(mark if tag == "blockquote" else " " * len(mark))
            if tag == "li":
                flow.marker = mark
        elif tag in ("ul", "ol", "menu", "dir"):
            flow.block(not lists)
            first = item.attrs.get("start", "1").strip()
            lists.append((int(first) if first.isascii() and first.isdigit() and len(first) < 10 else 1) if tag == "ol" else None)
        elif tag in ("pre", "xmp", "textarea"):
            flow.block(True)
            pre += 1
            if item.kids and isinstance(item.kids[0], str) and item.kids[0][:1] == "\n":
                item.kids[0] = item.kids[0][1:]
        elif tag == "q":
            flow.text("\"")
        elif tag in BLOCK:
            flow.block(tag in SPACED)
        todo.append((item,))
        kids = item.kids
        if tag == "details" and "open" not in item.attrs:
            kids = [k for k in kids if isinstance(k, Node) and k.tag == "summary"][:1]
        elif tag == "svg":
            kids = _svg_text(item)
        elif tag == "select":
            kids = _choice(item)
        elif tag == "textarea" and not kids:
            kids = [item.attrs.get("placeholder", "")]
        todo += reversed(kids)
    return "\n".join(flow.done()).replace("\xa0", " ")


def page_text(page: str | None) -> str:
    return render(parse(page)) if page else ""


def _render(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        text = [page_text(p) for p in pdf["html"]]
        yield pd.DataFrame({"page_id": pdf["page_id"].array, "url": pdf["url"], "text": text,
                            "n_chars": [len(t) for t in text],
                            "n_lines": [t.count("\n") + 1 if t else 0 for t in text]})


def page_texts(pages: DataFrame) -> DataFrame:
    """One row per row of ``pages`` (page_id, url, html): page_id, url, text, n_chars, n_lines.

    A null or empty page gives an empty text of 0 lines. Null ids, null urls and repeated rows
    are rows like any other; broken markup never fails (unclosed comments and tags run to the
    end); other columns are ignored; an empty table gives no rows."""
    base = pages.select(or_null(pages, "page_id", "long").alias("page_id"), or_null(pages, "url", "string").alias("url"),
                        or_null(pages, "html", "string").alias("html"))
    return base.mapInPandas(_render, struct_of(page_id=T.LongType(), url=T.StringType(), text=T.StringType(),
                                               n_chars=T.LongType(), n_lines=T.LongType()))


def op5_html_render(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_texts(read_table(spark, sf_dir, "pages"))
