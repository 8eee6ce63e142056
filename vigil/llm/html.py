"""Visible text of web pages by layout-aware rendering (operator 5).

A scanner cuts the page into tags and text, a tree builder adds the tags that HTML
implies (a paragraph ends where a block begins, list items, table rows and cells end each
other, tables get rows, unknown end tags are ignored), visibility rules prune the tree, and a
renderer walks it without recursion: blocks on their own lines, paragraphs set off by
blank lines, list items with bullets or numbers by nesting, table cells aligned in
columns, preformatted text as it stands. All visible text comes out, navigation included.

Any page takes time in proportion to its length: open elements are found by their tag, never by
walking the stack, and numbers and indentation are bounded. Of styles only those in `style`
attributes count (`display: none`, `visibility`); style sheets in or beside the page are not read.
"""

from __future__ import annotations

import html as entities
import re
from bisect import bisect_right

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from vigil.llm import common

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
HIDDEN = frozenset("script style head title template noscript iframe noembed noframes object datalist "
                   "audio video canvas rp".split())
BLOCK = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer "
                  "form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table "
                  "tbody td tfoot th thead tr ul caption optgroup option".split())
#: Blocks with a blank line before and after.
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre table ul ol dl menu figure".split())
#: An opening tag ends open elements of these names, up to the scope that holds them.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}, "optgroup": {"option", "optgroup"},
          "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "body": {"head"},
          **{k: {"tr", "td", "th", "thead", "tbody", "tfoot", "caption"} for k in ("thead", "tbody", "tfoot")}}
SCOPE = {"li": {"ul", "ol", "menu", "dir"}, "dt": {"dl"}, "dd": {"dl"},
         **{k: {"table"} for k in ("tr", "td", "th", "thead", "tbody", "tfoot")}}
ENDS_P = BLOCK - {"html", "body", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "option", "optgroup"}
LIMITS = frozenset("table td th caption html".split())
#: What a head can hold; any other tag or text ends it.
IN_HEAD = frozenset("title meta link base basefont bgsound script style noscript noframes template".split())
#: HTML tags that end svg and math around them.
BREAKOUT = frozenset("b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr "
                     "ol p pre ruby s small span strong strike sub sup table tt u ul var".split())
#: Parts of svg and math that are not drawn where they stand.
NOT_DRAWN = frozenset("defs symbol metadata desc title clippath mask marker pattern lineargradient radialgradient filter "
                      "annotation annotation-xml".split())
MATH_TEXT = frozenset("mi mo mn ms mtext".split())
ENDS_SELECT = frozenset("select input textarea caption table tbody thead tfoot tr td th".split())

TAG = re.compile(r"""<([a-zA-Z][^\s/>]*+)((?:[\s/]++|[^\s/>=][^\s/>=]*+(?:\s*+=\s*+(?:"[^"]*"|'[^']*'|[^\s>"'][^\s>]*+))?+|=)*+)>""")
ATTRIBUTE = re.compile(r"""([^\s/>=][^\s/>=]*+)(?:\s*+=\s*+(?:"([^"]*)"|'([^']*)'|([^\s>"'][^\s>]*+)))?+""")
NO_DISPLAY = re.compile(r"(?:^|;)\s*display\s*:\s*none", re.I)
VISIBILITY = re.compile(r"(?:^|;)\s*visibility\s*:\s*(visible|hidden|collapse)", re.I)
#: Numeric character references with more digits than any code point has.
LONG_REFERENCE = re.compile(r"&#(?:[xX]([0-9a-fA-F]{7,})|([0-9]{8,}));?")
#: Levels of indentation, columns that a cell spans at most, and columns whose cells may span rows.
DEEPEST, WIDEST, ROWSPAN_COLUMNS = 40, 1000, 100
#: End tags that reach beyond a cell or table.
BEYOND_CELL = frozenset("table tr td th tbody thead tfoot body html".split())
BUTTONS = {"submit": "Submit", "reset": "Reset", "button": ""}


def unescape(text: str) -> str:
    """Character references resolved, however many digits they have."""
    def short(m: re.Match) -> str:
        digits = (m[1] or m[2]).lstrip("0")
        return "\ufffd" if len(digits) > 7 else f"&#{'x' if m[1] else ''}{digits or '0'};"
    return entities.unescape(LONG_REFERENCE.sub(short, text) if "&#" in text else text)


def number(text: str, least: int, most: int, default: int) -> int:
    """A whole number in an attribute, within bounds, however many digits it has."""
    m = re.match(r"\s*\+?0*([0-9]{0,9})([0-9]*)", text)
    if not (m[1] or "0" in m[0]):
        return default
    return max(least, most if m[2] else min(most, int(m[1] or 0)))


class Node:
    """An element; `inside` says what its content is part of: "" (HTML), svg, svg text, math or select."""

    __slots__ = ("attrs", "inside", "kids", "tag")

    def __init__(self, tag: str, attrs: dict[str, str], inside: str = ""):
        self.tag, self.attrs, self.inside, self.kids = tag, attrs, inside, []


def attributes(raw: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for m in ATTRIBUTE.finditer(raw):
        out.setdefault(m[1].lower(), unescape(m[2] or m[3] or m[4] or ""))
    return out


def scan(page: str):
    """("text", text), ("open", tag, attributes) and ("close", tag) in order. An unfinished tag ends the page.

    Tags that close themselves do so in svg and math only, and there only if they are not HTML's.
    """
    at, last = 0, page.rfind(">")
    foreign = 0
    lower = None
    while at < len(page):
        lt = page.find("<", at)
        if lt < 0:
            yield "text", unescape(page[at:])
            return
        if lt > at:
            yield "text", unescape(page[at:lt])
        after = page[lt + 1:lt + 2]
        if page.startswith("<!--", lt):
            end = page.find("-->", lt + 4)
            at = len(page) if end < 0 else end + 3
        elif after in ("!", "?"):
            end = page.find(">", lt)
            at = len(page) if end < 0 else end + 1
        elif after == "/" and page[lt + 2:lt + 3].isalpha():
            end = page.find(">", lt)
            if end < 0:
                return
            tag, at = re.split(r"[\s/]", page[lt + 2:end].lower(), maxsplit=1)[0], end + 1
            foreign = max(0, foreign - (tag in ("svg", "math")))
            yield "close", tag
        elif after.isascii() and after.isalpha():
            m = TAG.match(page, lt) if lt < last else None
            if not m:
                return
            tag, at = m[1].lower(), m.end()
            yield "open", tag, attributes(m[2])
            foreign += tag in ("svg", "math")
            if foreign and tag not in VOID and tag not in BREAKOUT and closes_itself(m[2]):
                foreign -= tag in ("svg", "math")
                yield "close", tag
            elif tag in RAW:
                lower = lower if lower is not None else ascii_lower(page)
                end = lower.find(f"</{tag}", at)
                if end < 0:
                    end = len(page)
                yield "text", unescape(page[at:end]) if tag in ("textarea", "title") else page[at:end]
                at = end
        else:
            yield "text", "<"
            at = lt + 1


def closes_itself(raw: str) -> bool:
    """Whether the attributes end in a slash that belongs to none of them."""
    end = 0
    if raw.endswith("/"):
        for m in ATTRIBUTE.finditer(raw):
            end = m.end()
    return end < len(raw) and raw.endswith("/")


def ascii_lower(text: str) -> str:
    """Lower case of A-Z, positions unchanged."""
    return text.translate({c: c + 32 for c in range(65, 91)})


def content_of(parent: Node, tag: str) -> str:
    """What the content of a new element is part of."""
    if tag in ("svg", "math", "select"):
        return tag
    if parent.inside == "svg":
        return {"foreignobject": "", "text": "svg text"}.get(tag, "svg")
    return "" if parent.inside == "math" and tag in MATH_TEXT else parent.inside


def choose(select: Node) -> None:
    """Leave of a drop-down list what its closed box shows; lists of several lines show all options."""
    options, todo = [], [(k, False) for k in reversed(select.kids)]
    while todo:
        node, off = todo.pop()
        if isinstance(node, str):
            continue
        off = off or "disabled" in node.attrs
        if node.tag == "option":
            options.append((node, off))
            if node.attrs.get("label"):
                node.kids = [node.attrs["label"]]
        else:
            todo.extend((k, off) for k in reversed(node.kids))
    size = select.attrs.get("size", "")
    if "multiple" in select.attrs or (size.isascii() and size.isdigit() and size.strip("0") not in ("", "1")):
        return
    shown = [o for o, _ in options if "selected" in o.attrs][-1:] or [o for o, off in options if not off][:1]
    select.kids = [" ", *(shown[0].kids if shown else []), " "]


class Open:
    """The open elements, with the places of every tag among them."""

    def __init__(self, root: Node):
        self.nodes, self.places = [root], {}

    def push(self, node: Node) -> None:
        self.places.setdefault(node.tag, []).append(len(self.nodes))
        self.nodes.append(node)

    def cut(self, keep: int) -> None:
        """End all elements but the first `keep`."""
        while len(self.nodes) > keep:
            self.places[self.nodes.pop().tag].pop()

    def last(self, tags) -> int:
        """Place of the innermost element with one of the tags, 0 without any."""
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=0)

    def first_after(self, tags, place: int) -> int | None:
        """Place of the outermost element with one of the tags beyond a place."""
        found = [own[k] for t in tags if (own := self.places.get(t)) and (k := bisect_right(own, place)) < len(own)]
        return min(found, default=None)


def build_tree(page: str) -> Node:
    root = Node("html", {})
    elements, selects = Open(root), []
    stack = elements.nodes

    def close_p() -> None:
        if (p := elements.last(("p",))) > elements.last(LIMITS):
            elements.cut(p)

    for event in scan(page):
        if event[0] == "text":
            if stack[-1].tag == "head" and event[1].strip():
                elements.cut(len(stack) - 1)
            if event[1] and stack[-1].inside != "svg":
                stack[-1].kids.append(event[1])
        elif event[0] == "open":
            _, tag, attrs = event
            if tag in ("html", "body") and any(n.tag == tag for n in stack[:3]):
                continue
            if tag == "head" and (len(stack) > 1 or any(not isinstance(k, str) or k.strip() for k in root.kids)):
                continue  # the page's head is over
            if stack[-1].tag == "head" and tag not in IN_HEAD:
                elements.cut(len(stack) - 1)
            if tag in BREAKOUT:
                while stack[-1].inside in ("svg", "svg text", "math"):
                    elements.cut(len(stack) - 1)
            elif tag in ENDS_SELECT:
                while stack[-1].inside == "select":
                    elements.cut(len(stack) - 1)
            if tag in ENDS_P:
                close_p()
            if tag in CLOSES:
                low = elements.first_after(CLOSES[tag], elements.last(SCOPE.get(tag, ())))
                if low is not None:
                    elements.cut(low)
            if tag in ("td", "th") and stack[-1].tag in ("table", "thead", "tbody", "tfoot"):
                row = Node("tr", {})  # a cell without a row
                stack[-1].kids.append(row)
                elements.push(row)
            around = stack[-1].inside
            node = Node(tag, attrs, content_of(stack[-1], tag))
            if around in ("svg", "svg text", "math") and (tag in NOT_DRAWN or attrs.get("display") == "none" or attrs.get("visibility") in ("hidden", "collapse")):
                attrs["hidden"] = ""
            if tag == "select":
                selects.append(node)
            stack[-1].kids.extend((" ", node, " ") if around == "svg" and tag == "text" else (node,))
            if tag == "input" and (label := BUTTONS.get(attrs.get("type", "").lower())) is not None:
                node.kids = [" ", attrs.get("value", label), " "]
            if tag not in VOID:
                elements.push(node)
        else:
            tag = event[1]
            if tag == "br":
                stack[-1].kids.append(Node("br", {}))
                continue
            place = elements.last((tag,))
            # an end tag inside a cell does not end what is around the table
            if place and (tag in BEYOND_CELL or place >= elements.last(("td", "th", "table"))):
                elements.cut(place)
    for select in selects:
        choose(select)
    settle(root)
    return root


def settle(root: Node) -> None:
    """Drop the text of invisible elements, but not of visible ones inside them, and what closed details hide."""
    todo = [(root, False)]
    while todo:
        node, off = todo.pop()
        if said := VISIBILITY.search(node.attrs.get("style", "")):
            off = said[1].lower() != "visible"
        if off:
            node.kids = [k for k in node.kids if not isinstance(k, str)]
        if node.tag == "details" and "open" not in node.attrs:
            node.kids = [k for k in node.kids if not isinstance(k, str) and k.tag == "summary"][:1]
        todo.extend((k, off) for k in node.kids if not isinstance(k, str))


def visible(node: Node) -> bool:
    a = node.attrs
    return not (node.tag in HIDDEN or "hidden" in a or (node.tag == "input" and not node.kids)
                or (node.tag == "dialog" and "open" not in a) or ("style" in a and NO_DISPLAY.search(a["style"])))


class Page:
    """Lines of text with collapsing white space and block spacing."""

    def __init__(self):
        self.lines: list[str] = []
        self.parts: list[str] = []
        self.gap = self.space = False
        self.prefix = ""          # stands before the next line's text: bullet and indentation
        self.indent = ""

    def text(self, raw: str, keep: bool) -> None:
        if keep:
            for k, line in enumerate(raw.split("\n")):
                if k:
                    self.lines_end(True)
                if line:
                    self.parts.append(line)
            return
        words = raw.split()
        if not words:
            self.space = self.space or bool(raw)
            return
        if self.parts and (self.space or raw[0].isspace()):
            self.parts.append(" ")
        self.parts.append(" ".join(words))
        self.space = raw[-1].isspace()

    def lines_end(self, empty: bool = False) -> None:
        """End the line; nothing happens to a line without text, unless it may be empty."""
        line = "".join(self.parts).rstrip()
        self.space = False
        self.parts = []
        if not line and not empty:
            return
        if self.gap and self.lines:
            self.lines.append("")
        self.gap = False
        self.lines.append(((self.prefix or self.indent) + line).rstrip())
        self.prefix = ""

    def block(self, spaced: bool) -> None:
        self.lines_end()
        self.gap = self.gap or (spaced and bool(self.lines))


def flat_text(node: Node) -> str:
    """Visible text of a cell in one line."""
    out, todo = [], [node]
    while todo:
        x = todo.pop()
        if isinstance(x, str):
            out.append(x)
        elif x is node or visible(x):
            if x.tag in BLOCK or x.tag == "br":
                out.append(" ")
                todo.append(" ")
            todo.extend(reversed(x.kids))
    return " ".join("".join(out).split())


def table_lines(table: Node) -> list[str]:
    """Rows of a table, cells aligned in columns; captions and stray text on lines of their own before them."""
    rows: list[dict[int, str]] = []
    before, todo = [], list(reversed(table.kids))
    taken: dict[int, int] = {}  # column -> rows below that a cell above reaches into
    while todo:
        x = todo.pop()
        if isinstance(x, str):
            before += [" ".join(x.split())] if x.strip() else []
        elif not visible(x):
            continue
        elif x.tag in ("thead", "tbody", "tfoot"):
            todo.extend(reversed(x.kids))
        elif x.tag == "tr":
            cells: dict[int, str] = {}
            column, reaching = 0, {}
            for c in x.kids:
                if isinstance(c, str) and not c.strip() or not isinstance(c, str) and not visible(c):
                    continue
                while taken.get(column):
                    column += 1
                if isinstance(c, str):
                    cells[column], wide, high = " ".join(c.split()), 1, 1
                else:
                    cells[column] = flat_text(c)
                    wide, high = number(c.attrs.get("colspan", "1"), 1, WIDEST, 1), number(c.attrs.get("rowspan", "1"), 0, 65534, 1)
                if high != 1:  # 0: all rows below
                    reaching.update((k, high or 65534) for k in range(column, min(column + wide, ROWSPAN_COLUMNS)))
                column += wide
            taken = {k: n - 1 for k, n in {**taken, **reaching}.items() if n > 1}
            rows.append(cells)
        else:
            before += [t] if (t := flat_text(x)) else []
    widths: dict[int, int] = {}
    for cells in rows:
        for k, text in cells.items():
            widths[k] = max(widths.get(k, 0), len(text))
    begins, at = {}, 0
    for k in sorted(widths):
        begins[k], at = at, at + widths[k] + 2
    lines = []
    for cells in rows:
        parts, at = [], 0
        for k, text in cells.items():
            if text:
                parts += [" " * (begins[k] - at), text]
                at = begins[k] + len(text)
        lines.append("".join(parts))
    return [x for x in before + lines if x]


def render(root: Node) -> str:
    page = Page()
    # (node, state); state None opens a node, otherwise it is what to do when it ends
    todo: list[tuple] = [(root, None)]
    lists: list[list] = []
    kept = 0
    while todo:
        node, state = todo.pop()
        if isinstance(node, str):
            page.text(node, kept > 0)
            continue
        tag = node.tag
        if state is None:
            if not visible(node):
                continue
            if tag == "br":
                page.lines_end(bool(page.lines) or bool(page.parts))
                continue
            if tag == "table":
                page.block(True)
                for line in table_lines(node):
                    page.parts.append(line)
                    page.lines_end()
                page.block(True)
                continue
            if tag in BLOCK:
                page.block(tag in SPACED and not (lists and tag in ("ul", "ol", "menu", "p")))
            todo.append((node, page.indent))
            if tag in ("ul", "ol", "menu", "dir"):
                lists.append([tag, number(node.attrs.get("start", "1"), 0, 10**9, 1)])
            elif tag == "li":
                kind = lists[-1] if lists else ["ul", 1]
                bullet = f"{kind[1]}. " if kind[0] == "ol" else "- "
                kind[1] += 1
                pad = "  " * min(DEEPEST, max(0, len(lists) - 1))
                page.prefix, page.indent = pad + bullet, pad + " " * len(bullet)
            elif tag in ("blockquote", "dd"):
                page.indent = (page.indent + "  ")[:2 * DEEPEST]
                page.prefix = ""
            elif tag == "pre":
                kept += 1
            todo.extend((k, None) for k in reversed(node.kids))
        else:
            if tag in BLOCK:
                page.block(tag in SPACED and not (len(lists) > (tag in ("ul", "ol", "menu")) and tag in ("ul", "ol", "menu", "p")))
            if tag in ("ul", "ol", "menu", "dir"):
                lists.pop()
            elif tag == "pre":
                kept -= 1
            elif tag == "li":
                page.prefix = ""
            page.indent = state
    page.lines_end()
    return "\n".join(page.lines).strip("\n")


def visible_text(page: str) -> str:
    """Rendered visible text of a page."""
    return render(build_tree(page))


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url and text of every row of `pages`; null or empty html gives an empty text.

    Reads `page_id`, `url` and `html`; other columns are left out. Null ids and repeated rows come back as they are.
    """
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(
            [visible_text(x) for x in common.strings(batch.column(2))], pa.string())], ["page_id", "url", "text"])

    return common.python_rows(pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html")),
                              run, "page_id long, url string, text string")


def op5_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visible text of all pages."""
    return extract(common.table(spark, sf_dir, "pages"))
