"""Visible text of web pages, laid out as a reader sees it.

A tree builder supplies the tags that HTML lets authors leave out, visibility rules prune what
a browser would not show, and a renderer writes the rest: blocks on lines of their own, list
items with marks and indents, table cells in aligned columns.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditloom.llm.text import small_batches

# HTML element classes.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
RAW = {"script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes"}
NEVER_SHOWN = {"head", "script", "style", "title", "template", "iframe", "noembed", "noframes", "audio", "video", "canvas", "datalist"}
# Elements inside svg and math that are not drawn where they stand; pieces() names them svg:desc and so on.
FOREIGN = {
    "svg": {"defs", "symbol", "clippath", "mask", "marker", "pattern", "lineargradient", "radialgradient", "filter", "metadata", "desc", "title"},
    "math": {"annotation", "annotation-xml"},
}
NEVER_SHOWN |= {f"{k}:{name}" for k, names in FOREIGN.items() for name in names}
# Named likewise: lines of a drawing, rows of a matrix, and parts that stand apart.
FOREIGN_LAYOUT = {"svg": {"text"}, "math": {"mtr", "mtd", "mfrac"}}
HEAD_ONLY = {"base", "link", "meta", "script", "style", "template", "title", "noscript"}
SPACED = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "ul", "ol", "dl", "blockquote", "pre", "table", "figure", "hr", "fieldset", "menu", "xmp"}
BLOCK = SPACED | {
    "address", "article", "aside", "body", "caption", "center", "dd", "details", "dialog", "dir", "div", "dt", "figcaption", "footer", "form",
    "header", "hgroup", "html", "legend", "li", "main", "nav", "optgroup", "option", "search", "section", "summary", "tbody", "td", "tfoot", "th", "thead", "tr", "svg:text", "math:mtr",
}
ENDS_P = (BLOCK - {"li", "dt", "dd", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "body", "html", "option", "optgroup", "legend"}) | {"li", "dt", "dd"}
LISTS = {"ul", "ol", "menu", "dir"}
# An opening tag closes open elements of the first set, up to an element of the second.
IMPLIED_ENDS = {
    "li": ({"li"}, LISTS),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist", "optgroup"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tr": ({"td", "th", "tr", "caption", "colgroup"}, {"table"}),
    "tbody": ({"td", "th", "tr", "tbody", "thead", "tfoot", "caption", "colgroup"}, {"table"}),
    "thead": ({"td", "th", "tr", "tbody", "thead", "tfoot", "caption", "colgroup"}, {"table"}),
    "tfoot": ({"td", "th", "tr", "tbody", "thead", "tfoot", "caption", "colgroup"}, {"table"}),
    "body": ({"head"}, {"html"}),
}
# Elements that an end tag inside does not reach past.
WALLS = {"table", "td", "th", "caption", "html", "template", "object"}

TAG = re.compile(r"<(/?)([A-Za-z][^\s/>]*)")
REST = re.compile(r"(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>")
ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")
COMMENT = re.compile(r"/\*.*?(?:\*/|\Z)|<!--|-->", re.S)
CSS_MARK = re.compile(r"\"(?:[^\"\\\n]|\\.)*\"|'(?:[^'\\\n]|\\.)*'|[{};]", re.S)
DECLARATION = re.compile(r"\s*(display|visibility)\s*:\s*([\w-]+)[^!]*(!\s*important)?\s*\Z", re.I)
SIMPLE = re.compile(r"[.#]?[\w-]+")
SPACES = re.compile(r"[ \t\n\r\f]+")

# Lines of a table cell are wrapped between words at this width.
WIDEST_CELL = 60
# Elements that make a table without header cells one of layout: its cells are blocks.
SECTIONING = {"article", "aside", "footer", "header", "main", "nav", "section", "h1", "h2", "h3", "h4", "h5", "h6"}
MOST_SPAN = 1000


class Node:
    __slots__ = ("tag", "attrs", "children")

    def __init__(self, tag: str, attrs: dict[str, str]):
        self.tag, self.attrs, self.children = tag, attrs, []


def pieces(page: str) -> Iterator[tuple[str, str, dict[str, str]]]:
    """(kind, name or text, attributes): open, close and text in the order of the page."""
    at, n = 0, len(page)
    foreign: list[str] = []  # open svg and math
    while at < n:
        mark = page.find("<", at)
        if mark < 0:
            yield "text", page[at:], {}
            return
        if mark > at:
            yield "text", page[at:mark], {}
        if page.startswith("<!--", mark):
            end = page.find("-->", mark + 2)
            at = n if end < 0 else end + 3
            continue
        if page.startswith(("<!", "<?"), mark):
            end = page.find(">", mark)
            at = n if end < 0 else end + 1
            continue
        head = TAG.match(page, mark)
        if not head:
            yield "text", "<", {}
            at = mark + 1
            continue
        rest = REST.match(page, head.end())
        end = rest.end() if rest else page.find(">", head.end()) + 1 or n
        name = head[2].lower()
        if foreign and name in FOREIGN[foreign[-1]] | FOREIGN_LAYOUT[foreign[-1]]:
            name = f"{foreign[-1]}:{name}"
        if head[1]:
            if name in FOREIGN and name in foreign:
                del foreign[len(foreign) - 1 - foreign[::-1].index(name) :]
            yield "close", name, {}
        else:
            body = page[head.end() : end - 1]
            attrs = {}
            for key, value in ATTRIBUTE.findall(body) if body.strip("/ \n\t") else ():
                attrs.setdefault(key.lower(), html.unescape(value.strip("\"'")))
            if (foreign or name in FOREIGN) and body.endswith("/"):
                attrs["/"] = ""  # ends at once
            elif name in FOREIGN:
                foreign.append(name)
            yield "open", name, attrs
            if name in RAW and "/" not in attrs:
                close = re.compile(f"</{name}(?=[\\s/>])", re.I).search(page, end)
                stop = close.start() if close else n
                if stop > end:
                    yield "raw", page[end:stop], {}
                end = stop
        at = end


def build(page: str) -> tuple[Node, list[str]]:
    """The tree of a page, with implied tags, and the style sheets in it."""
    root = Node("html", {})
    open_: list[Node] = [root]
    sheets: list[str] = []
    body: Node | None = None

    def push(tag: str, attrs: dict[str, str]) -> Node:
        node = Node(tag, attrs)
        open_[-1].children.append(node)
        open_.append(node)
        return node

    def close(tags: set[str], walls: set[str]) -> None:
        """Close the outermost element of ``tags`` above the nearest wall, and what is in it."""
        for i in range(len(open_) - 1, 0, -1):
            if open_[i].tag in walls:
                break
            if open_[i].tag in tags:
                cut = i
                while cut - 1 > 0 and open_[cut - 1].tag in tags:
                    cut -= 1
                del open_[cut:]
                close(tags, walls)
                return

    def needs_body() -> None:
        nonlocal body
        if body is None:
            close({"head"}, {"html"})
            body = push("body", {})

    for kind, value, attrs in pieces(page):
        top = open_[-1].tag
        if kind == "raw":
            if top == "style":
                if on_screen(open_[-1].attrs.get("media", "")):
                    sheets.append(value)
            elif top == "xmp":
                open_[-1].children.append(value)
            elif top == "textarea":
                open_[-1].children.append(html.unescape(value))
            continue
        if kind == "text":
            if body is None and (top == "html" or top == "head") and value.strip():
                needs_body()
            open_[-1].children.append(html.unescape(value))
            continue
        if kind == "open":
            if value == "html":
                root.attrs = {**attrs, **root.attrs}
                continue
            if value == "body":
                if body is None:
                    close({"head"}, {"html"})
                    body = push("body", attrs)
                continue
            if value == "head":
                if body is None and top == "html":
                    push("head", attrs)
                continue
            if body is None and value not in HEAD_ONLY:
                needs_body()
            if value in IMPLIED_ENDS:
                close(*IMPLIED_ENDS[value])
            if value in ENDS_P:
                close({"p"}, WALLS | {"button"})
            top = open_[-1].tag
            if value in ("td", "th") and top in ("table", "tbody", "thead", "tfoot"):
                if top == "table":
                    push("tbody", {})
                push("tr", {})
            elif value == "tr" and top == "table":
                push("tbody", {})
            if value in VOID or "/" in attrs:
                open_[-1].children.append(Node(value, attrs))
            else:
                push(value, attrs)
            continue
        if value in ("html", "body", "head"):
            if value == "head":
                close({"head"}, {"html"})
            continue
        if value == "br":
            open_[-1].children.append(Node("br", {}))
            continue
        walls = {"html"} if value in WALLS or value in ("tr", "tbody", "thead", "tfoot") else WALLS
        walls = {"table"} if value in ("td", "th", "tr", "tbody", "thead", "tfoot", "caption") else walls - {value}
        for i in range(len(open_) - 1, 0, -1):
            if open_[i].tag == value:
                del open_[i:]
                break
            if open_[i].tag in walls or open_[i] is body:
                if value == "p":
                    open_[-1].children.append(Node("p", {}))
                break
    return root, sheets


def on_screen(media: str) -> bool:
    """Whether a list of media queries holds on every screen; conditions on its size do not."""
    queries = [q.split() for q in media.lower().split(",")]
    return any(not q or q in (["all"], ["screen"], ["only", "screen"], ["only", "all"]) or len(q) == 2 and q[0] == "not" and q[1] in ("print", "speech") for q in queries)


def css_rules(sheet: str) -> Iterator[tuple[str, str]]:
    """(selectors, declarations) of the rules that hold on every screen, in their order."""
    sheet = COMMENT.sub(" ", sheet)
    open_: list[tuple[str | None, bool]] = [(None, True)]  # selectors, if in a rule, and whether it holds
    start, parts = 0, []
    for mark in [*CSS_MARK.finditer(sheet), None]:
        what, at = (mark[0], mark.start()) if mark else ("", len(sheet))
        if mark and what not in "{};":
            continue
        selectors, holds = open_[-1]
        if what != "{" and selectors is not None:
            parts.append(sheet[start:at])
        if what != ";" and parts:
            if holds:
                yield selectors or "", ";".join(parts)
            parts = []
        if what == "{":
            prelude = sheet[start:at].strip()
            if prelude.startswith("@"):
                name, condition = re.match(r"([\w-]*)(.*)", prelude[1:], re.S).groups()
                inner = on_screen(condition) if name.lower() == "media" else name.lower() == "layer" or name.lower() == "supports" and not condition.strip().lower().startswith("not")
                open_.append((selectors, holds and inner))
            else:  # a rule inside a rule has no simple selector
                open_.append((prelude, holds and selectors is None))
        elif what == "}" and len(open_) > 1:
            open_.pop()
        start = at + 1


def declared(block: str) -> dict[str, tuple[bool, str]]:
    """display and visibility in a block of declarations: (important, value)."""
    out: dict[str, tuple[bool, str]] = {}
    for part in block.split(";"):
        found = DECLARATION.match(part)
        if found:
            key, fresh = found[1].lower(), (bool(found[3]), found[2].lower())
            if key not in out or fresh[0] >= out[key][0]:
                out[key] = fresh
    return out


def cascade(sheets: list[str]) -> dict[str, dict[str, tuple[bool, int, int, str]]]:
    """For each simple selector (tag, .class, #id) what style sheets declare of display and
    visibility: (important, specificity, order, value)."""
    out: dict[str, dict[str, tuple[bool, int, int, str]]] = {}
    for order, (selectors, block) in enumerate(rule for sheet in sheets for rule in css_rules(sheet)):
        found = declared(block)
        for name in selectors.split(",") if found else ():
            name = name.strip()
            if SIMPLE.fullmatch(name):
                own = out.setdefault(name if name[0] in ".#" else name.lower(), {})
                for key, (important, value) in found.items():
                    fresh = (important, {"#": 2, ".": 1}.get(name[0], 0), order, value)
                    own[key] = max(own[key], fresh) if key in own else fresh
    return out


def shown_as(node: Node, sheets: dict[str, dict[str, tuple[bool, int, int, str]]]) -> tuple[str, str]:
    """display and visibility of an element, empty where nothing is declared."""
    style = node.attrs.get("style", "")
    if not sheets and not style:
        return "", ""
    found = [sheets[n] for n in (node.tag, "#" + node.attrs.get("id", ""), *("." + c for c in node.attrs.get("class", "").split())) if n in sheets] if sheets else []
    if style:
        found.append({key: (important, 3, 0, value) for key, (important, value) in declared(style).items()})
    return tuple(max((x[key] for x in found if key in x), default=(False, 0, 0, ""))[3] for key in ("display", "visibility"))


def words_in(node: Node) -> str:
    """All text in an element."""
    out, todo = [], [node]
    while todo:
        x = todo.pop()
        if isinstance(x, str):
            out.append(x)
        else:
            todo += reversed(x.children)
    return "".join(out)


def choices(select: Node) -> tuple[list, int]:
    """What a select shows, the chosen option or all of a list box, and how many it does not."""
    options, groups, todo = [], {}, [(c, None) for c in reversed(select.children)]
    while todo:
        x, group = todo.pop()
        if isinstance(x, str):
            continue
        if x.tag == "option":
            options.append((x, group))
        else:
            inner = x if x.tag == "optgroup" else group
            todo += [(c, inner) for c in reversed(x.children)]
    size = select.attrs.get("size", "")
    label = lambda o: o.attrs.get("label") or words_in(o)
    if "multiple" in select.attrs or size.isdecimal() and len(size) < 9 and int(size) > 1:
        shown = []
        for o, group in options:
            if group is not None and id(group) not in groups:
                groups[id(group)] = True
                shown.append(Node("option", {}))
                shown[-1].children.append(group.attrs.get("label", ""))
            shown.append(Node("option", {}))
            shown[-1].children.append(label(o))
        return shown, 0
    free = [o for o, group in options if "disabled" not in o.attrs and (group is None or "disabled" not in group.attrs)]
    chosen = ([o for o, _ in options if "selected" in o.attrs][-1:] or free[:1] or [None])[0]
    return ([label(chosen)] if chosen is not None else []), len(options) - (chosen is not None)


class Writer:
    """Collects laid-out lines."""

    def __init__(self):
        self.lines: list[str] = []
        self.line: list[str] = []
        self.space = self.gap = False
        self.indent: list[str] = []
        self.mark = ""

    def text(self, value: str) -> None:
        words = SPACES.sub(" ", value)
        if words[:1] == " ":
            self.space = True
        clean = words.strip(" ")
        if clean:
            if not self.line:
                self.begin()
            elif self.space:
                self.line.append(" ")
            self.line.append(clean)
            self.space = words[-1] == " "

    def begin(self) -> None:
        if self.gap and self.lines:
            self.lines.append("")
        self.gap = self.space = False
        lead = "".join(self.indent)
        if self.mark:
            lead, self.mark = lead[: len(lead) - len(self.mark)] + self.mark, ""
        self.line.append(lead)

    def verbatim(self, value: str) -> None:
        for k, part in enumerate(value.split("\n")):
            if k:
                self.end(keep=True)
            if part:
                if not self.line:
                    self.begin()
                self.line.append(part)

    def end(self, keep: bool = False) -> None:
        """End the line; an empty one counts only if kept."""
        if self.line or keep:
            self.lines.append("".join(self.line).rstrip())
        self.line, self.space = [], False

    def block(self, spaced: bool) -> None:
        self.end()
        self.gap = self.gap or spaced

    def result(self) -> list[str]:
        self.end()
        return self.lines


def wrapped(line: str) -> list[str]:
    """A line cut between words at WIDEST_CELL, its indent kept; longer words stay whole."""
    if len(line) <= WIDEST_CELL:
        return [line]
    lead = line[: len(line) - len(line.lstrip(" "))]
    out, now = [], ""
    for word in line[len(lead) :].split(" "):
        if now.strip(" ") and len(lead) + len(now) + 1 + len(word) > WIDEST_CELL:
            out.append(lead + now)
            now = word
        else:
            now = f"{now} {word}" if now else word
    return [*out, lead + now]


def aligned(table: Table, writer: Writer) -> None:
    """Write the cells of a table, each a list of lines, in columns; those of a layout table as blocks.

    A table is one of layout if its role says so, if it has no header and holds sections or
    tables of several lines, or if nothing can be aligned: it has one column, or is one row
    without header of which a cell has several lines.
    """
    rows = table.rows
    single = not table.headed and len(rows) == 1 and any(len(cell) > 1 for row in rows for cell in row)
    if table.layout or table.sections and not table.headed or single or max(map(len, rows), default=0) < 2:
        for row in rows:
            for cell in row:
                if cell:
                    writer.block(False)
                    for line in cell:
                        writer.verbatim(line)
                        writer.end(keep=True)
        return
    rows = [[[part for line in cell for part in wrapped(line)] for cell in row] for row in rows]
    widths: list[int] = []
    for row in rows:
        widths += [0] * (len(row) - len(widths))
        for i, cell in enumerate(row):
            widths[i] = max(widths[i], max(map(len, cell), default=0))
    ruled = any(len(cell) > 1 for row in rows for cell in row)
    written = False
    for row in rows:
        height = max(map(len, row), default=0)
        if height and ruled and written:
            writer.block(False)
            writer.verbatim("-+-".join("-" * w for w in widths))
        for k in range(height):
            line = " | ".join((cell[k] if k < len(cell) else "").ljust(w) for cell, w in zip(row, widths, strict=False))
            if line.strip(" |") or height > 1:
                writer.block(False)
                writer.verbatim(line.rstrip())
                written = True


class Table:
    """Rows of a table while it is read; spans keep their place with empty cells."""

    def __init__(self, layout: bool):
        self.rows: list[list[list[str]]] = []
        self.layout, self.headed, self.sections = layout, False, False
        self.below: dict[int, int] = {}

    def start_row(self) -> None:
        self.rows.append([])
        self.fill()

    def fill(self) -> None:
        row = self.rows[-1]
        while self.below.get(len(row), 0) > 0:
            self.below[len(row)] -= 1
            row.append([])

    def cell(self, lines: list[str], columns: int, rows: int) -> None:
        if not self.rows:
            self.start_row()
        row = self.rows[-1]
        for k in range(columns):
            if rows > 1:
                self.below[len(row)] = rows - 1
            row.append(lines if k == 0 else [])
        self.fill()


def span_of(value: str | None) -> int:
    return min(max(int(value), 1), MOST_SPAN) if value and value.isdecimal() and len(value) < 9 else 1


def render(page: str | None) -> tuple[str, int, int, int, int]:
    """(text, blocks, list items, table cells, hidden elements) of one page."""
    root, sheets = build(page or "")
    styles = cascade(sheets)
    counts = {"blocks": 0, "items": 0, "cells": 0, "hidden": 0}
    writers, tables, lists = [Writer()], [], []
    # (node or text, leaving, visible, preformatted); an explicit stack, as pages nest deeply
    todo: list[tuple] = [(root, False, True, False)]
    while todo:
        node, leaving, visible, pre = todo.pop()
        out = writers[-1]
        if isinstance(node, str):
            if visible:
                out.verbatim(node) if pre else out.text(node)
            continue
        tag = node.tag
        if leaving:
            if tag in LISTS and lists:
                lists.pop()
            elif tag == "li" and out.indent:
                out.indent.pop()
                out.mark = ""
            elif tag in ("blockquote", "dd") and out.indent:
                out.indent.pop()
            elif tag in ("td", "th") and tables:
                lines = [x for x in writers.pop().result() if x]
                tables[-1].cell(lines, span_of(node.attrs.get("colspan")), span_of(node.attrs.get("rowspan")))
                continue
            elif tag == "table":
                table = tables.pop()
                out.block(True)
                before = len(out.lines)
                aligned(table, out)
                if tables and len(out.lines) > before + 1:
                    tables[-1].sections = True
            if tag in BLOCK:
                out.block(tag in SPACED and not (tag in LISTS and lists))
            continue
        display, visibility = shown_as(node, styles)
        if (
            tag in NEVER_SHOWN
            or "hidden" in node.attrs
            or display == "none"
            or tag == "dialog" and "open" not in node.attrs
            or tag == "object" and node.attrs.get("data")
        ):
            counts["hidden"] += 1
            continue
        if visibility in ("visible", "initial"):
            visible = True
        elif visibility in ("hidden", "collapse"):
            counts["hidden"] += 1
            visible = False
        if tag == "br":
            if visible:
                out.end(keep=bool(out.line))
            continue
        if tag == "hr":
            out.block(True)
            continue
        if tag in VOID:
            continue
        if tag in BLOCK and tag not in ("td", "th"):
            counts["blocks"] += visible
            out.block(tag in SPACED and not (tag in LISTS and lists))
        if tables and tag in SECTIONING:
            tables[-1].sections = True
        elif tables and tag in ("th", "thead", "caption"):
            tables[-1].headed = True
        if tag in LISTS:
            start = node.attrs.get("start", "")
            lists.append(int(start) if tag == "ol" and re.fullmatch(r"-?\d{1,8}", start) else 1 if tag == "ol" else None)
        elif tag == "li":
            counts["items"] += visible
            number = lists[-1] if lists else None
            mark = "- " if number is None else f"{number}. "
            if number is not None:
                lists[-1] = number + 1
            out.indent.append(" " * len(mark))
            out.mark = mark
        elif tag in ("blockquote", "dd"):
            out.indent.append("  ")
        elif tag == "table":
            tables.append(Table(node.attrs.get("role", "").strip().lower() in ("presentation", "none")))
        elif tag == "tr" and tables:
            tables[-1].start_row()
        elif tag in ("td", "th") and tables:
            counts["cells"] += visible
            writers.append(Writer())
        pre = pre or tag in ("pre", "textarea", "xmp")
        children = node.children
        if tag == "select":
            children, more = choices(node)
            counts["hidden"] += more
        elif tag in ("math:mfrac", "math:mtr"):
            children = [x for child in children for x in (child, " ")]
        todo.append((node, True, visible, pre))
        for child in reversed(children):
            todo.append((child, False, visible, pre))
    lines = writers[0].result()
    return "\n".join(lines).strip("\n"), counts["blocks"], counts["items"], counts["cells"], counts["hidden"]


def extract(pages: DataFrame, page_id: str = "page_id", page: str = "html") -> DataFrame:
    """(page_id, text, n_blocks, n_items, n_cells, n_hidden), one row for each row of ``pages``.

    text holds all visible text: runs of white space as one blank (kept in pre), blocks on
    their own lines, an empty line around paragraphs, headings, lists and tables, list items
    after ``-`` or their number, cells of tables in columns between bars, wrapped at 60
    characters, with a rule between the rows if a cell has several lines, and cells of layout
    tables (see ``aligned``) as blocks; of a select the chosen option or, in a list box, all.  Not shown are
    the head, scripts, styles, templates, embedded media (an object with ``data``), elements with
    ``hidden`` and those that inline styles or simple selectors of the page's own style sheets
    hide, by importance, specificity and order; rules for print or under conditions on the
    screen do not count.  Null and empty pages give empty text; broken markup
    is read as far as it goes; null ids stay null; repeated rows are read each; an empty table
    gives no rows; other columns are not looked at.
    """

    @F.pandas_udf("text string, n_blocks long, n_items long, n_cells long, n_hidden long")
    def read(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame([render(p) for p in batch], columns=["text", "n_blocks", "n_items", "n_cells", "n_hidden"])

    small_batches(pages)
    return pages.select(F.col(page_id).alias("page_id"), read(F.col(page)).alias("r")).select(F.col("page_id").alias(page_id), "r.*")
