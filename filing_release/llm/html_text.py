"""HTML extraction by layout-aware rendering.

A tree builder closes implied tags (``<p>``, ``<li>``, ``<dt>``, table parts,
``<option>``) and a renderer emits all visible text: blocks on lines of their
own, paragraphs apart by a blank line, list markers with indentation, table
cells in aligned columns, ``<pre>`` untouched.  Every line is written once,
with the indentation of all the lists and quotes around it; indentation grows
with their depth up to ``INDENT`` columns and stays there, so that the text of
a page is linear in its size however deep its lists are.

Not visible: head, script, style, template, noscript and embedded content;
elements with ``hidden``, ``display:none`` or ``visibility:hidden``; closed
``<details>`` but for its summary; hidden inputs.

Defined cases: null or empty pages give empty text; unclosed and stray tags
are repaired, at any depth of nesting; a column that a cell of an earlier row
spans (``rowspan``) stays empty; repeated pages each give a row.
"""

from __future__ import annotations

import re
import sys
from collections import Counter
from html.parser import HTMLParser

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_rows

# Fixed values of the HTML standard.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param",
        "source", "track", "wbr"}
HIDDEN = {"head", "script", "style", "template", "noscript", "iframe", "object", "audio",
          "video", "canvas", "svg", "math", "title", "datalist", "noframes"}
BLOCK = {"address", "article", "aside", "body", "center", "dd", "details", "dialog", "dir",
         "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "header",
         "hgroup", "html", "legend", "li", "main", "menu", "nav", "ol", "option", "section",
         "summary", "tr", "ul", "h1", "h2", "h3", "h4", "h5", "h6", "p", "blockquote", "pre",
         "table", "hr", "caption"}
SPACED = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "blockquote", "pre", "table", "ul", "ol",
          "dl", "figure", "hr"}
CLOSES_P = BLOCK - {"body", "html", "option", "tr", "caption", "legend"}
#: A start tag of the left closes an open element of the right ...
IMPLIED = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"},
           "optgroup": {"option", "optgroup"}, "tr": {"tr", "td", "th", "caption", "colgroup"},
           "td": {"td", "th"}, "th": {"td", "th"},
           **{x: {"thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup"}
              for x in ("thead", "tbody", "tfoot")}}
#: ... unless one of these is in between.
FENCE = {"li": {"ul", "ol", "menu", "dir"}, "dt": {"dl"}, "dd": {"dl"}, "option": {"select"},
         "optgroup": {"select"}}
TABLE_PARTS = {"tr", "td", "th", "thead", "tbody", "tfoot"}
_HIDING = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*hidden)\b", re.I)
_SPACE = re.compile(r"[ \t\n\r\f]+")


class Node:
    __slots__ = ("tag", "attrs", "items")

    def __init__(self, tag: str, attrs: dict):
        self.tag, self.attrs, self.items = tag, attrs, []


class Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("html", {})
        self.open = [self.root]
        self.tags: Counter = Counter()  # of the open elements but the root
        self.depth = 1

    def cut(self, k: int) -> None:
        for node in self.open[k:]:
            self.tags[node.tag] -= 1
        del self.open[k:]

    def close_to(self, tags: set[str], fence: set[str]) -> None:
        left = sum(self.tags[t] for t in tags)
        for k in range(len(self.open) - 1, 0, -1):
            if not left:
                return
            if self.open[k].tag in tags:
                # close this one, then look for further ones (a cell and its row)
                self.cut(k)
                left -= 1
            elif self.open[k].tag in fence:
                return

    def handle_starttag(self, tag, attrs):
        if tag in ("html", "body"):
            return
        if tag in CLOSES_P:
            self.close_to({"p"}, {"table", "td", "th", "button", "caption"})
        if tag in IMPLIED:
            self.close_to(IMPLIED[tag], FENCE.get(tag, {"table"}) | {"table"})
        if tag not in HIDDEN and self.tags["head"] and tag in BLOCK:
            self.close_to({"head"}, set())
        node = Node(tag, {k: v or "" for k, v in attrs})
        self.open[-1].items.append(node)
        if tag not in VOID:
            self.open.append(node)
            self.tags[tag] += 1
            self.depth = max(self.depth, len(self.open))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        if not self.tags[tag]:
            return
        fence = {"table"} if tag in TABLE_PARTS else {"td", "th"} if tag not in (
            "table", "body", "html") else set()
        for k in range(len(self.open) - 1, 0, -1):
            if self.open[k].tag == tag:
                self.cut(k)
                return
            if self.open[k].tag in fence:
                return

    def handle_data(self, data):
        self.open[-1].items.append(data)


def visible(node: Node) -> bool:
    a = node.attrs
    return not (node.tag in HIDDEN or "hidden" in a or "style" in a and _HIDING.search(a["style"])
                or node.tag == "input" and a.get("type", "").lower() == "hidden")


INDENT = 64  # columns


class Lines:
    """Output lines under construction: of a page or cell, or, with ``above``,
    of a list item or quote inside one, whose lines go to the same list."""

    def __init__(self, above: Lines | None = None, mark: str = "", trim: bool = False):
        self.above, self.mark = above, mark
        self.lines: list[str] = above.lines if above else []
        self.indent = (above.indent + " " * len(mark))[:INDENT] if above else ""
        self.trim = trim or bool(above and above.trim)  # no white space at the ends of lines
        self.begun = False    # has a line
        self.now: list[str] = []
        self.gap = False      # a blank line is due before the next text
        self.space = False    # a space is due before the next word

    def text(self, data: str) -> None:
        words = _SPACE.sub(" ", data)
        if not words.strip(" "):
            self.space = self.space or bool(words and self.now)
            return
        if (self.space or words[0] == " ") and self.now:
            self.now.append(" ")
        self.now.append(words.strip(" "))
        self.space = words[-1] == " "

    def newline(self, gap: bool = False) -> None:
        if self.now:
            self.add("".join(self.now))
        self.now, self.space = [], False
        self.gap = self.gap or gap

    def add(self, line: str) -> None:
        indent = self.indent if self.begun else self.begin()
        if self.gap:
            self.lines.append("")
        self.gap = False
        if line or indent != self.indent:
            line = indent + line
        self.lines.append(line.rstrip() if self.trim else line)

    def begin(self) -> str:
        """What precedes a first line: the marks of all items that it opens,
        after the indentation of the innermost that has a line."""
        marks, at = [], self
        while not at.begun:
            at.begun, at.gap = True, False
            if not at.above:
                return "".join(reversed(marks))
            marks.append(at.mark)
            at = at.above
        if at.gap:
            at.lines.append("")
            at.gap = False
        return at.indent + "".join(reversed(marks))


def render(node: Node) -> list[str]:
    """Lines of a node's visible contents."""
    out = Lines()
    _into(node, out)
    out.newline()
    return out.lines


def _into(node: Node, out: Lines) -> None:
    number = _start(node) if node.tag == "ol" else 0
    shut = node.tag == "details" and "open" not in node.attrs
    for item in node.items:
        if isinstance(item, str):
            if not shut:
                out.text(item)
            continue
        tag = item.tag
        if not visible(item) or shut and tag != "summary":
            continue
        if tag == "br":
            if not out.now and out.begun and not out.gap:
                out.add("")
            out.newline()
        elif tag == "hr":
            out.newline(True)
            out.add("---")
            out.gap = True
        elif tag == "pre":
            out.newline(True)
            raw = _raw(item).strip("\n")
            for line in raw.split("\n") if raw else []:
                out.add(line)
            out.gap = True
        elif tag == "table":
            out.newline(True)
            for line in table(item):
                out.add(line)
            out.gap = True
        elif tag == "li":
            out.newline()
            mark = "- "
            if node.tag == "ol":
                mark = f"{number}. "
                number += 1
            inner = Lines(out, mark, trim=True)
            _into(item, inner)
            inner.newline()
            if not inner.begun:
                inner.add("")
        elif tag in ("dd", "blockquote"):
            out.newline(tag == "blockquote")
            inner = Lines(out, "    ")
            _into(item, inner)
            inner.newline()
            out.gap = out.gap or tag == "blockquote"
        elif tag == "input":
            if item.attrs.get("type", "").lower() in ("submit", "button", "reset"):
                out.text(" " + item.attrs.get("value", "") + " ")
        elif tag in BLOCK:
            # a list inside a list follows its item without a blank line
            gap = tag in SPACED and not (tag in ("ul", "ol") and node.tag in ("li", "ul", "ol"))
            out.newline(gap)
            _into(item, out)
            out.newline(gap)
        else:
            _into(item, out)


def _start(node: Node) -> int:
    try:
        return int(node.attrs.get("start", "1"))
    except ValueError:
        return 1


def _raw(node: Node) -> str:
    out, todo = [], [node]
    while todo:
        x = todo.pop()
        if isinstance(x, str):
            out.append(x)
        elif x is not node and x.tag == "br":
            out.append("\n")
        elif x is node or visible(x):
            todo.extend(reversed(x.items))
    return "".join(out)


def table(node: Node) -> list[str]:
    """Rows with columns padded to their widest cell.  A cell over several
    columns takes no part in the widths.  Below a cell over several rows its
    columns are left empty, up to the end of the row group."""
    caption: list[str] = []
    rows: list[tuple[Node, list[tuple[list[str], int, int]]]] = []

    def walk(n: Node) -> None:
        for x in n.items:
            if isinstance(x, str):
                if x.strip():
                    caption.append(_SPACE.sub(" ", x).strip())
            elif not visible(x) or x.tag in ("col", "colgroup"):
                continue
            elif x.tag == "tr":
                cells = [(render(c), _span(c), _rowspan(c)) for c in x.items
                         if not isinstance(c, str) and c.tag in ("td", "th") and visible(c)]
                stray = Node("div", {})
                stray.items = [c for c in x.items
                               if isinstance(c, str) or c.tag not in ("td", "th")]
                caption.extend(render(stray))
                rows.append((n, cells))
            elif x.tag in ("thead", "tbody", "tfoot"):
                walk(x)
            elif x.tag in ("td", "th"):
                rows.append((n, [(render(x), _span(x), _rowspan(x))]))
            else:
                caption.extend(render(x))  # the caption, and what lies astray
    walk(node)
    widths: dict[int, int] = {}
    placed = _place(rows)
    for cells in placed:
        for col, lines, span in cells:
            if span == 1:
                widths[col] = max(widths.get(col, 0), *(len(s) for s in lines or [""]))
    out = caption
    for cells in placed:
        for k in range(max((len(lines) for _, lines, _ in cells), default=0)):
            parts = []
            for col, lines, span in cells:
                width = sum(widths.get(c, 0) for c in range(col, col + span)) + 3 * (span - 1)
                parts.append((lines[k] if k < len(lines) else "").ljust(width))
            out.append(" | ".join(parts).rstrip())
    return out


def _place(rows: list[tuple[Node, list[tuple[list[str], int, int]]]]
           ) -> list[list[tuple[int, list[str], int]]]:
    """``(column, lines, span)`` of each row's cells, and of the empty places
    that cells of earlier rows of the group take."""
    out, group = [], None
    hanging: list[tuple[int, int, int]] = []  # column, span, rows still to come
    for owner, cells in rows:
        if owner is not group:
            group, hanging = owner, []
        waiting, placed, below, col = sorted(hanging), [], [], 0
        for lines, span, down in cells:
            while waiting and waiting[0][0] <= col:
                c, w, _ = waiting.pop(0)
                if c + w > col:
                    placed.append((col, [], c + w - col))
                    col = c + w
            placed.append((col, lines, span))
            if down > 1:
                below.append((col, span, down - 1))
            col += span
        for c, w, _ in waiting:
            if c + w > col:
                col = max(c, col)
                placed.append((col, [], c + w - col))
                col = c + w
        hanging = [(c, w, n - 1) for c, w, n in hanging if n > 1] + below
        out.append(placed)
    return out


def _span(cell: Node) -> int:
    try:
        return min(max(int(cell.attrs.get("colspan", "1")), 1), 1000)
    except ValueError:
        return 1


def _rowspan(cell: Node) -> int:
    try:
        n = int(cell.attrs.get("rowspan", "1"))
    except ValueError:
        return 1
    return min(n, 65534) if n > 0 else 65534 if n == 0 else 1  # 0: to the group's end


def page_text(html: str | None) -> str:
    """The visible text of one page."""
    if not html:
        return ""
    b = Builder()
    b.feed(html)
    b.close()
    # at most four calls a level; Python's calls take heap, not C stack
    limit = sys.getrecursionlimit()
    sys.setrecursionlimit(max(limit, 4 * b.depth + 1000))
    try:
        return "\n".join(line.rstrip() for line in render(b.root))
    finally:
        sys.setrecursionlimit(limit)


def extract(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url``, ``text`` of every page with a page_id."""
    p = pages.where(F.col("page_id").isNotNull()).select(
        F.col("page_id").cast("long").alias("page_id"), "url", "html")
    return map_rows(p, lambda i, url, h: [(i, url, page_text(h))],
                    "page_id long, url string, text string", chunk=512)
