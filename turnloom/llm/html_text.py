"""HTML extraction: a tree builder with implied tags and visibility rules, rendered as laid-out text.

Elements are built on a stack and rendered when they close.  All visible text is kept; blocks start on lines of their own, paragraphs and
headings stand between blank lines, list items carry markers and indents, and the cells of a table are padded to the width of their column.
A cell keeps its lines; one that spans columns takes their width, and one that spans rows leaves its place empty in the rows below.

Time and text stay in proportion to a page, whatever its tags are.  The page is read forward once; open elements are found by their name;
lines move from an element to the one around it by joining the shorter run of lines to the longer one, and an indent is one number for a run.
For the same reason an indent ends at ``DEEPEST`` columns, lines wider than ``WIDEST`` do not widen their column, a row of more than
``MAX_COLUMNS`` columns is laid out as if its cells spanned one, and tables within ``NESTED`` others have each cell on lines of its own.

Not visible: comments, ``head``, ``script``, ``style``, ``template``, ``noscript`` and other elements without rendered text, whatever has
``hidden`` or ``display:none``, with all that is in it, and whatever has ``visibility:hidden``, but for what in it is ``visible`` again.

Defined results: a null page gives a null text; an empty page, or one without visible text, the empty text; a tag that never ends is text; a
quote that never ends does not keep a tag open; ``</br>`` is a line break; ``value`` and ``reversed`` count in ordered lists; rows that repeat
are rendered alike; an empty table gives an empty result.  Only id and html are read, so other columns cannot clash.
"""

from __future__ import annotations

import html
import re
import unicodedata
from bisect import bisect_right
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
UNSEEN = frozenset("head script style title template noscript iframe noembed noframes object audio video canvas svg math datalist".split())
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl table blockquote pre figure".split())
BLOCK = SPACED | frozenset("address article aside body caption center dd details dialog div dt fieldset figcaption footer form header hgroup html legend li main nav option optgroup search section select summary tbody td tfoot th thead tr textarea".split())
ENDS_P = BLOCK - frozenset("body html caption option optgroup select tbody td tfoot th thead tr textarea".split())
#: a start tag closes these open elements, up to the nearest of the second set
CLOSES = {
    "li": ({"li"}, {"ul", "ol"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "option": ({"option"}, {"select"}), "optgroup": ({"option", "optgroup"}, {"select"}),
    "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "tr": ({"tr", "td", "th"}, {"table"}),
    "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}), "thead": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}), "tfoot": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
}

_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_STOP = re.compile("[>\"']")
_ATTRIBUTE = re.compile(r"""([^\s/>][^\s/>=]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
_MAY_MATTER = re.compile("hidden|style|span|start|open|value|reversed", re.I)
MAX_COLUMNS = 1000
WIDEST = 400
_NUMBER = re.compile(r"\s*([+-]?\d{1,9})")
_COMMENT = re.compile(r"/\*.*?(?:\*/|\Z)", re.S)
_SPACE = re.compile(r"[ \t\n\r\f]{2,}|[\t\n\r\f]")
#: noncharacters, of which those that a page does not hold stand for kept white space
_MARKS = [chr(c) for c in (*range(0xFDD0, 0xFDF0), *(plane << 16 | 0xFFFE | k for plane in range(17) for k in (0, 1)))]
DEEPEST = 64
NESTED = 16


def _width(text: str) -> int:
    return sum((unicodedata.east_asian_width(c) in "WF") + 1 - bool(unicodedata.combining(c)) for c in text) if not text.isascii() else len(text)


def _attributes(raw: str) -> dict[str, str]:
    """Return a tag's attributes by name, if any of them may matter here; the first of a name counts."""
    found: dict[str, str] = {}
    if raw and _MAY_MATTER.search(raw):
        for m in _ATTRIBUTE.finditer(raw):
            found.setdefault(m[1].lower(), html.unescape(m[2] or m[3] or m[4] or ""))
    return found


def _style(attributes: dict[str, str]) -> dict[str, str]:
    """Return the values of a style attribute by property."""
    found: dict[str, tuple[bool, str]] = {}
    for part in _COMMENT.sub("", attributes.get("style", "")).lower().split(";"):
        name, _, value = part.partition(":")
        value, mark, _ = value.partition("!")
        if bool(mark) >= found.get(name.strip(), (False, ""))[0]:  # the last one counts, but for important ones
            found[name.strip()] = (bool(mark), value.strip())
    return {k: v for k, (_, v) in found.items()}


def _whole(attributes: dict[str, str], name: str, other: int) -> int:
    m = _NUMBER.match(attributes.get(name, ""))
    return int(m[1]) if m else other


class _Lines:
    """A run of lines: each has an indent, less ``shift``, and its pieces from the last to the first.  Blank lines are single and only between others."""

    __slots__ = ("rows", "shift", "gap", "led", "ended")

    def __init__(self) -> None:
        self.rows: deque[tuple[int, list[str]]] = deque()
        self.shift, self.gap = 0, False
        self.led: bool | None = None  # whether a blank line was asked for before all others
        self.ended = False  # or after them

    def blank(self) -> None:
        """Ask for a blank line before the next one."""
        self.gap, self.ended = bool(self.rows), True
        self.led = True if self.led is None else self.led

    def _next(self) -> None:
        if self.gap:
            self.rows.append((-self.shift, []))
        self.gap = self.ended = False
        self.led = False if self.led is None else self.led

    def add(self, text: str) -> None:
        """Add a line."""
        self._next()
        self.rows.append((-self.shift, [text] if text else []))

    def close(self) -> None:
        """Drop blank lines at the end."""
        while self.rows and not self.rows[-1][1]:
            self.rows.pop()

    def indent(self, by: int, mark: str = "") -> None:
        """Move all lines to the right; the first one carries a mark instead."""
        if mark:
            own, pieces = self.rows[0]
            pieces += [" " * max(0, min(own + self.shift, DEEPEST)), mark] if pieces else [mark]
            self.rows[0] = (-self.shift - by, pieces)
        self.shift += by

    def join(self, other: _Lines) -> None:
        """Add the lines of a closed run; it must not be used any more."""
        self._next()
        if len(other.rows) <= len(self.rows):
            move = other.shift - self.shift
            self.rows.extend((own + move, pieces) for own, pieces in other.rows)
        else:
            move = self.shift - other.shift
            other.rows.extendleft((own + move, pieces) for own, pieces in reversed(self.rows))
            self.rows, self.shift = other.rows, other.shift

    def texts(self) -> list[str]:
        """The lines as text."""
        return [" " * max(0, min(own + self.shift, DEEPEST)) + "".join(reversed(pieces)) if pieces else "" for own, pieces in self.rows]


class _Node:
    __slots__ = ("tag", "unseen", "faded", "pre", "lines", "inline", "rows", "cells", "count", "step", "held", "value", "span", "keep")

    def __init__(self, tag: str, unseen: bool, faded: bool, pre: bool, keep: tuple[str, str, str, str]):
        self.tag, self.unseen, self.faded, self.pre, self.keep = tag, unseen, faded, pre, keep  # faded: visibility:hidden, which inner elements may end
        self.lines = _Lines()
        self.inline: list[str] = []
        self.rows: list[list[_Cell]] | None = [] if tag == "table" else None
        self.cells: list[_Cell] | None = [] if tag == "tr" else None
        self.count, self.step = 0, 1
        self.held: list[_Node] | None = None  # items of a list that counts down from their number
        self.value: int | None = None
        self.span = (1, 1)

    def flush(self) -> None:
        if not self.inline:
            return
        text = _SPACE.sub(" ", "".join(self.inline))
        self.inline = []
        line_break, space, line, tab = self.keep
        parts = [x.strip(" ") for x in text.replace(line, line_break).split(line_break)] if line in text or line_break in text else [text.strip(" ")]
        if parts[-1] == "":
            parts.pop()
        for x in parts:
            self.lines.add(x.replace(space, " ").replace(tab, "\t"))


#: lines, columns and rows (0: all that follow) of a cell
_Cell = tuple[_Lines, int, int]


def _table(rows: list[list[_Cell]], depth: int, into: _Lines) -> None:
    """Lay out rows of cells in columns; one column, and cells of deeply nested tables, are lines one below the other."""
    if depth > NESTED or all(len(row) <= 1 and all(deep == 1 for *_, deep in row) for row in rows):
        for row in rows:
            for lines, _, _ in row:
                if lines.rows:
                    into.join(lines)
        return
    for text in _grid([[(lines.texts(), columns, deep) for lines, columns, deep in row] for row in rows]):
        into.add(text)


def _grid(rows: list[list[tuple[list[str], int, int]]]) -> list[str]:
    placed: list[list[tuple[int, int, list[str]]]] = []  # first column, columns, lines
    taken: dict[int, float] = {}  # column: rows that a cell from above still covers
    for row in rows:
        at, own = 0, []
        spans = sum(c for _, c, _ in row) <= MAX_COLUMNS
        covered, taken = taken, {c: n - 1 for c, n in taken.items() if n > 1}
        for lines, columns, depth in row:
            while at in covered:
                at += 1
            columns = columns if spans else 1
            own.append((at, columns, lines))
            if depth != 1:
                taken |= dict.fromkeys(range(at, at + columns), float("inf") if depth == 0 else depth - 1)
            at += columns
        placed.append(own)
    widths: dict[int, int] = {}
    for wide in (False, True):
        for at, columns, lines in (c for row in placed for c in row if (c[1] > 1) == wide):
            need = max((w for w in map(_width, lines) if w <= WIDEST), default=0) - sum(widths.get(c, 0) + 3 for c in range(at, at + columns - 1))
            widths[at + columns - 1] = max(widths.get(at + columns - 1, 0), need)
    out = []
    for row in placed:
        if any(lines for *_, lines in row):
            for k in range(max(len(lines) for *_, lines in row)):
                parts, at = [], 0
                for first, columns, lines in row:
                    parts += [" " * widths.get(c, 0) for c in range(at, first)]
                    text = lines[k] if k < len(lines) else ""
                    parts.append(text + " " * (sum(widths.get(c, 0) for c in range(first, first + columns)) + 3 * (columns - 1) - _width(text)))
                    at = first + columns
                out.append(" | ".join(parts).rstrip())
    return out


class _Builder:
    def __init__(self, keep: tuple[str, str, str, str]) -> None:
        self.keep = keep
        self.root = _Node("#root", False, False, False, keep)
        self.stack = [self.root]
        self.blocks = [self.root]
        self.at: dict[str, list[int]] = {}  # where elements of a name stand on the stack
        self.tables: list[_Node] = []

    def text(self, raw: str) -> None:
        top = self.stack[-1]
        if top.unseen or top.faded or not raw:
            return
        block = self.blocks[-1]
        if block.tag in ("table", "tbody", "thead", "tfoot", "tr") and not raw.strip():
            return
        if "&" in raw:
            raw = html.unescape(raw)
        if top.pre:
            _, space, line, tab = self.keep
            raw = raw.replace("\r\n", "\n").replace(" ", space).replace("\t", tab).replace("\n", line)
        block.inline.append(raw)

    def open(self, tag: str, attributes: str) -> None:
        if tag in ("html", "body") and any(n.tag == tag for n in self.stack[1:4]):
            return
        if tag == "body" or (tag in BLOCK and tag not in ("html",)):
            self.close_if_open("head", 4)
        if tag in ENDS_P:
            self.close_up_to({"p"}, {"td", "th", "table", "button", "caption", "object"})
        rule = CLOSES.get(tag)
        if rule:
            self.close_up_to(*rule)
            if tag in ("td", "th") and self.blocks[-1].tag in ("table", "tbody", "thead", "tfoot"):
                self.push("tr", "")
        if tag == "br":
            if not (self.stack[-1].unseen or self.stack[-1].faded):
                self.blocks[-1].inline.append(self.keep[0])
        elif tag == "hr":
            self.blocks[-1].flush()
            self.blocks[-1].lines.blank()
        elif tag == "wbr" or tag in VOID:
            pass
        else:
            self.push(tag, attributes)

    def push(self, tag: str, raw: str) -> None:
        top = self.stack[-1]
        own = _attributes(raw)
        style = _style(own) if "style" in own else {}
        gone = "hidden" in own and own["hidden"].strip().lower() != "until-found" or style.get("display") == "none" or (tag == "dialog" and "open" not in own)
        faded = style["visibility"] in ("hidden", "collapse") if style.get("visibility") in ("hidden", "collapse", "visible") else top.faded
        node = _Node(tag, top.unseen or tag in UNSEEN or gone, faded, top.pre or tag in ("pre", "textarea", "xmp"), self.keep)
        if tag == "ol":
            node.step = -1 if "reversed" in own else 1
            node.held = [] if node.step < 0 and "start" not in own else None
            node.count = _whole(own, "start", 1) - node.step
        elif tag == "li":
            node.value = _whole(own, "value", 0) if _NUMBER.match(own.get("value", "")) else None
        elif tag == "table":
            self.tables.append(node)
        elif tag in ("td", "th"):
            node.span = (min(max(_whole(own, "colspan", 1), 1), MAX_COLUMNS), max(_whole(own, "rowspan", 1), 0))
        self.at.setdefault(tag, []).append(len(self.stack))
        self.stack.append(node)
        if tag in BLOCK:
            self.blocks.append(node)

    def nearest(self, tag: str) -> int:
        """Where the innermost open element of a name is; 0: nowhere."""
        found = self.at.get(tag)
        return found[-1] if found else 0

    def close_to(self, at: int) -> None:
        """Close all from a place on the stack."""
        while len(self.stack) > at:
            self.pop()

    def close_if_open(self, tag: str, depth: int) -> None:
        found = self.at.get(tag)
        if found and found[0] < depth:
            self.close_to(found[-1])

    def close_up_to(self, tags: set[str], border: set[str]) -> None:
        """Close the outermost open element of ``tags`` above the nearest ``border``, and what is in it."""
        open_ = [found for t in tags if (found := self.at.get(t))]
        if open_:
            edge = max(map(self.nearest, border))
            above = [found[k] for found in open_ if (k := bisect_right(found, edge)) < len(found)]
            if above:
                self.close_to(min(above))

    def end(self, tag: str) -> None:
        at = self.nearest(tag)
        if at and (tag in ("table", "html", "body") or self.nearest("table") < at):
            self.close_to(at)

    def pop(self) -> None:
        node = self.stack.pop()
        self.at[node.tag].pop()
        if node.tag == "table":
            self.tables.pop()
        if node.tag not in BLOCK:
            return
        self.blocks.pop()
        if node.unseen:
            return
        node.flush()
        into, tag, lines = self.blocks[-1], node.tag, node.lines
        for item in node.held or ():
            node.value = node.value or len(node.held)
            self._place(item, node, f"{item.value if item.value is not None else node.value}. ")
            node.value = (item.value if item.value is not None else node.value) - 1
        if tag == "tr" and not self.tables:
            _table([node.cells], 1, lines)
        lines.close()
        if tag in ("td", "th") and into.cells is not None:
            into.cells.append((lines, *node.span))
            return
        if tag == "tr" and self.tables:
            if lines.led is not None:  # text outside cells
                node.cells.append((lines, 1, 1))
            self.tables[-1].rows.append(node.cells)
            return
        if tag == "table":
            lines.gap = False
            _table(node.rows, len(self.tables) + 1, lines)
        if tag == "li" and into.held is not None:
            if lines.rows:
                into.held.append(node)
            return
        mark = ""
        if tag == "li":
            into.count = node.value if node.value is not None else into.count + into.step
            mark = f"{into.count}. " if into.tag == "ol" else "- "
        self._place(node, into, mark)

    def _place(self, node: _Node, into: _Node, mark: str) -> None:
        """Hand a closed block's lines to the block around it."""
        into.flush()
        tag, lines = node.tag, node.lines
        spaced = tag in SPACED and not (tag in ("ul", "ol") and into.tag == "li")
        if lines.rows:
            if mark:
                lines.indent(len(mark), mark)
            elif tag in ("dd", "blockquote"):
                lines.indent(2)
            if spaced or lines.led:
                into.lines.blank()
            after = spaced or lines.ended
            into.lines.join(lines)
            if after:
                into.lines.blank()
        elif spaced and into.lines.led is not None:
            into.lines.blank()


class _Tags:
    """Finds where tags end: at the first ``>`` outside quotes, or, if quotes do not pair up to the end of the page, at the first one.

    A search that comes to the end of the page marks where it was outside quotes; another one that gets there, outside quotes too, would come
    to the same end.  So no character is passed more than once in each of three states.
    """

    def __init__(self, page: str):
        self.page, self.last, self.vain = page, page.rfind(">"), None

    def end(self, at: int) -> int:
        """The place of the ``>`` that ends a tag whose attributes begin here; there is one."""
        page, start, seen, vain = self.page, at, [], self.vain
        while True:
            stop = _STOP.search(page, at)
            if stop is None or (vain is not None and (vain[at] or vain[stop.start()])):
                break
            mark = stop.start()
            if page[mark] == ">":
                return mark
            seen.append((at, mark + 1))
            after = page.find(page[mark], mark + 1)
            if after < 0:
                break
            at = after + 1
        vain = self.vain = bytearray(len(page) + 1) if vain is None else vain
        for a, b in seen:
            vain[a:b] = b"\1" * (b - a)
        vain[at : at + 1] = b"\1"
        return page.find(">", start)


def render(page: str) -> str:
    """Return the visible text of a page as it is laid out."""
    held = set(page) if any(m in page for m in _MARKS[:4]) else set()
    keep = tuple([m for m in _MARKS if m not in held][:4]) if held else tuple(_MARKS[:4])
    tree, at, n, tags = _Builder(keep), 0, len(page), _Tags(page)
    look = 0  # where the next tag may begin; text before it has not been taken yet
    while True:
        begin = page.find("<", look)
        if begin < 0 or (begin > tags.last and not page.startswith("<!--", begin)):
            later = page.find("<!--", begin) if begin >= 0 else -1  # without any > left, only a comment can follow
            tree.text(page[at : later if later >= 0 else n])
            break
        if page.startswith("<!--", begin):
            tree.text(page[at:begin])
            stop = page.find("-->", begin + 4)
            if stop < 0:
                break
            at = look = stop + 3
            continue
        if page[begin + 1 : begin + 2] in ("!", "?"):
            tree.text(page[at:begin])
            at = look = page.find(">", begin + 2) + 1
            continue
        closing = page.startswith("/", begin + 1)
        name = _NAME.match(page, begin + 1 + closing)
        if name is None:
            look = begin + 1
            continue
        tree.text(page[at:begin])
        stop = tags.end(name.end())
        at = look = stop + 1
        tag = name[0].lower()
        if closing:
            if tag == "br":
                tree.open("br", "")
                continue
            if tag == "p" and not tree.at.get("p"):
                tree.open("p", "")
            tree.end(tag)
            continue
        tree.open(tag, page[name.end() : stop])
        if tag in RAW:
            finish = re.compile(f"</{tag}(?=[\\s/>]|\\Z)", re.I).search(page, at)
            tree.text(page[at : finish.start() if finish else n])
            at = look = finish.start() if finish else n
    tree.close_to(1)
    tree.root.flush()
    tree.root.lines.close()
    return "\n".join(tree.root.lines.texts())


def _render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            part = batch.slice(at, 500)
            texts = [None if x is None else render(x) for x in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts, pa.string())], names=["page_id", "text"])


def extract(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """Return page_id and the rendered text of every page."""
    return pages.select(F.col(id_col).cast("bigint").alias("page_id"), F.col(html_col).alias("html")).mapInArrow(_render, "page_id bigint, text string")


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Render every page."""
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))
