"""All visible text of HTML pages, laid out as a browser would: a scanner for tags, a tree
builder that supplies implied tags, visibility rules, and a renderer for blocks, lists and tables.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from tabloom.llm.common import named, pieces, record_batch, ship, whole_text

SLICE = 1 << 22     # bytes of pages rendered at once
DEEPEST = 200       # levels of nesting; deeper elements become siblings there, unless hidden
PADDED = 1 << 24    # characters a table may take when every column is as wide as its widest cell
WIDEST = 60         # characters a column of a larger table is padded to, at most

RENDERED = pa.schema([("page_id", pa.int64()), ("title", pa.string()), ("text", pa.string())])

# How HTML groups its elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style xmp iframe noembed noframes textarea title".split())
ESCAPED_RAW = frozenset("textarea title".split())
HEAD = frozenset("base link meta title style script noscript template".split())
UNSEEN = frozenset(
    "area audio base canvas col colgroup datalist embed head iframe link meta noembed noframes "
    "noscript object param rp script source style template title track video".split())
SPACED = frozenset(
    "blockquote dl fieldset figure form h1 h2 h3 h4 h5 h6 hr ol p pre table ul xmp".split())
BLOCK = SPACED | frozenset(
    "address article aside body caption center dd details dialog dir div dt figcaption footer "
    "header hgroup html legend li main menu nav optgroup option search section select summary "
    "tbody td tfoot th thead tr".split())
CLOSES_P = BLOCK - frozenset("body caption dd dt html legend li optgroup option select tbody td "
                             "tfoot th thead tr".split()) | frozenset(["li", "dd", "dt"])
# A start tag closes the nearest of these elements, unless one of the barriers comes first.
IMPLIED_END = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist", "optgroup"}),
    "optgroup": ({"optgroup", "option"}, {"select", "datalist"}),
    "tr": ({"tr", "caption", "colgroup"}, {"table", "template"}),
    "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "thead": ({"thead", "tbody", "tfoot", "caption", "colgroup"}, {"table"}),
    "tbody": ({"thead", "tbody", "tfoot", "caption", "colgroup"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "caption", "colgroup"}, {"table"}),
    "rt": ({"rt", "rp"}, {"ruby"}), "rp": ({"rt", "rp"}, {"ruby"}),
}
# Elements that an end tag of another kind does not reach beyond.
SCOPE = frozenset("button caption html marquee object table td template th".split())

TAG = re.compile(
    r"<(?:!--(?:-?>|.*?(?:--!?>|\Z))|(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)"
    r"(?P<attrs>(?:[^>=]++|=\s*+(?:\"[^\"]*\"|'[^']*')?+)*+)>|[!?/][^>]*>?)", re.DOTALL)
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]*)))?")
COMMENT = re.compile(r"/\*.*?(?:\*/|\Z)", re.DOTALL)
SHOWN_MEDIA = re.compile(r"(?:only\s+)?(?:all|screen)$", re.I)
PLAIN_SELECTOR = re.compile(r"[.#]?[\w-]+")
DISPLAY = re.compile(r"display\s*:\s*([\w-]+)", re.I)
VISIBILITY = re.compile(r"visibility\s*:\s*([\w-]+)", re.I)
BLANK = re.compile(r"[ \t\n\r\f]+")
UNSHOWN = ("none", "hidden", "collapse")


class Element:
    __slots__ = ("tag", "attrs", "children")

    def __init__(self, tag: str, attrs: dict[str, str]):
        self.tag, self.attrs, self.children = tag, attrs, []


def _rules(css: str) -> Iterator[tuple[str, str]]:
    """Selectors and declarations that apply on a screen of any size, in their order.

    Rules within ``@media`` count where the query names all media or screens and asks for no
    more; ``@supports`` and ``@layer`` blocks count, other at-rules hold none.
    """
    css, at = COMMENT.sub(" ", css), 0
    counts = [True]     # for each open block, whether its rules count
    while (brace := re.compile(r"[{};]").search(css, at)) is not None:
        before, at = css[at:brace.start()].strip(), brace.end()
        if brace[0] == "}":
            counts[1:] = counts[1:-1]
        elif brace[0] == "{" and before.startswith("@"):
            name, _, query = before[1:].partition(" ")
            name = name.lower()
            fits = any(SHOWN_MEDIA.match(q.strip()) for q in query.split(","))
            counts.append(counts[-1] and (name in ("supports", "layer") or name == "media" and fits))
        elif brace[0] == "{":
            end = css.find("}", at)
            end = len(css) if end < 0 else end
            if counts[-1]:
                yield before, css[at:end]
            at = end + 1


def _attributes(text: str) -> dict[str, str]:
    if not text or text.isspace():
        return {}
    out: dict[str, str] = {}
    for m in ATTRIBUTE.finditer(text):
        out.setdefault(m[1].lower(), html.unescape(m[2] or m[3] or m[4] or ""))
    return out


class Tree:
    """Builds the tree of a page; the head's elements are children of ``head``."""

    def __init__(self, page: str):
        self.root, self.head = Element("html", {}), Element("head", {})
        self.body = Element("body", {})
        self.root.children = [self.head, self.body]
        self.stack = [self.body]
        self.in_body = False
        self.title = ""
        self.hiding: dict[tuple[str, str], tuple[int, bool]] = {}   # see ``_style``
        self.order = 0
        self._scan(page)

    def _scan(self, page: str) -> None:
        at, n, last = 0, len(page), page.rfind(">")
        while at < n:
            m = TAG.search(page, at) if at <= last or page.find("<!--", at) >= 0 else None
            if m is None:
                # An unfinished tag at the end of a page is not text.
                cut = re.compile(r"<[a-zA-Z/!?]").search(page, at)
                self._text(page[at:cut.start()] if cut else page[at:])
                return
            self._text(page[at:m.start()])
            at, name = m.end(), m["name"]
            if not name:
                continue
            name = name.lower()
            if m["end"]:
                self._end(name)
                continue
            self._start(name, m["attrs"])
            if name in RAW:
                close = re.compile(rf"</{name}(?=[\s/>])|\Z", re.I).search(page, at)
                self._raw(name, page[at:close.start()])
                at = page.find(">", close.start()) + 1 or n

    def _text(self, text: str) -> None:
        if not text:
            return
        if not self.in_body:
            if not text.strip(" \t\n\r\f"):
                return
            self.in_body = True
        self.stack[-1].children.append(html.unescape(text) if "&" in text else text)

    def _raw(self, name: str, text: str) -> None:
        element = self.stack[-1] if self.stack[-1].tag == name else None
        if name in ESCAPED_RAW:
            text = html.unescape(text)
        if name == "title" and not self.title:
            self.title = BLANK.sub(" ", text).strip()
        if name == "style":
            self._style(text)
        if element is not None:
            element.children.append(text)
            self.stack.pop()

    def _style(self, css: str) -> None:
        """What plain selectors say of display and visibility; a later rule takes the place of
        an earlier one of the same selector."""
        for selectors, declared in _rules(css):
            said = [(what, m[1].lower()) for what, pattern in (
                ("display", DISPLAY), ("visibility", VISIBILITY))
                if (m := pattern.search(declared))]
            for selector in selectors.split(",") if said else ():
                selector = selector.strip()
                if PLAIN_SELECTOR.fullmatch(selector):
                    for what, value in said:
                        self.order += 1
                        self.hiding[what, selector] = (self.order, value in UNSHOWN)

    def _close(self, tags, barriers) -> None:
        for k in range(len(self.stack) - 1, 0, -1):
            tag = self.stack[k].tag
            if tag in tags:
                del self.stack[k:]
                return
            if tag in barriers:
                return

    def _start(self, name: str, attrs: str) -> None:
        if name in ("html", "head", "body"):
            if name == "body":
                self.body.attrs, self.in_body = {**_attributes(attrs), **self.body.attrs}, True
            return
        if not self.in_body and name in HEAD and name != "noscript":
            element = Element(name, _attributes(attrs))
            self.head.children.append(element)
            if name in RAW or name == "template":
                self.stack.append(element)
            return
        self.in_body = True
        if name in CLOSES_P:
            self._close({"p"}, SCOPE)
        if name in IMPLIED_END:
            self._close(*IMPLIED_END[name])
        if re.fullmatch("h[1-6]", name) and re.fullmatch("h[1-6]", self.stack[-1].tag):
            self.stack.pop()
        if name in ("td", "th") and self.stack[-1].tag in ("table", "thead", "tbody", "tfoot"):
            self._push(Element("tr", {}))
        element = Element(name, _attributes(attrs))
        if name in VOID or attrs.endswith("/") and name in ("path", "rect", "circle", "use"):
            self.stack[-1].children.append(element)
        else:
            self._push(element)

    def _push(self, element: Element) -> None:
        self.stack[-1].children.append(element)
        # A hidden element is never entered, so that what is in it may be as deep as it likes.
        if len(self.stack) != DEEPEST or element.tag in RAW or is_hidden(element, self.hiding):
            self.stack.append(element)

    def _end(self, name: str) -> None:
        if name == "br":
            self._start("br", "")
        elif name == "p" and not any(e.tag == "p" for e in self.stack):
            self.stack[-1].children.append(Element("p", {}))
        elif re.fullmatch("h[1-6]", name):
            self._close({f"h{i}" for i in range(1, 7)}, SCOPE)
        elif name not in ("html", "body", "head"):
            table = name in ("table", "tr", "td", "th", "tbody", "thead", "tfoot", "caption")
            self._close({name}, {"table"} if table else SCOPE)


class _Lines:
    """Text under layout: finished lines, and the line that is being filled."""

    def __init__(self):
        self.lines: list[str] = []
        self.now: list[str] = []
        self.blank = False      # a blank line is due before the next text
        self.space = False      # white space is due within the line

    def word(self, text: str) -> None:
        words = BLANK.split(text)
        if len(words) > 1 and not words[0]:
            self.space = True
        for word in words:
            if word:
                if self.now and self.space:
                    self.now.append(" ")
                self.now.append(word)
                self.space = True
        if words[-1]:
            self.space = False

    def literal(self, text: str) -> None:
        first, *rest = text.split("\n")
        self.now.append(first)
        for line in rest:
            self.finish(True)
            self.now.append(line)

    def finish(self, empty: bool = False) -> None:
        """End the line; an empty one counts only if asked for."""
        line = "".join(self.now).rstrip(" ")
        self.now, self.space = [], False
        if line or empty:
            if self.blank and self.lines:
                self.lines.append("")
            self.blank = False
            self.lines.append(line)

    def add(self, lines: list[str]) -> None:
        self.finish()
        if lines:
            if self.blank and self.lines:
                self.lines.append("")
            self.blank = False
            self.lines += lines


def is_hidden(e: Element, hiding: dict[tuple[str, str], tuple[int, bool]]) -> bool:
    """Whether an element, with all that is in it, is not shown.

    Of style rules, one for the id comes before one for a class, and that before one for the tag;
    of equals the last one counts. A style of the element's own comes before all of them.
    """
    if e.tag in UNSEEN:
        return True
    a = e.attrs
    if a:
        if "hidden" in a or e.tag == "input" and a.get("type", "").lower() == "hidden":
            return True
        if m := DISPLAY.search(a.get("style", "")):
            if m[1].lower() == "none":
                return True
    if e.tag == "dialog" and "open" not in a:
        return True
    if not hiding:
        return False
    own = a.get("style", "")
    named_by = [(0, e.tag), (2, f"#{a.get('id')}"),
                *[(1, f".{c}") for c in a.get("class", "").split()]]
    for what, pattern in (("display", DISPLAY), ("visibility", VISIBILITY)):
        found = [(rank, *hiding[what, n]) for rank, n in named_by if (what, n) in hiding]
        if found and max(found)[2] and not pattern.search(own):
            return True
    return False


class Renderer:
    def __init__(self, tree: Tree):
        self.hiding = tree.hiding

    def _hidden(self, e: Element) -> bool:
        return is_hidden(e, self.hiding)

    def block(self, e: Element, shown: bool = True, pre: bool = False) -> list[str]:
        """The lines of an element's content."""
        out = _Lines()
        self._content(e, out, shown, pre)
        out.finish()
        while out.lines and not out.lines[-1]:
            out.lines.pop()
        return out.lines

    def _content(self, e: Element, out: _Lines, shown: bool, pre: bool) -> None:
        number = 0
        if e.tag == "ol":
            start = e.attrs.get("start", "1")
            number = int(start) - 1 if re.fullmatch(r"-?\d{1,9}", start) else 0
        closed = e.tag == "details" and "open" not in e.attrs
        for child in e.children:
            if isinstance(child, str):
                if shown and not closed:
                    out.literal(child) if pre else out.word(child)
                continue
            if self._hidden(child) or closed and child.tag != "summary":
                continue
            seen = shown
            if m := VISIBILITY.search(child.attrs.get("style", "")):
                seen = m[1].lower() not in ("hidden", "collapse")
            tag = child.tag
            if tag == "br":
                if seen:
                    out.finish(True)
            elif tag == "input":
                if seen and child.attrs.get("type", "").lower() in ("button", "submit", "reset"):
                    out.word(" " + child.attrs.get("value", "") + " ")
            elif tag == "hr":
                out.finish()
                out.blank = True
            elif tag == "li":
                number += 1
                mark = f"{number}. " if e.tag == "ol" else "- "
                lines = self.block(child, seen, pre)
                if lines:
                    indent = " " * len(mark)
                    out.add([mark + lines[0], *(indent + x if x else x for x in lines[1:])])
            elif tag in ("table",):
                out.finish()
                out.blank = True
                out.add(self._table(child, seen))
                out.blank = True
            elif tag in BLOCK:
                spaced = tag in SPACED and not (tag in ("ul", "ol") and e.tag == "li")
                out.finish()
                out.blank = out.blank or spaced
                lines = self.block(child, seen, pre or tag in ("pre", "xmp"))
                if tag in ("blockquote", "dd"):
                    lines = ["  " + x if x else x for x in lines]
                out.add(lines)
                out.blank = out.blank or spaced
            else:
                self._content(child, out, seen, pre or tag == "textarea")

    def _table(self, e: Element, shown: bool) -> list[str]:
        """Rows of cells, every column padded to its widest cell.

        A cell that spans rows keeps its columns in the rows below.
        """
        grid: list[list[tuple[int, list[str], int]]] = []
        above: list[str] = []
        taken: dict[int, int] = {}      # columns that a cell above reaches into: for how many rows

        def number(cell: Element, name: str) -> int:
            value = cell.attrs.get(name, "1")
            return max(1, min(int(value), 1000)) if re.fullmatch(r"\d{1,4}", value) else 1

        def rows(part: Element) -> None:
            loose = Element("td", {})   # text and elements that belong to no cell
            for child in part.children:
                if isinstance(child, str) or child.tag not in (
                        "tr", "thead", "tbody", "tfoot", "caption", "td", "th"):
                    loose.children.append(child)
                elif self._hidden(child):
                    continue
                elif child.tag == "caption":
                    above.extend(self.block(child, shown))
                elif child.tag == "tr":
                    cells, column, below = [], 0, {c: n - 1 for c, n in taken.items() if n > 1}
                    for cell in child.children:
                        if isinstance(cell, str) or cell.tag not in ("td", "th"):
                            loose.children.append(cell)
                        elif not self._hidden(cell):
                            while column in taken:
                                column += 1
                            span = number(cell, "colspan")
                            cells.append((column, self.block(cell, shown), span))
                            if (reach := number(cell, "rowspan")) > 1:
                                below |= dict.fromkeys(range(column, column + span), reach - 1)
                            column += span
                    taken.clear()
                    taken.update(below)
                    grid.append(cells)
                else:
                    rows(child)
            above.extend(self.block(loose, shown))

        rows(e)
        widths: dict[int, int] = {}
        for cells in grid:
            for column, lines, span in cells:
                if span == 1:
                    widths[column] = max(widths.get(column, 0), max(map(len, lines), default=0))
        last = max((column + span for cells in grid for column, _, span in cells), default=0)
        height = sum(max((len(lines) for _, lines, _ in cells), default=0) for cells in grid)
        if height * (sum(widths.values()) + 2 * last) > PADDED:
            widths = {column: min(width, WIDEST) for column, width in widths.items()}
        starts = [0]
        for column in range(last):
            starts.append(starts[-1] + widths.get(column, 0) + 2)
        out = list(above)
        for cells in grid:
            for k in range(max((len(lines) for _, lines, _ in cells), default=0)):
                line = ""
                for column, lines, _ in cells:
                    if k < len(lines):
                        # What does not fit pushes the rest on, two blanks apart.
                        line = line.ljust(starts[column]) + lines[k] if len(line) + 2 <= starts[
                            column] or not column else line.rstrip() + "  " + lines[k]
                out.append(line.rstrip())
        return [x for i, x in enumerate(out) if x or i]


def page_text(page: str) -> tuple[str, str]:
    """The title and the visible text of a page, lines separated by line ends."""
    tree = Tree(page)
    renderer = Renderer(tree)
    if renderer._hidden(tree.body):
        return tree.title, ""
    return tree.title, "\n".join(renderer.block(tree.body))


def extract_text(df: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """``page_id, title, text`` of every row.

    Null and empty pages, and pages without visible text, have an empty text; text outside
    any tag is visible. Repeated rows are rendered each; a null id stays null. Further columns
    are not read. An empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in pieces(batch, SLICE, "html"):
                found = [page_text(t.as_buffer().to_pybytes().decode("utf-8", "replace"))
                         for t in some.column("html")]
                yield record_batch({
                    "page_id": some.column("page_id"), "title": [x[0] for x in found],
                    "text": [x[1] for x in found]}, RENDERED)

    ship(df.sparkSession)
    slim = df.select(named(id_col).cast("long").alias("page_id"),
                     whole_text(html_col).cast("binary").alias("html"))
    return slim.mapInArrow(run, "page_id long, title string, text string")
