"""HTML to text by layout: a tree with implied tags, visibility rules, and a renderer of blocks, lists and tables."""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of the HTML standard.
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
_RAW = {"script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes"}
_UNSEEN = {"head", "title", "script", "style", "template", "datalist", "noembed", "noframes", "iframe", "object", "video",
           "audio", "canvas", "svg", "math", "select", "textarea", "meta", "link", "base", "col", "colgroup", "area", "map"}
_SPACED = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "ul", "ol", "dl", "table", "blockquote", "pre", "figure", "hr", "menu"}
_BLOCK = _SPACED | {"html", "body", "div", "article", "section", "nav", "aside", "header", "footer", "main", "address",
                    "form", "fieldset", "legend", "li", "dt", "dd", "figcaption", "center", "details", "summary", "caption",
                    "tr", "thead", "tbody", "tfoot", "td", "th", "hgroup", "search", "option", "optgroup", "dialog"}
_ENDS_P = _BLOCK - {"html", "body", "tr", "thead", "tbody", "tfoot", "td", "th", "caption", "option", "optgroup", "legend"}
# An opening tag ends these elements, up to the given ones.
_IMPLIED_END = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist"}), "optgroup": ({"option", "optgroup"}, {"select"}),
    "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "tr": ({"tr", "td", "th", "caption"}, {"table"}),
    "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "thead": ({"tbody", "thead", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "body": ({"head"}, {"html"}),
}
_HEAD_ONLY = {"html", "head", "title", "meta", "link", "base", "script", "style", "template", "noscript"}

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>|<[!?/][^>]*>""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s=/>"']+)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")
_HIDDEN_STYLE = re.compile(r"display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse)", re.I)
_SPACE = re.compile(r"[ \t\n\r\f]+")


class _Node:
    __slots__ = ("tag", "attributes", "children")

    def __init__(self, tag: str, attributes: dict | None = None):
        self.tag, self.attributes, self.children = tag, attributes or {}, []


def _attributes(source: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for name, value in _ATTRIBUTE.findall(source):
        out.setdefault(name.lower(), html.unescape(value.strip("\"'")))
    return out


def parse(source: str) -> _Node:
    """The tree of a page. Missing end tags are implied, stray ones ignored; nothing is ever an error."""
    root = _Node("#root")
    stack, at, end = [root], 0, len(source)
    last_tag_end = source.rfind(">") + 1
    count: Counter[str] = Counter()  # open elements by tag, so that a stack without one is not searched

    def cut(depth: int) -> None:
        count.subtract(n.tag for n in stack[depth:])
        del stack[depth:]

    def push(node: _Node) -> None:
        stack[-1].children.append(node)
        stack.append(node)
        count[node.tag] += 1

    def text(value: str) -> None:
        if value:
            if stack[-1].tag == "head" and value.strip():
                cut(len(stack) - 1)
            stack[-1].children.append(html.unescape(value) if "&" in value else value)

    def close_to(wanted: set[str], stop: set[str]) -> None:
        for i in range(len(stack) - 1 if any(count[t] for t in wanted) else 0, 0, -1):
            if stack[i].tag in wanted:
                deepest = i
                while deepest > 1 and stack[deepest - 1].tag in wanted:
                    deepest -= 1
                cut(deepest)
                return
            if stack[i].tag in stop:
                return

    while at < end:
        found = _TAG.search(source, at) if at < last_tag_end or source.startswith("<!--", at) else None
        if not found:
            text(source[at:])
            break
        text(source[at:found.start()])
        at = found.end()
        tag = found[2] or found[5]
        if not tag:
            continue
        tag, closing, own = tag.lower(), found[1] or found[4], found[3] or found[6] or ""
        if closing:
            if tag == "p" and not count["p"]:
                stack[-1].children.append(_Node("p"))
            for i in range(len(stack) - 1 if count[tag] else 0, 0, -1):
                if stack[i].tag == tag:
                    cut(i)
                    break
                if stack[i].tag in ("table", "td", "th") and tag not in ("table", "tbody", "thead", "tfoot", "tr", "td", "th", "body", "html"):
                    break  # an end tag does not reach out of its cell
            continue
        if stack[-1].tag == "head" and tag not in _HEAD_ONLY:
            cut(len(stack) - 1)
        if tag in ("html", "body") and count[tag]:
            continue
        if tag in _IMPLIED_END:
            close_to(*_IMPLIED_END[tag])
        if tag in _ENDS_P:
            for i in range(len(stack) - 1 if count["p"] else 0, 0, -1):
                if stack[i].tag == "p":
                    cut(i)
                    break
                if stack[i].tag in ("td", "th", "table", "li", "body", "button", "caption"):
                    break
        if tag in ("td", "th") and stack[-1].tag in ("table", "tbody", "thead", "tfoot"):
            push(_Node("tr"))
        node = _Node(tag, _attributes(own) if own.strip(" /\n\t") else None)
        if tag in _VOID:
            stack[-1].children.append(node)
            continue
        if tag in _RAW:
            stack[-1].children.append(node)
            stop = re.compile(f"</{re.escape(tag)}[\\s/>]", re.I).search(source, at)
            node.children.append(source[at:stop.start() if stop else end])
            at = end if not stop else (source.find(">", stop.start()) + 1 or end)
            continue
        push(node)
    return root


def _seen(node: _Node) -> bool:
    if node.tag in _UNSEEN or "hidden" in node.attributes:
        return False
    if node.tag == "input" or node.tag == "dialog" and "open" not in node.attributes:
        return False
    return not ("style" in node.attributes and _HIDDEN_STYLE.search(node.attributes["style"]))


class _Flow:
    """Lines under construction. Breaks and blank lines collapse like margins; white space collapses outside ``pre``."""

    def __init__(self):
        self.lines: list[str] = []
        self.line, self.gap, self.indent, self.mark, self.pre = "", 0, "", "", 0

    def ended(self) -> None:
        if self.line.strip() or self.pre and self.line:
            self._put(self.line.rstrip())
        self.line = ""

    def _put(self, line: str) -> None:
        if self.gap > 1 and self.lines:
            self.lines.append("")
        self.gap = 0
        if self.mark:
            cut = max(0, len(self.indent) - len(self.mark))
            self.lines.append((self.indent[:cut] + self.mark + line).rstrip())
            self.mark = ""
        else:
            self.lines.append((self.indent + line).rstrip())

    def space(self, lines: int) -> None:
        self.ended()
        self.gap = max(self.gap, lines)

    def write(self, text: str) -> None:
        if self.pre:
            *whole, last = (self.line + text).replace("\r\n", "\n").split("\n")
            for line in whole:
                self._put(line)
            self.line = last
            return
        text = _SPACE.sub(" ", text)
        if text[:1] == " " and (not self.line or self.line[-1] == " "):
            text = text[1:]
        self.line += text

    def result(self) -> list[str]:
        self.ended()
        return self.lines


def _table(rows: list[list[tuple[list[str], int]]]) -> list[str]:
    """Rows of (cell lines, columns spanned) with their columns aligned two spaces apart."""
    widths: list[int] = []
    for row in rows:
        at = 0
        for lines, span in row:
            widths += [0] * (at + span - len(widths))
            if span == 1:
                widths[at] = max([widths[at], *map(len, lines)])
            at += span
    out = []
    for row in rows:
        for i in range(max((len(lines) for lines, _ in row), default=0)):
            line, at = "", 0
            for lines, span in row:
                width = sum(widths[at:at + span]) + 2 * (span - 1)
                line += (lines[i] if i < len(lines) else "").ljust(width) + "  "
                at += span
            out.append(line.rstrip())
    return out


def render(root: _Node) -> str:
    """All visible text of the tree. Walks with a stack of its own: any depth of nesting is safe."""
    flow, outer, lists, tables = _Flow(), [], [], []
    todo: list[tuple[bool, object]] = [(True, root)]
    while todo:
        entering, node = todo.pop()
        if isinstance(node, str):
            flow.write(node)
            continue
        tag = node.tag
        if entering:
            if not _seen(node):
                continue
            if tag == "br":
                if flow.pre or not flow.line.strip():
                    flow._put("")
                flow.ended()
                continue
            if tag in _BLOCK and tag not in ("td", "th", "tr"):
                flow.space(2 if tag in _SPACED and not (lists and tag in ("ul", "ol", "menu")) else 1)
            if tag in ("ul", "ol", "menu"):
                first = node.attributes.get("start", "1")
                lists.append([tag, int(first) if re.fullmatch(r"-?\d{1,9}", first) else 1])
                flow.indent += "  " if tag != "ol" else "   "
            elif tag == "li":
                kind = lists[-1] if lists else ["ul", 1]
                flow.mark = "- " if kind[0] != "ol" else f"{kind[1]}. "
                kind[1] += 1
                if not lists:
                    flow.indent += "  "
            elif tag in ("blockquote", "dd"):
                flow.indent += "  "
            elif tag == "pre":
                flow.pre += 1
            elif tag == "table":
                tables.append([])
            elif tag == "tr" and tables:
                tables[-1].append([])
            elif tag in ("td", "th") and tables:
                if not tables[-1]:
                    tables[-1].append([])
                outer.append((flow, lists))
                flow, lists = _Flow(), []
            todo.append((False, node))
            children = node.children
            if tag == "details" and "open" not in node.attributes:
                children = [c for c in children if isinstance(c, _Node) and c.tag == "summary"][:1]
            todo.extend((True, c) for c in reversed(children))
            continue
        if tag in ("td", "th") and tables:
            span = node.attributes.get("colspan", "1")
            cell = [line for line in flow.result() if line], min(int(span), 1000) if re.fullmatch(r"[1-9]\d{0,3}", span) else 1
            flow, lists = outer.pop()
            tables[-1][-1].append(cell)
            continue
        if tag == "table":
            flow.ended()
            for line in _table(tables.pop()):
                flow._put(line)
        elif tag == "pre":
            flow.ended()
            flow.pre -= 1
        elif tag in ("ul", "ol", "menu"):
            flow.ended()
            flow.indent = flow.indent[:-2 if tag != "ol" else -3]
            lists.pop()
        elif tag in ("blockquote", "dd") or tag == "li" and not lists:
            flow.ended()
            flow.indent = flow.indent[:-2]
        if tag in _BLOCK and tag != "tr":
            flow.space(2 if tag in _SPACED and not (tag in ("ul", "ol", "menu") and lists) else 1)
            if tag == "li":
                flow.mark = ""
    return "\n".join(flow.result())


def html_to_text(source: str | None) -> str:
    return render(parse(source)) if source else ""


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at = batch.schema.get_field_index("html")
        texts = pa.array([html_to_text(h) for h in batch.column(at).to_pylist()], pa.string())
        names = [n for n in batch.schema.names if n != "html"]
        yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), texts], [*names, "text"])


def extract_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_lines (lines with text) of every page; a null or empty page gives an empty text.

    Pages are read one by one and whole. Rows that repeat stay.
    """
    made = pages.select("page_id", "url", "html").mapInArrow(_extracted, "page_id bigint, url string, text string")
    lines = F.size(F.filter(F.split("text", "\n"), lambda x: F.trim(x) != ""))
    return made.withColumn("n_lines", lines.cast("long"))
