"""Per-row helper for the extraction UDFs: a tolerant HTML tree built with
the standard library's ``html.parser`` and a small XPath subset.

Supported paths: ``/`` and ``//`` steps over a tag name or ``*``, predicates
``[@a]``, ``[@a='v']``, ``[contains(@a,'v')]`` (joined with ``and``) and
``[n]``, a final ``text()`` or ``@attr`` step, ``(path)[n]``, optionally
wrapped in ``normalize-space(..)``.
Anything else raises ``UnsupportedXPath`` naming the rule.
"""

from __future__ import annotations

import re
from html import escape
from html.parser import HTMLParser

VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param",
        "source", "track", "wbr"}
# a start tag of the key closes an open element of the listed tags first
AUTO_CLOSE = {"p": {"p"}, "li": {"li"}, "option": {"option"}, "tr": {"tr"}, "td": {"td", "th"},
              "th": {"td", "th"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}}
BLOCKS_CLOSING_P = {"div", "article", "section", "ul", "ol", "table", "h1", "h2", "h3", "h4",
                    "h5", "h6", "blockquote", "pre", "form", "header", "footer", "nav", "main",
                    "aside", "figure", "p"}
SKIP_TEXT = {"script", "style", "noscript", "template"}


class Node:
    __slots__ = ("tag", "attrs", "children", "parent")

    def __init__(self, tag: str, attrs: dict | None = None, parent: "Node | None" = None):
        self.tag, self.attrs, self.children, self.parent = tag, attrs or {}, [], parent

    def elements(self):
        return [c for c in self.children if isinstance(c, Node)]

    # no recursion: a page of unclosed tags is as deep as it has tags
    def iter(self):
        todo = [self]
        while todo:
            n = todo.pop()
            yield n
            todo.extend(reversed(n.elements()))

    def text(self) -> str:
        """String value: all descendant text except scripts and styles."""
        out, todo = [], list(reversed(self.children))
        while todo:
            c = todo.pop()
            if isinstance(c, str):
                out.append(c)
            elif c.tag not in SKIP_TEXT:
                todo.extend(reversed(c.children))
        return "".join(out)

    def path(self) -> str:
        parts, n = [], self
        while n.parent is not None:
            same = [s for s in n.parent.elements() if s.tag == n.tag]
            parts.append(f"{n.tag}[{same.index(n) + 1}]" if len(same) > 1 else n.tag)
            n = n.parent
        return "/" + "/".join(reversed(parts))

    def to_html(self) -> str:
        """The element as markup; what was text is text again."""
        out, todo = [], [(self, False)]
        while todo:
            c, close = todo.pop()
            if isinstance(c, str):
                out.append(c if close else escape(c, quote=False))     # close: a script's or style's text
            elif close:
                out.append(f"</{c.tag}>")
            else:
                out.append(f"<{c.tag}" + "".join(f" {k}" if v is None else f' {k}="{escape(v)}"' for k, v in c.attrs.items()) + ">")
                if c.tag not in VOID:
                    todo.append((c, True))
                    todo.extend((x, isinstance(x, str) and c.tag in ("script", "style")) for x in reversed(c.children))
        return "".join(out)


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("#document")
        self.stack = [self.root]

    def _close(self, tags):
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i].tag in tags:
                del self.stack[i:]
                return

    def handle_starttag(self, tag, attrs):
        if tag in AUTO_CLOSE:
            open_tags = {n.tag for n in self.stack}
            hit = AUTO_CLOSE[tag] & open_tags
            if hit:
                self._close(hit)
        if tag in BLOCKS_CLOSING_P and any(n.tag == "p" for n in self.stack):
            self._close({"p"})
        node = Node(tag, dict(attrs), self.stack[-1])
        self.stack[-1].children.append(node)
        if tag not in VOID:
            self.stack.append(node)

    def handle_startendtag(self, tag, attrs):
        node = Node(tag, dict(attrs), self.stack[-1])
        self.stack[-1].children.append(node)

    def handle_endtag(self, tag):
        if any(n.tag == tag for n in self.stack[1:]):
            self._close({tag})

    def handle_data(self, data):
        self.stack[-1].children.append(data)


def parse_html(data) -> Node:
    if isinstance(data, (bytes, bytearray, memoryview)):
        data = bytes(data).decode("utf-8", errors="replace")
    b = _Builder()
    b.feed(data or "")
    b.close()
    return b.root


def normalize_space(s: str) -> str:
    return " ".join(s.split())


# ------------------------------------------------------------------ XPath
class UnsupportedXPath(ValueError):
    pass


_STEP = re.compile(r"(//|/)([A-Za-z_*][\w.-]*|text\(\)|@[\w:.-]+)((?:\[[^\]]*\])*)")
_PRED_ATTR_EQ = re.compile(r"""^@([\w:.-]+)\s*=\s*(['"])(.*)\2$""")
_PRED_CONTAINS = re.compile(r"""^contains\(\s*@([\w:.-]+)\s*,\s*(['"])(.*)\2\s*\)$""")


def _steps(path: str):
    path = path.strip()
    if not path.startswith("/"):
        path = "//" + path if not path.startswith(".") else path[1:]
    pos, out = 0, []
    while pos < len(path):
        m = _STEP.match(path, pos)
        if not m:
            raise UnsupportedXPath(path)
        preds = re.findall(r"\[([^\]]*)\]", m.group(3))
        out.append((m.group(1), m.group(2), preds))
        pos = m.end()
    return out


def _pred_ok(node: Node, pred: str) -> bool:
    parts = re.split(r"\s+and\s+", pred.strip())
    if len(parts) > 1:
        return all(_pred_ok(node, p) for p in parts)
    pred = parts[0]
    m = _PRED_ATTR_EQ.match(pred)
    if m:
        return node.attrs.get(m.group(1)) == m.group(3)
    m = _PRED_CONTAINS.match(pred)
    if m:
        return m.group(3) in (node.attrs.get(m.group(1)) or "")
    if re.fullmatch(r"@[\w:.-]+", pred):
        return pred[1:] in node.attrs
    raise UnsupportedXPath(pred)


def select(root: Node, path: str) -> list:
    """Nodes (or strings for text()/@attr) matched by ``path``; ``(path)[n]``
    takes the n-th match in document order."""
    m = re.fullmatch(r"\s*\((.*)\)\s*\[(\d+)\]\s*", path)
    if m:
        found = select(root, m.group(1))
        i = int(m.group(2))
        return found[i - 1:i]
    current: list = [root]
    for axis, name, preds in _steps(path):
        nxt: list = []
        for n in current:
            if not isinstance(n, Node):
                continue
            pool = [d for c in n.elements() for d in c.iter()] if axis == "//" else n.elements()
            if name == "text()":
                src = [d for c in n.elements() for d in c.iter()] + [n] if axis == "//" else [n]
                nxt.extend(t for s in src for t in s.children if isinstance(t, str))
                continue
            if name.startswith("@"):
                src = ([n] + pool) if axis == "//" else [n]
                nxt.extend(s.attrs[name[1:]] or "" for s in src if name[1:] in s.attrs)
                continue
            matched = [c for c in pool if name == "*" or c.tag == name]
            for p in preds:
                if p.strip().isdigit():
                    i = int(p)
                    if axis == "//":  # position among siblings of the same parent
                        matched = [c for c in matched
                                   if [s for s in c.parent.elements() if name == "*" or s.tag == name].index(c) + 1 == i]
                    else:
                        matched = matched[i - 1:i]
                else:
                    matched = [c for c in matched if _pred_ok(c, p)]
            nxt.extend(matched)
        seen, current = set(), []
        for x in nxt:
            if isinstance(x, Node):
                if id(x) in seen:
                    continue
                seen.add(id(x))
            current.append(x)
    return current


def string_value(x) -> str:
    return x.text() if isinstance(x, Node) else str(x)


def evaluate(root: Node, rule: str) -> str:
    """``normalize-space(path)``: normalised string value of the first match
    ('' when nothing matches)."""
    r = rule.strip()
    m = re.fullmatch(r"normalize-space\((.*)\)", r)
    if m:
        r = m.group(1)
    found = select(root, r)
    return normalize_space(string_value(found[0])) if found else ""


def remove(root: Node, path: str) -> None:
    """Drop matched elements; their tail text stays in the parent."""
    for n in select(root, path):
        if isinstance(n, Node) and n.parent is not None:
            n.parent.children = [c for c in n.parent.children if c is not n]
