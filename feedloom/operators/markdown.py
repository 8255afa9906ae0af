"""Markdown of an HTML page in one pass over its flat events.

A stack holds the open elements.  Inline elements collect pieces of the
paragraph at hand; block elements collect finished blocks.  A block that starts
inside inline elements ends the paragraph: what is open is closed before it,
opened again inside it and behind it, so emphasis and links never span blocks.
"""

from __future__ import annotations

import re

_BLOCKS = {"#root", "html", "body", "head", "title", "main", "article", "section", "div", "p", "h1", "h2", "h3", "h4", "h5", "h6", "ul", "ol", "menu", "li", "dl",
           "dt", "dd", "blockquote", "pre", "table", "thead", "tbody", "tfoot", "tr", "td", "th", "caption", "hr", "header", "footer", "nav", "aside", "form",
           "figure", "figcaption", "address", "fieldset", "details", "summary", "option", "select"}
_MARK = {"b": "**", "strong": "**", "i": "*", "em": "*", "del": "~~", "s": "~~", "strike": "~~"}
_CODE = {"code", "kbd", "samp"}
_BULLETS = "*+-"
_SPACE = re.compile(r"[ \t\r\n\f\v ]+")
_SPECIAL = re.compile(r"([\\`*_])")
_LOOKS_LIKE_BLOCK = re.compile(r"(#{1,6}(?= |$)|[+-](?= |$)|>|\d{1,9}(?=[.)](?: |$))|~~~|=+$)")


class _Frame:
    """An open element: its node, the paragraph at hand, and (blocks only) finished ``(kind, text)`` blocks."""

    __slots__ = ("node", "tag", "pieces", "blocks", "again", "count")

    def __init__(self, node, tag, block):
        self.node, self.tag, self.pieces = node, tag, []
        self.blocks = [] if block else None
        self.again: list = []  # inline elements to open again behind this block
        self.count = 0


def _edges(text: str) -> tuple[str, str, str]:
    body = text.strip()
    if not body:
        return text, "", ""
    at = text.index(body)
    return text[:at], body, text[at + len(body):]


def _ticks(text: str, least: int) -> str:
    """A run of back ticks longer than any in the text."""
    return "`" * max([least, *(len(r) + 1 for r in re.findall("`+", text))])


def _indent(text: str, first: str, rest: str) -> str:
    lines = text.split("\n")
    return "\n".join([first + lines[0], *(rest + x if x else x for x in lines[1:])])


def _join(blocks: list[tuple[str, str]], tight: bool = False) -> str:
    """Blocks with a blank line between; list items follow each other without, as do lists below an item's text (``tight``)."""
    out = []
    for i, (kind, text) in enumerate(blocks):
        if i:
            out.append("\n" if (kind == "item" and blocks[i - 1][0] == "item") or (tight and kind == "list") else "\n\n")
        out.append(text)
    return "".join(out)


class Writer:
    """The stack machine; ``nodes`` are ``[tag, attrs, ...]`` by number."""

    def __init__(self, nodes):
        self.nodes = nodes
        self.stack = [_Frame(-1, "#root", True)]
        self.lists: list[list] = []  # kind and next number of the open lists
        self.marks: dict[str, int] = {}
        self.raw = self.line = 0  # inside pre or code; inside a heading or cell

    def run(self, events) -> str:
        for kind, v in events:
            if kind == "t":
                self._text(v)
            elif kind == "s":
                self._start(v)
            elif kind == "e":
                self._end(v)
        self._paragraph()
        return _join(self.stack[0].blocks)

    # ------------------------------------------------------------ inline
    def _text(self, text: str) -> None:
        if not self.raw:
            text = _SPECIAL.sub(r"\\\1", _SPACE.sub(" ", text))
        self.stack[-1].pieces.append(text)

    def _close_inline(self, frame) -> str:
        """The markdown of an inline element's pieces."""
        text, tag = "".join(frame.pieces), frame.tag
        attrs = self.nodes[frame.node][1] if frame.node >= 0 else {}
        if tag in _MARK:
            self.marks[_MARK[tag]] -= 1
            if self.marks[_MARK[tag]] or self.raw:  # inside the same emphasis
                return text
            before, body, after = _edges(text)
            return f"{before}{_MARK[tag]}{body}{_MARK[tag]}{after}" if body else text
        if tag in _CODE:
            self.raw -= 1
            if self.raw:  # inside pre
                return text
            body = _SPACE.sub(" ", text).strip()
            fence = _ticks(body, 1)
            pad = " " if body.startswith("`") or body.endswith("`") else ""
            return f"{fence}{pad}{body}{pad}{fence}" if body else text
        if tag == "a" and attrs.get("href") and not self.raw:
            before, body, after = _edges(text)
            title = attrs.get("title", "").replace('"', r"\"")
            href = attrs["href"].strip()
            if body and not title and body.replace("\\", "") == href:
                return f"{before}<{href}>{after}"
            return f"{before}[{body}]({href}{f' {chr(34)}{title}{chr(34)}' if title else ''}){after}" if body else text
        if tag == "q" and not self.raw:
            return f'"{text}"'
        return text

    def _paragraph(self) -> None:
        """Close the open inline elements, and the paragraph of the block they are in."""
        again = []
        while self.stack[-1].blocks is None:
            frame = self.stack.pop()
            again.append(frame.node)
            self.stack[-1].pieces.append(self._close_inline(frame))
        block = self.stack[-1]
        text, block.pieces = "".join(block.pieces), []
        if block.tag == "pre":
            if text:
                block.blocks.append(("raw", text))
        else:
            lines = [_SPACE.sub(" ", x).strip() for x in text.split("\n")]
            while lines and not lines[0]:
                lines.pop(0)
            while lines and not lines[-1]:
                lines.pop()
            if lines:
                lines[0] = _LOOKS_LIKE_BLOCK.sub(lambda m: m.group() + "\\" if m.group()[0].isdigit() else "\\" + m.group(), lines[0], count=1) \
                    if _LOOKS_LIKE_BLOCK.match(lines[0]) and not self.line else lines[0]
                block.blocks.append(("text", (" " if self.line else "  \n").join(lines)))
        block.again = again[::-1]

    def _open_inline(self, node: int) -> None:
        tag = self.nodes[node][0]
        if tag in _MARK:
            self.marks[_MARK[tag]] = self.marks.get(_MARK[tag], 0) + 1
        self.raw += tag in _CODE
        self.stack.append(_Frame(node, tag, False))

    # ------------------------------------------------------------- events
    def _start(self, node: int) -> None:
        tag, attrs = self.nodes[node][:2]
        if tag == "br":
            self.stack[-1].pieces.append("\n")
        elif tag == "img":
            alt, src = attrs.get("alt", "").strip(), attrs.get("src", "").strip()
            if self.line:
                self._text(alt)
            elif src:
                self.stack[-1].pieces.append(f"![{alt}]({src})")
        elif tag in _BLOCKS:
            self._paragraph()
            if tag == "hr":
                self.stack[-1].blocks.append(("text", "---"))
                self._reopen(self.stack[-1])
                return
            again = self.stack[-1].again
            self.stack.append(_Frame(node, tag, True))
            for n in again:
                self._open_inline(n)
            if tag in ("ul", "ol", "menu"):
                start = attrs.get("start", "")
                self.lists.append(["ol", int(start) if start.isascii() and start.isdigit() and len(start) < 10 else 1] if tag == "ol" else ["ul", 0])
            self.raw += tag == "pre"
            self.line += tag in ("td", "th", "caption") or (len(tag) == 2 and tag[0] == "h")
        else:
            self._open_inline(node)

    def _reopen(self, block) -> None:
        again, block.again = block.again, []
        for n in again:
            self._open_inline(n)

    def _end(self, node: int) -> None:
        tag = self.nodes[node][0]
        if self.stack[-1].node == node and self.stack[-1].blocks is None:
            frame = self.stack.pop()
            self.stack[-1].pieces.append(self._close_inline(frame))
            return
        if tag not in _BLOCKS or tag == "hr":
            return
        self._paragraph()
        frame = self.stack[-1]
        if frame.node != node:
            return
        self.stack.pop()
        parent = self.stack[-1]
        blocks = frame.blocks
        if tag == "pre":
            self.raw -= 1
            text = "".join(t for _, t in blocks).strip("\n")
            fence = _ticks(text, 3)
            blocks = [("text", f"{fence}\n{text}\n{fence}")] if text.strip() else []
        elif len(tag) == 2 and tag[0] == "h" and tag[1].isdigit():
            self.line -= 1
            text = " ".join(t.replace("\n", " ") for _, t in blocks)
            blocks = [("text", "#" * int(tag[1]) + " " + text)] if text else []
        elif tag in ("td", "th", "caption"):
            self.line -= 1
            text = " ".join(t.replace("  \n", " ").replace("\n", " ") for _, t in blocks)
            blocks = [("text", text)] if tag == "caption" else [("head" if tag == "th" else "cell", text.replace("|", r"\|"))]
        elif tag == "tr":
            cells = [t for k, t in blocks if k in ("head", "cell")]
            blocks = [("row", "| " + " | ".join(cells) + " |")] if cells else []
            parent.count = max(parent.count, len(cells))
        elif tag in ("thead", "tbody", "tfoot"):
            parent.count = max(parent.count, frame.count)
        elif tag == "table":
            rows = [t for k, t in blocks if k == "row"]
            width = frame.count
            # the first row is the head; short rows get empty cells
            rows = [r + "  |" * (width - _cells(r)) for r in rows]
            rule = "|" + " --- |" * width
            blocks = [b for b in blocks if b[0] != "row"] + ([("text", "\n".join([rows[0], rule, *rows[1:]]))] if rows else [])
        elif tag == "blockquote":
            text = _join(blocks)
            blocks = [("text", "\n".join("> " + x if x else ">" for x in text.split("\n")))] if text else []
        elif tag in ("ul", "ol", "menu"):
            self.lists.pop()
            blocks = [("list", _join([(k if k == "item" else "text", t) for k, t in blocks]))] if blocks else []
        elif tag == "li":
            bullet = _BULLETS[0]
            if self.lists:
                kind, n = self.lists[-1]
                bullet = f"{n}." if kind == "ol" else _BULLETS[(sum(k == "ul" for k, _ in self.lists) - 1) % 3]
                self.lists[-1][1] += 1
            text = _join(blocks, tight=True)
            blocks = [("item", _indent(text, bullet + " ", " " * (len(bullet) + 1)))] if text else []
        parent.blocks += blocks
        self._reopen(parent)


def _cells(row: str) -> int:
    return len(re.findall(r"(?<!\\)\|", row)) - 1


def to_markdown(nodes, events) -> str:
    """Markdown of events ``(kind, value)`` with kind s(tart), e(nd), t(ext) over ``nodes``."""
    return Writer(nodes).run(events)
