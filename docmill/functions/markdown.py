"""HTML to Markdown, tag by tag with what is open.

Lists nest and count, rows of a table become a table, quotes are marked line by line, code stays as it is. Marks around
words (emphasis, code, struck words) are written where the element closes in the block it opened in, so that a page with
a forgotten end tag has no lone marks. White space outside of code is one blank, or a line end where it holds one and the
line may end (not in headings and cells). Character references are decoded where they end in `;`. A tag does not hold
`<` or `>`; what is no tag is text. Lists and quotes within more than DEEP others get no further marks of depth, so time
is linear in the page.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field
from html import unescape

SILENT = frozenset("script style head template".split())
BREAKS = frozenset("p div article nav footer header section main aside figure dl dt dd form fieldset address table thead tbody tfoot caption".split())
INLINE = {"b": "**", "strong": "**", "i": "*", "em": "*", "code": "`", "s": "~~", "del": "~~", "a": ""}
LISTS = frozenset(("ul", "ol", "blockquote"))
DEEP = 16
_TAG = re.compile(r"<(?:(!--)|(/?)([A-Za-z][A-Za-z0-9]*)\b([^<>]*)>|[!?/][^<>]*>)")
_ATTRIBUTE = r"""(?:^|[\s"'/]){}\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
_HREF, _SRC, _ALT, _START = (re.compile(_ATTRIBUTE.format(x), re.I) for x in ("href", "src", "alt", "start"))
_REFERENCE = re.compile(r"&(?:#[0-9]{1,7}|#[xX][0-9A-Fa-f]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});")
_BLANKS = re.compile(r"[ \t\n\r\f]+")
_TRAILING, _LINES = re.compile(r"(?<![ \t])[ \t]+\n"), re.compile(r"\n{3,}")
#: A line end inside of code, until all other ones are tidied.
_KEPT = "\0"


def _decoded(text: str) -> str:
    return _REFERENCE.sub(lambda m: unescape(m[0]).replace("\xa0", " "), text)


def _attribute(pattern: re.Pattern, tag: str) -> str | None:
    m = pattern.search(tag)
    return None if m is None else _decoded(next(x for x in m.groups() if x is not None))


def _tidy(text: str) -> str:
    return _LINES.sub("\n\n", _TRAILING.sub("\n", text))


@dataclass
class _Frame:
    """A list, a quote or the page: where it begins in the output, and the inline elements that are open in it."""

    name: str
    begin: int
    indent: str = ""
    number: int = 0
    inline: list[tuple[str, int, int, int, str | None]] = field(default_factory=list)  # name, place in the output, block, words before, target
    open: Counter = field(default_factory=Counter)


class _Writer:
    def __init__(self) -> None:
        self.out: list[str] = []
        self.fresh = True  # at the start of a line or behind white space
        self.words = 0  # pieces of text that are not blank
        self.block = 0  # goes up with every block
        self.frames = [_Frame("", 0)]
        self.open = Counter()
        self.code: list[str] | None = None  # what an open pre holds
        self.cells = self.heads = 0
        self.line = False  # in a heading or a cell

    def put(self, mark: str) -> None:
        self.out.append(mark)
        self.fresh = True
        self.block += 1

    def text(self, raw: str) -> None:
        if self.code is not None:
            self.code.append(_decoded(raw))
            return
        words = _BLANKS.sub(" " if self.line else lambda m: "\n" if "\n" in m[0] else " ", raw)
        words = _decoded(words[1:] if self.fresh and words[:1] in (" ", "\n") else words)
        if words:
            self.out.append(words)
            self.fresh = words[-1] in " \n"
            self.words += not words.isspace()

    def end_code(self) -> None:
        held, self.code = "".join(self.code), None
        self.put("\n```\n" + held.removeprefix("\n").removesuffix("\n").replace("\n", _KEPT) + "\n```\n")

    def end_frame(self) -> None:
        f = self.frames.pop()
        self.open[f.name] -= 1
        if f.name == "blockquote" and self.open[f.name] < DEEP:
            held = _tidy("".join(self.out[f.begin :])).strip("\n")
            del self.out[f.begin :]
            self.out.append("\n\n" + "\n".join(f"> {x}".rstrip() for x in held.split("\n")).replace(_KEPT, _KEPT + "> ") + "\n\n")
        if self.frames[-1].name not in ("ul", "ol") or f.name == "blockquote":
            self.put("\n\n")
        else:
            self.put("" if self.at_line() else "\n")

    def at_line(self) -> bool:
        return next((x.endswith("\n") for x in reversed(self.out[-4:]) if x), not self.out)

    def start(self, name: str, tag: str) -> None:
        if self.code is not None:
            return
        frame = self.frames[-1]
        if name in INLINE:
            frame.inline.append((name, len(self.out), self.block, self.words, _attribute(_HREF, tag) if name == "a" else None))
            frame.open[name] += 1
            self.out.append("")
        elif name == "pre":
            self.code = []
        elif name in LISTS:
            self.put("\n\n" if frame.name not in ("ul", "ol") or name == "blockquote" else "")
            deeper = {"ul": "  ", "ol": "   "}.get(frame.name, "") if len(frame.indent) < 2 * DEEP else ""
            indent = "" if name == "blockquote" else frame.indent + deeper
            begin = _attribute(_START, tag) or "1"
            self.frames.append(_Frame(name, len(self.out), indent, int(begin) if begin.isdecimal() and len(begin) < 10 else 1))
            self.open[name] += 1
        elif name == "li":
            begin = frame.indent if self.at_line() else "\n" + frame.indent
            self.put(f"{begin}{frame.number}. " if frame.name == "ol" else f"{begin}- ")
            frame.number += 1
        elif len(name) == 2 and name[0] == "h" and name[1] in "123456":
            self.put("\n" + "#" * int(name[1]) + " ")
            self.line = True
        elif name == "br":
            self.out.append(" " if self.line else "\n")
            self.fresh = True
        elif name == "hr":
            self.put("\n\n---\n\n")
        elif name == "img" and (target := _attribute(_SRC, tag)):
            self.out.append(f"![{_BLANKS.sub(' ', _attribute(_ALT, tag) or '')}]({target})")
            self.fresh = False
            self.words += 1
        elif name == "tr":
            self.end_row()
            self.put("\n")
        elif name in ("td", "th"):
            self.put(" | " if self.cells else "| ")
            self.cells += 1
            self.line = True
            self.heads += name == "th"
        elif name in BREAKS:
            self.part(name)

    def part(self, name: str) -> None:
        """Where a block begins or ends; inside of a cell it is a blank."""
        if self.cells and name != "table":
            self.out.append("" if self.fresh else " ")
            self.fresh = True
        else:
            self.line = False
            self.put("" if name in ("thead", "tbody", "tfoot") else "\n\n")

    def end_row(self) -> None:
        if self.cells:
            self.put(" |" + ("\n" + "|---" * self.cells + "|" if self.heads == self.cells else ""))
        self.cells = self.heads = 0
        self.line = False

    def end(self, name: str) -> None:
        if self.code is not None:
            if name == "pre":
                self.end_code()
            return
        if name in INLINE:
            self.end_inline(name)
        elif name in LISTS:
            while self.open[name]:
                found = self.frames[-1].name
                self.end_frame()
                if found == name:
                    break
        elif name == "tr":
            self.end_row()
        elif len(name) == 2 and name[0] == "h" and name[1] in "123456":
            self.put("\n")
            self.line = False
        elif name in BREAKS:
            if name in ("table", "thead", "tbody", "tfoot"):
                self.end_row()
            self.part(name)

    def end_inline(self, name: str) -> None:
        frame = self.frames[-1]
        while frame.open[name]:
            found, at, block, words, target = frame.inline.pop()
            frame.open[found] -= 1
            if found != name:
                continue
            if name == "a":
                if target is not None:
                    self.out[at] = "["
                    self.out.append(f"]({target})")
                    self.fresh = False
            elif block == self.block and words < self.words:
                last = self.out[-1]
                self.out[-1] = last.rstrip()
                self.out[at] = INLINE[name]
                self.out += [INLINE[name], last[len(last.rstrip()) :]]
            break

    def finish(self) -> str:
        if self.code is not None:
            self.end_code()
        self.end_row()
        while len(self.frames) > 1:
            self.end_frame()
        return _tidy("".join(self.out)).strip().replace(_KEPT, "\n")


def markdown(page: str) -> str:
    page = page.replace(_KEPT, "�").replace("\r\n", "\n")
    w, at, never = _Writer(), 0, set()
    for_text = 0
    while (m := _TAG.search(page, at)) is not None:
        at = m.end()
        name = m[3].lower() if m[3] else ""
        skip = None
        if m[1] and "-->" not in never:
            skip = page.find("-->", at), 3
        elif name in SILENT and not m[2] and name not in never:
            closing = re.compile(rf"</{name}\s*>", re.I).search(page, at)
            skip = (closing.start(), closing.end() - closing.start()) if closing else (-1, 0)
        if m.start() > for_text:
            w.text(page[for_text : m.start()])
        for_text = at
        if skip is not None:
            if skip[0] < 0:
                never.add("-->" if m[1] else name)
            else:
                at = for_text = sum(skip)
        elif m[2]:
            w.end(name)
        elif name:
            w.start(name, m[4])
    w.text(page[for_text:])
    return w.finish()
