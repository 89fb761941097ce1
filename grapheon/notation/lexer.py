"""Text to tokens, by one regular expression. Line comments and white space are dropped; block comments are tokens."""

from __future__ import annotations

import re
from typing import NamedTuple

# Fixed values of the notation: operators.
OPERATORS = """
::> !== === :>>
?? :> :: := == != <= >= .. -> ?. **
: = < > + - * / % ^ & | ~ ! # @ , ; . ( ) [ ] { } ?
""".split()

_TOKEN = re.compile(
    r"(?P<space>\s+|//[^\n]*)|/\*(?P<comment>.*?)\*/|(?P<open>/\*)|'(?P<quoted>(?:[^'\\]|\\.)*)'|\"(?P<string>(?:[^\"\\]|\\.)*)\""
    r"|(?P<number>\d+(?:\.\d+)?(?:[eE][+-]?\d+)?)|(?P<word>[^\W\d]\w*)|(?P<op>" + "|".join(re.escape(x) for x in sorted(OPERATORS, key=len, reverse=True)) + ")",
    re.DOTALL,
)


class Token(NamedTuple):
    kind: str  # word, quoted (a name in quotes), string, number, comment or op
    text: str
    line: int
    column: int

    @property
    def is_name(self) -> bool:
        return self.kind in ("word", "quoted")


class NotationError(ValueError):
    def __init__(self, message: str, line: int, column: int):
        super().__init__(f"{message} at {line}:{column}")
        self.message, self.line, self.column = message, line, column


def without_margin(comment: str) -> str:
    """A block comment's text without the asterisk that a line may begin with."""
    return "\n".join(re.sub(r"^\s*\* ?", "", x).strip() for x in comment.split("\n")).strip()


def tokens(text: str) -> list[Token]:
    """Raises NotationError at a character that starts no token, such as an open quote, and at a comment that nothing ends."""
    out, at, line, begin = [], 0, 1, 0
    while at < len(text):
        m = _TOKEN.match(text, at)
        if m is None:
            raise NotationError(f"unexpected {text[at]!r}", line, at - begin + 1)
        kind, raw = m.lastgroup, m.group()
        if kind == "open":
            raise NotationError("a comment is not ended", line, at - begin + 1)
        if kind != "space":
            inner = m.group(kind)
            if kind in ("quoted", "string"):
                inner = re.sub(r"\\(.)", lambda x: {"n": "\n", "t": "\t", "r": "\r", "b": "\b", "f": "\f"}.get(x[1], x[1]), inner)
            out.append(Token(kind, without_margin(inner) if kind == "comment" else inner, line, at - begin + 1))
        breaks = raw.count("\n")
        if breaks:
            line += breaks
            begin = at + raw.rindex("\n") + 1
        at = m.end()
    return out
