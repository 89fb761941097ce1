"""Tokens to declarations, in two steps.

First the brackets: a text is a list of statements, each a head (tokens up to `;` or `{`) and a body of statements. Then each head: what stands before
the keyword, the keyword phrase, the names, and slots. A slot starts at a marker (`:`, `:>`, `=`, `by`, `to`, ...) and ends at the next one; it
holds references or an expression. So a new form is a row of a table.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from grapheon.notation.lexer import NotationError, Token, tokens

# Fixed values of the notation: words before a keyword.
MODIFIERS = set("abstract variation variant individual readonly derived end ref ordered nonunique constant portion standard library crossing default bare".split())
DIRECTIONS, VISIBILITY = {"in", "out", "inout"}, {"public", "private", "protected"}
# Kinds that a keyword declares under its own name, and keywords whose kind has another name.
PLAIN = """attribute occurrence item part port connection interface flow allocation action state constraint requirement concern case analysis verification view
viewpoint rendering metadata package snapshot timeslice event message transition succession binding if loop subject actor stakeholder objective return entry exit do
accept send assign dependency import alias filter expose decide merge fork join terminate doc comment rep""".split()
RENAMED = {
    "enum": "enumeration", "calc": "calculation", "use case": "usecase", "use": "usecase", "analysis case": "analysis", "verification case": "verification",
    "event occurrence": "event", "succession flow": "succession", "while": "loop", "for": "loop", "connect": "connection", "bind": "binding", "allocate": "allocation",
    "first": "succession", "then": "succession",
}
KINDS = {x: x for x in PLAIN} | RENAMED
# Words that name the relation to the owner, with the relation and the kind where no keyword follows.
RELATIONS = {
    "perform": ("performs", "action"), "exhibit": ("exhibits", "state"), "include": ("includes", "usecase"), "assert": ("asserts", "constraint"), "assume": ("assumes", "constraint"),
    "require": ("requires", "constraint"), "satisfy": ("satisfies", "requirement"), "verify": ("verifies", "requirement"), "refine": ("refines", "requirement"),
    "derive": ("derives", "requirement"), "frame": ("frames", "concern"), "render": ("renders", "rendering"), "expose": ("exposes", "expose"), "do": ("doAction", "action"),
    "entry": ("entryAction", "action"), "exit": ("exitAction", "action"),
}
# Markers of slots, with the slot.
SLOTS = {
    ":": "type", ":>": "super", ":>>": "redefines", "::>": "references", "=": "value", ":=": "value", "defined by": "type", "typed by": "type", "specializes": "super",
    "subsets": "super", "redefines": "redefines", "references": "references", "conjugates": "conjugate", "conjugate": "conjugate", "disjoint from": "disjointFrom",
    "inverse of": "inverseOf", "unions": "unionOf", "intersects": "intersectionOf", "differences": "differenceOf", "chains": "chainOf", "by": "by", "connect": "ends",
    "of": "payload", "from": "from", "to": "to", "first": "first", "accept": "accept", "if": "guard", "do": "effect", "then": "then", "via": "via", "for": "for", "else": "otherwise",
}
#: The slot that begins right after the keyword, where the words that follow are no new name.
OPENING = {"connect": "ends", "allocate": "from", "bind": "ends", "first": "first", "then": "then", "import": "imported", "send": "payload", "assign": "to", "filter": "value", "expose": "exposed", "accept": "accept", "if": "guard", "while": "guard"}
EXPRESSIONS = {"value", "guard"}
# Binary operators, those that bind least first.
LEVELS = [("??",), ("implies",), ("|", "or"), ("xor",), ("&", "and"), ("==", "!=", "===", "!=="), ("<", ">", "<=", ">="), ("..",), ("+", "-"), ("*", "/", "%"), ("^",)]
_LEVEL = {x: i for i, level in enumerate(LEVELS) for x in level}
_CLOSED = {"(": ")", "[": "]"}


@dataclass
class Statement:
    head: list[Token]
    body: list[Statement] | None = None
    ended: bool = True  # false for a last statement that nothing ends: a result expression


@dataclass
class Declaration:
    kind: str
    line: int
    column: int
    name: str | None = None
    short_name: str | None = None
    is_definition: bool = False
    modifiers: list[str] = field(default_factory=list)
    visibility: str | None = None
    direction: str | None = None
    conjugated: bool = False
    relation: str | None = None
    multiplicity: dict | None = None
    value: dict | None = None
    expression: dict | None = None
    doc: str | None = None
    comments: list[str] = field(default_factory=list)
    annotations: list[dict] = field(default_factory=list)
    refs: list[tuple[str, list[str]]] = field(default_factory=list)  # slot; names and the marks between them
    children: list[Declaration] = field(default_factory=list)


def statements(toks: list[Token]) -> list[Statement]:
    """The bracket structure, with a stack of open bodies."""
    top: list[Statement] = []
    stack, head, depth = [top], [], 0
    carried: list[Statement] | None = None  # the body of a statement whose tail comes after it
    for i, t in enumerate(toks):
        if t.kind == "comment" and depth == 0:
            stack[-1].append(Statement([*head, t]))
            head = []
        elif t.kind == "op" and t.text in "([":
            depth += 1
            head.append(t)
        elif t.kind == "op" and t.text in ")]":
            depth -= 1
            head.append(t)
        elif t.kind == "op" and depth == 0 and t.text == ";":
            if head:
                stack[-1].append(Statement(head, carried))
            head, carried = [], None
        elif t.kind == "op" and depth == 0 and t.text == "{":
            opened = Statement(head, [])
            stack[-1].append(opened)
            stack.append(opened.body)
            head = []
        elif t.kind == "op" and depth == 0 and t.text == "}":
            if len(stack) == 1:
                raise NotationError("a body ends that wasn't begun", t.line, t.column)
            if head:
                stack[-1].append(Statement(head, None, False))
            stack.pop()
            head = []
            follows = toks[i + 1] if i + 1 < len(toks) else None
            if follows and follows.text in (":>", ":>>", "::>") and follows.kind == "op" and stack[-1]:
                before = stack[-1].pop()
                head, carried = before.head, before.body
        else:
            head.append(t)
    if len(stack) > 1 or depth:
        last = toks[-1]
        raise NotationError("a body or bracket is not ended", last.line, last.column)
    if head:
        top.append(Statement(head, None, False))
    return top


def joined(toks: list[Token]) -> str:
    out = ""
    for t in toks:
        text = f'"{t.text}"' if t.kind == "string" else t.text
        tight = t.kind == "op" and text in (")", "]", ",", ".", "::", "[", "(") or out.endswith(("(", "[", ".", "::"))
        out += text if tight or not out else " " + text
    return out


def chains(toks: list[Token]) -> list[list[str]]:
    """References of a token list: names with `::` or `.` between them; wildcards may end one. Called functions and units are none."""
    out, i, brackets = [], 0, 0
    while i < len(toks):
        t = toks[i]
        brackets += (t.text == "[") - (t.text == "]") if t.kind == "op" else 0
        if not t.is_name or t.kind == "word" and t.text in ("true", "false", "null", "and", "or", "xor", "not", "implies", "else", "as", "istype", "hastype", "all", "meta"):
            i += 1
            continue
        chain = [t.text]
        i += 1
        while i + 1 < len(toks) and toks[i].kind == "op" and toks[i].text in ("::", ".") and (toks[i + 1].is_name or toks[i + 1].text in ("*", "**")):
            chain += [toks[i].text, toks[i + 1].text]
            i += 2
        if not brackets and not (i < len(toks) and toks[i].kind == "op" and toks[i].text == "("):
            out.append(chain)
    return out


def value_of(toks: list[Token]) -> dict | None:
    """A literal, a quantity, a reference or an expression. A negative number is an expression."""
    if not toks:
        return None
    first, text = toks[0], joined(toks)
    if len(toks) == 1:
        if first.kind == "number":
            return {"num": float(first.text), "text": text}
        if first.kind == "string":
            return {"str": first.text, "text": text}
        if first.kind == "word" and first.text in ("true", "false"):
            return {"bool": first.text == "true", "text": text}
        if first.kind == "word" and first.text == "null":
            return None
    if first.kind == "number" and len(toks) > 3 and toks[1].text == "[" and toks[-1].text == "]" and not any(t.text == "[" for t in toks[2:]):
        unit = chains(toks[2:-1])
        return {"num": float(first.text), "unit": unit[-1][-1] if unit else joined(toks[2:-1]), "text": text}
    names = chains(toks)
    if len(names) == 1 and 2 * len(toks) - 1 >= len(names[0]) == len(toks):
        return {"reference": "".join(names[0]), "text": text}
    return {"expression": text, "operator": _operator(toks), "text": text, "tree": json.dumps(tree(toks), ensure_ascii=False)}


def _operator(toks: list[Token]) -> str:
    """The operator at an expression's root: the rightmost one of those that bind least."""
    depth, best, found = 0, len(LEVELS), None
    for i, t in enumerate(toks):
        if t.kind == "op" and t.text in _CLOSED:
            depth += 1
        elif t.kind == "op" and t.text in _CLOSED.values():
            depth -= 1
        elif depth == 0 and i and t.kind in ("op", "word") and _LEVEL.get(t.text, 99) <= best:
            before = toks[i - 1]
            if before.kind != "op" or before.text in (")", "]"):
                best, found = _LEVEL[t.text], t.text
    if found:
        return found
    if toks[0].text in ("-", "+", "~", "!", "not", "all"):
        return "unary " + toks[0].text
    return "if" if toks[0].text == "if" else "index" if toks[-1].text == "]" else "call" if toks[-1].text == ")" else "expression"


class _Tree:
    """An expression's tokens to nested lists, an operator and its operands, by binding powers."""

    def __init__(self, toks: list[Token]):
        self.toks, self.at = toks, 0

    def next(self, *texts: str) -> bool:
        """Whether the next token is one of these; then it is taken."""
        t = self.toks[self.at] if self.at < len(self.toks) else None
        if t is None or t.kind not in ("op", "word") or t.text not in texts:
            return False
        self.at += 1
        return True

    def binary(self, least: int = 0) -> list:
        left = self.unary()
        while self.at < len(self.toks):
            t = self.toks[self.at]
            level = _LEVEL.get(t.text, -1) if t.kind in ("op", "word") else -1
            if level < least:
                break
            self.at += 1
            left = [t.text, left, self.binary(level + 1)]
        return left

    def unary(self) -> list:
        sign = self.toks[self.at].text if self.at < len(self.toks) else ""
        if self.next("-", "+", "~", "!", "not", "all"):
            return ["unary " + sign, self.unary()]
        return self.postfix(self.primary())

    def arguments(self, end: str) -> list:
        out: list = []
        while self.at < len(self.toks) and not self.next(end):
            before = self.at
            out.append(self.binary())
            self.next(",", "=")
            self.at += self.at == before
        return out

    def postfix(self, node: list) -> list:
        while self.at < len(self.toks):
            t = self.toks[self.at]
            if self.next("("):
                node = ["call", node, *self.arguments(")")]
            elif self.next("["):
                inner = self.arguments("]")
                node = ["quantity" if node[0] == "number" else "index", node, *inner]
            elif self.next("->", "?.", "."):
                node = [t.text, node, self.primary()]
            elif self.next("as", "istype", "hastype", "meta"):
                node = [t.text, node, self.primary()]
            else:
                break
        return node

    def primary(self) -> list:
        if self.at >= len(self.toks):
            return ["empty"]
        if self.next("("):
            inner = self.arguments(")")
            return inner[0] if len(inner) == 1 else ["list", *inner]
        if self.next("if"):
            condition = self.binary()
            self.next("?", "then")
            yes = self.binary()
            self.next("else")
            return ["if", condition, yes, self.binary()]
        t = self.toks[self.at]
        self.at += 1
        if t.kind == "number":
            return ["number", float(t.text)]
        if t.kind == "string":
            return ["string", t.text]
        if t.kind == "word" and t.text in ("true", "false", "null"):
            return [t.text]
        if t.is_name:
            name = t.text
            while self.at + 1 < len(self.toks) and self.toks[self.at].text in ("::", ".") and self.toks[self.at].kind == "op" and self.toks[self.at + 1].is_name:
                name += self.toks[self.at].text + self.toks[self.at + 1].text
                self.at += 2
            return ["reference", name]
        return ["token", t.text]


def tree(toks: list[Token]) -> list:
    """The expression as nested lists; what no rule reads stays as tokens behind it."""
    parser = _Tree(toks)
    out = parser.binary()
    rest = [t.text for t in toks[parser.at :]]
    return ["rest", out, *rest] if rest else out


def _multiplicity(toks: list[Token]) -> dict:
    text = "".join(t.text for t in toks)
    low, _, high = text.partition("..")
    if text == "*":
        return {"text": text, "lower": 0, "upper": None}
    bound = lambda x: int(x) if x.isdecimal() else None
    return {"text": text, "lower": bound(low), "upper": bound(high or low)}


def _closing(head: list[Token], at: int) -> int:
    depth = 0
    for i in range(at, len(head)):
        if head[i].kind == "op":
            depth += (head[i].text in _CLOSED) - (head[i].text in _CLOSED.values())
            if depth == 0:
                return i
    return len(head) - 1


def _marker(head: list[Token], i: int) -> tuple[str, int] | None:
    t = head[i]
    if t.kind not in ("op", "word"):
        return None
    if i + 1 < len(head) and f"{t.text} {head[i + 1].text}" in SLOTS:
        return SLOTS[f"{t.text} {head[i + 1].text}"], 2
    return (SLOTS[t.text], 1) if t.text in SLOTS else None


def _phrase(head: list[Token], i: int) -> tuple[str, int] | None:
    for size in (2, 1):
        part = head[i : i + size]
        words = " ".join(t.text for t in part)
        if len(part) == size and all(t.kind == "word" for t in part) and words in KINDS:
            return words, size
    return None


def declaration(s: Statement, owner: Declaration | None = None) -> list[Declaration]:
    """The declarations that a statement makes: none if it says something of its owner, two if a succession declares its target."""
    head, i = s.head, 0
    if not head:
        return members(s.body or [], owner)
    d = Declaration("feature", head[0].line, head[0].column)
    implied = None
    while i < len(head):
        t = head[i]
        later = head[i + 1] if i + 1 < len(head) else None
        free = later is not None and not (later.kind == "op" and later.text in (":", "=", ".", "::"))
        if t.kind == "op" and t.text in "#@" and later is not None:
            end = i + 2
            while end + 1 < len(head) and head[end].text == "::":
                end += 2
            note = {"name": head[end - 1].text, "values": {}}
            if t.text == "@" and end >= len(head):  # a member that annotates its owner
                for x in members(s.body or [], None):
                    key = x.name or (x.refs[0][1][-1] if x.refs else None)
                    if key and x.value:
                        note["values"][key] = x.value.get("str", x.value["text"])
                if owner is not None:
                    owner.annotations.append(note)
                return []
            d.annotations.append(note)
            i = end
        elif t.kind == "word" and t.text in VISIBILITY and free:
            d.visibility, i = t.text, i + 1
        elif t.kind == "word" and t.text in DIRECTIONS and later is not None:
            d.direction, i = t.text, i + 1
        elif t.kind == "word" and t.text in MODIFIERS and free:
            d.modifiers.append(t.text)
            i += 1
        elif t.kind == "word" and t.text in RELATIONS and implied is None and free and t.text != "expose":
            d.relation, implied = RELATIONS[t.text]
            i += 1
        else:
            break
    word, found = "", _phrase(head, i) if i < len(head) else None
    if found and not (found[0] in ("use", "doc", "comment") and i + 1 >= len(head)):
        word, i = found[0], i + found[1]
        d.kind = KINDS[word]
        if i < len(head) and head[i].kind == "word" and head[i].text == "def":
            d.is_definition, i = True, i + 1
    elif implied:
        d.kind = implied
    elif owner is not None and (not s.ended or owner.kind in ("constraint", "requirement") and not d.direction and not d.modifiers and head[0].text not in SLOTS) and s.body is None:
        owner.expression = value_of(head)
        return []
    if head[-1].kind == "comment":
        if owner is not None and (word == "doc" or not word):
            owner.doc, owner.comments = (head[-1].text, owner.comments) if word == "doc" else (owner.doc, [*owner.comments, head[-1].text])
        elif owner is not None:
            owner.comments.append(head[-1].text)
        return []
    if word == "then" and i < len(head) and (_phrase(head, i) or (head[i].kind == "word" and head[i].text in RELATIONS)):
        target = declaration(Statement(head[i:], s.body, s.ended), owner)  # a succession that declares its target
        if target:
            d.refs.append(("then", [""]))
        return [d, *target]
    slot, at = OPENING.get(word), i
    if slot is None:
        if i + 2 < len(head) and head[i].text == "<" and head[i].kind == "op":
            d.short_name, i = head[i + 1].text, i + 3
        if i < len(head) and head[i].is_name and (head[i].kind == "quoted" or not _marker(head, i)):
            end = i + 1
            while end + 1 < len(head) and head[end].kind == "op" and head[end].text in (".", "::"):
                end += 2
            if word in ("dependency", "flow", "message", "succession flow") and end < len(head) and head[end].text in ("to", ","):
                end, slot = i, "from"
            elif end > i + 1 or (implied and not word):
                d.refs.append(("own", [t.text for t in head[i:end]]))
            else:
                d.name = head[i].text
            i = end if slot is None else i
        at = i
    content: list[Token] = []

    def close() -> None:
        if slot is None or not content:
            return
        if slot in EXPRESSIONS:
            if slot == "value":
                d.value = value_of(content)
            else:
                d.expression = value_of(content)
        if slot == "conjugate" or slot == "type" and content[0].text == "~":
            d.conjugated = True
        role = "type" if slot == "conjugate" else slot
        if slot != "value" or d.value and "reference" in d.value:
            d.refs.extend((role, c) for c in chains(content))

    i = at
    while i < len(head):
        t = head[i]
        if t.kind == "word" and t.text == "default" and slot not in EXPRESSIONS and i + 1 < len(head):  # before a value, with or without a sign
            close()
            slot, content, i = (slot if head[i + 1].text in ("=", ":=") else "value"), [], i + 1
            continue
        marked = _marker(head, i) if t.kind != "quoted" else None
        if marked and not (slot in EXPRESSIONS and t.text in ("if", "of", ":")) and not (word == "bind" and t.text == "="):
            close()
            slot = "ends" if slot == "ends" and marked[0] == "to" else marked[0]
            content = []
            i += marked[1]
        elif t.kind == "op" and t.text == "[" and slot not in EXPRESSIONS:
            end = _closing(head, i)
            d.multiplicity = _multiplicity(head[i + 1 : end])
            i = end + 1
        elif t.kind == "op" and t.text in _CLOSED and slot in EXPRESSIONS:
            end = _closing(head, i)
            content.extend(head[i : end + 1])
            i = end + 1
        else:
            content.append(t)
            i += 1
    close()
    if s.body is not None:
        d.children = members(s.body, d)
    return [d]


def members(body: list[Statement], owner: Declaration | None) -> list[Declaration]:
    out: list[Declaration] = []
    for s in body:
        if s.head and s.head[0].kind == "word" and s.head[0].text == "else":  # the other arm of the condition before
            given = out[-1] if out and out[-1].kind == "if" else None
            if given is None:
                given = Declaration("succession", s.head[0].line, s.head[0].column)
                out.append(given)
            rest = s.head[1:]
            if rest and rest[0].kind == "word" and rest[0].text == "then":
                rest = rest[1:]
            given.refs.extend(("otherwise" if given.kind == "if" else "then", c) for c in chains(rest))
            given.children.extend(members(s.body or [], given))
            continue
        out.extend(declaration(s, owner))
    return out


def parse(text: str) -> list[Declaration]:
    return members(statements(tokens(text)), None)
