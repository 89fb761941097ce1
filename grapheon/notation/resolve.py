"""Names to declarations, and the relations that declarations derive, within one module.

A module's declarations are indexed by owner and name; a reference's first name is looked for outward from where it is written, its other names among
the members of what was found, inherited ones included. Relations follow a table from slots to labels; a few kinds have a rule of their own.
"""

from __future__ import annotations

from collections import defaultdict

# Kinds that carry a relation and are owned by nothing, kinds whose keyword is a relation, and kinds that a succession can name.
STATEMENTS = {"import", "alias", "succession", "annotation", "filter"}
ROLES = {"subject", "actor", "stakeholder", "objective"}
STEPS = set("action state snapshot timeslice occurrence event part item entry exit do decide merge fork join terminate accept send assign calculation feature return usecase analysis verification case".split())
#: Slots whose references each give a relation from the declaration.
DIRECT = {"redefines": "redefines", "references": "referencesFeature", "value": "bindsTo", "via": "via", "effect": "effect"} | {
    x: x for x in ("disjointFrom", "inverseOf", "unionOf", "intersectionOf", "differenceOf", "chainOf")
}
#: Kinds that relate their sources to their targets.
PAIRS = {"flow": "flows", "message": "flows", "send": "sends", "allocation": "allocates", "dependency": "dependsOn", "assign": "assigns"}
BY_SOURCE = {"satisfies", "verifies", "refines", "derives"}
DEPTH = 6
#: Segments of a path that a display name takes before it takes the whole path.
DISPLAY = 8


class Module:
    """rows: dicts in file and declaration order, with local ids `id`, `owner`, and name, kind, refs."""

    def __init__(self, name: str, rows: list[dict]):
        self.name, self.rows = name, rows
        self.by_id = {r["id"]: r for r in rows}
        self.members: dict = defaultdict(dict)
        self.children: dict = defaultdict(list)
        self.tails: dict = defaultdict(list)
        self.folded: dict = {}  # short names in lower case; None where several have one
        self.busy: set = set()
        self.known: dict = {}
        self._label()
        self._show()

    def _label(self) -> None:
        """Qualified names; a second declaration of a name gets its line."""
        seen: set[str] = set()
        for r in self.rows:
            borrowed = next((p[-1] for role in ("redefines", "references", "own", "super") for x, p in r["refs"] if x == role), None)
            r["anonymous"] = r["name"] is None
            r["display"] = r["name"] or (borrowed if borrowed not in (None, "") else f"{r['kind']}@{r['line']}")
            owner = self.by_id.get(r["owner"])
            r["qualified"] = f"{owner['qualified']}::{r['display']}" if owner else r["display"]
            r["depth"] = owner["depth"] + 1 if owner else 0
            key = f"{self.name}::{r['qualified']}"
            n = 0
            while key in seen:
                n += 1
                key = f"{self.name}::{r['qualified']}#{r['line']}" + (f".{n}" if n > 1 else "")
            seen.add(key)
            r["identity"] = key
            self.children[r["owner"]].append(r)
            if r["kind"] not in STATEMENTS or r["kind"] == "alias":
                names = [r["name"]] if r["name"] else [p[-1] for x, p in r["refs"] if x == "redefines"]
                for name in names:
                    self.members[r["owner"]].setdefault(name, r)
                    self.tails[name].append(r)
                if r["short_name"]:
                    self.members[r["owner"]].setdefault(r["short_name"], r)
                    self.tails[r["short_name"]].append(r)
                    low = r["short_name"].lower()
                    self.folded[low] = None if low in self.folded else r

    def _show(self) -> None:
        """A display name for each declaration, unique in the module: the last segment in capitals, as it is where only one has it and longer by segments of its path else; then what tells them apart."""
        taken: dict[str, list[dict]] = defaultdict(list)
        for r in self.rows:
            taken[r["display"].upper()].append(r)
        for bare, same in taken.items():
            waiting, length = same, 1 if len(same) == 1 else 2
            while waiting:
                whole = length > DISPLAY
                by: dict[str, list[dict]] = defaultdict(list)
                for r in waiting:
                    path = r["qualified"].upper().split("::")
                    by[bare if length == 1 else "_".join(path if whole else path[-length:])].append(r)
                waiting = []
                for suffix, held in by.items():
                    for r in held:
                        r["unique"] = suffix
                    waiting.extend(held if len(held) > 1 and not whole else ())
                length += 1
        # the same path in other letters, or declared again: the one definition of two says so, others take their line, then a number
        for again in (False, True):
            groups: dict[str, list[dict]] = defaultdict(list)
            for r in self.rows:
                groups[r["unique"]].append(r)
            for name, held in groups.items():
                if len(held) < 2:
                    continue
                if again:
                    for n, r in enumerate(held[1:], 2):
                        r["unique"] = f"{name}_{n}"
                elif len(held) == 2 and held[0]["is_definition"] != held[1]["is_definition"]:
                    next(r for r in held if r["is_definition"])["unique"] = f"{name}_DEF"
                else:
                    for r in held:
                        r["unique"] = f"{name}_L{r['line']}"

    def member(self, scope: dict | None, name: str, depth: int = DEPTH, skip: dict | None = None) -> dict | None:
        """A member of scope other than skip: its own, else of what it is typed by, specializes or redefines, else an imported one."""
        at = scope["id"] if scope else None
        found = self.members[at].get(name)
        if found is not None and found is skip:
            found = None  # a redefinition means the inherited feature of its name
        if found is None and scope is not None and scope["kind"] == "alias":
            found = self._follow(scope, ("for",), name, depth)
        if found is None and scope is not None and depth:
            found = self._follow(scope, ("type", "super", "redefines", "references", "own"), name, depth)
        return found if found is not None or not depth else self._imported(at, name, depth)

    def _follow(self, scope: dict, roles: tuple, name: str, depth: int) -> dict | None:
        for role, path in scope["refs"]:
            if role in roles and path[-1] != name:
                to = self.resolve(path, scope, skip=scope)
                found = self.member(to, name, depth - 1) if to is not None else None
                if found is not None:
                    return found
        return None

    def _imported(self, at, name: str, depth: int) -> dict | None:
        for c in self.children[at]:
            if c["kind"] != "import":
                continue
            for role, path in c["refs"]:
                stars = [x for x in path if x in ("*", "**")]
                base = path[: len(path) - 2 * len(stars)]
                if not base or not stars and base[-1] != name:
                    continue
                to = self.resolve(base, c, skip=c, imports=False)
                if to is not None and to["id"] != at:
                    found = self.member(to, name, 0) if stars else to
                    if found is None and "**" in stars:
                        found = next((r for r in self.tails.get(name, ()) if r["qualified"].startswith(to["qualified"] + "::") and r["depth"] - to["depth"] <= 4), None)
                    if found is not None:
                        return found
        return None

    def resolve(self, path: list[str], at: dict, skip: dict | None = None, imports: bool = True) -> dict | None:
        """What a reference written in `at` means. skip: never the meaning of the first name."""
        key = (tuple(path), at["owner"], at["id"] if skip is not None else None, imports)
        if key in self.known:
            return self.known[key]
        if key in self.busy:
            return None
        self.busy.add(key)
        names = path[::2]
        found, scope = None, self.by_id.get(at["owner"])
        while True:
            found = self.member(scope, names[0], DEPTH if imports else 0, skip)
            if found is not None and skip is not None and found["id"] == skip["id"]:
                found = None
            if found is not None or scope is None:
                break
            scope = self.by_id.get(scope["owner"])
        if found is None:
            found = self.folded.get(names[0].lower())  # a short name in any case, if only one has it
            found = None if found is not None and skip is not None and found["id"] == skip["id"] else found
        if found is None:
            same = [r for r in self.tails.get(names[0], ()) if skip is None or r["id"] != skip["id"]]
            found = same[0] if len(same) == 1 else None
        for name in names[1:]:
            if found is None or name in ("*", "**"):
                break
            found = self.member(found, name)
        self.busy.discard(key)
        if not self.busy:  # an answer found while another is open may lack what that one gives
            self.known[key] = found
        return found

    def relations(self):
        """(source, label, target or None, reference as written, row, details), in declaration order."""
        previous: dict = {}
        for r in self.rows:
            owner, kind, refs = self.by_id.get(r["owner"]), r["kind"], defaultdict(list)
            for role, path in r["refs"]:
                refs[role].append(path)
            get = lambda role: [(self.resolve([x for x in p if x not in ("*", "**")] if role != "imported" else p, r, r), "".join(p)) for p in refs[role] if p != [""]]  # noqa: B023, E731
            if owner is not None and kind not in STATEMENTS:
                yield owner, "owns", r, "", r, {}
                if kind in ROLES:
                    yield owner, kind, r, "", r, {}
                if "variant" in r["modifiers"]:
                    yield r, "variantOf", owner, "", r, {}
            for to, text in get("type"):
                yield r, "conjugates" if r["conjugated"] else "typedBy", to, text, r, {}
            for to, text in get("super"):
                yield r, "specializes" if r["is_definition"] else "subsets", to, text, r, {}
            for role, label in DIRECT.items():
                for to, text in get(role):
                    yield r, label, to, text, r, {}
            for note in r["annotations"]:
                to = self.resolve([note["name"]], r, r)
                if to is not None:
                    yield r, "annotatedBy", to, note["name"], r, {}
            own = get("own")
            meant = own[0][0] if own and own[0][0] is not None else r
            if r["relation"] and owner is not None:
                ends = get("by") if r["relation"] in BY_SOURCE else []
                for source, text in ends or [(owner, "")]:
                    yield (source, r["relation"], meant if not own or own[0][0] is not None else None, own[0][1] if own else text, r, {}) if source is not None else (r, r["relation"], None, text, r, {})
            if kind in ("connection", "interface", "binding"):
                ends = get("ends")
                if kind != "binding":
                    for to, text in ends:
                        yield r, "connects", to, text, r, {}
                for (a, _), (b, text) in zip(ends, ends[1:], strict=False):
                    if a is not None:
                        yield a, "bindsTo" if kind == "binding" else "connectedTo", b, text, r, {} if kind == "binding" else {"through": r["identity"]}
            if kind in PAIRS or kind == "succession" and refs["from"] and refs["to"]:
                by_default = owner if kind in ("send", "assign") and owner is not None else r
                for a, _ in get("from") or [(by_default, "")]:
                    for b, text in get("to"):
                        if a is not None and b is not None:
                            yield a, PAIRS.get(kind, "flows"), b, text, r, {}
                            if kind == "succession":
                                yield a, "transitionsTo", b, text, r, {}
            if kind in ("flow", "message", "succession"):
                for to, text in get("payload"):
                    yield r, "carries", to, text, r, {}
            for role, label in (("imported", "imports"), ("for", "aliasOf"), ("exposed", "exposes")):
                if (role != "for" or kind == "alias") and refs[role]:
                    for to, text in get(role):
                        source = r if label == "aliasOf" or owner is None else owner
                        if to is not None or label != "imports":
                            yield source, label, to, text, r, {"recursive": "true"} if text.endswith("**") else {}
            for to, text in get("accept"):
                yield r, "triggeredBy" if kind in ("transition", "succession") else "accepts", to, text, r, {}
            if kind == "if":
                for role, branch in (("then", "then"), ("otherwise", "else")):
                    for to, text in get(role):
                        yield r, "transitionsTo", to, text, r, {"branch": branch}
            for to, text in get("guard"):
                yield r, "guardedBy", to, text, r, {}
            yield from self._steps(r, owner, kind, refs, get, previous)

    def _steps(self, r, owner, kind, refs, get, previous):
        """Successions of one body, in declaration order: the step before, or the one named, to the next."""
        at = r["owner"]
        if kind not in ("succession", "transition"):
            if kind in STEPS:
                previous[at] = r
            return
        detail = {"trigger": "".join(refs["accept"][0])} if refs["accept"] else {}
        if refs["guard"] and r["expression"]:
            detail["guard"] = r["expression"].get("text")
        first = get("first")
        source = first[0][0] if first else previous.get(at)
        if refs["then"] == [[""]]:  # the target is declared right behind
            place = self.children[at].index(r) + 1
            targets = [(self.children[at][place], "")] if place < len(self.children[at]) else []
        else:
            targets = get("then")
        if first and not targets and owner is not None:
            yield owner, "startsAt", source, first[0][1], r, {}
            previous[at] = source if source is not None else previous.get(at)
        for to, text in targets:
            if source is not None:
                yield source, "transitionsTo", to, text, r, detail
            elif owner is not None and not first:
                yield owner, "startsAt", to, text, r, {}
            if to is not None:
                previous[at] = to
