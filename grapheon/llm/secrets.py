"""Secret scan: fixed patterns, and high-entropy windows of candidate strings.

Every text is scanned whole. Fixed kinds (assign, access, hex) are leftmost non-overlapping
matches, each kind on its own. The entropy kinds slide a window over each candidate string, once for
each character class: the counts of the window's characters change by one character in and
one out, and sum(c * log2 c) is kept up to date with them, so a step costs O(1). Windows at
or above the class's threshold are united to spans. A span is suppressed if the allow-list
covers it: known harmless shapes (UUIDs, runs of the alphabet or of digits, addresses,
words without digits, placeholder words) or patterns that the caller adds.

Nulls: a null text is an empty text; a null doc_id stays null. Empty texts have no spans. Repeated rows
are scanned each for itself. Columns other than doc_id and text are ignored, whatever their
names. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame

from grapheon.llm.common import lean, slices

#: Kinds in the order in which equal starts are listed.
KINDS = ("assign", "access", "hex", "entropy_hex", "entropy_base64")

ASSIGN = re.compile(r"""(?a)(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")  # a run of 20 or more
HEX = re.compile(r"[0-9a-f]{24,}")  # a run is maximal, so shorter ones never match in part
CANDIDATE = re.compile(r"[A-Za-z0-9+/=_-]{20,}")
#: kind, pattern of the class within a candidate, window, least entropy in bits
CLASSES = (
    ("entropy_hex", re.compile(r"[0-9a-fA-F]{20,}"), 20, 2.9),
    ("entropy_base64", re.compile(r"[A-Za-z0-9+/=_-]{24,}"), 24, 3.9),
)
ALLOW = tuple(
    map(
        re.compile,
        (
            r"[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}",
            r"[^0-9]*",
            r"[0-9+/=_-]*",
            r"(?i:.*(?:abcdefghij|0123456789|example|placeholder|xxxxxxxx).*)",
            r"(?:[A-Za-z]+[/_-])+[A-Za-z]*[0-9]{0,4}",
            r"/?(?:[A-Za-z0-9_-]{1,16}/)+[A-Za-z0-9_=-]{0,16}",
        ),
    )
)
SPANS_SCHEMA = "doc_id long, n_assign long, n_access long, n_hex long, n_entropy long, base_sha256 string, spans string"


def windows(s: str, width: int, least: float) -> list[tuple[int, int]]:
    """Spans of s that windows of `width` characters with entropy of `least` bits or more cover."""
    if len(s) < width:
        return []
    xlogx = [0.0] + [c * math.log2(c) for c in range(1, width + 1)]
    counts: dict[str, int] = {}
    total = 0.0
    most = (math.log2(width) - least) * width + 1e-9  # entropy >= least  <=>  sum(c log2 c) <= most
    out: list[tuple[int, int]] = []
    for i, ch in enumerate(s):
        c = counts.get(ch, 0)
        counts[ch] = c + 1
        total += xlogx[c + 1] - xlogx[c]
        if i >= width:
            old = s[i - width]
            c = counts[old]
            counts[old] = c - 1
            total += xlogx[c - 1] - xlogx[c]
        if i >= width - 1 and total <= most:
            start = i - width + 1
            if out and start <= out[-1][1]:
                out[-1] = (out[-1][0], i + 1)
            else:
                out.append((start, i + 1))
    return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed kinds."""
    found = []
    low = text.lower()
    if "pass" in low or "secret" in low or "token" in low or "api" in low:
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return found


def entropy_spans(text: str, allow: Sequence[re.Pattern] = ALLOW) -> list[tuple[int, int, int]]:
    found = []
    for m in CANDIDATE.finditer(text):
        whole = m.group()
        if any(a.fullmatch(whole) for a in allow):
            continue
        for kind, within, width, least in CLASSES:
            for part in within.finditer(whole):
                for a, b in windows(part.group(), width, least):
                    piece = part.group()[a:b]
                    if not any(x.fullmatch(piece) for x in allow):
                        at = m.start() + part.start()
                        found.append((at + a, KINDS.index(kind), at + b))
    return found


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))


def scan(text: str | None, allow: Sequence[re.Pattern] = ALLOW) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """The fixed spans and those that the entropy windows add."""
    text = text or ""
    return base_spans(text), entropy_spans(text, allow)


def secret_spans(docs: DataFrame, allow: Sequence[str] = ()) -> DataFrame:
    """One row per row of docs: counts of the fixed kinds, a digest of their spans, and all spans.

    allow: further patterns; a candidate or span that one of them matches in full is no secret.
    """
    patterns = ALLOW + tuple(map(re.compile, allow))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            rows: list[list] = [[], [], [], [], [], [], []]
            for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                base, more = scan(text, patterns)
                n = [sum(k == kind for _, k, _ in base) for kind in range(3)]
                digest = hashlib.sha256(joined(base).encode()).hexdigest()
                for column, x in zip(rows, (doc_id, *n, len(more), digest, joined(base + more)), strict=True):
                    column.append(x)
            types = [pa.int64()] * 5 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, types, strict=True)], names=["doc_id", "n_assign", "n_access", "n_hex", "n_entropy", "base_sha256", "spans"])

    return docs.select(docs["doc_id"].cast("long"), docs["text"].cast("string")).mapInArrow(lean(run), SPANS_SCHEMA)


def redacted(text: str, allow: Sequence[re.Pattern] = ALLOW, mask: str = "[SECRET]") -> str:
    """The text with each secret replaced: of an assignment the value, else the whole span."""
    base, more = scan(text, allow)
    cuts = sorted((ASSIGN.match(text, a).start(2) if k == 0 else a, b) for a, k, b in base + more)
    out, at = [], 0
    for a, b in cuts:
        if a >= at:
            out += [text[at:a], mask]
        at = max(at, b)
    return "".join([*out, text[at:]])


def redact_secrets(docs: DataFrame, allow: Sequence[str] = (), mask: str = "[SECRET]") -> DataFrame:
    """docs with secrets in text masked; all other columns as they are. A null text stays null."""
    patterns = ALLOW + tuple(map(re.compile, allow))
    schema = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            at = part.schema.get_field_index("text")
            texts = [t if t is None else redacted(t, patterns, mask) for t in part.column(at).to_pylist()]
            yield part.set_column(at, part.schema.field(at), pa.array(texts, part.schema.field(at).type))

    return docs.mapInArrow(lean(run), schema)
