"""Secret scans: names and literals of source and configuration syntax, constants carried to their uses."""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from personpub.llm.common import only, table

#: kinds of spans in the order in which those of one start are given
ASSIGN, ACCESS, HEX, LITERAL = KINDS = ("assign", "access", "hex", "literal")
LEAST = {ASSIGN: 6, ACCESS: 20, HEX: 24}
#: a literal counts if sensitivity of its name times its own score reaches this
THRESHOLD = 0.4

_KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
_ACCESS, _HEX = re.compile(r"AKIA[A-Z0-9]+"), re.compile(r"[0-9a-f]{%d,}" % LEAST[HEX])


class Span(NamedTuple):
    kind: str
    start: int
    end: int
    name: str | None = None
    score: float | None = None


def base_spans(text: str) -> list[Span]:
    """What the three patterns find; of each kind the leftmost ones that do not overlap."""
    out = []
    low = text.lower()
    if any(word in low for word in _KEYWORDS):
        found = _ASSIGN.finditer(text)
        out += [Span(ASSIGN, *m.span()) for m in found if m.end(2) - m.start(2) >= LEAST[ASSIGN]]
    if "AKIA" in text:
        out += [Span(ACCESS, *m.span()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= LEAST[ACCESS]]
    # a run is matched whole, so a run of the least length is the same as any run kept by its length
    out += [Span(HEX, *m.span()) for m in _HEX.finditer(text)]
    return out


# ---- names

#: words of a name that make it sensitive, alone or before "key"
_WORDS = {
    "password": 1.0, "passwd": 1.0, "pwd": 1.0, "passphrase": 1.0, "passcode": 1.0, "pass": 0.9, "secret": 1.0,
    "secrets": 1.0, "passwords": 1.0, "tokens": 0.9, "token": 1.0, "apikey": 1.0, "credential": 1.0, "credentials": 1.0,
    "jwt": 0.9, "bearer": 0.9, "authorization": 0.8, "auth": 0.6, "salt": 0.6, "pin": 0.6, "privatekey": 1.0,
    "accesskey": 1.0, "secretkey": 1.0,
}
_BEFORE_KEY = {
    "api", "access", "private", "secret", "auth", "encryption", "signing", "client", "master", "account", "service",
    "shared", "session", "deploy", "license", "storage",
}
#: last words that tell that the value is about a secret and none itself
_ABOUT = {
    "type", "name", "hint", "label", "field", "length", "len", "size", "count", "url", "uri", "path", "file", "expiry",
    "expires", "ttl", "timeout", "policy", "regex", "pattern", "placeholder", "prompt", "column", "header", "min", "max",
    "limit", "prefix", "suffix", "format", "title", "message", "error", "help", "enabled", "required", "version",
}
_PART = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")


def about(name: str) -> bool:
    """Whether a value of this name tells something about a secret: `password_hint`."""
    words = _PART.findall(name)
    return bool(words) and words[-1].lower() in _ABOUT


def sensitivity(name: str) -> float:
    """How likely a value of this name is a secret, 0 to 1."""
    words = [w.lower() for w in _PART.findall(name)]
    if not words or about(name):
        return 0.0
    best = max(_WORDS.get(w, 0.0) for w in words)
    for a, b in zip(words, words[1:]):
        if b in ("key", "keys") and a in _BEFORE_KEY or (a, b) == ("pass", "word"):
            best = 1.0
    return best


# ---- literals

_HOLDERS = re.compile(
    r"(?:your|my|the|some|change|replace|insert|enter|example|dummy|sample|placeholder|todo|fixme|redacted|none|null|"
    r"true|false|undefined|default)(?:[ _.\-].*|me.*|this.*)?|[x*.\-_#]+|<.*>|\$\{?.*\}?|\{\{.*\}\}|%.*%|"
    r"(?:password|passwd|secret|token|api_?key)",
    re.ASCII | re.IGNORECASE | re.DOTALL,
)
_PLACE = re.compile(r"(?:[a-z][a-z0-9+.\-]*://[^@\s]*|[./~][\w./\-]*|[A-Z][A-Z_]+|[a-z]+(?:[._\- ][a-z]+)*\(?\)?)", re.ASCII)


def literal_score(value: str) -> float:
    """How much a literal looks like a secret, 0 to 1: its length times the entropy of its characters,
    less for words and sentences, nothing for a stand-in."""
    value = value.strip()
    if len(value) < 6 or len(set(value)) < 3 or _HOLDERS.fullmatch(value):
        return 0.0
    counts = Counter(value)
    bits = -sum(n * math.log2(n / len(value)) for n in counts.values())
    classes = sum((any(c.islower() for c in counts), any(c.isupper() for c in counts),
                   any(c.isdigit() for c in counts), any(not c.isalnum() and not c.isspace() for c in counts)))
    score = min(1.0, bits / 48) + 0.2 * (classes - 1)
    if _PLACE.fullmatch(value):
        score *= 0.3
    if value.count(" ") > 1:
        score *= 0.3
    return min(1.0, score)


# ---- syntax

_TOKEN = re.compile(
    r"""
    (?P<text>\"\"\"(?:[^"\\]|\\.|"(?!\"\"))*\"\"\"|'''(?:[^'\\]|\\.|'(?!''))*'''
      |[bfruBFRU@]{0,2}"(?:[^"\\\n]|\\.)*"|(?<![\w'])[bfruBFRU]{0,2}'(?:[^'\\\n]|\\.)*'|`[^`\n]*`)
    |(?P<ref>\$\{\w+(?::?[-=?+][^}\n]*)?\}|\{\{\s*[\w.]+\s*\}\}|%\w+%)
    |(?P<tag><(?P<element>[A-Za-z_][\w.\-]*)>(?P<inner>[^<>\n]+)</(?P=element)>)
    |(?P<name>--[A-Za-z][\w\-]*|[$@]?[A-Za-z_]\w*(?:(?:\.|->|::|-(?=[A-Za-z]))[A-Za-z_]\w*)*)
    |(?P<compare>===?|!==?|<=|>=|:?://|::)
    |(?P<put>:=|=>|\?=|\+=|=|:)
    |(?P<join>\+|\|\||\?\?|\.\.|\.)
    |(?P<open>[(\[{])
    |(?P<close>[)\]}])
    |(?P<line>\n[ \t]*)
    |(?P<stop>[,;])
    |(?P<other>[0-9][\w.\-]*|[^\s\w])
    """,
    re.VERBOSE | re.ASCII,
)
#: what stands unquoted after an operator to the end of its value
_BARE = re.compile(r"[^\S\n]*([^\s\"'`,;(){}\[\]<>]+)(?=[^\S\n]*(?:[,;#\n]|$))", re.ASCII)
_NAME = re.compile(r"[$@]?[A-Za-z_]\w*(?:(?:\.|->|::)[A-Za-z_]\w*)*", re.ASCII)
_INNER = re.compile(r"""(?:[bfruBFRU@]{0,2})(\"\"\"|'''|["'`])(.*)\1""", re.DOTALL)
_FIRST = re.compile(r"\w+")
_SITE = re.compile(r"[=:]|<[A-Za-z_][\w.\-]*>")


class Literal(NamedTuple):
    start: int
    end: int
    bare: bool


class Assignment:
    """One setting of a name: the literals and the other settings that its value is made of."""

    __slots__ = ("name", "sens", "literals", "parts")

    def __init__(self, name: str, sens: float):
        self.name, self.sens = name, sens
        self.literals: list[Literal] = []
        self.parts: list[int] = []


class Reader:
    """Name-literal pairs of a text, in one pass over its tokens.

    A value lasts to the end of the line, a comma or semicolon outside brackets that opened in it,
    or a closing bracket; `a = b = "x"` sets both. A name in a value stands for what it was last
    set to, or, if it was not set before, for its first setting later on. Keys within a map or
    an indented block of a sensitive name (`secrets:`) are as sensitive as that name.
    """

    def __init__(self, text: str):
        self.text = text
        self.settings: list[Assignment] = []
        self.now: dict[str, int] = {}
        self.awaited: dict[str, list[tuple[int, Literal | None]]] = {}
        self._read()

    def _key(self, name: str) -> str:
        return name.lstrip("$@-").replace("->", ".").replace("::", ".").removeprefix("self.").removeprefix("this.")

    def _set(self, name: str, around: float) -> int:
        self.settings.append(Assignment(name, 0.0 if about(name) else max(sensitivity(name), around)))
        return len(self.settings) - 1

    def _known(self, at: int) -> None:
        """From here on the name means this setting."""
        key = self._key(self.settings[at].name)
        self.now[key] = at
        for user, _ in self.awaited.pop(key, ()):
            self.settings[user].parts.append(at)

    def _use(self, at: int, name: str, literal: Literal | None) -> None:
        """The value of setting `at` has this name, which may also be an unquoted literal."""
        key = self._key(name)
        if key in self.now:
            if self.now[key] != at:
                self.settings[at].parts.append(self.now[key])
        else:
            self.awaited.setdefault(key, []).append((at, literal))

    def _read(self) -> None:
        text, pos = self.text, 0
        last: tuple[str, bool] | None = None  # name before an operator
        targets: list[int] = []
        depth, indent, line_indent = 0, 0, 0
        blocks: list[tuple[int, int, float]] = []  # bracket depth, indent, sensitivity
        empty = False  # nothing stands after the operator yet
        match = _TOKEN.search(text, pos)
        while match:
            kind, pos = match.lastgroup, match.end()
            if kind in ("element", "inner"):
                kind = "tag"
            got = match.group()
            around = blocks[-1][2] if blocks else 0.0
            if kind == "put" and last is not None:
                name, fresh = last
                while blocks and depth <= blocks[-1][0] and line_indent <= blocks[-1][1]:
                    blocks.pop()
                at = self._set(name, blocks[-1][2] if blocks else 0.0)
                if targets and not fresh:  # `a = b = ...`: b was read as a part of a
                    targets.append(at)
                else:
                    self._end(targets)
                    targets, indent = [at], depth
                last, empty = None, True
                bare = _BARE.match(text, pos)
                if bare and not _TOKEN_REF.fullmatch(bare[1]):
                    span = Literal(bare.start(1), bare.end(1), True)
                    if _NAME.fullmatch(bare[1]):
                        for t in targets:
                            self._use(t, bare[1], span)
                    else:
                        self.settings[targets[-1]].literals.append(span)
                    empty, pos = False, bare.end()
                elif got == ":" and "\n" == text[pos : pos + 1]:
                    blocks.append((depth, line_indent, self.settings[at].sens))
            elif kind == "text":
                inner = _INNER.fullmatch(got)
                if targets:
                    span = Literal(pos - len(got) + inner.start(2), pos - len(got) + inner.end(2), False)
                    self.settings[targets[-1]].literals.append(span)
                    empty = False
                last = (inner[2], not targets or depth > indent) if 0 < len(inner[2]) <= 200 else None
            elif kind == "name":
                if targets:
                    called = text[pos : pos + 1] == "("
                    if not called:
                        following = _NEXT_PUT.match(text, pos)
                        if not following:
                            self._use(targets[-1], got, None)
                    empty = False
                last = (got, not targets or depth > indent)
            elif kind == "ref":
                if targets:
                    self._use(targets[-1], _FIRST.search(got)[0], None)
                    empty = False
                last = None
            elif kind == "tag":
                at = self._set(match["element"], around)
                self.settings[at].literals.append(Literal(match.start("inner"), match.end("inner"), False))
                self._known(at)
                last = None
            elif kind == "open":
                if got == "{" and targets:
                    blocks.append((depth, line_indent, self.settings[targets[-1]].sens))
                    self._end(targets)
                    targets = []
                depth += 1
                last = None if got != "[" else last
            elif kind == "close":
                depth = max(depth - 1, 0)
                if targets and depth < indent:
                    self._end(targets)
                    targets = []
                while got == "}" and blocks and blocks[-1][0] >= depth:
                    blocks.pop()
                last = last if got == "]" else None
            elif kind == "line":
                line_indent = len(got) - 1
                if targets and depth <= indent and not (empty and line_indent):
                    self._end(targets)
                    targets = []
                last = None
            elif kind == "stop":
                if targets and depth <= indent:
                    self._end(targets)
                    targets = []
                last = None
            elif kind in ("compare", "other"):
                last = None
            match = _TOKEN.search(text, pos)
        self._end(targets)

    def _end(self, targets: list[int]) -> None:
        """The value is over: earlier targets of a chain share the last one's, and the names count."""
        for a in targets[:-1]:
            self.settings[a].parts.append(targets[-1])
        for a in targets:
            self._known(a)

    def found(self) -> Iterator[tuple[Literal, str, float]]:
        """Literals under the most sensitive name that they reach, with its sensitivity.

        Settings are visited from the most sensitive down, each once.
        """
        for waiting in self.awaited.values():  # a name set nowhere is a literal without quotes
            for at, literal in waiting:
                if literal is not None:
                    self.settings[at].literals.append(literal)
        seen = [False] * len(self.settings)
        given: set[tuple[int, int]] = set()
        for first in sorted(range(len(self.settings)), key=lambda i: -self.settings[i].sens):
            top = self.settings[first]
            if not top.sens:
                break
            stack = [first]
            while stack:
                at = stack.pop()
                if seen[at]:
                    continue
                seen[at] = True
                stack += self.settings[at].parts
                for literal in self.settings[at].literals:
                    if literal[:2] not in given:
                        given.add(literal[:2])
                        yield literal, top.name, top.sens


_TOKEN_REF = re.compile(r"\$\{.*|\{\{.*|%\w+%|\$\w+")
_NEXT_PUT = re.compile(r"[^\S\n]*(?:=(?![=>])|:=|:(?![:/]))")


def literal_spans(text: str, threshold: float = THRESHOLD) -> Iterator[Span]:
    """Literals that a sensitive name is set to, directly or through other names."""
    if not _SITE.search(text):
        return
    for literal, name, sens in Reader(text).found():
        score = sens * literal_score(text[literal.start : literal.end])
        if literal.bare and _NAME.fullmatch(text, literal.start, literal.end):
            score *= 0.8  # may be a name that is set elsewhere
        if score >= threshold:
            yield Span(LITERAL, literal.start, literal.end, name, round(score, 4))


def scan(text: str, threshold: float = THRESHOLD) -> list[Span]:
    """All spans of a text by start and kind: those of the patterns, and literals outside them."""
    base = base_spans(text)
    # the farthest end of the spans that start at or before a place tells what lies inside one
    ordered = sorted((s.start, s.end) for s in base)
    starts, ends, far = [s for s, _ in ordered], [], 0
    for _, e in ordered:
        far = max(far, e)
        ends.append(far)

    def inside(s: Span) -> bool:
        i = bisect_right(starts, s.start)
        return bool(i) and ends[i - 1] >= s.end

    more = [s for s in literal_spans(text, threshold) if not inside(s)]
    return sorted(base + more, key=lambda s: (s.start, KINDS.index(s.kind), s.end))


SPANS = "array<struct<kind: string, start: bigint, `end`: bigint, name: string, score: double>>"
_ARROW = pa.list_(
    pa.struct(
        [("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("name", pa.string()), ("score", pa.float64())]
    )
)


def find_secrets(
    docs: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: doc_id and spans (kind, start, end, name, score) in code points.

    Three patterns find settings of common names (`assign`), access keys (`access`) and long
    hexadecimal runs (`hex`); of each kind the leftmost that do not overlap. `literal` are
    literals that a sensitive name is set to in source or configuration syntax, also through
    other names and by joining parts; what one of the patterns covers is not given again.
    Spans of one start go by kind.

    A null text counts as empty and has no spans. Repeated rows each give a row, null ids too; an
    empty table gives none, other columns are not read. A text is read whole; what is held
    beside it grows with the number of its settings.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [[s._asdict() for s in scan(t.as_py() or "", threshold)] for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, _ARROW)], names=["doc_id", "spans"])

    rows = only(docs, doc_id=id_col, text=text_col)
    kind = dict(rows.dtypes)["doc_id"]
    return rows.mapInArrow(run, f"doc_id {kind}, spans {SPANS}")


def _told(spans: Column) -> Column:
    one = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(one, ",")


def op11_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = F.col("spans")

    def of(kind: str) -> Column:
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")

    base = F.filter(spans, lambda s: s["kind"] != LITERAL)
    return find_secrets(table(spark, sf_dir, "documents")).select(
        "doc_id",
        of(ASSIGN).alias("n_assign"),
        of(ACCESS).alias("n_access"),
        of(HEX).alias("n_hex"),
        F.sha2(_told(base).cast("binary"), 256).alias("base_sha256"),
        _told(spans).alias("spans"),
    )
