"""Secret scans: assignment-aware lexing of names and literals.

Two layers share one pass over each whole text:

* the base patterns (``assign``, ``access``, ``hex``), leftmost and non-overlapping per kind;
* a small lexer for source and configuration syntax.  At every ``=``, ``:``, ``:=`` and ``=>``
  it reads the target name on the left and the value on the right: quoted literals, names,
  ``+`` or nothing but blanks between them, or a bare configuration value.  ``#define``, setters
  (``setPassword("v")``, ``set("password", "v")``) and tags (``name="password" value="v"``,
  ``<password>v</password>``) give pairs of a name and a value, too.  Names bound to literals are
  constants; a value that mentions one stands for the literals it was last bound to, or, where it
  was not bound before, for those it is bound to first thereafter (not of the name itself, and no name
  within its own value).  Every literal is scored by the words of its target name and by its own
  shape, and reported as ``named`` from ``THRESHOLD`` on, unless it lies inside a base span.
  Placeholders, short words and unquoted values without a score are no secrets under any name.

Offsets are code points, ends exclusive.  NULL and empty texts have no spans.  Nothing is shared
between rows.  A concatenation costs its parts and the different characters in them, never the length
or the number of literals of the constants in it; every literal is reported once.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from winnow.llm.common import map_texts, unused

KINDS = ("assign", "access", "hex", "named")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")

# How strongly a word of a target name speaks for a secret value.
SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "passphrase": 1.0, "pwd": 0.9, "pass": 0.7, "secret": 1.0,
    "token": 0.9, "apikey": 1.0, "credential": 0.9, "credentials": 0.9, "bearer": 0.8, "auth": 0.6,
    "private": 0.5, "access": 0.4, "signing": 0.4, "encryption": 0.5, "api": 0.4, "key": 0.5,
}
HARMLESS = {"public", "name", "path", "file", "url", "length", "size", "count", "type", "id", "field"}
PLACEHOLDERS = re.compile(
    r"(?i)^(none|null|true|false|nil|undefined|changeme|example|placeholder|your[_-].*|x{3,}|\*+|\.+|<.*>"
    r"|\$\{.*\}|\$\(.*\)|%\(.*\).?|\{\{.*\}\})$"
)
THRESHOLD = 1.2
_LONG = 1 << 10  # characters up to which a concatenation is kept as text

_OPERATOR = re.compile(r"=>|:=|[=:]")
_COMPARE = set("=!<>~+-*/%&|^")
_NAME_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_$.-")
_QUOTED = re.compile(r'"((?:[^"\\\n]|\\.)*)"|\'((?:[^\'\\\n]|\\.)*)\'|`((?:[^`\\\n]|\\.)*)`')
_NAME = re.compile(r"[A-Za-z_$][A-Za-z0-9_$]*(?:\.[A-Za-z_$][A-Za-z0-9_$]*)*(?![A-Za-z0-9+/=_-])")
_BARE = re.compile(r"[A-Za-z0-9+/_.=~!@$%^&*-]+")
_PLUS = re.compile(r"[ \t]*\+[ \t]*")
# Blanks before an adjoining literal: on this line, behind a backslash, or on an indented next line.
_ADJOINING = re.compile(r"[ \t]*(?:\\?\n[ \t]+)?(?=[\"'])")
_KEYED = re.compile(r"[ \t]*[:=]")
_DEFINE = re.compile(r"^[ \t]*#[ \t]*define[ \t]+([A-Za-z_][A-Za-z0-9_]*)[ \t]+", re.MULTILINE)
_SETTER = re.compile(r"""\b[sS]et_?([A-Za-z][A-Za-z0-9_]*)\([ \t]*(?=["'])""")
_PUT = re.compile(
    r"""\b(?:set|put|setProperty|setenv|putenv|setdefault|setItem|define|append)\([ \t]*"""
    r"""(?:"([^"\\\n]*)"|'([^'\\\n]*)')[ \t]*,[ \t]*(?=["'])"""
)
_TAG = re.compile(r"<([A-Za-z_][A-Za-z0-9_.-]*)([^<>]*)>")
_TAG_NAME = re.compile(r"""(?<![A-Za-z0-9_.:-])(?:name|key|id)[ \t]*=[ \t]*(?:"([^"]*)"|'([^']*)')""")
_TAG_VALUE = re.compile(r"""(?<![A-Za-z0-9_.:-])value[ \t]*=[ \t]*(?:"([^"]*)"|'([^']*)')""")
_PART = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")


def name_score(name: str) -> float:
    """Weight of the most telling words of a name; 0 if nothing in it is sensitive."""
    parts = [p.lower() for p in _PART.findall(name)]
    if not parts:
        return 0.0
    words = parts + ["".join(pair) for pair in zip(parts, parts[1:])]
    score = sum(sorted((SENSITIVE.get(w, 0.0) for w in set(words)), reverse=True)[:2])
    return 0.0 if parts[-1] in HARMLESS or "public" in parts else min(score, 1.2)


def _shape(length: float, counts: dict[str, float]) -> float:
    """The score of a value that is no placeholder, from its length and the counts of its characters."""
    total = sum(counts.values())
    bits = -sum(n / total * math.log2(n / total) for n in counts.values() if n / total)
    characters = "".join(counts)
    kinds = sum(
        bool(re.search(p, characters)) for p in (r"[a-z]", r"[A-Z]", r"[0-9]", r"[^A-Za-z0-9]")
    )
    if kinds < 2 or not re.search(r"[0-9]", characters):
        return 0.2 if kinds < 2 else 0.4
    return min(1.0, 0.2 + bits / 8 + min(length, 32) / 64)


def literal_score(value: str) -> float:
    """0 for placeholders and short words, up to 1 for long values of many different characters."""
    if len(value) < 6 or PLACEHOLDERS.match(value) or " " in value.strip():
        return 0.0
    return _shape(len(value), Counter(value))


class _Long:
    """A value by what its score needs, as sums over its parts; counts are in units of 2**scale."""

    __slots__ = ("counts", "scale", "head", "tail", "blank", "lead", "inside", "trail")

    def __init__(self, value: str = ""):
        core = value.strip()
        self.counts, self.scale = Counter(value), 0
        self.head, self.tail = value[:8], value[-8:]
        self.blank = not core  # nothing but white space
        self.inside = " " in core
        self.lead = " " in value[: len(value) - len(value.lstrip())]
        self.trail = " " in value[len(value.rstrip()) :]

    def __add__(self, other: _Long) -> _Long:
        both = _Long()
        both.scale = max(self.scale, other.scale)
        for one in (self, other):
            down = one.scale - both.scale
            for c, n in one.counts.items():
                both.counts[c] += math.ldexp(n, down) if down else n
        if max(both.counts.values(), default=0) > 2.0**500:
            both.counts = Counter({c: math.ldexp(n, -400) for c, n in both.counts.items()})
            both.scale += 400
        both.head, both.tail = (self.head + other.head)[:8], (self.tail + other.tail)[-8:]
        both.blank = self.blank and other.blank
        both.inside = self.inside or other.inside or (
            not self.blank and not other.blank and (self.trail or other.lead)
        )
        both.lead = self.lead or self.blank and other.lead
        both.trail = other.trail or other.blank and self.trail
        return both

    def placeholder(self) -> bool:
        # Between head and tail, one of each character decides every placeholder pattern.
        return bool(PLACEHOLDERS.match(self.head + "".join(self.counts) + self.tail))

    def score(self) -> float:
        if self.inside or self.placeholder():
            return 0.0
        return _shape(sum(self.counts.values()) if not self.scale else math.inf, self.counts)


class _Value:
    """What a name stands for.

    ``spans`` is a tree that shares the trees of the constants it is made of: ``[seen, start, end]``
    or ``[seen, trees]``.  The text itself is kept up to ``_LONG`` characters or for one
    literal; what is put together beyond that is kept as sums, so no value outgrows the text.
    """

    __slots__ = ("spans", "text", "sums", "quoted", "_score")

    def __init__(self, spans: list, text: str | None, quoted: bool, sums: _Long | None = None):
        self.spans, self.text, self.quoted, self.sums, self._score = spans, text, quoted, sums, None

    def long(self) -> _Long:
        if self.sums is None:
            self.sums = _Long(self.text)
        return self.sums

    @property
    def score(self) -> float:
        if self._score is None:
            self._score = self.long().score() if self.text is None else literal_score(self.text)
        return self._score

    @property
    def telling(self) -> bool:
        """Whether the value may be a secret at all: not a short word, placeholder or bare prose.

        A quoted value with blanks has no score but may be a passphrase.
        """
        if self.score:
            return True
        if not self.quoted:
            return False
        if self.text is None:
            return not self.sums.placeholder()
        return len(self.text.strip()) >= 6 and not PLACEHOLDERS.match(self.text.strip())


def _together(values: list[_Value]) -> _Value:
    """The values one after the other."""
    if len(values) == 1:
        return values[0]
    spans, quoted = [False, [value.spans for value in values]], any(value.quoted for value in values)
    if all(value.text is not None for value in values) and sum(len(v.text) for v in values) <= _LONG:
        return _Value(spans, "".join(value.text for value in values), quoted)
    sums = values[0].long()
    for value in values[1:]:
        sums = sums + value.long()
    return _Value(spans, None, quoted, sums)


def _target(text: str, at: int, line: int) -> str | None:
    """The name that ends before position ``at``: bare, quoted or followed by ``[...]``.

    ``line`` is where the line of ``at`` begins.
    """
    end = at
    while end and text[end - 1] in " \t":
        end -= 1
    if end and text[end - 1] == "]":
        end -= 1
    if end and text[end - 1] in "\"'`":
        start = text.rfind(text[end - 1], line, end - 1)
        return text[start + 1 : end - 1] if start >= 0 else None
    start = end
    while start and text[start - 1] in _NAME_CHARS:
        start -= 1
    if start == end:
        return None
    before = start
    while before and text[before - 1] in " \t":
        before -= 1
    if before and text[before - 1] == ":" and text[at] != ":":  # ``name: type = value``
        return _target(text, before - 1, line) or text[start:end]
    return text[start:end]


def _parts(text: str, place: int) -> list[tuple]:
    """The parts of the value at ``place``: ``(kind, value, start, end)`` each."""
    parts = []
    while True:
        if found := _QUOTED.match(text, place):
            group = found.lastindex or 1
            parts.append(("literal", found[group], *found.span(group)))
        elif found := _NAME.match(text, place):
            parts.append(("name", found[0], *found.span()))
        elif not parts and (found := _BARE.match(text, place)):
            parts.append(("bare", found[0], *found.span()))
        else:
            return parts
        place = found.end()
        if plus := _PLUS.match(text, place):
            place = plus.end()
            continue
        near = parts[-1][0] == "literal" and _ADJOINING.match(text, place)
        follower = near and _QUOTED.match(text, near.end())
        # What a colon or an equals sign follows is a name, not a piece of the value.
        if not follower or _KEYED.match(text, follower.end()):
            return parts
        place = near.end()


def assignments(text: str) -> Iterator[tuple[int, str, list]]:
    """Place, name and parts of every assignment."""
    done, line, line_end = 0, 0, text.find("\n")
    for operator in _OPERATOR.finditer(text):
        at, end = operator.span()
        if at < done:
            continue
        if at and text[at - 1] in _COMPARE or text[end : end + 1] in ("=", ":", "/"):
            continue
        if at and text[at - 1] == ":":
            continue
        while 0 <= line_end < at:
            line, line_end = line_end + 1, text.find("\n", line_end + 1)
        name = _target(text, at, line)
        if not name:
            continue
        place = end
        while place < len(text) and text[place] in " \t":
            place += 1
        if parts := _parts(text, place):
            if parts[0][0] == "literal":
                done = parts[-1][3]
            yield at, name, parts


def definitions(text: str) -> Iterator[tuple[int, str, list]]:
    """Place, name and parts of every ``#define``."""
    if "define" in text:
        for found in _DEFINE.finditer(text):
            if parts := _parts(text, found.end()):
                yield found.start(), found[1], parts


def handed_over(text: str) -> Iterator[tuple[int, str, list]]:
    """Place, name and parts of what setters and tags give to a sensitive name; they bind no constant."""
    if "(" in text:
        for pattern in (_SETTER, _PUT):
            for found in pattern.finditer(text):
                name = found[found.lastindex] if found.lastindex else ""
                if name_score(name) and (parts := _parts(text, found.end())):
                    yield found.start(), name, parts
    if "<" not in text:
        return
    for tag in _TAG.finditer(text):
        whole = tag[2]
        name, value = _TAG_NAME.search(whole), _TAG_VALUE.search(whole)
        key = name[name.lastindex] if name else tag[1]
        if not name_score(key):
            continue
        kind = "literal" if value else "bare"
        if value:
            start, end = (tag.start(2) + place for place in value.span(value.lastindex))
        elif whole.endswith("/"):
            continue
        else:  # what stands up to the next tag
            start = tag.end()
            end = text.find("<", start)
            if end < 0 or not text.startswith(f"</{tag[1]}", end):
                continue
            core = text[start:end].strip()
            start = text.find(core, start, end) if core else start
            end = start + len(core)
        if end > start:
            yield tag.start(), key, [(kind, text[start:end], start, end)]


def _values(bound: list[tuple[int, str, list, bool]], text: str) -> list[_Value | None]:
    """What each of the pairs in text order stands for; names refer as the module says."""
    first: dict[str, int] = {}
    for n, (_, name, _, binds) in enumerate(bound):
        if binds:
            first.setdefault(name, n)
    last: dict[str, int] = {}
    refers: list[list[int | None]] = []  # per part the pair it refers to
    for n, (_, name, parts, binds) in enumerate(bound):
        to = []
        for kind, value, _, _ in parts:
            k = None
            if kind == "name":
                k = last.get(value)
                if k is None and value != name:
                    k = first.get(value)
            to.append(k)
        refers.append(to)
        if binds:
            last[name] = n

    values: list[_Value | None] = [None] * len(bound)
    state = bytearray(len(bound))  # 1: begun, 2: known
    for root in range(len(bound)):
        path = [] if state[root] else [root]
        while path:
            n = path[-1]
            if not state[n]:
                state[n] = 1
                path += [k for k in refers[n] if k is not None and not state[k]]
                continue
            path.pop()
            if state[n] == 2:
                continue
            pieces = []
            for (kind, value, start, end), k in zip(bound[n][2], refers[n], strict=True):
                if k is not None:
                    pieces.append(values[k] if state[k] == 2 else None)
                elif kind == "name" and (
                    len(bound[n][2]) > 1 or "." in value or text[end : end + 1] in ("(", "[")
                ):
                    continue  # code, not a literal
                else:
                    pieces.append(_Value([False, start, end], value, kind == "literal"))
            pieces = [piece for piece in pieces if piece]
            values[n] = _together(pieces) if pieces else None
            state[n] = 2
    return values


def named_spans(text: str) -> list[tuple[int, int]]:
    """Literals whose target names are sensitive, with constants followed to their literals."""
    pairs = [(*pair, True) for find in (assignments, definitions) for pair in find(text)]
    pairs += [(*pair, False) for pair in handed_over(text)]
    pairs.sort(key=lambda pair: pair[0])
    found: set[tuple[int, int]] = set()
    for (_, name, _, _), whole in zip(pairs, _values(pairs, text), strict=True):
        weight = name_score(name)
        if weight and whole and whole.telling and weight + whole.score >= THRESHOLD:
            # A tree that was reported once is not walked again.
            trees = [whole.spans]
            while trees:
                tree = trees.pop()
                if tree[0]:
                    continue
                tree[0] = True
                if len(tree) == 2:
                    trees += tree[1]
                elif tree[2] > tree[1]:
                    found.add((tree[1], tree[2]))
    return sorted(found)


def scan(text: str | None) -> list[tuple[int, int, str]]:
    """All spans of a text by start, then by kind in the order of ``KINDS``."""
    text = text or ""
    spans = []
    lowered = text.lower()
    if any(word in lowered for word in ASSIGN_WORDS):
        spans += [(*m.span(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        spans += [(*m.span(), "access") for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    spans += [(*m.span(), "hex") for m in HEX.finditer(text)]
    if any(sign in text for sign in "=:(<") or "#" in text and "define" in text:
        base = sorted((start, end) for start, end, _ in spans)
        inside, at, reach = [], 0, 0
        for start, end in named_spans(text):
            while at < len(base) and base[at][0] <= start:
                reach = max(reach, base[at][1])
                at += 1
            if end > reach:
                inside.append((start, end, "named"))
        spans += inside
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def redact(text: str | None, spans: list[tuple[int, int, str]], mark: str = "[secret]") -> str | None:
    """The text with every maximal run of overlapping spans replaced by ``mark``."""
    if not spans:
        return text
    out, place, reach = [], 0, -1
    for start, end, _ in spans:
        if start >= reach:
            if reach >= 0:
                place = reach
            out += [text[place:start], mark]
        reach = max(reach, end)
    out.append(text[reach:])
    return "".join(out)


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, ``found`` (array of start, end, kind) and ``redacted``."""

    def setup():
        def work(texts):
            found = [scan(text) for text in texts]
            rows = [
                [{"start": s, "end": e, "kind": k} for s, e, k in spans] for spans in found
            ]
            return rows, [redact(t, s) for t, s in zip(texts, found, strict=True)]

        return work

    fields = "found array<struct<start: long, end: long, kind: string>>, redacted string"
    return map_texts(docs, setup, fields, [id_col], text_col)


def redact_secrets(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with every found span of its texts replaced by a mark; other columns stay."""
    rest = [name for name in docs.columns if name != text_col]

    def setup():
        return lambda texts: [[redact(text, scan(text)) for text in texts]]

    made_text = unused("_redacted", docs.columns)
    made = map_texts(docs, setup, f"`{made_text}` string", rest, text_col)
    return made.withColumnRenamed(made_text, text_col).select(*docs.columns)


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts, digest of the base spans and all spans as one string."""

    def joined(items):
        return F.array_join(
            F.transform(items, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
        )

    def count(kind):
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long")

    base = F.filter("found", lambda s: s["kind"] != "named")
    return found.select(
        id_col, count("assign").alias("n_assign"), count("access").alias("n_access"),
        count("hex").alias("n_hex"), F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("found")).alias("spans"), count("named").alias("n_named"),
    )


def base_digest(spans: list[tuple[int, int, str]]) -> str:
    """The same digest in plain Python, for tests."""
    text = ",".join(f"{k}:{s}:{e}" for s, e, k in spans if k != "named")
    return hashlib.sha256(text.encode()).hexdigest()
