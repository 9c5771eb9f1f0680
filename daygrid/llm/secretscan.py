"""Secret scans: fixed patterns, and literals that reach sensitive names by assignment.

Source and configuration syntax is read into bindings of a name and what is assigned to it:
quoted and bare literals and names of other bindings. Constants propagate along names, and what
reaches a name is scored by how sensitive the name is and how random the joined literals look.
Work is linear in the text: an operator is a site, its name is read backwards and its expression
forwards, and every binding is visited once.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from math import log2
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daygrid.llm.common import per_row

KINDS = ("assign", "access", "hex", "literal")

# The patterns of the three plain kinds and the least lengths of what they find.
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
_LEAST_ASSIGNED, _LEAST_ACCESS, _LEAST_HEX = 12, 18, 16
# A run is matched whole or not at all, so the least length can stand in these two patterns.
_ACCESS = re.compile(r"AKIA[A-Z0-9]{%d,}" % (_LEAST_ACCESS - 4))
_HEX = re.compile(r"[0-9a-f]{%d,}" % _LEAST_HEX)
_ASSIGN_STEMS = ("password", "passwd", "secret", "token", "api")

# Words of names that hold secrets, words that weaken or undo them, and words
# of literals that stand for a secret without being one.
STRONG_WORDS = frozenset(
    "password passwd passwort passphrase passcode pwd secret secrets token apikey credential "
    "credentials privatekey accesskey secretkey authtoken".split()
)
STRONG_PAIRS = frozenset(
    "api key,access key,private key,secret key,auth key,signing key,encryption key,master key,"
    "account key,client key,pass phrase,pass word,auth token,connection string".split(",")
)
STRONG_ENDS = ("password", "passwd", "secret", "token", "apikey", "secretkey", "accesskey", "privatekey")
WEAK_WORDS = frozenset("key pass auth cred creds pin salt bearer authorization signature".split())
UNDOING_LAST = frozenset(
    "name count length len size limit url uri path file filename dir type field label hint prompt "
    "policy expiry expires ttl timeout header prefix suffix format enabled required regex pattern "
    "placeholder error message description title class index version algorithm".split()
)
UNDOING_ANY = frozenset("public max min num total".split())
_PLACEHOLDER = re.compile(
    r"(?i)change.?me|example|placeholder|dummy|your[_ -]|insert[_ -]|redacted|xxxx|\*{3}|<[^<>]*>|%\(|\.{3}"
)
#: Every sensitive name holds one of these.
_STEMS = ("pass", "pwd", "secret", "token", "key", "cred", "auth", "pin", "salt", "bearer", "sign", "connection")
_TYPE_WORDS = frozenset("string str text char bytes varchar nvarchar object any auto".split())

#: Least sum of a name's and a literal's score.
THRESHOLD = 4.0
_LEAST_SECRET = 8

# An operator's first character is matched first, so that the search skips all others.
_OPERATOR = re.compile(
    r"[:=](?<![=!<>:+*/%&|^~?-][:=])(?:(?<=:)=|(?<==)>|(?<==)(?![=~>])|(?<=:)(?![:/=]))"
)
_NAME_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_$.-")
_PARENTHESIS = re.compile(r"[ \t]*\(\s*+(?=[\"'`])")
_BLANK = re.compile(r"\s*+")
_TOKEN = re.compile(
    r"""(?P<space>[ \t]+)
    |(?P<string>[rRbBuUfF]{0,2}(?:"{3}(?P<t1>(?:[^"\\]|\\.|"(?!""))*+)"{3}|'{3}(?P<t2>(?:[^'\\]|\\.|'(?!''))*+)'{3}
      |"(?P<q1>(?:[^"\\\n]|\\.)*+)"|'(?P<q2>(?:[^'\\\n]|\\.)*+)'|`(?P<q3>[^`\n]*+)`))
    |(?P<shell>\$\{(?P<s1>\w++)\}|\$(?P<s2>[A-Za-z_]\w*+))
    |(?P<join>\+|\.\.?(?=[ \t"'`$])|&(?=[ \t"'`]))
    |(?P<name>[A-Za-z_][A-Za-z0-9_]*+(?:(?:\.|->)[A-Za-z_][A-Za-z0-9_]*+)*+(?![^\s+,;)\]}(.&]))
    |(?P<bare>[^\s"'`,;()\[\]{}<>$&]++)""",
    re.VERBOSE | re.DOTALL,
)
_ANNOTATION = re.compile(r"[ \t]*[A-Za-z_][A-Za-z0-9_.]*+(?:[<\[][A-Za-z0-9_., |<>\[\]]*+)?[?!]?[ \t]*=(?![=~>])")
_INTERPOLATED = re.compile(r"\$?\{\s*([A-Za-z_][\w.]*+)\s*\}")
_ELEMENT = re.compile(r"<([A-Za-z_][\w:.-]*+)(?:\s[^<>]*+)?>([^<>]++)</\1\s*>")
_PAIR_TAG = re.compile(
    r"""(?i)\b(?:key|name)\s*=\s*(["'])([^"'<>\n]*+)\1[^<>\n"']*?\bvalue\s*=\s*(["'])((?:(?!\3)[^<>\n])*+)\3"""
)
_PAIR_CALL = re.compile(r"""\(\s*(["'])([A-Za-z_][\w. -]*+)\1\s*,\s*(["'])((?:(?!\3)[^\\\n])*+)\3\s*[,)]""")
_WORDS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")


class Literal(NamedTuple):
    """A piece of text in an expression, by code points."""

    start: int
    end: int


class Binding(NamedTuple):
    """A name, and the literals and names whose values are joined under it."""

    name: str
    at: int
    parts: tuple[Literal | str, ...]


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the three plain kinds."""
    spans: list[tuple[int, int, int]] = []
    low = text.lower()
    if any(stem in low for stem in _ASSIGN_STEMS):
        spans += [
            (m.start(), 0, m.end())
            for m in _ASSIGN.finditer(text)
            if m.end(2) - m.start(2) >= _LEAST_ASSIGNED
        ]
    if "AKIA" in text:
        spans += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text)]
    spans += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return spans


def _word_before(text: str, at: int) -> int:
    """Start of the name that ends at ``at``."""
    while at and text[at - 1] in _NAME_CHARS:
        at -= 1
    return at


def _without_blanks(text: str, end: int) -> int:
    while end and text[end - 1] in " \t":
        end -= 1
    return end


class _Targets:
    """Names to the left of operators that come in the text's order.

    Where the last line, bracket and quotes began is carried on from operator to operator, so
    no stretch is searched twice.
    """

    def __init__(self, text: str, start: int):
        self.text = text
        self.seen = start
        self.last = dict.fromkeys("\n[\"'`", start - 1)

    def name(self, end: int) -> str:
        """The name of the operator at ``end``; empty if there is none."""
        text, end = self.text, _without_blanks(self.text, end)
        if end <= self.seen:
            return ""
        for char in self.last:
            self.last[char] = max(self.last[char], text.rfind(char, self.seen, end - 1))
        self.seen, final = end - 1, text[end - 1]
        line = self.last["\n"]
        if final in "\"'`":
            begin = self.last[final]
            return text[begin + 1 : end - 1] if begin > line else ""
        if final == "]":
            begin = self.last["["]
            if begin <= line:
                return ""
            self.last["["] = line  # a bracket has one partner
            inner = text[begin + 1 : end - 1].strip(" \t\"'`")
            if inner and not inner.isdigit():
                return inner
            end = begin
        begin = _word_before(text, end)
        name = text[begin:end]
        if name.lower() in _TYPE_WORDS:  # the type may stand between name and operator
            before = _without_blanks(text, begin)
            name = text[_word_before(text, before) : before] or name
        return name.strip("-.")


def _literal_parts(text: str, start: int, end: int, filled: bool) -> list[Literal | str]:
    """A quoted text, parted at the names that it interpolates."""
    if not filled:
        return [Literal(start, end)]
    parts: list[Literal | str] = []
    for m in _INTERPOLATED.finditer(text, start, end):
        parts += [Literal(start, m.start()), m.group(1)]
        start = m.end()
    return [*parts, Literal(start, end)]


def _expression(text: str, at: int, limit: int) -> tuple[list[Literal | str], list[Literal], int]:
    """(literals and names that are joined from ``at`` on, quoted ones among them, where it ends)."""
    parts: list[Literal | str] = []
    quoted: list[Literal] = []
    wrapped = _PARENTHESIS.match(text, at, limit)
    at = wrapped.end() if wrapped else at
    joined = True  # whether another operand may follow
    end = at
    while True:
        if wrapped or (joined and parts):  # the line may end after a join and in parentheses
            at = _BLANK.match(text, at, limit).end()
        m = _TOKEN.match(text, at, limit)
        if m is None:
            break
        kind = m.lastgroup if m.lastgroup in ("space", "join", "name", "bare") else None
        if kind == "space":
            at = m.end()
            continue
        if kind == "join":
            if joined:
                break
            joined, at = True, m.end()
            continue
        if m.group("string") is not None:
            group = next(g for g in ("t1", "t2", "q1", "q2", "q3") if m.group(g) is not None)
            prefix = m.group("string")[: m.start(group) - m.start()]
            filled = group in ("q1", "q3") and "${" in m.group(group) or "f" in prefix.lower()
            if not joined and isinstance(parts[-1], str):
                break  # texts that stand side by side are one, a name before a text isn't
            parts += _literal_parts(text, m.start(group), m.end(group), filled)
            quoted.append(Literal(m.start(group), m.end(group)))
        elif not joined and text[m.start() - 1] in " \t\n":
            break  # without a join only shell words that touch go on
        elif m.group("shell") is not None:
            parts.append(m.group("s1") or m.group("s2"))
        elif kind == "name":
            if text[m.end() : m.end() + 1] == "(":
                break  # a call's value is unknown
            parts += [m.group(), Literal(m.start(), m.end())]
        elif text[m.end() - 1] == ":":
            break  # a name with an operator of its own
        else:
            parts.append(Literal(m.start(), m.end()))
        joined, at = False, m.end()
        end = at
    return parts, quoted, end


def _assignments(text: str, start: int, limit: int) -> tuple[list[Binding], list[Literal]]:
    """Bindings by operators within a stretch, and the quoted texts in them. What stands in an
    expression belongs to its name; operators there begin no binding."""
    found, quoted, done = [], [], start
    targets = _Targets(text, start)
    for m in _OPERATOR.finditer(text, start, limit):
        if m.start() < done:
            continue
        name = targets.name(m.start())
        if not name:
            continue
        at = m.end()
        if m.group() == ":" and (typed := _ANNOTATION.match(text, at, limit)):
            at = typed.end()
        parts, texts, end = _expression(text, at, limit)
        if parts:
            found.append(Binding(name, m.start(), tuple(parts)))
            quoted += texts
            done = end
    return found, quoted


def bindings(text: str) -> list[Binding]:
    """All bindings of a text, in its order. Quoted texts are read for bindings of their own,
    as of a configuration kept in a string, but not once more within."""
    found, quoted = _assignments(text, 0, len(text))
    for inner in quoted:
        found += _assignments(text, inner.start, inner.end)[0]
    for pattern, name, value in ((_ELEMENT, 1, 2), (_PAIR_TAG, 2, 4), (_PAIR_CALL, 2, 4)):
        for m in pattern.finditer(text):
            start, end = m.span(value)
            while start < end and text[start].isspace():
                start += 1
            while end > start and text[end - 1].isspace():
                end -= 1
            found.append(Binding(m.group(name), m.start(), (Literal(start, end),)))
    return sorted(found, key=lambda b: b.at)


def name_score(name: str) -> float:
    """How likely a name holds a secret: 3 for sure, 1.5 maybe, 0 not."""
    words = [w.lower() for w in _WORDS.findall(name)]
    while words and words[-1].isdigit():
        words.pop()
    if not words or words[-1] in UNDOING_LAST or UNDOING_ANY.intersection(words):
        return 0.0
    if STRONG_WORDS.intersection(words) or any(
        f"{a} {b}" in STRONG_PAIRS for a, b in zip(words, words[1:])
    ):
        return 3.0
    if any(len(w) > len(end) and w.endswith(end) for w in words for end in STRONG_ENDS):
        return 3.0
    return 1.5 if words[-1] in WEAK_WORDS else 0.0


class Looks:
    """What joined literals look like: letter counts that add up, never the joined text."""

    MOST = 1e6  # counts beyond it say nothing more; joins may double without end

    def __init__(self, counts: Counter | None = None, placeholder: bool = False):
        self.counts = counts or Counter()
        self.placeholder = placeholder

    def add(self, other: Looks) -> None:
        for char, n in other.counts.items():
            self.counts[char] = min(self.MOST, self.counts[char] + n)
        self.placeholder |= other.placeholder

    def score(self) -> float:
        """How random the text looks; very low for words, placeholders and short texts."""
        n = sum(self.counts.values())
        if n < _LEAST_SECRET or self.placeholder:
            return -9.0
        entropy = -sum(c / n * log2(c / n) for c in self.counts.values())
        kinds = [
            any(c.islower() for c in self.counts),
            any(c.isupper() for c in self.counts),
            any(c.isdigit() for c in self.counts),
            any(not c.isalnum() and not c.isspace() for c in self.counts),
        ]
        if entropy < 2.5:
            return -3.0
        blank = 3.0 * any(c.isspace() for c in self.counts)
        if not kinds[2]:  # without a digit most texts are words
            return (1.0 if kinds[0] and kinds[1] and n >= 16 else -2.0) - blank
        return 0.5 * sum(kinds) + (n >= 16) + 0.5 * (n >= 24) - (3.0 if sum(kinds) == 1 else 0.0) - blank


class _Constants:
    """Values and origins of bindings, each found once."""

    def __init__(self, text: str, found: list[Binding]):
        self.text = text
        self.found = found
        self.named: dict[str, list[int]] = {}
        for k, binding in enumerate(found):
            self.named.setdefault(binding.name, []).append(k)
            short = re.split(r"[.]|->", binding.name)[-1]
            if short != binding.name:
                self.named.setdefault(short, []).append(k)
        self.links = [self._links(k) for k in range(len(found))]

    def _links(self, k: int) -> list[Literal | int]:
        """The binding's parts with names replaced by bindings. A word that names a binding
        isn't a literal; one that names nothing is."""
        out: list[Literal | int] = []
        parts = self.found[k].parts
        for i, part in enumerate(parts):
            if isinstance(part, Literal):
                bare = i and isinstance(parts[i - 1], str) and self.text[part.start : part.end] == parts[i - 1]
                if not bare or not (out and isinstance(out[-1], int)):
                    out.append(part)
                continue
            other = self._binding_of(part, k)
            if other is not None:
                out.append(other)
        return out

    def _binding_of(self, name: str, k: int) -> int | None:
        """The last binding of a name before the k-th, else its first one after."""
        places = self.named.get(name) or self.named.get(re.split(r"[.]|->", name)[-1])
        if not places:
            return None
        at = bisect_left(places, k)
        return places[at - 1] if at else next((p for p in places if p > k), None)

    def looks(self, starts: list[int]) -> dict[int, Looks]:
        """What the values of the given bindings, and of those they need, look like. A name that
        leads back to itself adds nothing."""
        made: dict[int, Looks] = {}
        opened: set[int] = set()
        stack = list(starts)
        while stack:
            k = stack[-1]
            if k in made:
                stack.pop()
                continue
            if k not in opened:
                opened.add(k)
                stack += [p for p in self.links[k] if isinstance(p, int) and p not in opened]
                continue
            total = made[k] = Looks()
            for part in self.links[k]:
                if isinstance(part, int):
                    if part in made and part != k:
                        total.add(made[part])
                    continue
                piece = self.text[part.start : part.end]
                total.add(Looks(Counter(piece), _PLACEHOLDER.search(piece) is not None))
        return made

    def origins(self, starts: list[int]) -> set[Literal]:
        """Literals that reach the given bindings."""
        seen, out, stack = set(starts), set(), list(starts)
        while stack:
            for part in self.links[stack.pop()]:
                if isinstance(part, Literal):
                    if part.end > part.start:
                        out.add(part)
                elif part not in seen:
                    seen.add(part)
                    stack.append(part)
        return out


def assigned_spans(text: str) -> set[Literal]:
    """Literals that reach a sensitive name and look like a secret."""
    low = text.lower()
    if not any(stem in low for stem in _STEMS):
        return set()
    found = bindings(text)
    names = {b.name for b in found}
    scores = {name: name_score(name) for name in names if any(stem in name.lower() for stem in _STEMS)}
    sensitive = [k for k, b in enumerate(found) if scores.get(b.name)]
    if not sensitive:
        return set()
    constants = _Constants(text, found)
    looks = constants.looks(sensitive)
    hits = [k for k in sensitive if scores[found[k].name] + looks[k].score() >= THRESHOLD]
    return constants.origins(hits)


def secret_spans(text: str | None) -> list[tuple[int, int, int]]:
    """(start, kind, end) of all spans of a whole text, in order.

    A literal within a span of a plain kind is found already and isn't listed again.
    """
    text = text or ""
    spans = sorted(base_spans(text))
    added, reach, at = [], 0, 0
    for literal in sorted(assigned_spans(text)):
        while at < len(spans) and spans[at][0] <= literal.start:
            reach = max(reach, spans[at][2])
            at += 1
        if reach < literal.end:
            added.append((literal.start, len(KINDS) - 1, literal.end))
    return sorted(spans + added)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, found) of every row: found lists (kind, start, end) in code points, end
    exclusive, by start and then by kind as ``KINDS`` has them.

    Null and empty texts have no spans. Rows that repeat and rows without an id are rows like
    others, an empty table gives an empty result, other columns are not read.
    """

    def make(batch):
        made = [secret_spans(t) for t in batch.column(1).to_pylist()]
        return {
            "doc_id": batch.column(0),
            "found": [[{"kind": KINDS[k], "start": s, "end": e} for s, k, e in m] for m in made],
        }

    source = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text")
    )
    found = "array<struct<kind: string, start: long, end: long>>"
    return per_row(source, f"doc_id long, found {found}", make)


def _listed(found: Column) -> Column:
    return F.array_join(
        F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))),
        ",",
    )


def scan_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans for every row, from ``scan``."""
    rows = scan(docs, id_col, text_col)

    def count(kind: str) -> Column:
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    plain = F.filter("found", lambda s: s["kind"] != KINDS[-1])
    return rows.select(
        "doc_id",
        *[count(kind) for kind in KINDS[:-1]],
        F.sha2(_listed(plain).cast("binary"), 256).alias("base_sha256"),
        _listed(F.col("found")).alias("spans"),
    )
