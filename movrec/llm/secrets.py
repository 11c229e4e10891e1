"""Secret scans: base patterns plus assignment-aware lexing.

Base kinds, leftmost non-overlapping, each over the whole text:

* ``assign``: a sensitive word, an assignment sign, a value of 6 or more;
* ``access``: ``AKIA`` keys of 20 or more characters;
* ``hex``: lower-case hexadecimal runs of 24 or more.

The method adds kind ``literal``.  A text is lexed into names, strings of all
quote kinds (also prefixed, triple and template strings), signs, brackets and
line ends, and the tokens are read as (name, literal) pairs: ``name = "x"``,
``name: x``, ``"name": "x"``, ``export NAME=x``, ``--name x``, ``<name>x</name>``,
``config["name"] = "x"``, ``name: str = "x"``, ``setName("x")``, ``set("name", "x")``,
``name: X`` before ``value: x``, indented blocks after ``name: |``, and all of these
inside a string.  Constants are propagated (``K = "..."`` then ``password = K``,
``a + K``, ``f(K)``, ``f"{K}"`` or ``$K``), and a literal is scored by the words of
the names it reaches, its length, its mix of characters and its entropy;
placeholders score nothing, nor do texts that ask for a stored value by its name
(``getenv("DB_PASSWORD")``).  Of a text of several lines each line is a literal.
Added spans cover the literal's characters and never replace a base span.

Defined results: null and empty texts have no spans; very long texts are lexed
whole, in time that grows with their length; repeated rows are scanned one by
one; other columns are not read.  Offsets are code points, end exclusive.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from movrec.llm.common import arrow_map

KINDS = ("assign", "access", "hex", "literal")
MASK = "<secret>"

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
#: a run is matched whole or not at all, so this equals `[0-9a-f]+` of 24 or more
HEX = re.compile(r"[0-9a-f]{24,}")
SENSITIVE = re.compile(r"passw|secret|token|api_?key", re.ASCII | re.IGNORECASE)

#: words of a target name and what they weigh
NAME_WEIGHTS = {
    "password": 1.0, "passwd": 1.0, "pwd": 0.9, "passphrase": 1.0, "pass": 0.6, "secret": 1.0, "token": 0.8,
    "apikey": 1.0, "credential": 0.9, "credentials": 0.9, "auth": 0.5, "bearer": 0.7, "private": 0.5, "access": 0.4,
    "key": 0.4, "signing": 0.4, "salt": 0.5, "client": 0.1,
}
#: parts of names that speak of something other than the secret itself
NAME_DISCOUNT = {"name": 0.5, "id": 0.4, "length": 0.9, "count": 0.9, "url": 0.7, "path": 0.7, "file": 0.7, "field": 0.8, "type": 0.8, "expiry": 0.8, "max": 0.6, "min": 0.6}
PLACEHOLDER = re.compile(r"(?i)^(?:x+|\*+|\.+|none|null|true|false|todo|change_?me|example|placeholder|your[-_].*|<.*>|\$\{.*\}|\{\{.*\}\}|\$\w+|%\w+%)$")
THRESHOLD = 1.0
LEAST_LITERAL = 6

_NAME = r"[A-Za-z_$@][\w$]*+(?:[.\-][\w$]++)*+"
#: a quote that is never closed opens a text up to the end of its line
_DOUBLE, _SINGLE = (rf"{q}(?:[^{q}\\\n]++|\\.)*+\\?(?:{q}|(?=\n)|\Z)" for q in "\"'")
_TRIPLE = r"\"\"\"(?s:.*?)\"\"\"|'''(?s:.*?)'''"
#: a template may span lines, not paragraphs
_TEMPLATE = r"`(?:[^`\\\n]++|\\.|\\?\n(?![ \t]*\n))*+\\?(?:`|(?=\n)|\Z)"
#: an apostrophe after a letter opens no string
_STRING = rf"(?:(?<![\w$])[bBrRuUfF]{{1,2}})?(?:{_TRIPLE}|{_DOUBLE})|(?<![\w$])[bBrRuUfF]{{1,2}}{_SINGLE}|(?<!\w){_SINGLE}|{_TEMPLATE}"
#: the kinds of token; a stretch of plain words is one token, so prose costs little
TOKEN = re.compile(
    rf"(?P<fence>```+)|(?P<text>{_STRING})|(?P<option>(?<![\w\-])--(?=[A-Za-z]))"
    rf"|(?P<element><(?P<tag>{_NAME})>(?P<inner>[^<>\s]+)</(?P=tag)>)"
    r"|(?P<prose>(?:[A-Za-z_][\w.\-]*+(?:'[a-z]{1,2})?,?[ \t]++){1,64}(?=[A-Za-z_]))"
    rf"|(?P<name>{_NAME})|(?P<number>\d[\w.]*+)|(?P<skip>[!<>]=+|::)|(?P<sign>:=|=>|[+?|&]{{0,2}}={{1,3}}|:)"
    r"|(?P<open>[(\[{])|(?P<close>[)\]}])|(?P<comma>,)|(?P<stop>[;\n])",
    re.ASCII,
)
NAME = re.compile(_NAME, re.ASCII)
#: what may stand in quotes as the name of a value
KEY = re.compile(r"[\w.\-$@/ ]{1,128}", re.ASCII)
BARE = re.compile(r"[^\s,;{}()\"'`<>#+]+")
IN_URL = re.compile(r"[^\s,;{}()\"'`<>#+&]+")
BLANKS = re.compile(r"[ \t]*+")
WHITE = re.compile(r"\s*+")
JOINT = re.compile(r"\s*+\+\s*+|[ \t]*+(?:\|\||\?\?|\bor\b)\s*+")
#: constants named inside a formatted text, or by the shell
INSERTED = re.compile(r"\$?\{([A-Za-z_]\w*)\}")
SHELL = re.compile(r"\$\{?([A-Za-z_]\w*)\}?", re.ASCII)
BLOCK = re.compile(r"[ \t]*+[|>][+\-]?\d?[ \t]*+(?:#[^\n]*)?\n")
CALLED = re.compile(r"[\w$]\([ \t]*[bBrRuUfF]{0,2}[\"'`]")
ENVIRONMENT = re.compile(r"[A-Z][A-Z0-9]*(?:_[A-Z0-9]+)+")
SETTERS = {"set", "put", "add", "with", "use", "define", "setenv", "putenv", "setdefault", "insert", "assign", "update"}
GETTERS = {"get", "env", "environ", "getenv", "read", "load", "fetch", "find", "input", "prompt", "lookup", "header", "headers", "args"}
TYPES = {"string", "str", "String", "char", "byte", "text", "any", "auto", "object", "varchar"}
#: how deep calls and texts within texts are followed; deeper ones have pairs of their own
DEEPEST, INNER_TEXTS = 8, 2
PART = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    spans = []
    if SENSITIVE.search(text):
        spans += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        spans += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    spans += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    return _ordered(spans)


def _ordered(spans: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def name_score(name: str) -> float:
    """How sensitive the words of a target name are, from 0 to about 1."""
    parts = [p.lower() for p in PART.findall(name)]
    words = parts + [a + b for a, b in zip(parts, parts[1:])]
    weight = min(1.2, sum(NAME_WEIGHTS.get(w, 0.0) for w in dict.fromkeys(words)))
    return max(0.0, weight - max([NAME_DISCOUNT.get(p, 0.0) for p in parts], default=0.0))


def literal_score(value: str, quoted: bool) -> float:
    """How much a literal looks like a credential, from 0 to about 1."""
    if len(value) < LEAST_LITERAL or PLACEHOLDER.match(value) or any(c.isspace() for c in value):
        return 0.0
    if not quoted:  # the end of a sentence is no part of a bare value
        value = value.rstrip(".!?:")
    n = len(value)
    if not n:
        return 0.0
    entropy = -sum(c / n * math.log2(c / n) for c in Counter(value).values())
    kinds = sum(any(t(c) for c in value) for t in (str.islower, str.isupper, str.isdigit, lambda c: not c.isalnum()))
    if kinds < 2 and not quoted:
        return 0.0
    return 0.25 * (kinds - 1) + min(1.0, entropy / 4.0) * 0.5 + min(1.0, n / 32) * 0.25


def path_score(path: str) -> float:
    """The score of a name or of the last key of a path such as ``config/signing_key``, whichever is higher."""
    return max(name_score(path), name_score(path.rsplit("/", 1)[-1]))


class _Statements:
    """Tokens of one text and the name-literal pairs read from them."""

    def __init__(self, text: str):
        self.text = text
        self.tokens = [(m.lastgroup, m.start(), m.end()) for m in TOKEN.finditer(text) if m.lastgroup not in ("fence", "skip")]
        self.starts = [t[1] for t in self.tokens]

    def kind(self, i: int) -> str | None:
        return self.tokens[i][0] if 0 <= i < len(self.tokens) else None

    def at(self, i: int) -> str:
        return self.text[self.tokens[i][1] : self.tokens[i][2]]

    def touch(self, i: int, end: int | None = None) -> bool:
        """Nothing but blanks between token ``i`` and the next one (or ``end``)."""
        to = self.tokens[i + 1][1] if end is None else end
        return BLANKS.match(self.text, self.tokens[i][2]).end() >= to

    def inside(self, i: int) -> tuple[int, int]:
        """Where the content of a text token starts and ends."""
        _, start, end = self.tokens[i]
        while self.text[start] not in "\"'`":
            start += 1
        n = 3 if end - start >= 6 and self.text[start : start + 3] in ('"""', "'''") else 1
        closed = end - start > 1 and self.text[end - 1] == self.text[start]
        return start + n, max(start + n, end - n * closed)

    def literals(self, i: int) -> list[tuple[str, int, int, bool]]:
        """The content of a text token, line by line."""
        return self.lines(*self.inside(i))

    def lines(self, start: int, end: int) -> list[tuple[str, int, int, bool]]:
        if "\n" not in self.text[start:end]:
            return [(self.text[start:end], start, end, True)]
        found = []
        for line in self.text[start:end].split("\n"):
            a = start + len(line) - len(line.lstrip())
            if line.strip():
                found.append((line.strip(), a, a + len(line.strip()), True))
            start += len(line) + 1
        return found

    def inserted(self, i: int) -> list[str]:
        a, b = self.inside(i)
        first = self.tokens[i][1]
        formatted = self.text[first] == "`" or "f" in self.text[first : a - 1].lower() or "${" in self.text[a:b]
        return INSERTED.findall(self.text, a, b) if formatted else []

    def target(self, i: int) -> tuple[str, int] | None:
        """The name that ends with token ``i``, and its first token."""
        keys: list[str] = []
        while self.kind(i) == "close" and self.at(i) == "]" and self.kind(i - 2) == "open" and self.at(i - 2) == "[":
            if self.kind(i - 1) == "text":
                a, b = self.inside(i - 1)
                keys.append(self.text[a:b])
            i -= 3
            if i < 0 or not self.touch(i):
                return None
        if self.kind(i) == "name":
            keys.append(self.at(i))
        elif self.kind(i) == "text" and not keys:
            a, b = self.inside(i)
            keys.append(self.text[a:b])
        if not keys or not all(KEY.fullmatch(k) for k in keys):
            return None
        return "/".join(k.replace("/", ".") for k in reversed(keys)), i

    def targets(self, sign: int) -> tuple[list[str], int]:
        """Names on the left of a sign; an annotated or typed name counts beside its type."""
        if sign < 1 or not self.touch(sign - 1):
            return [], sign
        found = self.target(sign - 1)
        if found is None:
            return [], sign
        names, first = [found[0]], found[1]
        if self.kind(first - 1) == "sign" and self.at(first - 1) == ":" and self.touch(first - 1):
            before = self.target(first - 2) if self.touch(first - 2) else None
            if before:
                names.append(before[0])
        elif found[0] in TYPES and self.kind(first - 1) == "prose":
            names.append(self.at(first - 1).split()[-1].rstrip(","))
        return names, first

    def right(self, at: int, url: bool = False) -> tuple[list, list[str], int]:
        """Literals and references of the expression that starts at ``at``, and how far bare words were read."""
        text, literals, references, read = self.text, [], [], at
        quiet: list[bool] = []  # for each open bracket: whether it asks for a value by name
        k = 0
        while True:
            at = (WHITE if quiet else BLANKS).match(text, at).end()
            k = bisect_left(self.starts, at, k)
            kind = self.kind(k) if k < len(self.starts) and self.starts[k] == at else None
            called = NAME.match(text, at)
            if kind == "text":
                found = self.literals(k)
                if quiet:  # an argument: the name of a stored value is no secret
                    found = [f for f in found if not quiet[-1] and any(map(str.isdigit, f[0])) and not ENVIRONMENT.fullmatch(f[0])]
                literals += found
                references += self.inserted(k)
                at = self.tokens[k][2]
            elif called and text[called.end() : called.end() + 1] in ("(", "["):
                if len(quiet) == DEEPEST:
                    break
                if text[called.end()] == "[":
                    a = bisect_left(self.starts, called.end())
                    if self.kind(a + 2) == "close":
                        path = self.target(a + 2)
                        references += [path[0]] if path else []
                words = {p.lower() for p in PART.findall(called[0])}
                quiet.append(bool(words & GETTERS) or text[called.end()] == "[" or (bool(quiet) and quiet[-1]))
                at = called.end() + 1
                continue
            elif kind == "open" and text[at] != "{":
                if len(quiet) == DEEPEST:
                    break
                quiet.append(bool(quiet) and quiet[-1])
                at += 1
                continue
            elif quiet:
                if called:
                    references.append(called[0])
                    at = called.end()
                elif kind == "close":
                    quiet.pop()
                    at += 1
                elif at >= len(text) or text[at] == ";" or text[at] in "{}":
                    break
                else:
                    at = self.tokens[k][2] if kind else at + 1
                if quiet:
                    continue
            else:
                bare = (IN_URL if url else BARE).match(text, at)
                shell = SHELL.match(text, at)
                if shell:
                    references.append(shell[1])
                if not bare:
                    break
                if NAME.fullmatch(bare[0]):
                    references.append(bare[0])
                literals.append((bare[0], bare.start(), bare.end(), False))
                at = bare.end()
                if not bare[0].startswith("//"):  # an address may hold names of its own
                    read = at
            if quiet:
                continue
            joint = JOINT.match(text, at)
            if not joint:
                break
            at = joint.end()
        return literals, references, read

    def block(self, sign: int, first: int) -> list[tuple[str, int, int, bool]]:
        """Lines of an indented block that a ``name: |`` opens."""
        m = BLOCK.match(self.text, self.tokens[sign][2])
        if not m or self.at(sign) != ":":
            return []
        line = self.text.rfind("\n", 0, self.tokens[first][1]) + 1
        indent = BLANKS.match(self.text, line).end() - line
        at = m.end()
        while at < len(self.text):
            end = self.text.find("\n", at)
            end = len(self.text) if end < 0 else end
            inner = BLANKS.match(self.text, at).end()
            if inner < end and inner - at <= indent:
                break
            at = end + 1
        return self.lines(m.end(), min(at, len(self.text))) if at > m.end() else []

    def call(self, i: int) -> list[tuple[str, list, list[str]]]:
        """``setName("x")`` and ``set("name", "x")``; token ``i`` is the opening bracket."""
        words = [p.lower() for p in PART.findall(self.at(i - 1).rsplit(".", 1)[-1])]
        if not words or words[0] not in SETTERS:
            return []
        found = []
        if self.kind(i + 1) == "text" and self.kind(i + 2) == "comma":
            key = self.target(i + 1)
            if key:
                literals, references, _ = self.right(self.tokens[i + 2][2])
                found.append((key[0], [x for x in literals if x[3]], references))
        arguments, references, k, depth = [], [], i + 1, 0
        while self.kind(k) in ("text", "name", "comma", "prose", "number"):
            if self.kind(k) == "text":
                arguments += self.literals(k)
            elif self.kind(k) == "name":
                references.append(self.at(k))
            k += 1
        found.append((self.at(i - 1), arguments, references))
        return found


def pairs(text: str, level: int = 0) -> list[tuple[str, list[tuple[str, int, int, bool]], list[str]]]:
    """``(name, literals, references)`` of every assignment; a literal is (value, start, end, quoted)."""
    lexed = _Statements(text)
    found: list[tuple[str, list, list[str]]] = []
    read, labelled, label_end = 0, "", -1
    for i, (kind, start, end) in enumerate(lexed.tokens):
        if start < read:  # inside a bare value
            continue
        if kind == "sign":
            names, first = lexed.targets(i)
            if not names:
                continue
            begin = lexed.tokens[first][1]
            block = lexed.block(i, first)
            literals, references, read = (block, [], end) if block else lexed.right(end, begin > 0 and text[begin - 1] in "?&")
            # `name: X` followed by `value: x` names the value
            if names[0] == "value" and labelled and text.count("\n", label_end, begin) <= 1:
                names = [*names, labelled]
            labelled = ""
            if names[0] in ("name", "key") and len(literals) == 1 and KEY.fullmatch(literals[0][0]):
                labelled, label_end = literals[0][0].replace("/", "."), literals[0][2]
            found += [(n, literals, references) for n in names]
        elif kind == "open" and text[start] == "(" and i and lexed.kind(i - 1) == "name" and lexed.touch(i - 1):
            found += lexed.call(i)
        elif kind == "option" and lexed.kind(i + 1) in ("name", "prose"):
            name = NAME.match(text, end)
            if text[name.end() : name.end() + 1] in (" ", "\t"):
                value = BLANKS.match(text, name.end()).end()
                if text[value : value + 1] not in ("-", "=", ":"):
                    literals, references, _ = lexed.right(value)
                    found.append((name[0], literals, references))
        elif kind == "element":
            m = TOKEN.match(text, start)
            found.append((m["tag"], [(m["inner"], m.start("inner"), m.end("inner"), False)], [m["inner"]] if NAME.fullmatch(m["inner"]) else []))
        elif kind == "text" and level < INNER_TEXTS:
            a, b = lexed.inside(i)
            if b - a > LEAST_LITERAL and _may_assign(text[a:b]):
                for name, literals, references in pairs(text[a:b], level + 1):
                    found.append((name, [(v, x + a, y + a, q) for v, x, y, q in literals], references))
    return found


def literal_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of literals that reach a sensitive name, directly or through constants."""
    found = pairs(text)
    score: dict[str, float] = {}
    for name, _, _ in found:
        score[name] = path_score(name)
    # a constant is as sensitive as the most sensitive name it flows into
    sources: dict[str, list[str]] = {}
    for name, _, refs in found:
        sources.setdefault(name, []).extend(r for r in refs if r in score)
    done: set[str] = set()
    for top in sorted(score, key=score.get, reverse=True):
        stack = [top]
        while stack:
            name = stack.pop()
            if name not in done:
                done.add(name)
                score[name] = max(score[name], score[top])
                stack += sources.get(name, [])
    spans = {
        ("literal", a, b)
        for name, literals, _ in found
        for value, a, b, quoted in literals
        if score[name] >= 0.5 and not (not quoted and value in score) and score[name] + literal_score(value, quoted) >= THRESHOLD + 0.5
    }
    return _ordered(list(spans))


def find_spans(text: str | None) -> list[tuple[str, int, int]]:
    """All spans by start, then kind as listed."""
    if not text:
        return []
    spans = base_spans(text)
    if _may_assign(text):
        spans = _ordered(spans + literal_spans(text))
    return spans


def _may_assign(text: str) -> bool:
    """Each of the lexed forms has one of these; a name can be spelt in too many ways to look for."""
    return "=" in text or ":" in text or "--" in text or "</" in text or CALLED.search(text) is not None


def redact(text: str | None) -> str | None:
    """The text with every maximal run of overlapping spans replaced by the mask."""
    spans = find_spans(text)
    if not spans:
        return text
    out, at = [], 0
    start, end = spans[0][1], spans[0][2]
    for _, a, b in [*spans[1:], ("", len(text) + 1, 0)]:
        if a < end:
            end = max(end, b)
            continue
        out += [text[at:start], MASK]
        at, start, end = end, a, b
    return "".join([*out, text[at:]])


_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def scan_secrets(docs: DataFrame) -> DataFrame:
    """``doc_id, spans`` (kind, start, end) for every row of ``docs``."""

    def run(batches):
        for batch in batches:
            found = [[{"kind": k, "start": a, "end": b} for k, a, b in find_spans(x.as_py())] for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, _SPANS)], ["doc_id", "spans"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return arrow_map(docs.select("doc_id", "text"), run, f"doc_id {kind}, spans array<struct<kind:string,start:bigint,end:bigint>>")


def redact_documents(docs: DataFrame) -> DataFrame:
    """``docs`` with secrets masked in ``text``; ``n_chars``, where there is one, follows the new text."""
    at = docs.columns.index("text")

    def run(batches):
        for batch in batches:
            new = pa.array([redact(x.as_py()) for x in batch.column(at)], batch.schema.field(at).type)
            yield pa.RecordBatch.from_arrays([new if i == at else c for i, c in enumerate(batch.columns)], batch.schema.names)

    out = arrow_map(docs, run, docs.schema)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(F.col("text").contains(MASK), F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return out
