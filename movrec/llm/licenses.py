"""License scan: notice phrases and identifier tags by Aho-Corasick, expressions by shunting yard.

One automaton over the words of a text (A-Z lower-cased, words
``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``) finds licence names and the phrases that
introduce a licence expression (``SPDX-License-Identifier:``, ``licensed
under`` and the like).  What follows such a phrase on its line, in the original
text, is lexed into licences, parentheses and the operators ``or``, ``and`` and
``with``; a shunting-yard parser orders it and evaluates it to the licences
named and an openness between 0 and 1: a choice is as open as its most open
side, a combination as its least open one, and an exception halves what a
licence withholds.  A document is as open as its least open statement.

Defined results: null and empty texts have no words and no labels, their score
is 0, as is that of every text without a licence; places in a row may overlap
and all count; equal rows are judged one by one; an expression ends where it
stops being one (open parentheses are closed, an operator without a right side
is dropped), so a line of any length and depth costs time linear in it; texts
of any length are read whole; other columns are neither read nor changed.
"""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Container, Iterable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from movrec.llm import words as W
from movrec.llm.common import arrow_map
from movrec.llm.decontaminate import NORMAL

#: fixed values: the base phrases and their labels
BASE_PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

#: openness of a licence family, by the label its names get
OPENNESS = {
    "cc0": 1.0, "unlicense": 1.0, "public-domain": 1.0, "mit": 0.95, "isc": 0.95, "bsd": 0.95, "zlib": 0.95, "boost": 0.95, "apache": 0.9,
    "cc-by": 0.85, "artistic": 0.75, "mpl": 0.7, "epl": 0.65, "eupl": 0.6, "cc-by-sa": 0.6, "lgpl": 0.6, "gpl": 0.4, "agpl": 0.3,
    "cc-by-nc": 0.2, "cc-by-nd": 0.2, "cc-by-nc-sa": 0.15, "cc-by-nc-nd": 0.1, "proprietary": 0.05,
}
UNKNOWN_OPENNESS = 0.5

#: names of licences as words, besides the base phrases
NAMES = {
    **BASE_PHRASES,
    "mit": "mit", "mit licence": "mit", "expat license": "mit", "isc": "isc", "isc license": "isc", "zlib": "zlib", "zlib license": "zlib",
    "bsd": "bsd", "bsd license": "bsd", "bsd 2 clause": "bsd", "bsd 3 clause": "bsd", "2 clause bsd": "bsd", "3 clause bsd": "bsd",
    "apache": "apache", "apache software license": "apache", "boost software license": "boost", "bsl 1 0": "boost", "artistic license": "artistic",
    "mpl": "mpl", "mozilla public license": "mpl", "epl": "epl", "eclipse public license": "epl", "eupl": "eupl", "european union public licence": "eupl",
    "gpl": "gpl", "gnu gpl": "gpl", "lgpl": "lgpl", "gnu lesser general public license": "lgpl", "gnu library general public license": "lgpl",
    "agpl": "agpl", "gnu affero general public license": "agpl", "affero general public license": "agpl",
    "cc0": "cc0", "creative commons zero": "cc0", "unlicense": "unlicense", "public domain": "public-domain",
    "creative commons attribution": "cc-by", "cc by sa": "cc-by-sa", "creative commons attribution sharealike": "cc-by-sa",
    "cc by nc": "cc-by-nc", "creative commons attribution noncommercial": "cc-by-nc", "cc by nd": "cc-by-nd", "cc by nc sa": "cc-by-nc-sa", "cc by nc nd": "cc-by-nc-nd",
    "all rights reserved": "proprietary",
}
#: names that are a licence only inside an expression: as words of a text they say too little
ONLY_IN_EXPRESSIONS = {"mit", "isc", "zlib", "bsd", "apache", "mpl", "epl", "eupl", "gpl", "lgpl", "agpl", "unlicense", "public domain"}

IDENTIFIER, NOTICE = "identifier", "notice"
#: phrases that an expression follows on the same line
LEADS = {
    "spdx license identifier": IDENTIFIER,
    "licensed under": NOTICE, "released under": NOTICE, "distributed under": NOTICE, "available under": NOTICE, "published under": NOTICE,
    "licenced under": NOTICE, "provided under": NOTICE, "subject to": NOTICE,
}

PRECEDENCE = {"or": 1, "and": 2, "with": 3}
FILLERS = {"the", "a", "an", "terms", "of", "either", "both", "this", "work", "is", "conditions", "your", "choice"}
ID_TOKEN = re.compile(rb"[()]|[A-Za-z0-9][A-Za-z0-9.+-]*|[\x80-\xff]+")
WORD_TOKEN = re.compile(rb"[()]|[0-9A-Za-z\x80-\xff]+")
_VERSION = re.compile(r"v?[0-9]+\Z")
_LONGEST = max(len(n.split()) for n in NAMES)
_NAMES = {tuple(n.split()): label for n, label in NAMES.items()}

Token = tuple[str, str]


class _Ahead:
    """Lower-cased tokens of a line, read only as far as asked for."""

    def __init__(self, pattern: re.Pattern, text: bytes, start: int, stop: int):
        self.rest = pattern.finditer(text, start, stop)
        self.seen: deque[str] = deque()

    def peek(self, n: int) -> tuple[str, ...]:
        while len(self.seen) < n and (m := next(self.rest, None)):
            self.seen.append(m[0].lower().decode("utf-8", "replace"))
        return tuple(islice(self.seen, n))

    def take(self, n: int = 1) -> None:
        for _ in range(n):
            self.seen.popleft()

    def skip(self, words: Container[str]) -> None:
        while (t := self.peek(1)) and t[0] in words:
            self.take()


def identifier_tokens(text: bytes, start: int, stop: int) -> Iterator[Token]:
    """``(kind, text)`` of an SPDX expression: operators, parentheses, licence and exception identifiers."""
    ahead = _Ahead(ID_TOKEN, text, start, stop)
    while t := ahead.peek(1):
        ahead.take()
        low = t[0].rstrip(".")
        yield (low, low) if low in PRECEDENCE or low in "()" else ("licence", low)


def notice_tokens(text: bytes, start: int, stop: int) -> Iterator[Token]:
    """``(kind, text)`` of an expression in prose: names and versions become identifiers, fillers go."""
    ahead, last = _Ahead(WORD_TOKEN, text, start, stop), ""
    while near := ahead.peek(_LONGEST):
        size = next((n for n in range(len(near), 0, -1) if near[:n] in _NAMES), 0)
        if size:
            ahead.take(size)
            yield "licence", _NAMES[near[:size]] + _version(ahead)
            last = "licence"
        elif near[0] in "()" or near[0] in PRECEDENCE or last == "with":
            ahead.take()  # after "with" comes the name of an exception
            last = "licence" if last == "with" else near[0]
            yield last, near[0]
        elif near[0] in FILLERS and last != "licence":
            ahead.take()
        else:
            return


def _version(ahead: _Ahead) -> str:
    """The version that follows a licence's name, as the end of its identifier."""
    ahead.skip(("license", "licence", "version", "public"))
    number = []
    while len(number) < 3 and (t := ahead.peek(1)) and _VERSION.match(t[0]):
        number.append(t[0].lstrip("v"))
        ahead.take()
    end = "-" + ".".join(number) if number else ""
    for later in (("or", "later"), ("or", "any", "later")):
        if ahead.peek(len(later)) == later:
            ahead.take(len(later))
            end += "-or-later"
    ahead.skip(("only", "version", "license", "licence"))
    return end


def family(label: str) -> str | None:
    """The family of an identifier: its longest leading part that is one."""
    parts = label.rstrip("+").split("-")
    return next((f for n in range(len(parts), 0, -1) if (f := "-".join(parts[:n])) in OPENNESS), None)


def openness(label: str) -> float:
    return OPENNESS.get(family(label) or "", UNKNOWN_OPENNESS)


def to_postfix(tokens: Iterable[Token]) -> list[Token]:
    """Shunting yard: the longest leading part of ``tokens`` that is an expression, in postfix order."""
    out, stack, want = [], [], True  # want: a licence (or an opening parenthesis) must come next
    for kind, text in tokens:
        if kind == "licence":
            if not want:
                break
            out.append((kind, text))
            want = False
        elif kind == "(":
            if not want:
                break
            stack.append(kind)
        elif kind == ")":
            if want or "(" not in stack:
                break
            while stack[-1] != "(":
                out.append((stack.pop(), ""))
            stack.pop()
        else:
            if want:
                break
            while stack and stack[-1] != "(" and PRECEDENCE[stack[-1]] >= PRECEDENCE[kind]:
                out.append((stack.pop(), ""))
            stack.append(kind)
            want = True
    while want and stack:  # operators and parentheses that nothing follows
        want = stack.pop() == "("
    out.extend((s, "") for s in reversed(stack) if s != "(")
    return out


def evaluate(postfix: list[Token]) -> tuple[list[str], float] | None:
    """Licences named (with their exceptions) and the openness of the whole; None for no expression."""
    stack: list[tuple[list[str], float]] = []
    for kind, text in postfix:
        if kind == "licence":
            stack.append(([text], openness(text)))
            continue
        (right, r), (left, value) = stack.pop(), stack.pop()
        if kind == "with":
            stack.append(([f"{left[-1]} with {right[0]}"] if len(left) == 1 else left + right, value + (1 - value) / 2))
        else:
            left.extend(right)
            stack.append((left, max(value, r) if kind == "or" else min(value, r)))
    return stack[0] if stack else None


class Scanner:
    """The automaton and the scan of one text."""

    def __init__(self):
        import ahocorasick

        self.tree = ahocorasick.Automaton()
        for phrase in {**{n: 0 for n in NAMES if n not in ONLY_IN_EXPRESSIONS}, **LEADS}:
            self.tree.add_word(f" {phrase} ", phrase)
        self.tree.make_automaton()

    def scan(self, text: bytes) -> tuple[int, list[tuple[int, str]], list[dict]]:
        """Word count, ``(start word, phrase)`` of every name, and the statements with their openness."""
        parts = text.translate(NORMAL).split()
        joined = (b" " + b" ".join(parts) + b" ").decode("latin-1")
        places, leads, seen, at = [], [], 0, 0
        for end, phrase in self.tree.iter(joined):
            seen += joined.count(" ", at, end)
            at = end
            (leads if phrase in LEADS else places).append((seen - len(phrase.split()), phrase))
        return len(parts), places, self.statements(text, leads) if leads else []

    @staticmethod
    def statements(text: bytes, leads: list[tuple[int, str]]) -> list[dict]:
        raw = np.frombuffer(text, np.uint8)
        _, ends = W.word_bounds(W.LOWER[raw], np.zeros(1, np.int64), W.ALNUM)
        lines = np.append(np.flatnonzero(raw == 0x0A), len(raw))
        out = []
        for start, phrase in leads:
            at = int(ends[start + len(phrase.split()) - 1])
            lex = identifier_tokens if LEADS[phrase] == IDENTIFIER else notice_tokens
            found = evaluate(to_postfix(lex(text, at, int(lines[np.searchsorted(lines, at)]))))
            if found:
                out.append({"word": start, "licences": found[0], "openness": found[1]})
        return out


SCHEMA = (
    "n_words bigint, places array<struct<word:bigint,label:string,base:boolean>>, "
    "statements array<struct<word:bigint,licences:array<string>,openness:double>>, labels array<string>, score double"
)
_PLACE = pa.list_(pa.struct([("word", pa.int64()), ("label", pa.string()), ("base", pa.bool_())]))
_STATEMENT = pa.list_(pa.struct([("word", pa.int64()), ("licences", pa.list_(pa.string())), ("openness", pa.float64())]))


def judge(places: list[tuple[int, str]], statements: list[dict]) -> tuple[list[str], float]:
    """Sorted labels and the document's openness (0 without a licence)."""
    labels = {NAMES[p] for _, p in places}
    for s in statements:
        for name in s["licences"]:
            labels.add(name)
            labels.update(filter(None, [family(name.split(" with ")[0])]))
    named = {family(name.split(" with ")[0]) for s in statements for name in s["licences"]}
    # a name inside an expression counts by what the expression makes of it
    values = [OPENNESS[NAMES[p]] for _, p in places if NAMES[p] not in named] + [s["openness"] for s in statements]
    return sorted(labels), min(values, default=0.0)


def scan_licenses(docs: DataFrame) -> DataFrame:
    """``doc_id, n_words, places, statements, labels, score`` for every row of ``docs``."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def scan(batches):
        scanner = Scanner()
        for batch in batches:
            raw, offsets = W.buffers(batch.column(1))
            cols = [[], [], [], [], []]
            for i in range(batch.num_rows):
                n, places, statements = scanner.scan(raw[offsets[i] : offsets[i + 1]].tobytes())
                labels, score = judge(places, statements) if places or statements else ([], 0.0)
                shown = [{"word": w, "label": NAMES[p], "base": p in BASE_PHRASES} for w, p in places]
                for c, v in zip(cols, (n, shown, statements, labels, score)):
                    c.append(v)
            types = (pa.int64(), _PLACE, _STATEMENT, pa.list_(pa.string()), pa.float64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, t) for c, t in zip(cols, types)]],
                ["doc_id", "n_words", "places", "statements", "labels", "score"],
            )

    return arrow_map(docs.select("doc_id", "text"), scan, f"doc_id {id_type}, {SCHEMA}")
