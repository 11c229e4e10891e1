"""Benchmark decontamination: one Aho-Corasick automaton over benchmark word windows.

Texts and items are normalised alike: A-Z lower-cased, then words
``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``.  Every window of ``window`` consecutive
item words is one key of the automaton (an item with fewer words, but not
none, is one key as a whole).  A key is a sequence of word numbers, so a match
starts and ends at word borders, and each document is scanned once.  The
normalisation maps byte to byte; match offsets therefore point into the
original text, and are given as code points.

A benchmark whose automaton would be too large (``max_chars`` characters of words
for each) is cut in pieces that share ``window - 1`` words, and the documents are
scanned by one automaton after the other; the hits of a row are united.

Defined results: a null or empty text has no words and no hits; a null item id
counts as one item, written as an empty string; items without words are
ignored; very long texts are scanned whole, in time that grows with their length;
equal rows are judged one by one; other columns of the inputs are neither read nor
changed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from movrec.llm import words as W
from movrec.llm.common import arrow_map, settle, written

WINDOW = 10
#: characters of benchmark words in one automaton; two millions take some 280 MB in a worker
MAX_AUTOMATON_CHARS = 2_000_000
#: windows that start in one piece of an item
PIECE_WINDOWS = 4096

#: byte to byte: A-Z to a-z, every separator to a space
NORMAL = bytes(int(W.LOWER[b]) if W.ALNUM[W.LOWER[b]] else 0x20 for b in range(256))

SCHEMA = (
    "n_words bigint, n_hit bigint, items array<string>, "
    "spans array<struct<start:bigint,end:bigint>>"
)
_SPAN = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


class Automaton:
    """The keys of all items, and the scan of one document."""

    def __init__(self, items: list[tuple[str, str]], window: int = WINDOW):
        import ahocorasick

        self.numbers: dict[bytes, int] = {}
        owners: dict[tuple[int, ...], set[str]] = {}
        for item, text in items:
            seq = [self.numbers.setdefault(w, len(self.numbers) + 1) for w in (text or "").encode().translate(NORMAL).split()]
            keys = [seq] if 0 < len(seq) < window else [seq[i : i + window] for i in range(len(seq) - window + 1)]
            for key in keys:
                owners.setdefault(tuple(key), set()).add(item)
        self.lengths = [len(k) for k in owners]
        self.items = [sorted(v) for v in owners.values()]
        self.tree = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
        for n, key in enumerate(owners):
            self.tree.add_word(key, n)
        self.tree.make_automaton()

    def scan(self, text: bytes) -> tuple[int, list[int], list[tuple[int, int]]]:
        """Word count, keys found, and their word ranges."""
        number = self.numbers.get
        seq = tuple([number(w, 0) for w in text.translate(NORMAL).split()])
        if not self.lengths or not seq:
            return len(seq), [], []
        keys, ranges = [], []
        for end, key in self.tree.iter(seq):
            keys.append(key)
            ranges.append((end + 1 - self.lengths[key], end + 1))
        return len(seq), keys, ranges


def original_spans(raw: np.ndarray, hit: np.ndarray) -> list[dict]:
    """Code-point ranges in the original text of the maximal runs of hit words."""
    low = W.LOWER[raw]
    starts, ends = W.word_bounds(low, np.zeros(1, np.int64), W.ALNUM)
    points = np.concatenate(([0], np.cumsum((raw & 0xC0) != 0x80)))
    edge = np.diff(np.concatenate(([0], hit.astype(np.int8), [0])))
    return [
        {"start": int(points[starts[i]]), "end": int(points[ends[j - 1]])}
        for i, j in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1))
    ]


_BUILT: list = []


def _automaton(shared, window: int) -> Automaton:
    """One automaton for each worker process and broadcast value."""
    items = shared.value
    if not (_BUILT and _BUILT[0] is items and _BUILT[1] == window):
        _BUILT[:] = [items, window, Automaton(items, window)]
    return _BUILT[2]


def benchmark_pieces(benchmark: DataFrame, window: int) -> DataFrame:
    """``item, words``: every item's words, long items in pieces that hold each window once."""

    def cut(batches):
        for batch in batches:
            items, pieces = [], []
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = (text or "").encode().translate(NORMAL).split()
                for at in range(0, max(len(words) - window + 1, min(len(words), 1)), PIECE_WINDOWS):
                    items.append(item)
                    pieces.append(b" ".join(words[at : at + PIECE_WINDOWS + window - 1]).decode())
            yield pa.RecordBatch.from_arrays([pa.array(items, pa.string()), pa.array(pieces, pa.string())], ["item", "words"])

    named = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), "text")
    return arrow_map(named, cut, "item string, words string").distinct()


def benchmark_parts(benchmark: DataFrame, window: int = WINDOW, max_chars: int = MAX_AUTOMATON_CHARS) -> Iterator[tuple[list[tuple[str, str]], bool]]:
    """The pieces of one automaton after the other, and whether they are the last."""
    pieces = settle(benchmark_pieces(benchmark, window))
    size = pieces.agg(F.sum(F.length("words") + 16)).first()[0] or 0
    parts = max(1, -(-size // max_chars))
    for part in range(parts):
        own = pieces.filter(F.pmod(F.xxhash64("item", "words"), F.lit(parts)) == part) if parts > 1 else pieces
        yield [(r[0], r[1]) for r in own.collect()], part == parts - 1  # about max_chars characters


def _hit_words(n: int, ranges: list[tuple[int, int]]) -> np.ndarray:
    delta = np.zeros(n + 1, np.int64)
    at = np.array(ranges, np.int64).reshape(-1, 2)
    np.add.at(delta, at[:, 0], 1)
    np.add.at(delta, at[:, 1], -1)
    return np.cumsum(delta)[:n] > 0


def _scan(rows: DataFrame, items: list[tuple[str, str]], window: int, last: bool) -> DataFrame:
    """``rows`` (doc_id, text, items, ranges) with the hits of one automaton added, or the results if it is the last."""
    shared = rows.sparkSession.sparkContext.broadcast(items)
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def scan(batches):
        automaton = _automaton(shared, window)
        for batch in batches:
            raw, offsets = W.buffers(batch.column(1))
            counts, hits, found, spans, united = [], [], [], [], []
            earlier = zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())
            for i, (known, covered) in enumerate(earlier):
                one = raw[offsets[i] : offsets[i + 1]]
                n, keys, ranges = automaton.scan(one.tobytes())
                ranges += zip(covered[::2], covered[1::2])
                hit = _hit_words(n, ranges) if ranges else None
                found.append(sorted({x for k in set(keys) for x in automaton.items[k]}.union(known)))
                if last:
                    counts.append(n)
                    hits.append(int(hit.sum()) if ranges else 0)
                    spans.append(original_spans(one, hit) if ranges else [])
                else:
                    united.append(np.flatnonzero(np.diff(np.concatenate(([0], hit.astype(np.int8), [0])))).tolist() if ranges else [])
            names = pa.array(found, pa.list_(pa.string()))
            if last:
                cols = [batch.column(0), pa.array(counts, pa.int64()), pa.array(hits, pa.int64()), names, pa.array(spans, _SPAN)]
                yield pa.RecordBatch.from_arrays(cols, ["doc_id", "n_words", "n_hit", "items", "spans"])
            else:
                cols = [batch.column(0), batch.column(1), names, pa.array(united, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(cols, ["doc_id", "text", "items", "ranges"])

    return arrow_map(rows, scan, f"doc_id {id_type}, {SCHEMA if last else 'text string, items array<string>, ranges array<bigint>'}")


def find_contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, max_chars: int = MAX_AUTOMATON_CHARS) -> DataFrame:
    """``doc_id, n_words, n_hit, items, spans`` for every row of ``docs``."""
    rows = docs.select("doc_id", "text", F.array().cast("array<string>").alias("items"), F.array().cast("array<bigint>").alias("ranges"))
    for items, last in benchmark_parts(benchmark, window, max_chars):
        rows = _scan(rows, items, window, last)
        if not last:  # a worker holds one automaton at a time
            rows = written(rows)
    return rows


def clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, max_chars: int = MAX_AUTOMATON_CHARS) -> DataFrame:
    """The rows of ``docs`` without any benchmark window, columns unchanged."""
    for items, last in benchmark_parts(benchmark, window, max_chars):
        docs = _without(docs, items, window)
        if not last:
            docs = written(docs)
    return docs


def _without(docs: DataFrame, items: list[tuple[str, str]], window: int) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(items)
    at = docs.columns.index("text")

    def keep(batches):
        automaton = _automaton(shared, window)
        for batch in batches:
            raw, offsets = W.buffers(batch.column(at))
            free = [not automaton.scan(raw[offsets[i] : offsets[i + 1]].tobytes())[1] for i in range(batch.num_rows)]
            yield batch.filter(pa.array(free, pa.bool_()))

    return arrow_map(docs, keep, docs.schema)
