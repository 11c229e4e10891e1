"""Ranked lexical search: MaxScore with bounds on pairs of terms, exact top ``k`` per query.

The corpus is indexed in blocks of documents (at most ``BLOCK_DOCS`` or
``BLOCK_POSTINGS``), so a term of any frequency is spread over as many blocks as
its documents fill and no posting list is ever gathered in one place.

1. ``postings``: one pass over the texts; a block keeps, for the terms that some
   query asks for, the documents and counts, and the length of every document.
2. ``corpus_counts``: N, L and the document frequencies, summed over blocks.
3. ``build_index``: every posting becomes its exact impact; each term gets its
   maximum in the block, and each pair of terms that a query ranks side by side
   gets its intersection list with the joint maximum of the two impacts.
4. ``search``: a query's pairs and single terms of a block are its units.  The
   bound of a pair is the greatest of its joint maximum and the two single
   maxima, which is less than their sum wherever the two never peak together.
   Units whose bounds together stay below the current ``k``-th score are left
   out of the candidate search; candidates from the others are completed unit by
   unit, the largest bound first, and dropped as soon as their score and the
   bounds left cannot reach that score.  The intersection list sharpens this
   for each candidate: outside it, only the greater single maximum counts.
   The ``k``-th score is carried from block to block of a task, and the best of
   every task are ranked by a window.

A document below the ``k``-th score is skipped, one that equals it never is, so
the result is that of scoring everything; scores are 64-bit integers.

Defined results: null and empty texts have no terms and are never found; a null
item id is an id like any other; item rows equal in id and text count once, and
texts that share an id are searched one by one, each with its own ranks; items
without terms give no rows; document rows with equal ids are documents of their
own; equal scores rank by ascending ``doc_id``, null ids last; texts of any length
are read whole; other columns are neither read nor changed.  Queries are taken
in groups whose terms fit ``max_terms``, each group with an index of its own, so
any number of queries is answered whole.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from movrec.llm import words as W
from movrec.llm.common import arrow_map, written
from movrec.llm.decontaminate import NORMAL

TOP = 10
BLOCK_DOCS, BLOCK_POSTINGS = 8_192, 500_000
MAX_TERMS = 200_000

POSTINGS = "docs array<{id}>, n array<bigint>, term array<int>, df array<int>, doc array<int>, tf array<bigint>"
INDEX = (
    "docs array<{id}>, term array<int>, df array<int>, doc array<int>, impact array<bigint>, best array<bigint>, "
    "pair array<int>, pair_df array<int>, pair_doc array<int>, pair_best array<bigint>"
)


def terms_of(text: bytes) -> list[bytes]:
    """Maximal runs of digits, letters and bytes beyond ASCII, A-Z lower-cased."""
    return text.translate(NORMAL).split()


class Queries:
    """A group of queries: their terms by number, and the pairs of terms that stand side by side by weight."""

    def __init__(self, items: list[tuple[int, bytes]]):
        self.numbers: dict[bytes, int] = {}
        self.terms = {q: sorted({self.numbers.setdefault(t, len(self.numbers)) for t in terms_of(text)}) for q, text in items}
        self.pairs: dict[tuple[int, int], int] = {}
        self.units: dict[int, list[int]] = {}

    def weigh(self, n: int, df: np.ndarray) -> np.ndarray:
        """Weights of all terms; each query's terms are paired in falling order of weight."""
        weight = np.floor(1000 * np.log((2 * n + 2) / (2 * df.astype(np.float64) + 1))).astype(np.int64)
        for q, terms in self.terms.items():
            ranked = sorted(terms, key=lambda t: (-weight[t], t))
            self.units[q] = [self.pairs.setdefault((a, b), len(self.pairs)) for a, b in zip(ranked[::2], ranked[1::2])]
        return weight


def query_groups(items: DataFrame, max_terms: int = MAX_TERMS) -> Iterator[tuple[list, list[tuple[int, bytes]]]]:
    """``(item ids, [(number, text)])`` in groups of at most ``max_terms`` words (or one item); streamed to the driver."""
    ids, group, size = [], [], 0
    for row in items.select("item_id", F.coalesce("text", F.lit("")).alias("text")).distinct().toLocalIterator():
        text = row["text"].encode()
        n = len(terms_of(text))
        if group and size + n > max_terms:
            yield ids, group
            ids, group, size = [], [], 0
        group.append((len(ids), text))
        ids.append(row["item_id"])
        size += n
    if group:
        yield ids, group


# --- index ---------------------------------------------------------------------------
def _lists(values: list, kind: pa.DataType) -> pa.Array:
    """A column with one list."""
    flat = values if isinstance(values, pa.Array) else pa.array(values, kind)
    return pa.ListArray.from_arrays(pa.array([0, len(flat)], pa.int32()), flat)


def postings(docs: DataFrame, numbers: dict[bytes, int], block_docs: int = BLOCK_DOCS, block_postings: int = BLOCK_POSTINGS) -> DataFrame:
    """Blocks of the corpus: documents with a term, their lengths, and the postings of the numbered terms by term."""
    shared = docs.sparkSession.sparkContext.broadcast(numbers)
    field = docs.schema["doc_id"].dataType.simpleString()

    def scan(batches):
        known = shared.value
        names = known.keys()
        block = _Block()
        for batch in batches:
            raw, offsets = W.buffers(batch.column(1))
            kind = batch.schema.field(0).type
            for i in range(batch.num_rows):
                parts = terms_of(raw[offsets[i] : offsets[i + 1]].tobytes())
                if not parts:
                    continue
                counts = Counter(parts)
                block.add(batch.column(0)[i].as_py(), len(parts), [(known[t], counts[t]) for t in counts.keys() & names])
                if len(block.docs) >= block_docs or len(block.term) >= block_postings:
                    yield block.pack(kind)
                    block = _Block()
        if block.docs:
            yield block.pack(kind)

    return arrow_map(docs.select("doc_id", "text"), scan, POSTINGS.format(id=field))


class _Block:
    def __init__(self):
        self.docs, self.n, self.term, self.doc, self.tf = [], [], [], [], []

    def add(self, doc, n: int, found: list[tuple[int, int]]) -> None:
        at = len(self.docs)
        self.docs.append(doc)
        self.n.append(n)
        for term, tf in found:
            self.term.append(term)
            self.doc.append(at)
            self.tf.append(tf)

    def pack(self, kind: pa.DataType) -> pa.RecordBatch:
        term, doc = np.array(self.term, np.int32), np.array(self.doc, np.int32)
        order = np.lexsort((doc, term))
        names, df = np.unique(term, return_counts=True)
        columns = {
            "docs": _lists(self.docs, kind), "n": _lists(self.n, pa.int64()),
            "term": _lists(names, pa.int32()), "df": _lists(df.astype(np.int32), pa.int32()),
            "doc": _lists(doc[order], pa.int32()), "tf": _lists(np.array(self.tf, np.int64)[order], pa.int64()),
        }
        return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))


def corpus_counts(blocks: DataFrame, terms: int) -> tuple[int, int, np.ndarray]:
    """N, L and the document frequency of each numbered term (at most one row a term reaches the driver)."""
    total = F.aggregate("n", F.lit(0).cast("bigint"), lambda a, x: a + x)
    n, length = blocks.agg(F.sum(F.size("docs")), F.sum(total)).first()
    df = np.zeros(terms, np.int64)
    each = blocks.select(F.explode(F.arrays_zip("term", "df")).alias("t")).groupBy("t.term").agg(F.sum("t.df").alias("df"))
    for term, count in each.toLocalIterator():
        df[term] = count
    return n or 0, length or 0, df


def _column(batch: pa.RecordBatch, name: str, row: int) -> np.ndarray:
    return batch.column(name)[row].values.to_numpy(zero_copy_only=False)


def impacts(weight: np.ndarray, tf: np.ndarray, n: np.ndarray, docs: int, length: int) -> np.ndarray:
    """The exact contributions of postings: weight, count and document length of each."""
    m = 100 - 90 + (90 * n * docs) // length
    return weight * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))


def build_index(blocks: DataFrame, queries: Queries, docs: int, length: int, weight: np.ndarray) -> DataFrame:
    """Blocks with impacts, each term's maximum, and the pairs' intersection lists with their joint maxima."""
    pairs = np.array(list(queries.pairs), np.int64).reshape(-1, 2)
    shared = blocks.sparkSession.sparkContext.broadcast((pairs, weight))
    field = blocks.schema["docs"].dataType.elementType.simpleString()

    def enrich(batches):
        pairs, weight = shared.value
        for batch in batches:
            for row in range(batch.num_rows):
                term, df, doc = (_column(batch, c, row) for c in ("term", "df", "doc"))
                ends = np.cumsum(df.astype(np.int64))
                owner = np.repeat(term, df)
                value = impacts(weight[owner], _column(batch, "tf", row), _column(batch, "n", row)[doc], docs, length)
                best = np.maximum.reduceat(value, ends - df) if len(term) else np.zeros(0, np.int64)
                here = np.full(len(weight), -1, np.int64)
                here[term] = np.arange(len(term))
                found, sizes, lists, tops = [], [], [], []
                for p in np.flatnonzero((here[pairs] >= 0).all(axis=1)).tolist() if len(pairs) else ():
                    a, b = here[pairs[p]].tolist()
                    sa, sb = slice(ends[a] - df[a], ends[a]), slice(ends[b] - df[b], ends[b])
                    both, i, j = np.intersect1d(doc[sa], doc[sb], assume_unique=True, return_indices=True)
                    found.append(p)
                    sizes.append(len(both))
                    lists.append(both)
                    tops.append(int((value[sa][i] + value[sb][j]).max()) if len(both) else 0)
                columns = {
                    "docs": _lists(batch.column("docs")[row].values, None), "term": _lists(term, pa.int32()), "df": _lists(df, pa.int32()),
                    "doc": _lists(doc, pa.int32()), "impact": _lists(value, pa.int64()), "best": _lists(best, pa.int64()),
                    "pair": _lists(found, pa.int32()), "pair_df": _lists(sizes, pa.int32()),
                    "pair_doc": _lists(np.concatenate(lists) if lists else [], pa.int32()), "pair_best": _lists(tops, pa.int64()),
                }
                yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return arrow_map(blocks, enrich, INDEX.format(id=field))


# --- search --------------------------------------------------------------------------
class Block:
    """One index block, opened for searching."""

    def __init__(self, batch: pa.RecordBatch, row: int, terms: int):
        self.docs = batch.column("docs")[row].values
        term, df, self.doc, self.impact, self.best = (_column(batch, c, row) for c in ("term", "df", "doc", "impact", "best"))
        self.end = np.cumsum(df.astype(np.int64))
        self.begin = self.end - df
        self.here = np.full(terms, -1, np.int64)
        self.here[term] = np.arange(len(term))
        pair, size, self.pair_doc, top = (_column(batch, c, row) for c in ("pair", "pair_df", "pair_doc", "pair_best"))
        ends = np.cumsum(size.astype(np.int64))
        self.pair = {p: (int(e - s), int(e), int(t)) for p, e, s, t in zip(pair.tolist(), ends, size, top)}

    def list(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        at = self.here[term]
        part = slice(self.begin[at], self.end[at])
        return self.doc[part], self.impact[part]

    def units(self, terms: list[int], pairs: list[tuple[int, int, int]]) -> list[tuple[int, list[int], tuple | None]]:
        """``(bound, terms, pair entry)`` of the query's parts that occur in the block."""
        out, done = [], set()
        for p, a, b in pairs:
            if p in self.pair:
                single = max(int(self.best[self.here[a]]), int(self.best[self.here[b]]))
                out.append((max(self.pair[p][2], single), [a, b], (*self.pair[p], single)))
                done |= {a, b}
        out.extend((int(self.best[self.here[t]]), [t], None) for t in terms if t not in done and self.here[t] >= 0)
        return sorted(out, key=lambda u: u[0])

    def best_documents(self, units: list, top: int, floor: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents that reach ``floor`` (and some that do not) with their exact scores; all of the block's best ``top`` that do."""
        bounds = np.cumsum([u[0] for u in units])
        essential = int(np.searchsorted(bounds, floor))  # the first units together stay below the floor
        score = np.zeros(len(self.docs), np.int64)
        for _, terms, _ in units[essential:]:
            for t in terms:
                docs, impact = self.list(t)
                score[docs] += impact
        live = np.flatnonzero(score)
        for u in range(essential - 1, -1, -1):
            if len(live) > top:
                floor = max(floor, int(np.partition(score[live], -top)[-top]))
            _, terms, pair = units[u]
            rest = int(bounds[u - 1]) if u else 0
            if pair is None:
                live = live[score[live] + int(bounds[u]) >= floor]
            else:  # the joint maximum holds inside the intersection, the greater single one outside
                begin, end, joint, single = pair
                both = _holds(self.pair_doc[begin:end], live)
                live = live[score[live] + np.where(both, joint, single) + rest >= floor]
            for t in terms:
                docs, impact = self.list(t)
                at = np.minimum(np.searchsorted(docs, live), len(docs) - 1)
                score[live] += np.where(docs[at] == live, impact[at], 0)
        return live, score[live]


def _holds(sorted_docs: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    if not len(sorted_docs):
        return np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(sorted_docs, wanted), len(sorted_docs) - 1)
    return sorted_docs[at] == wanted


class Ranking:
    """The best documents of one query so far: score falling, then id rising (null last)."""

    def __init__(self, top: int):
        self.top = top
        self.rows: list[tuple[int, bool, object]] = []

    @property
    def floor(self) -> int:
        """The least score that can still enter."""
        return max(1, -self.rows[-1][0]) if len(self.rows) == self.top else 1

    def add(self, docs: pa.Array, at: np.ndarray, score: np.ndarray) -> None:
        ok = score >= self.floor
        at, score = at[ok], score[ok]
        if len(at) > self.top:  # ties at the border stay
            ok = score >= np.partition(score, -self.top)[-self.top]
            at, score = at[ok], score[ok]
        ids = docs.take(pa.array(at)).to_pylist()
        rows = [(-s, d is None, 0 if d is None else d) for s, d in zip(score.tolist(), ids)]
        self.rows = sorted(self.rows + rows)[: self.top]


def search(index: DataFrame, queries: Queries, top: int = TOP) -> DataFrame:
    """``query, doc_id, score``: every task's ``top`` best documents of each query."""
    by_number = {p: (p, a, b) for (a, b), p in queries.pairs.items()}
    plan = {q: (terms, [by_number[p] for p in queries.units[q]]) for q, terms in queries.terms.items()}
    shared = index.sparkSession.sparkContext.broadcast((plan, len(queries.numbers)))
    field = index.schema["docs"].dataType.elementType

    def scan(batches):
        plan, terms = shared.value
        best = {q: Ranking(top) for q in plan}
        kind = pa.null()
        for batch in batches:
            kind = batch.schema.field("docs").type.value_type
            for row in range(batch.num_rows):
                block = Block(batch, row, terms)
                for q, (wanted, pairs) in plan.items():
                    units = block.units(wanted, pairs)
                    if units:
                        best[q].add(block.docs, *block.best_documents(units, top, best[q].floor))
        rows = [(q, None if null else d, -s) for q, r in best.items() for s, null, d in r.rows]
        if rows:
            q, d, s = zip(*rows)
            yield pa.RecordBatch.from_arrays([pa.array(q, pa.int32()), pa.array(d, kind), pa.array(s, pa.int64())], ["query", "doc_id", "score"])

    return arrow_map(index, scan, f"query int, doc_id {field.simpleString()}, score bigint")


def rank_documents(docs: DataFrame, items: DataFrame, top: int = TOP, max_terms: int = MAX_TERMS, **block) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``top`` best documents of every item."""
    spark = docs.sparkSession
    out = None
    id_type = items.schema["item_id"].dataType
    for ids, group in query_groups(items, max_terms):
        queries = Queries(group)
        blocks = written(postings(docs, queries.numbers, **block))
        n, length, df = corpus_counts(blocks, len(queries.numbers))
        index = written(build_index(blocks, queries, n, length, queries.weigh(n, df)))
        found = search(index, queries, top)
        order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
        names = spark.createDataFrame(list(enumerate(ids)), f"query int, item_id {id_type.simpleString()}")
        part = ranked.join(F.broadcast(names), "query").select("item_id", "rank", "doc_id", "score")
        out = part if out is None else out.unionByName(part)
    if out is None:
        return spark.createDataFrame([], f"item_id {id_type.simpleString()}, rank int, doc_id {docs.schema['doc_id'].dataType.simpleString()}, score bigint")
    return out
