"""Substring dedup by seed and extend.

A *window* is ``length`` consecutive words of one document.  Its seed is the
least hash among its ``seed``-word grams (winnowing), so equal windows have
equal seeds wherever they stand, and only about one word in seven is an anchor.

1. Seeds.  Each run of windows with the same anchor gives one row: the anchor's
   hash, the hash of the words from the run's first to its last window (its
   *reach*: as far as the seed extends both ways), document and position.
   Rows are joined on the anchor: a range of equal anchors is read as a stream.
2. Extension.  Occurrences with the same anchor and reach are equal in both
   directions; all but the first are repeats with every window in them.
   Copies inside one task are settled before the shuffle, so a passage shared by
   a third of all documents sends a few rows per task, and no pairs are made.
   An anchor that has more than ``crowded`` reaches inside one task (a common
   phrase) needs no grouping to know that it has several: its occurrences go
   straight to the comparison of windows, and one witness per task stands for
   them among the rows of the anchor.
   First occurrences whose anchor has other reaches extend only part of the
   way: their windows are compared one by one by their own hashes, the least
   (document, position) first.
3. Repeats.  Overlapping and adjacent repeated windows merge to maximal repeats
   of at least ``length`` words per document; they are what is removed.

Texts cross the shuffle compressed.  Hash equality is on 128 bits (two
independent polynomials; anchor and reach, or anchor and window).

Defined results: order is by ``doc_id`` (null last), then start.  Rows with equal
id and text count as one document and get equal results; rows with equal ids
and different texts are ordered by a key of their text.  Null and empty texts
have no words, very long ones are read whole.  Other columns are not read.  Texts that share
an id (all null ids are one) are numbered by their 128-bit digest, at most 2**31
of them; an id of a single row needs no number.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from movrec.llm import words as W
from movrec.llm.common import arrow_map, running_before, settle, written

LENGTH, SEED_WORDS = 20, 8
#: anchors that a task holds before it settles copies and passes them on
HELD = 1 << 20
#: reaches of one anchor in one task from which it counts as crowded
CROWDED = 64

_LAST_ID = (1 << 63) - 1


class _Hashes:
    """Running sums of one run of texts."""

    def __init__(self):
        self.word, self.gram, self.reach = W.Sums(11), W.Sums(12), W.Sums(13)


def anchors(h: _Hashes, data: np.ndarray, offsets: np.ndarray, length: int, seed: int):
    """Per run of windows with one anchor: text, anchor hash, reach hash, first window, windows.

    Then the running sums of grams and reaches, and the borders of the texts.
    """
    n = len(offsets) - 1
    starts, ends = W.word_bounds(data, offsets[:-1], W.SPACED)
    owner = W.owners(offsets, starts)
    border = W.per_text(owner, n)
    word = h.word.slices(h.word.over(h.word.bytes[data]), starts, ends)
    reach = h.reach.over(word)
    grams = h.gram.over(word)
    empty, none = np.zeros(0, np.int64), np.zeros(0, np.uint64)
    if len(word) < length:
        return empty, none, none, empty, empty, grams, reach, border
    at = np.arange(len(word) - seed + 1)
    gram = h.gram.slices(grams, at, at + seed)
    first = np.arange(len(word) - length + 1)
    anchor = first + np.lib.stride_tricks.sliding_window_view(gram, length - seed + 1).argmin(axis=1)
    ok = np.flatnonzero(owner[first] == owner[first + length - 1])
    if not len(ok):
        return empty, none, none, empty, empty, grams, reach, border
    anchor, own = anchor[ok], owner[ok]
    new = np.concatenate(([True], (np.diff(anchor) != 0) | (np.diff(own) != 0)))
    lo = np.flatnonzero(new)
    windows = np.diff(np.concatenate((lo, [len(ok)])))
    begin = ok[lo]
    left = (anchor[lo] - begin).astype(np.uint64)
    reaching = h.reach.slices(reach, begin, begin + windows + length - 1) + left
    return own[lo], gram[anchor[lo]], reaching, begin, windows, grams, reach, border


def _pack(tag: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Text tag (31 bits) and word position (32 bits) in one number that orders by both."""
    return (tag << 32) | start


_ROW = ["ah", "rh", "id", "loc", "windows"]
_ROWS = "ah bigint, rh bigint, id bigint, loc bigint, windows int, state int"
#: states of rows: to be grouped by anchor, known to be a repeat, known to need comparison
_OPEN, _SETTLED, _CROWDED = 0, 1, 2
#: kinds of findings: a reach that stands earlier, and a first reach whose windows must be compared
_REPEAT, _COMPARE = 0, 1


def _settle_copies(parts: list) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Of equal (anchor, reach), the least occurrence goes on; the others are repeats."""
    ah, rh, doc, loc, windows = (np.concatenate(x) for x in zip(*parts))
    order = np.lexsort((loc, doc, rh, ah))
    ah, rh, doc, loc, windows = (x[order] for x in (ah, rh, doc, loc, windows))
    head = np.concatenate(([True], (np.diff(ah) != 0) | (np.diff(rh) != 0)))
    # equal id and place: a repeated row, no repeat of its own
    first = np.flatnonzero(head)[np.cumsum(head) - 1]
    again = ~head & ((doc != doc[first]) | (loc != loc[first]))
    cols = (ah, rh, doc, loc, windows)
    return [x[head] for x in cols], [x[again] for x in cols]


def _flushed(rows, crowded: int | None = None):
    """Hold (anchor, reach, id, place, windows) arrays up to ``HELD`` rows, settle copies, emit every state."""
    held, size = [], 0
    for part in rows:
        if not len(part[0]):
            continue
        held.append(part)
        size += len(part[0])
        if size >= HELD:
            yield from _emit(held, crowded)
            held, size = [], 0
    if held:
        yield from _emit(held, crowded)


def _emit(held, crowded: int | None):
    heads, again = _settle_copies(held)
    out = [(heads, _OPEN), (again, _SETTLED)]
    if crowded is not None:
        new = np.concatenate(([True], np.diff(heads[0]) != 0))
        group = np.cumsum(new) - 1
        many = np.bincount(group)[group] > crowded
        if many.any():
            # a witness: least of all reaches, no windows
            witness = [x[many & new] for x in heads]
            witness[1] = np.full(len(witness[0]), np.iinfo(np.int64).min)
            witness[4] = np.zeros(len(witness[0]), np.int32)
            out = [([x[~many] for x in heads], _OPEN), (witness, _OPEN), ([x[many] for x in heads], _CROWDED), (again, _SETTLED)]
    for rows, state in out:
        for at in range(0, len(rows[0]), 65536):
            part = [x[at : at + 65536] for x in rows]
            yield pa.RecordBatch.from_arrays([*map(pa.array, part), pa.array(np.full(len(part[0]), state, np.int32))], [*_ROW, "state"])


def _seeds(length: int, seed: int, crowded: int = CROWDED):
    def rows(batches):
        h = _Hashes()
        for batch in batches:
            raw, offsets = W.buffers(batch.column(0))
            doc, tag = (batch.column(c).to_numpy(zero_copy_only=False) for c in (1, 2))
            for i, j in W.runs(offsets):
                own, ah, rh, begin, windows, _, _, border = anchors(h, raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], length, seed)
                yield ah.view(np.int64), rh.view(np.int64), doc[i + own], _pack(tag[i + own], begin - border[own]), windows.astype(np.int32)

    return lambda batches: _flushed(rows(batches), crowded)


def _windows(length: int, seed: int):
    """Rows of single windows, for the listed runs of each document."""

    def rows(batches):
        h, unpack = _Hashes(), zstandard.ZstdDecompressor()
        for batch in batches:
            doc, tag = (batch.column(c).to_numpy(zero_copy_only=False) for c in (1, 2))
            for i in range(batch.num_rows):
                data = np.frombuffer(unpack.decompress(batch.column(0)[i].as_py()), np.uint8)
                _, _, _, _, _, grams, reach, _ = anchors(h, data, np.array([0, len(data)]), length, seed)
                runs = batch.column(3).slice(i, 1).flatten()
                begin, count = (runs.field(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in (0, 1))
                at = np.repeat(begin - np.concatenate(([0], np.cumsum(count)[:-1])), count) + np.arange(count.sum())
                one = np.ones(len(at), np.int32)
                yield (
                    h.reach.slices(reach, at, at + length).view(np.int64), h.gram.slices(grams, at, at + length).view(np.int64),
                    np.full(len(at), doc[i]), _pack(np.full(len(at), tag[i]), at), one,
                )

    return lambda batches: _flushed(rows(batches))


def _classify(compare: bool):
    """One pass over rows sorted by (state, anchor, reach, id, place), with one row carried over.

    Every row but the first of its (anchor, reach) is a repeat.  With
    ``compare``, first rows of anchors that have more than one reach come out
    as well; a first row is held back until a second reach shows up.
    """

    def run(batches):
        carry = None
        for batch in batches:
            cols = [batch.column(c).to_numpy(zero_copy_only=False) for c in range(6)]
            for state, kind in ((_SETTLED, _REPEAT), (_CROWDED, _COMPARE)):
                known = cols[5] == state
                if known.any():
                    yield _found(kind, cols[2][known], cols[3][known], cols[4][known])
            cols = [c[cols[5] == _OPEN] for c in cols]
            if not len(cols[0]):
                continue
            sent = False
            if carry is not None:
                sent = carry[1]
                cols = [np.concatenate(([x], c)) for x, c in zip(carry[0], cols)]
            ah, rh, doc, loc, windows = cols[:5]
            anchor = np.concatenate(([True], np.diff(ah) != 0))
            head = anchor.copy()
            head[1:] |= np.diff(rh) != 0
            heads = np.flatnonzero(head)
            first = heads[np.cumsum(head) - 1]
            again = ~head & ((doc != doc[first]) | (loc != loc[first])) & (windows > 0)
            if again.any():
                yield _found(_REPEAT, doc[again], loc[again], windows[again])
            group = np.cumsum(anchor)[heads] - 1
            several = np.bincount(group)[group] > 1
            if sent:
                several |= group == 0
            if compare:
                out = heads[several]
                if sent:
                    out = out[out != 0]
                out = out[windows[out] > 0]  # a witness is only counted
                if len(out):
                    yield _found(_COMPARE, doc[out], loc[out], windows[out])
            last = heads[-1]
            carry = ([c[last] for c in cols], bool(several[-1]))

    return run


def _found(kind: int, doc, loc, windows) -> pa.RecordBatch:
    n = len(doc)
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(n, kind, np.int32)), pa.array(doc), pa.array(loc), pa.array(windows.astype(np.int32))],
        ["kind", "id", "loc", "windows"],
    )


def _dealt(rows: DataFrame) -> DataFrame:
    """Rows by anchor, in order; rows whose state is known go anywhere."""
    place = F.when(F.col("state") > _OPEN, F.xxhash64("id", "loc")).otherwise(F.col("ah"))
    return rows.repartition(place).sortWithinPartitions("state", "ah", "rh", "id", "loc")


def _by_document(found: DataFrame) -> DataFrame:
    """``id, tag, runs``: the found runs (start, windows) of each document, at most one for each of its words."""
    start = F.col("loc").bitwiseAND(F.lit((1 << 32) - 1)).cast("int")
    return (
        found.select("id", F.shiftright("loc", 32).cast("int").alias("tag"), F.struct(start.alias("start"), "windows").alias("run"))
        .groupBy("id", "tag").agg(F.collect_list("run").alias("runs"))
    )


def _pressed(texts: DataFrame) -> DataFrame:
    """Compress whole texts before they are shuffled."""

    def run(batches):
        press = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            raw, offsets = W.buffers(batch.column(0))
            packed = [press.compress(raw[offsets[i] : offsets[i + 1]].tobytes()) for i in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays([pa.array(packed, pa.binary()), *batch.columns[1:]], batch.schema.names)

    rest = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in texts.schema.fields[1:])
    return arrow_map(texts, run, f"text binary, {rest}")


def numbered_texts(docs: DataFrame) -> DataFrame:
    """``text, id, tag, doc_id``: the texts of one id have different tags, in the order of their digests.

    Only ids that stand on several rows are numbered; the numbers are running sums
    over range partitions, so an id with a third of all rows is no single task.
    """
    texts = docs.select(F.coalesce("text", F.lit("")).alias("text"), F.coalesce(F.col("doc_id").cast("bigint"), F.lit(_LAST_ID)).alias("id"), "doc_id")
    several = settle(texts.groupBy("id").count().filter("count > 1").select(F.col("id").alias("_id")))
    if several.isEmpty():
        return texts.select("text", "id", F.lit(0).alias("tag"), "doc_id")
    marked = texts.join(several, F.col("id") == F.col("_id"), "left")
    marked = written(marked.withColumn("_digest", F.when(F.col("_id").isNotNull(), F.md5("text"))).drop("_id"))
    named = marked.filter("_digest is not null").select("id", F.col("_digest").alias("_d")).distinct().withColumn("_one", F.lit(1))
    numbers = running_before(named, "id", ["_d"], "_one", "tag").select(F.col("id").alias("_id"), "_d", F.col("tag").cast("int").alias("tag"))
    joined = marked.join(numbers, (F.col("id") == F.col("_id")) & (F.col("_digest") == F.col("_d")), "left")
    return joined.select("text", "id", F.coalesce("tag", F.lit(0)).alias("tag"), "doc_id")


def repeated_runs(docs: DataFrame, length: int = LENGTH, seed: int = SEED_WORDS, crowded: int = CROWDED) -> tuple[DataFrame, DataFrame]:
    """The keyed texts, and ``id, tag, runs`` of all windows that stand earlier."""
    if not 0 < seed <= length:
        raise ValueError("the seed must be between one word and the whole length")
    texts = numbered_texts(docs)
    wide = texts.select("text", "id", F.col("tag").cast("bigint").alias("tag"))
    seeds = arrow_map(wide, _seeds(length, seed, crowded), _ROWS)
    found = written(arrow_map(_dealt(seeds), _classify(True), "kind int, id bigint, loc bigint, windows int"))
    ask = _by_document(found.filter(F.col("kind") == _COMPARE))
    asked = _pressed(wide).join(ask.withColumn("tag", F.col("tag").cast("bigint")), ["id", "tag"])
    single = arrow_map(asked.select("text", "id", "tag", "runs"), _windows(length, seed), _ROWS)
    partly = arrow_map(_dealt(single), _classify(False), "kind int, id bigint, loc bigint, windows int")
    return texts, _by_document(found.filter(F.col("kind") == _REPEAT).unionByName(partly))


def remove_repeats(docs: DataFrame, length: int = LENGTH, seed: int = SEED_WORDS, crowded: int = CROWDED) -> DataFrame:
    """``doc_id, n_words, n_removed, repeats, kept`` for every row of ``docs``.

    ``repeats`` are the maximal repeats as word ranges, ``kept`` the remaining
    words joined by one space.
    """
    texts, runs = repeated_runs(docs, length, seed, crowded)
    joined = _pressed(texts).join(runs, ["id", "tag"], "left").select("text", "doc_id", "runs")
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            out = [cut(unpack.decompress(batch.column(0)[i].as_py()), batch.column(2).slice(i, 1).flatten(), length) for i in range(batch.num_rows)]
            words, removed, repeats, kept = zip(*out)
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), pa.array(words, pa.int64()), pa.array(removed, pa.int64()), pa.array(repeats, _REPEATS), pa.array(kept, pa.string())],
                ["doc_id", "n_words", "n_removed", "repeats", "kept"],
            )

    return arrow_map(joined, run, f"doc_id {kind}, n_words bigint, n_removed bigint, repeats array<struct<start:bigint,end:bigint>>, kept string")


_REPEATS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def cut(text: bytes, runs: pa.Array, length: int) -> tuple[int, int, list, str]:
    """Merge a document's repeated windows to maximal repeats and drop their words."""
    data = np.frombuffer(text, np.uint8)
    starts, ends = W.word_bounds(data, np.zeros(1, np.int64), W.SPACED)
    n = len(starts)
    delta = np.zeros(n + 1, np.int64)
    if len(runs):
        begin, count = (runs.field(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in (0, 1))
        np.add.at(delta, begin, 1)
        np.add.at(delta, begin + count + length - 1, -1)
    gone = np.cumsum(delta)[:n] > 0
    edge = np.diff(np.concatenate(([0], gone.astype(np.int8), [0])))
    repeats = [{"start": int(a), "end": int(b)} for a, b in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1))]
    s, e = starts[~gone], ends[~gone]
    if not len(s):
        return n, int(gone.sum()), repeats, ""
    lens = e - s
    out = np.full(int(lens.sum()) + len(s) - 1, 0x20, np.uint8)
    shift = np.repeat(s - (np.cumsum(lens + 1) - (lens + 1)), lens)
    to = np.arange(int(lens.sum())) + np.repeat(np.arange(len(s)), lens)
    out[to] = data[to + shift]
    return n, int(gone.sum()), repeats, out.tobytes().decode()
