"""SimHash near-dedup with bit-sliced comparison.

1. Fingerprints.  Each whole text is lower-cased (A-Z), cut into words
   ``[^\\x20\\x09-\\x0D]+`` and ``shingle``-word shingles, repeats included; a
   fingerprint bit is 1 if it is set in over half of the shingles' XXH64
   (seed 42).  Fewer words: the whole sequence is one shingle; none: zero.
2. Candidates.  Only distinct fingerprints go on.  The 64 bits are cut into
   ``n`` pieces; two fingerprints within ``radius`` bits agree in at least ``n -
   radius`` of them (pigeonhole), so comparing those that agree in some choice
   of that many pieces loses no link.  ``n`` follows the measured number of
   fingerprints, so that a key is shared by few: radius + 1 pieces and as many
   choices up to millions of them, more and longer keys beyond; every ``n``
   finds the same links.  A key shared by more than ``block`` fingerprints is
   cut into blocks by hash and each pair of blocks is compared in its own group:
   no group is larger than two blocks, and every pair of blocks still meets.
3. Comparison.  Inside a group the fingerprints are turned into 64 vertical
   bit planes.  Differences are added plane by plane to bitwise carry-save
   counters, 64 distances in one word; rows whose lanes all exceed the radius
   are abandoned.
4. Links inside a group are reduced to a star for each local component before
   they leave the task, so a group of m near copies emits at most m edges.
5. Components by alternating stars over fingerprints.

Defined results: null and empty texts have the zero fingerprint and link like
any other; a null ``doc_id`` never becomes a component's id (a component of
null ids only has a null id); repeated rows each get a row; other columns are
not read.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from movrec.llm import words as W
from movrec.llm.common import arrow_map, keep_chosen, settle, text_key
from movrec.llm.graph import components

SHINGLE, RADIUS, SEED, BLOCK = 4, 4, 42, 4096

_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.float64)
_ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def fingerprints(data: np.ndarray, offsets: np.ndarray, shingle: int = SHINGLE, seed: int = SEED) -> np.ndarray:
    """SimHash of each text of a run, as unsigned 64-bit numbers."""
    n = len(offsets) - 1
    low = W.LOWER[data]
    starts, ends = W.word_bounds(low, offsets[:-1], W.SPACED)
    out = np.zeros(n, np.uint64)
    if not len(starts):
        return out
    lens = ends - starts
    owner = W.owners(offsets, starts)
    border = W.per_text(owner, n)
    count = np.diff(border)
    # all words of the run, each followed by one space
    kept = low[W.SPACED[low]]
    first = np.cumsum(lens + 1) - (lens + 1)
    joined = np.full(int(first[-1] + lens[-1] + 1), 0x20, np.uint8)
    joined[np.arange(len(kept)) + np.repeat(np.arange(len(lens)), lens)] = kept
    last = first + lens
    i = np.arange(max(len(starts) - shingle + 1, 0))
    i = i[owner[i] == owner[i + shingle - 1]]
    short = np.flatnonzero((count > 0) & (count < shingle))
    a = np.concatenate((first[i], first[border[short]])).tolist()
    b = np.concatenate((last[i + shingle - 1], last[border[short + 1] - 1])).tolist()
    of = np.concatenate((owner[i], short))
    view, digest = memoryview(joined.tobytes()), xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(view[x:y], seed) for x, y in zip(a, b)), np.uint64, len(a))
    total = np.bincount(of, minlength=n)
    octets = hashes.view(np.uint8).reshape(-1, 8)
    for j in range(8):
        seen = np.bincount(of * 256 + octets[:, j], minlength=n * 256).reshape(n, 256) @ _BITS
        bits = (2 * seen > total[:, None]).astype(np.uint64) << np.arange(8, dtype=np.uint64)
        out |= bits.sum(axis=1, dtype=np.uint64) << np.uint64(8 * j)
    return out


def sliced_links(fps: np.ndarray, radius: int, side: np.ndarray | None = None, rows: int = 256) -> tuple[np.ndarray, np.ndarray]:
    """Pairs ``i < j`` within ``radius`` bits; with ``side`` only pairs of different sides."""
    n = len(fps)
    lanes = -(-n // 64)
    bits = np.unpackbits(fps.astype("<u8").view(np.uint8).reshape(n, 8), axis=1, bitorder="little")
    padded = np.zeros((64, lanes * 64), np.uint8)
    padded[:, :n] = bits.T
    planes = np.packbits(padded, axis=1, bitorder="little").view("<u8").astype(np.uint64)
    order = np.arange(lanes * 64)
    width = max(3, int(radius).bit_length())
    step = 8
    left, right = [], []
    for at in range(0, n - 1, rows):
        q = np.arange(at, min(at + rows, n - 1))
        closed = order[None, :] <= q[:, None]
        closed[:, n:] = True
        if side is not None:
            closed[:, :n] |= side[None, :] == side[q][:, None]
        over = np.packbits(closed, axis=1, bitorder="little").view("<u8").astype(np.uint64)
        flip = bits[q].astype(np.uint64) * _ALL
        count = [np.zeros_like(over) for _ in range(width)]
        beyond = over
        for base in range(0, 64, step):
            x = [planes[base + t][None, :] ^ flip[:, base + t, None] for t in range(step)]
            over = _add_eight(count, x, over)
            beyond = over | _greater(count, radius)
            alive = ~(beyond == _ALL).all(axis=1)
            if not alive.all():
                if not alive.any():
                    q = q[:0]
                    break
                q, flip, over, beyond = q[alive], flip[alive], over[alive], beyond[alive]
                count = [c[alive] for c in count]
        if len(q):
            open_ = np.unpackbits((~beyond).astype("<u8").view(np.uint8), axis=1, bitorder="little")
            r, c = np.nonzero(open_)
            left.append(q[r])
            right.append(c)
    if not left:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(left), np.concatenate(right)


def _csa(a, b, c):
    """Carry-save adder: three planes of one weight give a sum and a carry plane."""
    u = a ^ b
    return u ^ c, (a & b) | (u & c)


def _add_eight(count: list, x: list, over: np.ndarray) -> np.ndarray:
    """Add eight planes of weight one to the counters; overflow is or-ed into ``over``."""
    one, two_a = _csa(count[0], x[0], x[1])
    one, two_b = _csa(one, x[2], x[3])
    two, four_a = _csa(count[1], two_a, two_b)
    one, two_a = _csa(one, x[4], x[5])
    one, two_b = _csa(one, x[6], x[7])
    two, four_b = _csa(two, two_a, two_b)
    four, carry = _csa(count[2], four_a, four_b)
    count[0], count[1], count[2] = one, two, four
    for k in range(3, len(count)):
        count[k], carry = count[k] ^ carry, count[k] & carry
    return over | carry


def _greater(count: list, radius: int) -> np.ndarray:
    """Lanes whose counter exceeds ``radius``, by comparison from the top bit."""
    more = np.zeros_like(count[0])
    same = np.full_like(count[0], _ALL)
    for k in reversed(range(len(count))):
        if radius >> k & 1:
            same &= count[k]
        else:
            more |= same & count[k]
            same &= ~count[k]
    return more


def star_edges(n: int, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(member, root)`` for the local components of links ``i, j``; roots are least."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        np.minimum.at(new, root[i], low)
        np.minimum.at(new, root[j], low)
        new = new[new]
        if (new == root).all():
            break
        root = new
    member = np.flatnonzero(root != np.arange(n))
    return member, root[member]


def band_masks(radius: int, pieces: int) -> list[int]:
    """Bits that two fingerprints within ``radius`` share in at least one mask (signed 64-bit numbers)."""
    edges = [round(64 * k / pieces) for k in range(pieces + 1)]
    piece = [(1 << hi) - (1 << lo) for lo, hi in zip(edges, edges[1:])]
    masks = [sum(chosen) for chosen in itertools.combinations(piece, pieces - radius)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def pieces_for(count: int, radius: int, block: int) -> int:
    """Pieces with which a key of evenly spread fingerprints is shared by at most half a block of them."""
    for pieces in range(radius + 1, radius + 5):
        key_bits = (pieces - radius) * (64 // pieces)
        if count >> key_bits <= block // 2:
            break
    return pieces


def fingerprint_documents(docs: DataFrame, shingle: int = SHINGLE, seed: int = SEED, extra: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id, *extra, fp`` (signed 64 bits) for every row."""
    fields = [docs.schema[c] for c in ("doc_id", *extra)]
    names = [f.name for f in fields] + ["fp"]

    def run(batches):
        for batch in batches:
            raw, offsets = W.buffers(batch.column(0))
            parts = [fingerprints(raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], shingle, seed) for i, j in W.runs(offsets)]
            fp = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(fp.view(np.int64))], names)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + ", fp bigint"
    return arrow_map(docs.select("text", *[f.name for f in fields]), run, schema)


def near_links(distinct: DataFrame, radius: int = RADIUS, block: int = BLOCK, pieces: int | None = None) -> DataFrame:
    """Star edges ``(u, v)`` over the distinct fingerprints in column ``fp``."""
    masks = band_masks(radius, pieces or pieces_for(distinct.count(), radius, block))
    bands = F.array(*[
        F.struct(F.lit(b).alias("band"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for b, m in enumerate(masks)
    ])
    rows = distinct.select("fp", F.explode(bands).alias("b")).select("fp", "b.band", "b.key")
    large = (
        rows.groupBy("band", "key").count().filter(F.col("count") > block)
        .select("band", "key", F.ceil(F.col("count") / block).cast("int").alias("blocks"))
    )
    rows = rows.join(settle(large), ["band", "key"], "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    cells = (
        rows.withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("band", "key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "fp")
    )
    keys = ["band", "key", "i", "j"]

    def compare(batches):
        left = None
        for batch in batches:
            t = pa.Table.from_batches([batch] if left is None else [left, batch]).combine_chunks()
            done = yield from _groups(t, radius, False)
            rest = t.slice(done).combine_chunks().to_batches()
            left = rest[0] if rest else None
        if left is not None:
            yield from _groups(pa.Table.from_batches([left]), radius, True)

    sorted_cells = cells.repartition(*[F.col(k) for k in keys]).sortWithinPartitions(*keys)
    return arrow_map(sorted_cells, compare, "u bigint, v bigint")


def _groups(t: pa.Table, radius: int, last: bool):
    """Compare all complete groups of a sorted table; returns the rows used."""
    band, key, i, j, own, fp = (t.column(c).to_numpy() for c in ("band", "key", "i", "j", "own", "fp"))
    n = len(fp)
    change = (np.diff(band) != 0) | (np.diff(key) != 0) | (np.diff(i) != 0) | (np.diff(j) != 0)
    at = np.concatenate(([0], np.flatnonzero(change) + 1, [n])) if n else np.zeros(1, int)
    if not last:
        at = at[:-1]
    us, vs = [], []
    for x, y in zip(at[:-1], at[1:]):
        if y - x < 2:
            continue
        block = fp[x:y].view(np.uint64)
        a, b = sliced_links(block, radius, own[x:y] if i[x] != j[x] else None)
        if len(a):
            member, root = star_edges(y - x, a, b)
            us.append(fp[x:y][member])
            vs.append(fp[x:y][root])
    if us:
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(us)), pa.array(np.concatenate(vs))], ["u", "v"])
    return int(at[-1]) if len(at) else 0


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, block: int = BLOCK, seed: int = SEED, extra: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id, *extra, fp, class_fp, component_id`` for every row of ``docs``.

    ``component_id`` is the least ``doc_id`` reachable over links; ``class_fp``
    names the component also where all its ids are null.
    """
    prints = settle(fingerprint_documents(docs, shingle, seed, extra))
    distinct = settle(prints.groupBy("fp").agg(F.min("doc_id").alias("least")))
    comp = components(near_links(distinct.select("fp"), radius, block))
    member = distinct.join(comp, distinct.fp == comp.id, "left").select("fp", "least", F.coalesce("component", "fp").alias("class_fp"))
    linked = member.join(comp.select(F.col("id").alias("fp")), "fp", "left_semi")
    least = linked.groupBy("class_fp").agg(F.min("least").alias("component_id"))
    member = settle(
        member.join(least, "class_fp", "left").select("fp", "class_fp", F.coalesce("component_id", "least").alias("component_id"))
    )
    return prints.join(member, "fp").select("doc_id", *extra, "fp", "class_fp", "component_id")


def one_per_group(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """The rows of ``docs`` that stay: for each component its least ``doc_id``, once.

    Of repeated rows one stays; of a component with null ids only, the row
    with the least text key.
    """
    keyed = docs.select(F.col("doc_id"), F.col("text"), text_key().alias("_text"))
    found = near_duplicates(keyed, shingle, radius, extra=("_text",))
    head = found.filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
    chosen = head.groupBy("class_fp").agg(F.min(F.struct("doc_id", "_text")).alias("c")).select(F.col("c.doc_id").alias("_id"), F.col("c._text").alias("_text"))
    return keep_chosen(docs, chosen)
