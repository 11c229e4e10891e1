"""Periodic run detection on a Re-Pair grammar of the word ids.

A run is a stretch of consecutive words with smallest period ``q`` (words ``q``
apart are identical), of at least ``max(MIN_LENGTH, MIN_EXPONENT * q)`` words,
that no neighbouring word extends keeping the period.

Documents are taken in chunks of about 1 MB of text (one that is longer makes a
chunk of its own).  Every word inside a run starts a window of ``WINDOW`` words
that occurs twice in its document, so only stretches covered by such windows
are kept: an exact condition, which leaves ordinary text out.  Their words
become numbers, and Re-Pair replaces the commonest pairs of neighbours by new
symbols, round by round, until no pair occurs twice; then neighbours are paired
whatever they are, so that each stretch ends as one symbol.  For a new symbol
the runs that cross the border of its two halves are computed once, on its
first occurrence, and translated to every place where it was put in - all its
derivations, since a symbol is only made in its own round.  A run is found
whole at the smallest symbol that holds it; pieces of it found at smaller ones
overlap it by a period or more and are merged into it.

Borders are examined by comparing hashed slices for all periods at once; every
run that is kept is compared word by word, and extended by plain comparison if
hashes agreed where words do not.

Defined results: null and empty texts have no words and no runs; words are
``[^\\x20\\x09-\\x0D]+``; equal rows are judged one by one; texts of any length are
read whole, in memory that follows the largest document; other columns are
neither read nor changed.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from movrec.llm import words as W
from movrec.llm.common import arrow_map

MIN_LENGTH, MIN_EXPONENT = 24, 3
#: a window of so many words from anywhere in a run occurs in it twice: max(24, 3 * q) - 8 >= 2 * q
WINDOW = 9

SCHEMA = "n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"
_RUN = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

_WORDS, _SLICES = W.Sums(31), W.Sums(37)


def repeated_stretches(hashes: np.ndarray, borders: np.ndarray) -> list[tuple[int, int]]:
    """Maximal ranges of words covered by windows that occur twice in their document, ``MIN_LENGTH`` words or more."""
    n = len(hashes)
    if n < MIN_LENGTH:
        return []
    running = _SLICES.over(hashes)
    at = np.arange(n - WINDOW + 1)
    doc = np.searchsorted(borders, at, side="right")
    inside = borders[doc] >= at + WINDOW
    at, doc = at[inside], doc[inside]
    prints = W.mix(_SLICES.slices(running, at, at + WINDOW) ^ W.mix(doc.astype(np.uint64)))
    order = np.argsort(prints, kind="stable")
    same = prints[order][1:] == prints[order][:-1]
    twice = np.zeros(len(at), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    edges = np.zeros(n + 1, np.int64)
    np.add.at(edges, at[twice], 1)
    np.add.at(edges, at[twice] + WINDOW, -1)
    covered = np.cumsum(edges[:-1]) > 0
    cut = np.flatnonzero(np.diff(np.concatenate(([0], covered.astype(np.int8), [0]))))
    out = []
    for i, j in zip(cut[::2].tolist(), cut[1::2].tolist()):
        docs = borders[(borders > i) & (borders < j)].tolist() if len(borders) > 1 else []
        bounds = [i, *docs, j]
        out.extend((a, b) for a, b in zip(bounds, bounds[1:]) if b - a >= MIN_LENGTH)
    return out


class Grammar:
    """Re-Pair over stretches of word numbers, and the runs crossing each symbol's border."""

    def __init__(self, ids: np.ndarray, stretch: np.ndarray):
        """``ids``: word numbers of all stretches one after the other; ``stretch``: ascending stretch numbers."""
        self.ids = ids
        self.running = _SLICES.over(W.mix(ids.astype(np.uint64) + np.uint64(1)))
        self.symbols = ids.astype(np.int64)
        self.start = np.arange(len(ids), dtype=np.int64)  # where each symbol of the sequence begins
        self.size = np.ones(len(ids), np.int64)
        self.stretch = stretch
        self.next = int(ids.max()) + 1 if len(ids) else 0
        self.found: list[np.ndarray] = []  # rows (period, start, end)

    def runs(self) -> np.ndarray:
        """All runs as rows (start, end, period) on the stretches' words, by start, then period."""
        while self._round():
            pass
        while self._halve():
            pass
        if not self.found:
            return np.zeros((0, 3), np.int64)
        return self._merged(np.concatenate(self.found))

    # --- the grammar ---------------------------------------------------------------
    def _neighbours(self) -> np.ndarray:
        """Places whose symbol has a right neighbour in the same stretch."""
        return np.flatnonzero(self.stretch[1:] == self.stretch[:-1])

    def _round(self) -> bool:
        """Replace the commonest pairs: all that occur at least half as often as the most frequent one."""
        at = self._neighbours()
        if not len(at):
            return False
        key = self.symbols[at] * self.next + self.symbols[at + 1]
        order = np.argsort(key, kind="stable")
        ranked = key[order]
        first = np.flatnonzero(np.concatenate(([True], ranked[1:] != ranked[:-1])))
        counts = np.diff(np.append(first, len(ranked)))
        most = int(counts.max())
        if most < 2:
            return False
        often = counts >= max(2, (most + 1) // 2)
        number = np.zeros(len(at), np.int64)  # rank of the place's pair by frequency, 1 first; 0: not replaced
        rank = np.zeros(len(first), np.int64)
        common = np.flatnonzero(often)  # equally frequent pairs in hashed order, so that chains of rising rank stay short
        rank[common[np.lexsort((W.mix(ranked[first[common]].astype(np.uint64)), -counts[common]))]] = np.arange(1, len(common) + 1)
        number[order] = np.repeat(rank, counts)
        taken = self._disjoint(at, number)
        kept = np.bincount(number[taken], minlength=len(first) + 1)
        taken = taken[kept[number[taken]] > 1]  # overlaps may leave a pair a single time
        if not len(taken):  # overlaps only: give way to the commonest pair alone
            taken = self._disjoint(at, np.where(number == 1, 1, 0))
        self._replace(at[taken], number[taken])
        return True

    @staticmethod
    def _disjoint(at: np.ndarray, number: np.ndarray) -> np.ndarray:
        """Indices of places to replace, none overlapping: at each overlap the commoner pair, then the left one."""
        place = np.flatnonzero(number)
        if not len(place):
            return place
        pos, rank = at[place], number[place]
        alive = np.ones(len(place), bool)
        won = np.zeros(len(place), bool)
        while alive.any():
            live = np.flatnonzero(alive)
            p, r = pos[live], rank[live]
            close = np.diff(p) == 1
            # in a chain of overlapping places: every other one of each stretch of equal rank that no commoner pair touches
            lower_left = np.concatenate(([False], close & (r[:-1] < r[1:])))
            lower_right = np.concatenate((close & (r[1:] < r[:-1]), [False]))
            new = np.concatenate(([True], ~(close & (r[1:] == r[:-1]))))
            group = np.cumsum(new) - 1
            blocked = np.zeros(group[-1] + 1, bool)
            np.logical_or.at(blocked, group, lower_left | lower_right)
            begin = np.flatnonzero(new)[group]
            win = ~blocked[group] & ((np.arange(len(live)) - begin) % 2 == 0)
            won[live[win]] = True
            alive[live[~blocked[group]]] = False
            gone = np.zeros(len(live), bool)
            gone[1:] |= win[:-1] & close
            gone[:-1] |= win[1:] & close
            alive[live[gone]] = False
        return place[won]

    def _halve(self) -> bool:
        """Join every other pair of neighbours of each stretch, until each stretch is one symbol."""
        at = self._neighbours()
        if not len(at):
            return False
        new = np.concatenate(([True], self.stretch[1:] != self.stretch[:-1]))
        begin = np.flatnonzero(new)[np.cumsum(new) - 1]
        at = at[(at - begin[at]) % 2 == 0]
        self._replace(at, np.arange(1, len(at) + 1))
        return True

    def _replace(self, at: np.ndarray, number: np.ndarray) -> None:
        """Put a new symbol for each number at its places ``at`` (ascending), after looking at its border once."""
        _, first, which = np.unique(number, return_index=True, return_inverse=True)
        size = self.size[at] + self.size[at + 1]
        self._translate(self._crossing(at[first]), which, self.start[at])
        self.symbols[at] = self.next + which
        self.size[at] = size
        keep = np.ones(len(self.symbols), bool)
        keep[at + 1] = False
        self.symbols, self.start, self.size, self.stretch = self.symbols[keep], self.start[keep], self.size[keep], self.stretch[keep]
        self.next += len(first)

    # --- runs ------------------------------------------------------------------------
    def _crossing(self, at: np.ndarray) -> np.ndarray:
        """Rows (symbol, period, start, end): runs across the border of each pair at ``at``, inside the pair.

        Offsets count from the symbol's first word.  A run of three periods has
        one and a half of them on one side of the border, so the half period
        beside the border must equal that one period on: one comparison of
        slices settles a period that is none.
        """
        lo, mid = self.start[at], self.start[at + 1]
        hi = mid + self.size[at + 1]
        parts = []
        for right in (True, False):
            room = hi - mid if right else mid - lo
            most = np.minimum(room * 2 // 3, (hi - lo) // MIN_EXPONENT)
            most[hi - lo < MIN_LENGTH] = 0
            for s in _batches(most):
                owner = np.repeat(s, most[s])
                q = np.arange(len(owner)) - np.repeat(np.cumsum(most[s]) - most[s], most[s]) + 1
                b, half = mid[owner], (q + 1) // 2
                one, two = (b, b + q) if right else (b - half, b - half - q)
                fits = (two + half <= hi[owner]) if right else (two >= lo[owner])
                owner, q, one, two, half = owner[fits], q[fits], one[fits], two[fits], half[fits]
                same = self._equal(one, two, half)
                owner, q = owner[same], q[same]
                b = mid[owner]
                left, ahead = (b, b + q) if right else (b - q, b)  # positions a period apart around the border
                back = self._extend(left, ahead, np.minimum(left - lo[owner], ahead - lo[owner]), -1)
                on = self._extend(left, ahead, np.minimum(hi[owner] - left, hi[owner] - ahead), 1)
                start, end = left - back, ahead + on
                long = (end - start >= np.maximum(MIN_LENGTH, MIN_EXPONENT * q)) & (start < b) & (end > b)
                parts.append(np.stack([owner[long], q[long], start[long], end[long]], axis=1))
        rows = np.concatenate(parts) if parts else np.zeros((0, 4), np.int64)
        if not len(rows):
            return rows
        rows = self._exact(_least_period(rows), lo, hi)
        rows[:, 2] -= lo[rows[:, 0]]
        rows[:, 3] -= lo[rows[:, 0]]
        return rows

    def _equal(self, i: np.ndarray, j: np.ndarray, length: np.ndarray) -> np.ndarray:
        return _SLICES.slices(self.running, i, i + length) == _SLICES.slices(self.running, j, j + length)

    def _extend(self, i: np.ndarray, j: np.ndarray, most: np.ndarray, step: int) -> np.ndarray:
        """How many words from ``i`` and ``j`` on (or back from them) agree, at most ``most``."""
        low, high = np.zeros_like(most), np.maximum(most, 0)
        while len(open_ := np.flatnonzero(low < high)):
            mid = (low[open_] + high[open_] + 1) // 2
            a, b = (i[open_], j[open_]) if step > 0 else (i[open_] - mid, j[open_] - mid)
            same = self._equal(a, b, mid)
            low[open_[same]] = mid[same]
            high[open_[~same]] = mid[~same] - 1
        return low

    def _exact(self, rows: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Rows whose words agree; where hashes misled, the stretch that does around the border is taken."""
        out = []
        for owner, q, start, end in rows.tolist():
            if np.array_equal(self.ids[start : end - q], self.ids[start + q : end]):
                out.append((owner, q, start, end))
                continue
            for p in range(1, (int(hi[owner]) - int(lo[owner])) // MIN_EXPONENT + 1):  # plain search of one symbol
                agree = self.ids[lo[owner] : hi[owner] - p] == self.ids[lo[owner] + p : hi[owner]]
                cut = np.flatnonzero(np.diff(np.concatenate(([0], agree.astype(np.int8), [0]))))
                for a, b in zip(cut[::2].tolist(), cut[1::2].tolist()):
                    if b - a + p >= max(MIN_LENGTH, MIN_EXPONENT * p):
                        out.append((owner, p, int(lo[owner]) + a, int(lo[owner]) + b + p))
        return _least_period(np.array(out, np.int64).reshape(-1, 4))

    def _translate(self, rows: np.ndarray, which: np.ndarray, starts: np.ndarray) -> None:
        """The rows of each symbol at every place where it stands."""
        if not len(rows):
            return
        per = np.bincount(rows[:, 0], minlength=int(which.max()) + 1)
        rows = rows[np.argsort(rows[:, 0], kind="stable")]
        begin = np.cumsum(per) - per
        times = per[which]
        place = np.repeat(np.arange(len(which)), times)
        row = begin[which[place]] + np.arange(len(place)) - np.repeat(np.cumsum(times) - times, times)
        shift = starts[place]
        self.found.append(np.stack([rows[row, 1], rows[row, 2] + shift, rows[row, 3] + shift], axis=1))

    @staticmethod
    def _merged(found: np.ndarray) -> np.ndarray:
        """Unite pieces of equal period that overlap by a period or more."""
        period, start, end = found[np.lexsort((-found[:, 2], found[:, 1], found[:, 0]))].T
        bar = end.max() + 1
        reach = np.maximum.accumulate(end + period * bar) - period * bar  # the furthest end so far, by period
        new = np.concatenate(([True], (period[1:] != period[:-1]) | (start[1:] > reach[:-1] - period[1:])))
        first = np.flatnonzero(new)
        out = np.stack([start[first], np.maximum.reduceat(end, first), period[first]], axis=1)
        return out[np.lexsort((out[:, 2], out[:, 0]))]


def _least_period(rows: np.ndarray) -> np.ndarray:
    """Of rows (symbol, period, start, end) with equal symbol, start and end, the one with the least period."""
    if not len(rows):
        return rows
    rows = rows[np.lexsort((rows[:, 1], rows[:, 3], rows[:, 2], rows[:, 0]))]
    key = rows[:, [0, 2, 3]]
    return rows[np.concatenate(([True], (key[1:] != key[:-1]).any(axis=1)))]


def _batches(most: np.ndarray, limit: int = 1 << 20):
    """Indices in groups whose ``most`` sum to about ``limit``."""
    some = np.flatnonzero(most)
    if len(some):
        cut = np.flatnonzero(np.diff(np.cumsum(most[some]) // limit)) + 1
        yield from np.split(some, cut)


def word_runs(texts: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """``(start, length, period)`` of the runs of each text, given as its words, by start, then period."""
    sizes = np.array([len(t) for t in texts], np.int64)
    borders = np.cumsum(sizes)
    flat = [w for t in texts for w in t]
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    if not flat:
        return out
    stretches = repeated_stretches(_hashes(flat), borders)
    if not stretches:
        return out
    numbers: dict[bytes, int] = {}
    ids = np.array([numbers.setdefault(w, len(numbers)) for i, j in stretches for w in flat[i:j]], np.int64)
    lengths = np.array([j - i for i, j in stretches], np.int64)
    firsts = np.array([i for i, _ in stretches], np.int64)
    begins = np.cumsum(lengths) - lengths
    for start, end, period in Grammar(ids, np.repeat(np.arange(len(lengths)), lengths)).runs().tolist():
        s = int(np.searchsorted(begins, start, side="right")) - 1
        place = int(firsts[s]) + start - int(begins[s])
        doc = int(np.searchsorted(borders, place, side="right"))
        out[doc].append((place - int(borders[doc] - sizes[doc]), end - start, period))
    return out


def _hashes(flat: list[bytes]) -> np.ndarray:
    """A 64-bit hash of each word."""
    ends = np.cumsum(np.fromiter(map(len, flat), np.int64, len(flat)))
    data = np.frombuffer(b"".join(flat), np.uint8)
    return _WORDS.slices(_WORDS.over(_WORDS.bytes[data]), np.concatenate(([0], ends[:-1])), ends)


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words joined by one space, without those that a run repeats after its first period."""
    if not runs:
        return b" ".join(words)
    drop = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        drop[start + period] += 1
        drop[start + length] -= 1
    kept = np.flatnonzero(np.cumsum(drop[:-1]) <= 0)
    return b" ".join([words[i] for i in kept.tolist()])


def find_runs(docs: DataFrame) -> DataFrame:
    """``doc_id, n_words, runs, collapsed`` for every row of ``docs``."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def scan(batches):
        for batch in batches:
            raw, offsets = W.buffers(batch.column(1))
            for i, j in W.runs(offsets):
                texts = [raw[offsets[k] : offsets[k + 1]].tobytes().split() for k in range(i, j)]
                found = word_runs(texts)
                shown = [[{"start": s, "length": n, "period": q} for s, n, q in f] for f in found]
                collapsed = pa.array([collapse(t, f) for t, f in zip(texts, found)], pa.binary()).cast(pa.string())
                counts = pa.array([len(t) for t in texts], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), counts, pa.array(shown, _RUN), collapsed], ["doc_id", "n_words", "runs", "collapsed"]
                )

    return arrow_map(docs.select("doc_id", "text"), scan, f"doc_id {id_type}, {SCHEMA}")
