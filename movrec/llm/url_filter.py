"""URL filters by a Bloom filter cascade.

Listed keys are rules (``host`` or ``host/path-prefix``, allow or block) and
listed hosts.  A rule fits its host and all subdomains of it where the url's
path starts with the rule's; so a url's candidate keys are its host's suffixes
joined with those prefixes of its path whose lengths occur in rules; suffixes of
more labels than any listed host has are none.

The key universe is every candidate key of the whole corpus.  Level 0 of the
cascade encodes the listed keys, level 1 those keys of the universe that pass
level 0 without being listed, level 2 the listed keys that pass level 1, and
so on until a level lets no wrong key pass.  Over that universe membership is
exact; a url is judged by looking its candidates up in the broadcast levels,
without a join.  Bits are set by a grouped ``bit_or`` and only the words of the
filters reach the driver; their size is checked against ``max_filter_bytes``.
Where a cascade would be larger, the keys are halved by their hash, as often as
needed, and the candidates are looked up in one cascade after the other.

The longest listed candidate wins (by the length of host and path together; of
equal ones the longer host, then block before allow).  Without a rule the
method's own verdict is block for a listed host or its subdomain, else allow.

Defined results: a null url or one without ``://`` has an empty host and path,
no candidates, and is allowed; very long hosts and paths are read whole, in time
that grows with their length; repeated rows are judged one by one; other columns
are not read; empty rule and host lists are allowed.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from movrec.llm.common import arrow_map, ascii_lower, settle
from movrec.llm.words import mix

MAX_FILTER_BYTES = 256 << 20
BITS_PER_KEY = 12
#: the keys are halved at most until there are so many parts
MOST_PARTS = 1 << 16
ALLOW, BLOCK, HOST = "A", "B", "H"


def split_url(url: str = "url") -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url column."""
    text = F.coalesce(F.col(url), F.lit(""))
    rest = F.when(F.instr(text, "://") > 0, F.substr(text, F.instr(text, "://") + 3)).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), r"^[^?#]*", 0)
    return ascii_lower(host), path


def places(h1: np.ndarray, h2: np.ndarray, hashes: int, salt: int, bits: int):
    """The bit places of keys in one level; every level hashes anew, so keys that collide in one part in the next."""
    a, b = mix(h1 + np.uint64(salt * 0x9E3779B97F4A7C15 % (1 << 64))), mix(h2 ^ np.uint64(salt)) | np.uint64(1)
    for i in range(hashes):
        yield (a + np.uint64(i) * b) % np.uint64(bits)


@dataclass
class Level:
    """One Bloom filter."""

    words: np.ndarray
    hashes: int
    salt: int

    def has(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        out = np.ones(len(h1), bool)
        for at in places(h1, h2, self.hashes, self.salt, len(self.words) * 64):
            out &= (self.words[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)
        return out


class FilterTooLarge(ValueError):
    """A cascade does not fit in the bytes allowed."""


class Cascade:
    """Alternate levels of listed keys and false positives, for part ``part`` of ``parts`` of all keys."""

    def __init__(self, levels: list[Level], part: int = 0, parts: int = 1):
        self.levels, self.part, self.parts = levels, part, parts

    def mine(self, h1: np.ndarray) -> np.ndarray:
        return h1 % np.uint64(self.parts) == np.uint64(self.part)

    def has(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        listed = np.zeros(len(h1), bool)
        open_ = np.arange(len(h1))
        for n, level in enumerate(self.levels):
            passed = level.has(h1[open_], h2[open_])
            listed[open_[~passed]] = n % 2 == 1
            open_ = open_[passed]
        listed[open_] = len(self.levels) % 2 == 1
        return listed

    @property
    def bytes(self) -> int:
        return sum(8 * len(x.words) for x in self.levels)


def key_hashes(key: Column) -> tuple[Column, Column]:
    """Two independent 64-bit hashes of a key; the second is odd."""
    return F.xxhash64(key), F.xxhash64(F.lit("cascade"), key).bitwiseOR(F.lit(1))


def _build_level(keys: DataFrame, salt: int, bits_per_key: float, room: int) -> Level | None:
    n = keys.count()
    if not n:
        return None
    words = max(1, math.ceil(n * bits_per_key / 64))
    if words * 8 > room:
        raise FilterTooLarge(f"{n} keys need a filter of {words * 8} bytes; {room} are left of max_filter_bytes")
    hashes = max(1, round(bits_per_key * math.log(2)))

    def set_bits(batches):
        for batch in batches:
            h1, h2 = (batch.column(c).to_numpy().view(np.uint64) for c in (0, 1))
            at = np.concatenate(list(places(h1, h2, hashes, salt, words * 64)))
            bit = (np.uint64(1) << (at & np.uint64(63))).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array((at >> np.uint64(6)).astype(np.int64)), pa.array(bit)], ["word", "bit"])

    rows = arrow_map(keys.select("h1", "h2"), set_bits, "word bigint, bit bigint").groupBy("word").agg(F.bit_or("bit").alias("bits"))
    out = np.zeros(words, np.uint64)
    for batch in _batches(rows):
        out[batch.column("word").to_numpy()] = batch.column("bits").to_numpy().view(np.uint64)
    return Level(out, hashes, salt)


def _batches(df: DataFrame):
    t = df.toArrow()
    return t.combine_chunks().to_batches()


def _passing(df: DataFrame, level: Level) -> DataFrame:
    shared = df.sparkSession.sparkContext.broadcast(level)
    at = [df.columns.index(c) for c in ("h1", "h2")]

    def run(batches):
        for batch in batches:
            h1, h2 = (batch.column(c).to_numpy().view(np.uint64) for c in at)
            yield batch.filter(pa.array(shared.value.has(h1, h2)))

    return arrow_map(df, run, df.schema)


def build_cascade(listed: DataFrame, universe: DataFrame, bits_per_key: float = BITS_PER_KEY, max_filter_bytes: int = MAX_FILTER_BYTES) -> Cascade:
    """The cascade for the keys in ``listed.key`` over the complete key universe ``universe.key``."""
    h1, h2 = key_hashes(F.col("key"))
    inside = settle(listed.select("key").distinct().withColumn("h1", h1).withColumn("h2", h2))
    levels = [_build_level(inside, 0, bits_per_key, max_filter_bytes)]
    if levels[0] is None:
        return Cascade([])
    passed = _passing(universe.select("key", h1.alias("h1"), h2.alias("h2")), levels[0])
    # of the keys that pass, those without a listed row are the false positives
    marked = passed.withColumn("l", F.lit(0)).unionByName(inside.withColumn("l", F.lit(1)))
    wrong = settle(marked.groupBy("key", "h1", "h2").agg(F.max("l").alias("l")).filter("l = 0").drop("l"))
    right = inside
    while True:
        room = max_filter_bytes - sum(8 * len(x.words) for x in levels)
        level = _build_level(wrong, len(levels), bits_per_key, room)
        if level is None:
            return Cascade(levels)
        levels.append(level)
        wrong, right = settle(_passing(right, level)), wrong


def build_cascades(
    listed: DataFrame, universe: DataFrame, bits_per_key: float = BITS_PER_KEY, max_filter_bytes: int = MAX_FILTER_BYTES, part: int = 0, parts: int = 1
) -> Iterator[Cascade]:
    """Cascades of at most ``max_filter_bytes`` each; every key belongs to one of them, by its hash."""
    mine = F.xxhash64("key").bitwiseAND(F.lit(parts - 1)) == part  # parts is a power of two
    some, all_ = (listed, universe) if parts == 1 else (listed.filter(mine), universe.filter(mine))
    try:
        cascade = build_cascade(some, all_, bits_per_key, max_filter_bytes)
    except FilterTooLarge:
        if parts >= MOST_PARTS:
            raise
    else:
        cascade.part, cascade.parts = part, parts
        yield cascade
        return
    yield from build_cascades(listed, universe, bits_per_key, max_filter_bytes, part, 2 * parts)
    yield from build_cascades(listed, universe, bits_per_key, max_filter_bytes, part + parts, 2 * parts)


def candidate_keys(host: Column, path: Column, lengths: Sequence[int], most_labels: int) -> Column:
    """Rule candidates (longest first) of a host and path, as an array of strings; hosts of up to ``most_labels`` labels."""
    labels = F.split(host, r"\.")
    n = F.size(labels)
    first = F.greatest(F.lit(1), n - (most_labels - 1))
    suffixes = F.when((host != "") & F.lit(most_labels > 0), F.transform(F.sequence(F.least(first, n), n), lambda i: F.array_join(F.slice(labels, i, n), "."))).otherwise(
        F.array().cast("array<string>")
    )
    lens = F.filter(F.array(*[F.lit(int(x)) for x in sorted(set(lengths), reverse=True)]).cast("array<int>"), lambda x: x <= F.length(path))
    keys = F.flatten(F.transform(suffixes, lambda s: F.transform(lens, lambda k: F.concat(s, F.substring(path, F.lit(1), k)))))
    # stable: longer first; equal lengths keep the order of suffixes, longer hosts first
    pairs = F.transform(keys, lambda k, i: F.struct((-F.length(k)).alias("n"), i.alias("i"), k.alias("k")))
    return F.transform(F.array_sort(pairs), lambda p: p.k)


def judge_urls(
    pages: DataFrame,
    rules: DataFrame,
    hosts: DataFrame | None = None,
    bits_per_key: float = BITS_PER_KEY,
    max_filter_bytes: int = MAX_FILTER_BYTES,
    keep: tuple[str, ...] = ("page_id",),
) -> DataFrame:
    """``*keep, host, path, rule, verdict`` for every row of ``pages`` (column ``url``).

    ``rules`` has columns host, path and allow (boolean); ``hosts`` column host.
    Rule paths have few distinct lengths; these lengths, not the rules, reach the driver.
    """
    spark = pages.sparkSession
    lengths = [r[0] for r in rules.select(F.length("path")).distinct().collect()]
    names = rules.select("host") if hosts is None else rules.select("host").unionByName(hosts.select("host"))
    most_labels = names.agg(F.max(F.size(F.split("host", r"\."))).alias("n")).first()["n"] or 0
    listed = rules.select(F.concat(F.when(F.col("allow"), ALLOW).otherwise(BLOCK), "host", "path").alias("key"))
    if hosts is not None:
        listed = listed.unionByName(hosts.select(F.concat(F.lit(HOST), "host").alias("key")))
    host, path = split_url()
    judged = pages.select(*keep, host.alias("host"), path.alias("path"))
    rule_keys = candidate_keys(F.col("host"), F.col("path"), lengths, most_labels)
    host_keys = candidate_keys(F.col("host"), F.lit(""), [0], most_labels)
    tagged = F.concat(
        F.flatten(F.transform(rule_keys, lambda k: F.array(F.concat(F.lit(BLOCK), k), F.concat(F.lit(ALLOW), k)))),
        F.transform(host_keys, lambda k: F.concat(F.lit(HOST), k)),
    )
    universe = judged.select("host", "path").distinct().select(F.explode(tagged).alias("key")).distinct()
    rows = judged.withColumn("_keys", tagged).withColumn("_at", F.lit(-1))
    for cascade in build_cascades(listed, universe, bits_per_key, max_filter_bytes):
        rows = _look_up(rows, cascade, spark)
    key = F.when(F.col("_at") >= 0, F.get("_keys", F.col("_at")))
    rule = F.when(F.substring(key, 1, 1) != HOST, F.substring(key, 2, 1 << 30))
    verdict = F.when(key.isNull() | (F.substring(key, 1, 1) == ALLOW), "allow").otherwise("block")
    return rows.select(*keep, "host", "path", rule.alias("rule"), verdict.alias("verdict"))


def _look_up(rows: DataFrame, cascade: Cascade, spark: SparkSession) -> DataFrame:
    """``rows`` with ``_at`` lowered to the first of ``_keys`` that this cascade lists."""
    shared = spark.sparkContext.broadcast(cascade)
    names = rows.columns
    hashed = rows.withColumn("_a", F.transform("_keys", lambda k: key_hashes(k)[0])).withColumn("_b", F.transform("_keys", lambda k: key_hashes(k)[1]))

    def run(batches):
        for batch in batches:
            a, b, before = (batch.column(batch.schema.names.index(c)) for c in ("_a", "_b", "_at"))
            h1, h2 = a.flatten().to_numpy().view(np.uint64), b.flatten().to_numpy().view(np.uint64)
            own = np.flatnonzero(shared.value.mine(h1))
            at = own[shared.value.has(h1[own], h2[own])]
            ends = np.cumsum(np.asarray(a.value_lengths().fill_null(0)))
            begins = np.concatenate(([0], ends[:-1])).astype(np.int64)
            place = np.searchsorted(at, begins)
            found = np.concatenate((at, [-1]))[np.minimum(place, len(at))]
            hit = (place < len(at)) & (found < ends)
            old = before.to_numpy()
            new = np.where(hit & ((old < 0) | (found - begins < old)), found - begins, old)
            cols = [pa.array(new, pa.int32()) if c == "_at" else batch.column(batch.schema.names.index(c)) for c in names]
            yield pa.RecordBatch.from_arrays(cols, names)

    return arrow_map(hashed, run, rows.schema)
