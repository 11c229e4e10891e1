"""Which rows of a snapshot a large change set may touch, told without moving the rows.

A change set above the broadcast cap would have every row of the snapshot, all
50 columns wide, shuffled to meet it, though most rows meet nothing.  So its keys
are first hashed into a bit set of bounded size, which is broadcast: a row whose
bit is not set has no change, and only the others go on to the join.  The bit set
may name rows too many, never one too few; what it names is still joined by its
key, so the result is exact whatever its size.  At 16 bits for each key some 6 % of
the other rows are named; beyond :data:`MAX_BITS` the share grows, and a change set
with more keys than bits is joined without a filter.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from movrec.operators.sizing import Measured, materialize

BITS_PER_KEY = 16
MIN_BITS = 1 << 15  # one bucket of Spark's bitmap functions
MAX_BITS = 1 << 28  # 32 MiB


def _position(columns: Sequence[Column], bits: int) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(bits)) + 1  # the bitmap functions number positions from 1


def filter_bits(rows: int) -> int | None:
    """The size of a filter for this many keys: a power of two; ``None`` where it would tell nothing."""
    wanted = max(MIN_BITS, 1 << (max(rows, 1) * BITS_PER_KEY - 1).bit_length())
    return min(wanted, MAX_BITS) if rows < MAX_BITS else None


def key_bits(keys: Sequence[DataFrame], bits: int) -> DataFrame:
    """``_bucket, _bits``: the bit set of the hashed keys, in pieces of 4 KiB."""
    at = [k.select(_position([F.col(c) for c in k.columns], bits).alias("_at")) for k in keys]
    united = at[0]
    for more in at[1:]:
        united = united.union(more)
    placed = united.select(F.bitmap_bucket_number("_at").alias("_bucket"), F.bitmap_bit_position("_at").alias("_place"))
    # dealt by bucket first: partial bit sets would be larger than the places in them
    return placed.repartition("_bucket").groupBy("_bucket").agg(F.bitmap_construct_agg("_place").alias("_bits"))


def _is_set() -> Column:
    """Whether the bit of the row's ``_at`` is set in the piece that was joined to it."""
    place = F.bitmap_bit_position("_at")
    byte = F.conv(F.hex(F.substring(F.col("_bits"), (F.floor(place / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("bigint")
    return F.coalesce(F.getbit(byte, (place % 8).cast("int")) == 1, F.lit(False))


def _probed(mov: DataFrame, columns: Sequence[str], keys: Sequence[tuple[Measured, Sequence[str]]]) -> DataFrame | None:
    """``mov`` with ``_named``: whether ``columns`` may hold one of the ``keys`` (each with its own column names).

    ``None`` where all keys are broadcast anyway, or no filter would help.
    """
    if not columns or all(m.broadcastable for m, _ in keys):
        return None
    bits = filter_bits(sum(m.rows for m, _ in keys))
    kinds = [mov.schema[c].dataType for c in columns]
    # equal values of different types may hash differently
    if bits is None or any([m.df.schema[c].dataType for c in names] != kinds for m, names in keys):
        return None
    known = keys[0][0].filters if len(keys) == 1 else {}  # a change set may be looked up more than once
    at = (tuple(keys[0][1]), bits)
    if at not in known:
        known[at] = materialize(key_bits([m.df.select(*names) for m, names in keys], bits)).df
    row = mov.withColumn("_at", _position([mov[c] for c in columns], bits))
    return row.join(F.broadcast(known[at]), F.bitmap_bucket_number("_at") == F.col("_bucket"), "left").withColumn("_named", _is_set())


def split_by_keys(mov: DataFrame, columns: Sequence[str], keys: Sequence[Measured]) -> tuple[DataFrame, DataFrame] | None:
    """``mov`` in two parts: rows whose ``columns`` may be in one of the ``keys``, and rows that are in none.

    Both parts read ``mov``, which should be a scan or little more.  ``None`` as in :func:`_probed`.
    """
    probed = _probed(mov, columns, [(m, columns) for m in keys])
    if probed is None:
        return None
    return probed.filter(F.col("_named")).select(*mov.columns), probed.filter(~F.col("_named")).select(*mov.columns)


def possible_rows(mov: DataFrame, columns: Sequence[str], keys: Measured, names: Sequence[str] | None = None) -> DataFrame:
    """``mov`` without rows that cannot meet the ``keys`` (columns ``names``, default the same) in an inner or semi join."""
    probed = _probed(mov, columns, [(keys, names or columns)])
    return mov if probed is None else probed.filter(F.col("_named")).select(*mov.columns)
