"""Range join of rows to the period windows that contain them.

A window join has no equality key (``periodo BETWEEN lo AND hi``).  Instead of
a nested-loop join, each window is expanded to the period *bins* it covers and
rows join on their own bin, with the exact range as a residual predicate.
Every row has one bin, so a (row, window) pair matches at most once, and the
cost per row is the number of windows sharing its bin, not the number of
windows.  The expanded windows are broadcast only when their measured size is
under the cap.  On the shuffle path a bin alone would be a hot key (a year of
data has a dozen of them), so rows get one of ``SALTS`` salts from their own
content and each window row is repeated for every salt.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from movrec.operators.sizing import Measured, materialize

DEFAULT_BIN_DAYS = 32
SALTS = 32


def period_bin(col: str | Column, bin_days: int) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.floor(F.unix_date(c) / F.lit(bin_days)).cast("int")


def window_bins(windows: DataFrame, lo: str, hi: str, bin_days: int = DEFAULT_BIN_DAYS) -> Measured:
    """Windows (with ``lo <= hi``) exploded to one row per covered bin, checkpointed and measured."""
    valid = windows.filter(F.col(lo).isNotNull() & F.col(hi).isNotNull() & (F.col(lo) <= F.col(hi)))
    binned = valid.withColumn(
        "_bin", F.explode(F.sequence(period_bin(lo, bin_days), period_bin(hi, bin_days)))
    )
    return materialize(binned, {"_lo": F.min(lo), "_hi": F.max(hi)})


def attach_windows(rows: DataFrame, bins: Measured, period: str, lo: str, hi: str, bin_days: int = DEFAULT_BIN_DAYS) -> DataFrame:
    """``rows`` joined to every window whose ``[lo, hi]`` contains ``rows[period]``."""
    keyed = rows.withColumn("_bin", period_bin(period, bin_days))
    w = bins.side()
    if bins.broadcastable:
        salted = F.lit(True)
    else:
        keyed = keyed.withColumn("_salt", F.pmod(F.xxhash64(*rows.columns), F.lit(SALTS)).cast("int"))
        w = w.withColumn("_ws", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        salted = keyed["_salt"] == w["_ws"]
    joined = keyed.join(
        w,
        (keyed["_bin"] == w["_bin"]) & salted & (keyed[period] >= w[lo]) & (keyed[period] <= w[hi]),
    )
    return joined.drop(keyed["_bin"]).drop(w["_bin"]).drop("_salt", "_ws")
