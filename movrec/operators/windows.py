"""Transform B: discover every stand-in / core pair inside period windows.

Per window the reference collects the stand-ins (type ``STANDIN`` or
``STANDIN_P``), finds the core movements (type NULL) on the same account whose
document is the stand-in's repost reference, takes the distinct union of the
two documents per account, and returns every movement in the window carrying
one of those (account, document) keys.

Set-based plan over all windows at once:

    windows --guard/collapse--> window keys (multiplicity ``wn_n``)
    movements(stand-ins) --distinct, measured--> stand-ins with a reference
    movements(core)  --semi join on their keys--> core keys and days, measured
    stand-ins --semi join on core keys--> those with a partner anywhere
    both      --binned range join--> per window                              [N3]
    stand-ins --semi join on cores--> matched --explode 2 docs--> distinct keys [N4, A2]
    movements --(account, document, window range)--> 50 columns              [N5]

No step emits all stand-in × core pairs: the core side is reduced to distinct
keys (map-side partial aggregate), so a hot (account, document) key collapses
before it is shuffled.  The core rows, the bulk of the table, are scanned once
over four columns; only those on a stand-in's key are moved.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from movrec.functions.formatting import format_movements
from movrec.functions.predicates import all_truthy
from movrec.operators.ranges import DEFAULT_BIN_DAYS, attach_windows, window_bins
from movrec.operators.requests import as_date, empty_result
from movrec.operators.sizing import Measured, materialize
from movrec.schema import STANDIN, STANDIN_PARKED
from movrec.sources.snapshot import restrict_period

WIN_KEY = ("wn_lo", "wn_hi")


def guard_windows(win: DataFrame) -> DataFrame:
    """keep windows whose ``periodo`` and ``periodo_tope`` are truthy."""
    return win.filter(all_truthy(win, ("periodo", "periodo_tope")))


def window_keys(win: DataFrame) -> DataFrame:
    g = guard_windows(win)
    keyed = g.select(as_date(g, "periodo_tope").alias("wn_lo"), as_date(g, "periodo").alias("wn_hi"))
    return keyed.groupBy(*WIN_KEY).agg(F.count(F.lit(1)).alias("wn_n"))


def _standins(bins: Measured, mov: DataFrame) -> DataFrame:
    return restrict_period(mov, bins.extras["_lo"], bins.extras["_hi"]).filter(
        F.col("tipo_procesamiento").isin(STANDIN_PARKED, STANDIN)
    ).select("periodo", "numero_cuenta_id", "numero_documento", "numero_comprobante_reposting")


def window_standins(bins: Measured, mov: DataFrame, bin_days: int = DEFAULT_BIN_DAYS) -> DataFrame:
    """N3: stand-in movements inside each window (account, document, repost reference)."""
    return attach_windows(_standins(bins, mov), bins, "periodo", "wn_lo", "wn_hi", bin_days).select(
        *WIN_KEY, "wn_n", "numero_cuenta_id", "numero_documento", "numero_comprobante_reposting"
    )


def referenced_cores(bins: Measured, mov: DataFrame, standins: Measured) -> Measured:
    """Distinct ``(day, account, document)`` of the core rows (type NULL) that some stand-in refers to."""
    keys = standins.df.select(F.col("numero_cuenta_id").alias("_c"), F.col("numero_comprobante_reposting").alias("_d")).distinct()
    keys = F.broadcast(keys) if standins.broadcastable else keys  # a projection of the measured stand-ins
    m = restrict_period(mov, bins.extras["_lo"], bins.extras["_hi"]).filter(F.col("tipo_procesamiento").isNull())
    m = m.select("periodo", F.col("numero_cuenta_id").alias("co_cuenta"), F.col("numero_documento").alias("co_documento"))
    return materialize(m.join(keys, (F.col("co_cuenta") == F.col("_c")) & (F.col("co_documento") == F.col("_d")), "left_semi").distinct())


def window_matched_standins(bins: Measured, mov: DataFrame, bin_days: int = DEFAULT_BIN_DAYS) -> DataFrame:
    """N4: distinct (window, account, core document, stand-in document) with a core partner.

    The core document equals the stand-in's repost reference (join key), so
    the result is the distinct projection of the reference's core × stand-in
    join without producing the product.
    """
    standins = materialize(_standins(bins, mov).filter(F.col("numero_comprobante_reposting").isNotNull()).distinct())
    cores = referenced_cores(bins, mov, standins)
    on = (F.col("numero_cuenta_id") == F.col("co_cuenta")) & (F.col("numero_comprobante_reposting") == F.col("co_documento"))
    partnered = standins.df.join(cores.side().drop("periodo"), on, "left_semi")  # before any is repeated for the windows it lies in
    found = attach_windows(partnered, bins, "periodo", "wn_lo", "wn_hi", bin_days).select(
        *WIN_KEY, "wn_n", F.col("numero_cuenta_id").alias("cuenta"), F.col("numero_comprobante_reposting").alias("documento_core"),
        F.col("numero_documento").alias("documento_standin"),
    )
    core_keys = attach_windows(cores.df, bins, "periodo", "wn_lo", "wn_hi", bin_days).select(
        *WIN_KEY, F.col("co_cuenta").alias("cuenta"), F.col("co_documento").alias("documento_core")
    )
    return found.distinct().join(core_keys.distinct(), [*WIN_KEY, "cuenta", "documento_core"], "left_semi")


def window_key_union(matched: DataFrame) -> DataFrame:
    """A2: per window, the distinct union of (account, core document) and (account, stand-in document)."""
    docs = matched.select(
        *WIN_KEY, "wn_n", "cuenta", F.explode(F.array("documento_core", "documento_standin")).alias("documento")
    )
    return docs.distinct()


def window_movements(keys: Measured, mov: DataFrame) -> DataFrame:
    """N5: movements of each window carrying one of its (account, document) keys, with ``_rep``."""
    k = keys.side()
    wide = restrict_period(mov, keys.extras["_lo"], keys.extras["_hi"])
    joined = wide.join(
        k,
        (wide["numero_cuenta_id"] == k["cuenta"])
        & (wide["numero_documento"] == k["documento"])
        & (wide["periodo"] >= k["wn_lo"])
        & (wide["periodo"] <= k["wn_hi"]),
    )
    return joined.withColumn("_rep", F.col("wn_n"))


def prepare_window_keys(win: DataFrame, mov: DataFrame, bin_days: int = DEFAULT_BIN_DAYS) -> Measured | None:
    bins = window_bins(window_keys(win), "wn_lo", "wn_hi", bin_days)
    if bins.rows == 0:
        return None
    matched = window_matched_standins(bins, mov, bin_days)
    return materialize(window_key_union(matched), {"_lo": F.min("wn_lo"), "_hi": F.max("wn_hi")})


def match_windows(win: DataFrame, mov: DataFrame, bin_days: int = DEFAULT_BIN_DAYS) -> DataFrame:
    """P3: the 50 movement columns as text for every window, as transform B returns them."""
    keys = prepare_window_keys(win, mov, bin_days)
    if keys is None or keys.rows == 0:
        return empty_result(mov.sparkSession, False)
    return format_movements(window_movements(keys, mov), repeat="_rep")
