"""Measured materialisation and size-checked broadcasts.

Small driving-side results (request keys, key pairs, windows) are used by
several joins.  They are checkpointed once to the shared checkpoint folder
(reliable: it survives executor loss and cuts the lineage), measured in the
same job, and broadcast only when the measured size is under the cap.  Above
the cap the join stays a shuffle join and AQE re-plans it from runtime sizes.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from movrec.session import ensure_checkpoint_dir

CAP_CONF = "spark.movrec.broadcastMaxBytes"
DEFAULT_CAP = 64 * 1024 * 1024
_ROW_OVERHEAD = 16
_FIELD_BYTES = 8


@dataclass
class Measured:
    """A materialised DataFrame with its measured row count and size estimate."""

    df: DataFrame
    rows: int
    bytes: int
    extras: dict = field(default_factory=dict)
    broadcastable: bool = False
    filters: dict = field(default_factory=dict)  # bit sets of its keys, see keyfilter

    def side(self) -> DataFrame:
        """The DataFrame to put on the small side of a join."""
        return F.broadcast(self.df) if self.broadcastable else self.df


def broadcast_cap(spark) -> int:
    """Byte cap for explicit broadcasts: ``spark.movrec.broadcastMaxBytes`` or 64 MiB."""
    raw = spark.conf.get(CAP_CONF, None)
    if raw is None:
        return DEFAULT_CAP
    return int(raw)


def _row_bytes(schema: T.StructType) -> Column:
    """Estimated bytes of one row: 8 per field plus the bytes of text fields (one SQL expression)."""
    parts = [str(_ROW_OVERHEAD)]
    for f in schema.fields:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            parts.append(f"coalesce(octet_length(`{f.name}`), 0) + {_FIELD_BYTES}")
        else:
            parts.append(str(_FIELD_BYTES))
    return F.expr(" + ".join(f"CAST({p} AS BIGINT)" for p in parts))


def materialize(df: DataFrame, extras: dict[str, Column] | None = None) -> Measured:
    """Checkpoint ``df`` once (reliable, eager) and measure it in the same job.

    The checkpoint goes to the shared checkpoint folder (``spark.checkpoint.dir``),
    so it survives executor loss and cuts the lineage: later joins read the
    written rows instead of recomputing them.  Row count, a byte estimate and
    the ``extras`` aggregates are collected with ``DataFrame.observe`` while the
    rows are written, so no second pass is needed.  With
    ``spark.cleaner.referenceTracking.cleanCheckpoints`` the files are removed
    once the DataFrame is no longer referenced.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    obs = Observation()
    aggs = [F.count(F.lit(1)).alias("_rows"), F.sum(_row_bytes(df.schema)).alias("_bytes")]
    for name, expr in (extras or {}).items():
        aggs.append(expr.alias(name))
    ck = df.observe(obs, *aggs).checkpoint(eager=True)
    r = obs.get
    rows = int(r.get("_rows") or 0)
    nbytes = int(r.get("_bytes") or 0)
    m = Measured(ck, rows, nbytes, {n: r.get(n) for n in (extras or {})})
    m.broadcastable = nbytes <= broadcast_cap(spark)
    return m
