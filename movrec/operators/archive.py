"""O5: archive qualifying result rows to the lake, then purge them from the hot table."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from movrec.operators.apply import apply_deletes
from movrec.operators.changes import archive_rows, result_keys
from movrec.operators.sizing import Measured, materialize
from movrec.schema import WRITE_KEY
from movrec.sources.lake import BATCH_COLUMN, append_to_lake, read_batch


@dataclass
class ArchiveResult:
    remaining: DataFrame  # the snapshot without the archived keys
    keys: DataFrame | Measured  # the purged keys
    rows: int  # rows this call appended
    path: str
    fmt: str
    batch_id: str
    selected: DataFrame  # this call's selection

    @property
    def archived(self) -> DataFrame:
        """The rows of this batch as stored in the lake (read back on demand)."""
        held = read_batch(self.remaining.sparkSession, self.path, self.batch_id, self.fmt)
        return self.selected.limit(0).withColumn(BATCH_COLUMN, F.lit(self.batch_id)) if held is None else held


def archive_and_purge(
    rows: DataFrame,
    mov: DataFrame,
    path: str,
    fmt: str = "delta",
    batch_id: str | None = None,
) -> ArchiveResult:
    """Append the archive selection to its batch in the lake and derive the purged snapshot.

    The append runs first (one action): a failed append raises before anything
    is purged, and every written key is purged - the reference only purges the
    keys its 10,000-row preview happened to evaluate.  A batch is one folder of
    the lake; without ``batch_id`` it gets a fresh one.  A batch the lake does not
    know is streamed into its folder.  For one it knows (a rerun with the same, a
    larger or a smaller selection, or after a half-written append) only the rows
    it lacks are appended, counted, so that repeated rows stay repeated.  The
    purge keys are two columns read back from that folder: exactly what the lake
    holds of the batch is purged.  No other batch is listed or read.
    """
    spark = mov.sparkSession
    batch_id = batch_id or uuid.uuid4().hex
    selection = archive_rows(rows)
    held = read_batch(spark, path, batch_id, fmt)
    new = selection if held is None else missing_rows(selection, held)
    counted = Observation()
    appended = new.observe(counted, F.count(F.lit(1)).alias("rows")).withColumn(BATCH_COLUMN, F.lit(batch_id))
    append_to_lake(appended, path, fmt=fmt)
    stored = read_batch(spark, path, batch_id, fmt)
    keys = materialize(result_keys(selection.limit(0) if stored is None else stored))
    return ArchiveResult(apply_deletes(mov, keys, WRITE_KEY), keys, counted.get["rows"], path, fmt, batch_id, selection)


def row_digest(df: DataFrame, columns: list[str]) -> Column:
    """A 256-bit digest of the named columns (nulls, also of columns that ``df`` lacks, differ from empty text)."""
    values = [(F.col(c) if c in df.columns else F.lit(None)).cast("string").alias(c) for c in columns]
    return F.sha2(F.to_json(F.struct(*values), {"ignoreNullFields": "false"}), 256)


def missing_rows(selection: DataFrame, held: DataFrame) -> DataFrame:
    """Rows of ``selection`` beyond those ``held`` has, as a difference of multisets.

    Rows are compared by digest: of ``held`` only digests and counts are moved, and
    a row that repeats is moved once with its count.
    """
    columns = selection.columns
    has = held.groupBy(row_digest(held, columns).alias("_held")).agg(F.count(F.lit(1)).alias("_has"))
    row = F.struct(*[F.col(c) for c in columns])
    wanted = selection.groupBy(row_digest(selection, columns).alias("_digest")).agg(F.count(F.lit(1)).alias("_n"), F.any_value(row).alias("_row"))
    lack = wanted.join(has, F.col("_digest") == F.col("_held"), "left").withColumn("_lack", (F.col("_n") - F.coalesce("_has", F.lit(0))).cast("int"))
    times = lack.filter("_lack > 0").select("_row", F.explode(F.sequence(F.lit(1), F.col("_lack"))).alias("_i"))
    return times.select("_row.*")


__all__ = ["BATCH_COLUMN", "ArchiveResult", "archive_and_purge", "missing_rows", "row_digest"]
