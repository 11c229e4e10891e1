"""Entry points with the host framework's two call shapes.

``transform_*(spark, df, params) -> DataFrame`` and
``output_*(spark, df, write_options, params) -> OutputResult`` take the same
driving DataFrames as the reference's plug-ins.  Instead of one database
round trip per driving row, they read the movement snapshot once and return
set-based results; writes are change sets applied to a new snapshot version.

``params`` keys:

* the snapshot: ``SNAPSHOT_PATH`` (+ ``SNAPSHOT_FORMAT``), a Parquet or Delta
  table, or ``JDBC_URL`` and ``JDBC_TABLE`` (+ ``JDBC_USER``, ``ROOT_CERT``,
  ``CLIENT_CERT``, ``KEY_CERT``).  The JDBC read is split into
  ``JDBC_PARTITIONS`` queries (default 16) of about equal numbers of rows, from a
  histogram of periods that the database counts; a day that holds more than a
  part is cut by ``JDBC_HASH``, an expression of the database that hashes the id
  to whole numbers from 0 (known for PostgreSQL; without one a day stays whole).
  With ``JDBC_LOWER`` or ``JDBC_UPPER`` it is cut in equal ranges between them;
* where an output writes, one of: ``SNAPSHOT_OUT``, a new snapshot version that
  keeps the partitioning of the old; ``REWRITE_IN_PLACE`` (true), for a Parquet
  snapshot partitioned by ``periodo``: only the files that hold a touched row are
  rewritten; ``CHANGE_LOG`` (true), for a Parquet snapshot: the change set is
  committed to the log beside it (:mod:`movrec.operators.changelog`), and whoever
  names the snapshot here reads it with all committed changes;
  ``JDBC_STAGE_TABLE``, the change set loaded into a staging table of the
  database, for one set-based statement there; or ``DRY_RUN`` (true): nothing is
  written and the result is lazy.  An output with none of these raises;
* the archive: ``LAKE_PATH``, or ``LAKE_BUCKET``, ``LAKE_PREFIX`` and
  ``TABLE_NAME``; ``LAKE_FORMAT``; ``BATCH_ID``.

Every output evaluates its driving DataFrame once: the columns it needs are
materialised, and keys and status are both derived from that.  Driving columns
that are missing read as NULL, so their rows are skipped.  A driving row whose
period is text but no date fails by itself: its status names the reason, the
other rows go on.  In a transform such a row ends the job, as in the original.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from movrec.functions.predicates import all_truthy, column_or_null
from movrec.operators import apply as ap
from movrec.operators import changes as ch
from movrec.operators import requests as rq
from movrec.operators import windows as wn
from movrec.operators.archive import archive_and_purge
from movrec.operators.changelog import ChangeLog
from movrec.operators.sizing import Measured, materialize
from movrec.schema import REQUEST_COLUMNS, STANDIN, STATUS_COLUMN, VERDICT_COLUMN, WRITE_KEY
from movrec.sources.lake import lake_path
from movrec.sources.snapshot import (
    jdbc_period_bounds,
    load_snapshot,
    partitioned_by_period,
    read_jdbc_equal_depth,
    read_jdbc_snapshot,
    stage_changes_jdbc,
    write_snapshot,
)

JDBC_PARTITIONS = 16


def flag(params: dict, name: str) -> bool:
    """A yes/no parameter, given as a boolean or as text."""
    return str(params.get(name, "")).strip().lower() in ("1", "true", "yes")


def _jdbc_connection(params: dict) -> dict:
    return dict(
        url=params["JDBC_URL"], user=params.get("JDBC_USER"), root_cert=params.get("ROOT_CERT"),
        client_cert=params.get("CLIENT_CERT"), key_cert=params.get("KEY_CERT"),
    )


def _parquet(params: dict) -> bool:
    return bool(params.get("SNAPSHOT_PATH")) and params.get("SNAPSHOT_FORMAT", "parquet") == "parquet"


def snapshot_from_params(spark: SparkSession, params: dict) -> DataFrame:
    """The snapshot as it stands: an in-place rewrite that a crash broke off is finished, a change log laid over it."""
    if _parquet(params):
        ap.finish_rewrite(spark, params["SNAPSHOT_PATH"])
        log = ChangeLog(spark, params["SNAPSHOT_PATH"])
        if log.entries():
            return log.read()
    if params.get("SNAPSHOT_PATH"):
        return load_snapshot(spark, params["SNAPSHOT_PATH"], fmt=params.get("SNAPSHOT_FORMAT", "parquet"))
    if params.get("JDBC_URL"):
        kw = dict(_jdbc_connection(params), table=params["JDBC_TABLE"])
        lower, upper, parts = params.get("JDBC_LOWER"), params.get("JDBC_UPPER"), int(params.get("JDBC_PARTITIONS", JDBC_PARTITIONS))
        if lower is None and upper is None:
            return read_jdbc_equal_depth(spark, parts, params.get("JDBC_HASH"), **kw)
        if lower is None or upper is None:
            found = jdbc_period_bounds(spark, **kw)
            if found is None:  # no row has a period
                return read_jdbc_snapshot(spark, **kw)
            lower, upper = lower or found[0], upper or found[1]
        return read_jdbc_snapshot(spark, **kw, partition_column="periodo", lower_bound=lower, upper_bound=upper, num_partitions=parts)
    raise ValueError("params need SNAPSHOT_PATH, or JDBC_URL and JDBC_TABLE")


@dataclass
class OutputResult:
    snapshot: DataFrame  # the new snapshot version (lazy unless written)
    status: DataFrame  # one audit row per driving row
    change: DataFrame  # the change set: keys, and new values where there are any
    written_to: str | None = None

    def preview(self) -> DataFrame:
        """The bounded rows an operator's console shows; the action itself is never limited."""
        return ap.preview(self.status)


def _target(params: dict) -> str:
    """Which of the output targets the parameters name; checked before any work."""
    targets = [n for n in ("SNAPSHOT_OUT", "JDBC_STAGE_TABLE") if params.get(n)] + [n for n in ("REWRITE_IN_PLACE", "CHANGE_LOG", "DRY_RUN") if flag(params, n)]
    if len(targets) != 1:
        raise ValueError(f"an output needs one of SNAPSHOT_OUT, REWRITE_IN_PLACE, CHANGE_LOG, JDBC_STAGE_TABLE or DRY_RUN; got {targets or 'none'}")
    if targets[0] in ("REWRITE_IN_PLACE", "CHANGE_LOG") and not _parquet(params):
        raise ValueError(f"{targets[0]} needs a Parquet SNAPSHOT_PATH; table formats apply the change set with their MERGE")
    return targets[0]


def _finish(spark, params, mov, status, change: ap.Change) -> OutputResult:
    """Write what the target asks for; the audit describes the snapshot before that."""
    target, keys = _target(params), change.keys
    if target == "DRY_RUN":
        return OutputResult(change(mov), status, keys.df)
    status = materialize(status).df
    path = params.get("SNAPSHOT_PATH")
    if target == "JDBC_STAGE_TABLE":
        stage_changes_jdbc(keys.df, params["JDBC_STAGE_TABLE"], **_jdbc_connection(params))
        return OutputResult(change(mov), status, keys.df, params["JDBC_STAGE_TABLE"])
    if target == "CHANGE_LOG":
        log = ChangeLog(spark, path)
        log.commit(change)
        return OutputResult(log.read(), status, keys.df, log.log)
    if target == "REWRITE_IN_PLACE":
        if not partitioned_by_period(spark, path):
            raise ValueError(f"{path} is not partitioned by periodo: nothing can be rewritten in place")
        if ChangeLog(spark, path).entries():
            raise ValueError(f"{path} has a change log: commit to that (CHANGE_LOG), or write a new version (SNAPSHOT_OUT)")
        ap.rewrite_touched_partitions(spark, path, keys, change, schema=mov.schema, key_columns=change.columns)
        return OutputResult(load_snapshot(spark, path, schema=mov.schema), status, keys.df, path)
    out = params["SNAPSHOT_OUT"]
    kept = "periodo" if _parquet(params) and partitioned_by_period(spark, path) else None
    write_snapshot(change(mov), out, partition_by=kept)
    return OutputResult(load_snapshot(spark, out, schema=mov.schema), status, keys.df, out)


def _driving(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """The named columns (NULL where missing) with a row number, evaluated once."""
    picked = df.select(*[column_or_null(df, c).alias(c) for c in columns], F.monotonically_increasing_id().alias("_row"))
    return materialize(picked).df


def _reason(rows: DataFrame, name: str) -> Column:
    """Why a row cannot be carried out: its date is none (NULL if it is)."""
    return F.when(rq.no_date(rows, name), F.concat(F.lit(f"{name} is no date: "), F.col(name).cast("string")))


def _key_status(rows: DataFrame, mov: DataFrame, keys: tuple[str, ...] = WRITE_KEY) -> DataFrame:
    """One status per row; a row that failed has no period but the reason names what it gave."""
    read = {k: rq.as_date(rows, k, strict=False) if k == "periodo" else F.col(k) for k in keys}
    return ap.audit(rows, read, all_truthy(rows, WRITE_KEY), mov, keys, _reason(rows, "periodo")).select(*WRITE_KEY, STATUS_COLUMN, "outcome")


# --- transforms -----------------------------------------------------------------
def transform_requests(spark: SparkSession, df: DataFrame, params: dict) -> DataFrame:
    """Transform A: matched movements + verdict for every request row."""
    return rq.match_requests(df, snapshot_from_params(spark, params))


def transform_windows(spark: SparkSession, df: DataFrame, params: dict) -> DataFrame:
    """Transform B: every stand-in/core movement group of every window row."""
    return wn.match_windows(df, snapshot_from_params(spark, params))


# --- outputs --------------------------------------------------------------------
def _row_status(rows: DataFrame, ok: Column, found: DataFrame, shown: list[Column], reason: Column) -> DataFrame:
    """One status per driving row: ``found`` holds the ``_row`` of those that touch something."""
    hit = found.select("_row", F.lit(True).alias("_found"))
    ok = F.coalesce(ok, F.lit(False))
    flagged = rows.select("_row", *shown, ok.alias("_ok"), F.when(ok, reason).alias("_why")).join(hit, "_row", "left")
    names = [c for c in flagged.columns if c not in ("_row", "_ok", "_why", "_found")]
    return flagged.select(*names, ap.status_text("_why"), ap.outcome(F.col("_ok"), F.col("_found"), F.col("_why")).alias("outcome"))


def mark_requests(spark: SparkSession, df: DataFrame, write_options: dict, params: dict) -> OutputResult:
    """The write half of transform A: mark both stand-in legs of every request."""
    _target(params)
    mov = snapshot_from_params(spark, params)
    rows = _driving(df, REQUEST_COLUMNS)
    marks = materialize(ch.mark_reposted_changes(rows, mov))
    ids = [F.col("guid_ordenante"), F.col("guid_beneficiario")]
    status = _row_status(rows, all_truthy(rows, rq.REQUEST_GUARD), ch.mark_hits(rows, mov), ids, _reason(rows, "periodo_tope"))
    return _finish(spark, params, mov, status, ap.Change(marks, ch.MARK_KEYS, ch.MARK_ASSIGN))


def output_delete_legs(spark: SparkSession, df: DataFrame, write_options: dict, params: dict) -> OutputResult:
    """O3: delete both legs of each request (keyed on the request's period).

    A row is ``applied`` if the snapshot holds either of its legs.
    """
    _target(params)
    mov = snapshot_from_params(spark, params)
    rows = _driving(df, ("periodo", "guid_ordenante", "guid_beneficiario"))
    keys = materialize(ch.request_leg_delete_keys(rows))
    ok = all_truthy(rows, ("periodo", "guid_ordenante"))
    legs = rows.filter(ok).select(
        "_row", rq.as_date(rows, "periodo", strict=False).alias("periodo"), F.explode(F.array("guid_ordenante", "guid_beneficiario")).alias("id_transaccion")
    )
    found = legs.join(ap.present_keys(legs.select(*WRITE_KEY), mov, WRITE_KEY), list(WRITE_KEY)).select("_row").distinct()
    status = _row_status(rows, ok, found, [F.col("periodo").cast("string").alias("periodo"), F.col("guid_ordenante"), F.col("guid_beneficiario")], _reason(rows, "periodo"))
    return _finish(spark, params, mov, status, ap.Change(keys, WRITE_KEY))


def output_park(spark: SparkSession, df: DataFrame, write_options: dict, params: dict) -> OutputResult:
    """O4: park every key of NO MATCH groups.

    ``PARK_ONLY_STANDIN`` limits it to rows that are stand-ins now; only those are audited then.
    """
    _target(params)
    mov = snapshot_from_params(spark, params)
    matched = _driving(df, (*WRITE_KEY, "tipo_procesamiento", VERDICT_COLUMN))
    rows, only_standin = ch.unmatched_rows(matched), flag(params, "PARK_ONLY_STANDIN")
    if only_standin:
        rows = rows.filter(F.col("tipo_procesamiento") == F.lit(STANDIN))
    keys = materialize(ch.park_unmatched_keys(matched, only_standin=only_standin))
    key_cols = ch.PARK_STANDIN_KEYS if only_standin else WRITE_KEY
    return _finish(spark, params, mov, _key_status(rows, mov, key_cols), ap.Change(keys, key_cols, ch.PARK_ASSIGN))


def output_release(spark: SparkSession, df: DataFrame, write_options: dict, params: dict) -> OutputResult:
    """O6: release parked keys back to ``STANDIN``."""
    _target(params)
    mov = snapshot_from_params(spark, params)
    rows = ch.parked_rows(_driving(df, (*WRITE_KEY, "tipo_procesamiento")))
    keys = materialize(ch.result_keys(rows))
    return _finish(spark, params, mov, _key_status(rows, mov), ap.Change(keys, WRITE_KEY, ch.RELEASE_ASSIGN))


def output_archive(spark: SparkSession, df: DataFrame, write_options: dict, params: dict) -> OutputResult:
    """O5: append qualifying rows to the lake, then purge the keys the lake holds."""
    _target(params)
    mov = snapshot_from_params(spark, params)
    path = params.get("LAKE_PATH") or lake_path(params["LAKE_BUCKET"], params["TABLE_NAME"], params["LAKE_PREFIX"])
    missing = [F.lit(None).cast("string").alias(c) for c in (*WRITE_KEY, "numero_comprobante_reposting", "tipo_procesamiento") if c not in df.columns]
    rows = materialize(df.select("*", *missing)).df
    status = materialize(_key_status(ch.archive_rows(rows), mov)).df
    res = archive_and_purge(rows, mov, path, fmt=params.get("LAKE_FORMAT", "delta"), batch_id=params.get("BATCH_ID"))
    return _finish(spark, params, mov, status, ap.Change(res.keys, WRITE_KEY))
