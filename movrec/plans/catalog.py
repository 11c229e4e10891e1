"""Named plans over the fixture inputs: one per operator of the inventory.

Each plan takes ``(spark, sf_dir)``, derives the movement snapshot, requests
and windows from the given tables and returns a DataFrame whose columns are
text (dates as ``yyyy-MM-dd``) or integers, so results compare exactly
against the DuckDB oracle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from movrec.functions.formatting import format_movements
from movrec.functions.predicates import all_truthy, strip_leading_zeros
from movrec.operators import apply as ap
from movrec.operators import changes as ch
from movrec.operators import requests as rq
from movrec.operators import windows as wn
from movrec.operators.archive import BATCH_COLUMN, archive_and_purge
from movrec.operators.changelog import ChangeLog
from movrec.operators.ordered import match_ordered
from movrec.operators.sizing import materialize
from movrec.operators.staircases import match_windows_overlapping
from movrec.operators.verdicts import Verdicts
from movrec.plans import host
from movrec.schema import DATE_PATTERN, WRITE_KEY, movement_schema
from movrec.session import ensure_checkpoint_dir, scratch_path
from movrec.sources.fixtures import borrados_texto, fixture_snapshot, fixture_snapshot_place, solicitudes, ventanas, ventanas_clientes
from movrec.sources.lake import lake_path
from movrec.sources.layouts import IdIndex, KeyedSnapshot
from movrec.sources.snapshot import load_snapshot, write_clustered

Plan = Callable[[SparkSession, str], DataFrame]


def _day(c: str | Column) -> Column:
    return F.date_format(F.col(c) if isinstance(c, str) else c, DATE_PATTERN)


def movements(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_checkpoint_dir(spark)
    return fixture_snapshot(spark, sf_dir)


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return solicitudes(spark, sf_dir)


def windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ventanas(spark, sf_dir)


# --- projections and scalar functions ----------------------------------------
def q_format_movements(spark, sf_dir):
    return format_movements(movements(spark, sf_dir))


def q_strip_leading_zeros(spark, sf_dir):
    m = movements(spark, sf_dir)
    return m.select(
        "id_transaccion",
        "cuenta_beneficiario",
        strip_leading_zeros("cuenta_beneficiario").alias("cuenta_beneficiario_sin_ceros"),
    )


# --- transform A ----------------------------------------------------------------
def q_guard_requests(spark, sf_dir):
    g = rq.guard_requests(requests(spark, sf_dir))
    return g.select(
        "producto_ordenante",
        "producto_beneficiario",
        "numero_documento_original",
        _day("periodo").alias("periodo"),
        _day("periodo_tope").alias("periodo_tope"),
        "guid_ordenante",
        "guid_beneficiario",
    )


def _request_cols() -> list[Column]:
    return [
        F.col("rq_guid").alias("guid_ordenante"),
        F.col("rq_doc").alias("numero_documento_original"),
        _day("rq_lo").alias("periodo_tope"),
        _day("rq_hi").alias("periodo"),
    ]


def q_request_leg_lookup(spark, sf_dir):
    mov, req = movements(spark, sf_dir), requests(spark, sf_dir)
    keys = rq.measure_keys(rq.request_keys(req), "rq_lo", "rq_hi")
    legs = rq.request_legs(keys, mov).withColumn("_rep", F.col("rq_n"))
    return rq.expand(legs).select(*_request_cols(), "cuenta_ordenante", "cuenta_beneficiario", "numero_documento")


def _pairs(spark, sf_dir):
    mov, req = movements(spark, sf_dir), requests(spark, sf_dir)
    return mov, rq.prepare_pairs(req, mov)


def q_request_key_pairs(spark, sf_dir):
    _, pairs = _pairs(spark, sf_dir)
    p = pairs.df.withColumn("_rep", F.col("rq_n") * F.col("kp_m"))
    return rq.expand(p).select(*_request_cols(), F.col("kp_cuenta").alias("cuenta"), F.col("kp_documento").alias("documento"))


def q_request_movements(spark, sf_dir):
    mov, pairs = _pairs(spark, sf_dir)
    rows = rq.request_movements(pairs, mov)
    return rq.expand(rows).select(
        *_request_cols(),
        "id_transaccion",
        _day("periodo").alias("periodo_movimiento"),
        "tipo_procesamiento",
    )


def q_request_verdict(spark, sf_dir):
    mov, pairs = _pairs(spark, sf_dir)
    return rq.request_verdicts(pairs, mov).select(*_request_cols(), "reposting_completo")


def q_match_requests(spark, sf_dir):
    return rq.match_requests(requests(spark, sf_dir), movements(spark, sf_dir))


def _marks(spark, sf_dir):
    mov, req = movements(spark, sf_dir), requests(spark, sf_dir)
    return mov, ch.mark_reposted_changes(req, mov)


def q_mark_reposted_changes(spark, sf_dir):
    _, marks = _marks(spark, sf_dir)
    return marks.select(
        _day("periodo").alias("periodo"),
        "id_transaccion",
        "tipo_procesamiento",
        "numero_comprobante_reposting",
        "estado_transaccion",
        "n_documentos",
    )


def q_mark_reposted_apply(spark, sf_dir):
    mov, marks = _marks(spark, sf_dir)
    return format_movements(ap.apply_updates(mov, materialize(marks), ch.MARK_KEYS, ch.MARK_ASSIGN))


def q_match_requests_dedupe(spark, sf_dir):
    return rq.match_requests(requests(spark, sf_dir), movements(spark, sf_dir), dedupe=True)


def q_match_requests_after_mark(spark, sf_dir):
    from movrec.plans.batch import reconcile_batch

    return reconcile_batch(requests(spark, sf_dir), movements(spark, sf_dir), read_after_mark=True).matched


def q_reconcile_batch(spark, sf_dir):
    from movrec.plans.batch import reconcile_batch

    return format_movements(reconcile_batch(requests(spark, sf_dir), movements(spark, sf_dir)).snapshot)


def _index(spark, mov: DataFrame) -> IdIndex:
    """Built over one part of the snapshot, then extended by the rest, as movements come in."""
    first = F.pmod(F.xxhash64("id_transaccion"), F.lit(3)) > 0
    index = IdIndex.build(mov.filter(first), scratch_path(spark, "ids"))
    index.add(mov.filter(~first))
    return index


def q_leg_lookup_indexed(spark, sf_dir):
    mov, req = movements(spark, sf_dir), requests(spark, sf_dir)
    keys = rq.measure_keys(rq.request_keys(req), "rq_lo", "rq_hi")
    legs = rq.request_legs(keys, mov, _index(spark, mov)).withColumn("_rep", F.col("rq_n"))
    return rq.expand(legs).select(*_request_cols(), "cuenta_ordenante", "cuenta_beneficiario", "numero_documento")


def q_mark_indexed(spark, sf_dir):
    mov, req = movements(spark, sf_dir), requests(spark, sf_dir)
    marks = ch.mark_reposted_changes(req, mov, _index(spark, mov))
    return marks.withColumn("periodo", _day("periodo"))


def q_match_requests_bucketed(spark, sf_dir):
    mov = movements(spark, sf_dir)
    keyed = KeyedSnapshot.write(mov, scratch_path(spark, "keyed"))
    return rq.match_requests_keyed(requests(spark, sf_dir), keyed)


def q_reconcile_ordered(spark, sf_dir):
    """Every request reads what the earlier ones marked; the rows it returned, and the table in the end."""
    done = match_ordered(requests(spark, sf_dir), movements(spark, sf_dir))
    matched = done.matched.withColumn("orden", F.col("orden").cast("bigint")).withColumn("place", F.lit("matched"))
    return matched.unionByName(format_movements(done.snapshot).withColumn("place", F.lit("snapshot")), allowMissingColumns=True)


def q_verdict_incremental(spark, sf_dir):
    """The verdicts after each of three arrivals that together are the snapshot."""
    mov = movements(spark, sf_dir)
    kind = F.when(F.col("id_transaccion").like("S%"), 0).when(F.col("id_transaccion").like("C%"), 1).otherwise(2)
    turn = (F.col("orden_registro").cast("bigint") + kind) % 3
    state, out = Verdicts(spark, requests(spark, sf_dir), scratch_path(spark, "verdicts")), []
    for n in range(3):
        state.arrive(mov.filter(turn == n))
        now = materialize(state.verdicts()).df
        out.append(now.select(F.lit(n + 1).alias("arrival"), *_request_cols(), "reposting_completo"))
    return out[0].unionByName(out[1]).unionByName(out[2])


# --- transform B ----------------------------------------------------------------
def _window_cols() -> list[Column]:
    return [_day("wn_lo").alias("periodo_tope"), _day("wn_hi").alias("periodo")]


def q_guard_windows(spark, sf_dir):
    """F2 over a window set that grows with the data; some bounds are NULL or empty."""
    return wn.guard_windows(ventanas_clientes(spark, sf_dir)).select("periodo", "periodo_tope")


def _bins(spark, sf_dir):
    from movrec.operators.ranges import window_bins

    mov, win = movements(spark, sf_dir), windows(spark, sf_dir)
    return mov, window_bins(wn.window_keys(win), "wn_lo", "wn_hi")


def q_window_standins(spark, sf_dir):
    mov, bins = _bins(spark, sf_dir)
    s = wn.window_standins(bins, mov).withColumn("_rep", F.col("wn_n"))
    return rq.expand(s).select(*_window_cols(), "numero_cuenta_id", "numero_documento", "numero_comprobante_reposting")


def q_window_core_pairs(spark, sf_dir):
    mov, bins = _bins(spark, sf_dir)
    matched = wn.window_matched_standins(bins, mov)
    return matched.select(
        *_window_cols(),
        "cuenta",
        F.col("documento_core").alias("numero_documento"),
        F.col("documento_standin").alias("numero_comprobante_standin"),
    )


def q_window_key_union(spark, sf_dir):
    mov, bins = _bins(spark, sf_dir)
    matched = wn.window_matched_standins(bins, mov)
    keys = wn.window_key_union(matched).withColumn("_rep", F.col("wn_n"))
    return rq.expand(keys).select(*_window_cols(), "cuenta", "documento")


def q_match_windows(spark, sf_dir):
    return wn.match_windows(windows(spark, sf_dir), movements(spark, sf_dir))


def q_match_windows_overlapping(spark, sf_dir):
    """One window per customer, most of which overlap others; some have no bounds."""
    return match_windows_overlapping(ventanas_clientes(spark, sf_dir), movements(spark, sf_dir))


# --- outputs ---------------------------------------------------------------------
def q_request_leg_delete(spark, sf_dir):
    mov, req = movements(spark, sf_dir), requests(spark, sf_dir)
    keys = materialize(ch.request_leg_delete_keys(req))
    return format_movements(ap.apply_deletes(mov, keys, WRITE_KEY))


def q_request_leg_delete_rows(spark, sf_dir):
    mov, req = movements(spark, sf_dir), requests(spark, sf_dir)
    keys = materialize(ch.request_leg_delete_keys(req))
    return format_movements(ap.touched_rows(mov, keys, WRITE_KEY))


def q_park_unmatched(spark, sf_dir):
    mov = movements(spark, sf_dir)
    matched = q_match_requests(spark, sf_dir)
    keys = materialize(ch.park_unmatched_keys(matched))
    return format_movements(ap.apply_updates(mov, keys, WRITE_KEY, ch.PARK_ASSIGN))


def q_park_unmatched_standin_only(spark, sf_dir):
    mov = movements(spark, sf_dir)
    matched = q_match_requests(spark, sf_dir)
    keys = materialize(ch.park_unmatched_keys(matched, only_standin=True))
    return format_movements(ap.apply_updates(mov, keys, ch.PARK_STANDIN_KEYS, ch.PARK_ASSIGN))


def q_release_parked(spark, sf_dir):
    mov = movements(spark, sf_dir)
    found = q_match_windows(spark, sf_dir)
    keys = materialize(ch.release_parked_keys(found))
    return format_movements(ap.apply_updates(mov, keys, WRITE_KEY, ch.RELEASE_ASSIGN))


def _archive(spark, sf_dir):
    mov = movements(spark, sf_dir)
    found = q_match_windows(spark, sf_dir)
    lake = lake_path(scratch_path(spark, "lake"), "movimientos", "archive/cold")
    return archive_and_purge(found, mov, lake, fmt="parquet", batch_id="b1")


def q_archive_rows(spark, sf_dir):
    return _archive(spark, sf_dir).archived.drop(BATCH_COLUMN)


def q_purge_archived(spark, sf_dir):
    return format_movements(_archive(spark, sf_dir).remaining)


def q_archive_rerun(spark, sf_dir):
    """The lake after a half-appended batch, its rerun with all rows and one with fewer; every row stands once."""
    mov = movements(spark, sf_dir)
    found = materialize(q_match_windows(spark, sf_dir)).df
    half = found.filter(F.col("orden_registro").cast("bigint") % 4 == 0)
    lake = scratch_path(spark, "lake")
    for rows in (half, found, half):
        last = archive_and_purge(rows, mov, lake, fmt="parquet", batch_id="b1")
    hot = format_movements(last.remaining).withColumn("place", F.lit("hot"))
    return last.archived.drop(BATCH_COLUMN).withColumn("place", F.lit("lake")).unionByName(hot)


def _partitioned(spark, sf_dir) -> str:
    """A copy of the snapshot, partitioned by period, that outputs may rewrite."""
    mov = movements(spark, sf_dir)  # lies by period already
    return write_clustered(mov, scratch_path(spark, "in-place"), partition_by="periodo")


def q_request_leg_delete_in_place(spark, sf_dir):
    """O3 in place, read back from disk."""
    path = _partitioned(spark, sf_dir)
    host.output_delete_legs(spark, requests(spark, sf_dir), {}, {"SNAPSHOT_PATH": path, "REWRITE_IN_PLACE": "true"})
    return format_movements(load_snapshot(spark, path, schema=movement_schema()))


def q_purge_in_place(spark, sf_dir):
    """O5 in place, read back from disk."""
    path = _partitioned(spark, sf_dir)
    params = {"SNAPSHOT_PATH": path, "REWRITE_IN_PLACE": "true", "LAKE_PATH": scratch_path(spark, "lake"), "LAKE_FORMAT": "parquet", "BATCH_ID": "b1"}
    host.output_archive(spark, q_match_windows(spark, sf_dir), {}, params)
    return format_movements(load_snapshot(spark, path, schema=movement_schema()))


def _logged(spark, sf_dir, compact: bool) -> ChangeLog:
    """Mark, park, delete and release committed to a log, in this order; each step reads what the ones before it left."""
    ensure_checkpoint_dir(spark)
    path, schema = fixture_snapshot_place(spark, sf_dir)
    log = ChangeLog(spark, path, scratch_path(spark, "changes"), schema)
    req = requests(spark, sf_dir)
    before = log.read()
    marks = materialize(ch.mark_reposted_changes(req, before))
    park = materialize(ch.park_unmatched_keys(rq.match_requests(req, before)))
    log.commit(ap.Change(marks, ch.MARK_KEYS, ch.MARK_ASSIGN))
    log.commit(ap.Change(park, WRITE_KEY, ch.PARK_ASSIGN))
    log.commit(ap.Change(materialize(ch.request_leg_delete_keys(req)), WRITE_KEY))
    if compact:
        log.compact()
        log.clean()
    found = wn.match_windows(windows(spark, sf_dir), log.read())
    log.commit(ap.Change(materialize(ch.release_parked_keys(found)), WRITE_KEY, ch.RELEASE_ASSIGN))
    return log


def q_overlay_snapshot(spark, sf_dir):
    """The base with four change sets laid over it."""
    return format_movements(_logged(spark, sf_dir, compact=False).read())


def q_overlay_compacted(spark, sf_dir):
    """Three change sets folded into a new base, the fourth laid over that."""
    return format_movements(_logged(spark, sf_dir, compact=True).read())


def q_park_in_place(spark, sf_dir):
    """O4 in place, by file, read back from disk."""
    path = _partitioned(spark, sf_dir)
    params = {"SNAPSHOT_PATH": path, "REWRITE_IN_PLACE": "true"}
    host.output_park(spark, q_match_requests(spark, sf_dir), {}, params)
    return format_movements(load_snapshot(spark, path, schema=movement_schema()))


def _audited(spark, sf_dir) -> DataFrame:
    """Parked rows audited after the leg delete: some keys are gone, some rows have none."""
    mov, req = movements(spark, sf_dir), requests(spark, sf_dir)
    left = ap.apply_deletes(mov, materialize(ch.request_leg_delete_keys(req)), WRITE_KEY)
    parked = ch.parked_rows(q_match_windows(spark, sf_dir))
    key = {"periodo": rq.as_date(parked, "periodo"), "id_transaccion": F.col("id_transaccion")}
    return ap.audit(parked, key, all_truthy(parked, WRITE_KEY), left, WRITE_KEY)


def q_action_audit(spark, sf_dir):
    return _audited(spark, sf_dir).select(_day("periodo").alias("periodo"), "id_transaccion", "delete_status", "outcome")


def q_action_failures(spark, sf_dir):
    """The audit of a leg delete some of whose rows hold no date, and what the others left."""
    path, _ = fixture_snapshot_place(spark, sf_dir)
    done = host.output_delete_legs(spark, borrados_texto(spark, sf_dir), {}, {"SNAPSHOT_PATH": path, "DRY_RUN": True})
    left = done.snapshot.select(_day("periodo").alias("periodo"), F.col("id_transaccion").alias("guid_ordenante"))
    return done.status.unionByName(left.withColumn("outcome", F.lit("left")), allowMissingColumns=True)


def q_status_preview(spark, sf_dir):
    """How many rows the preview of the audit shows (which ones is unspecified)."""
    return ap.preview(_audited(spark, sf_dir)).agg(F.count(F.lit(1)).alias("n_rows"))


PLANS: dict[str, Plan] = {
    "format_movements": q_format_movements,
    "guard_requests": q_guard_requests,
    "strip_leading_zeros": q_strip_leading_zeros,
    "request_leg_lookup": q_request_leg_lookup,
    "request_key_pairs": q_request_key_pairs,
    "request_movements": q_request_movements,
    "request_verdict": q_request_verdict,
    "match_requests": q_match_requests,
    "match_requests_dedupe": q_match_requests_dedupe,
    "mark_reposted_changes": q_mark_reposted_changes,
    "mark_reposted_apply": q_mark_reposted_apply,
    "leg_lookup_indexed": q_leg_lookup_indexed,
    "mark_indexed": q_mark_indexed,
    "match_requests_bucketed": q_match_requests_bucketed,
    "reconcile_ordered": q_reconcile_ordered,
    "verdict_incremental": q_verdict_incremental,
    "match_requests_after_mark": q_match_requests_after_mark,
    "reconcile_batch": q_reconcile_batch,
    "guard_windows": q_guard_windows,
    "window_standins": q_window_standins,
    "window_core_pairs": q_window_core_pairs,
    "window_key_union": q_window_key_union,
    "match_windows": q_match_windows,
    "match_windows_overlapping": q_match_windows_overlapping,
    "request_leg_delete": q_request_leg_delete,
    "request_leg_delete_rows": q_request_leg_delete_rows,
    "park_unmatched": q_park_unmatched,
    "park_unmatched_standin_only": q_park_unmatched_standin_only,
    "release_parked": q_release_parked,
    "archive_rows": q_archive_rows,
    "purge_archived": q_purge_archived,
    "archive_rerun": q_archive_rerun,
    "request_leg_delete_in_place": q_request_leg_delete_in_place,
    "purge_in_place": q_purge_in_place,
    "park_in_place": q_park_in_place,
    "overlay_snapshot": q_overlay_snapshot,
    "overlay_compacted": q_overlay_compacted,
    "action_audit": q_action_audit,
    "action_failures": q_action_failures,
    "status_preview": q_status_preview,
}
