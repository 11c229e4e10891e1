"""Change sets of the write steps (keyed by ``periodo`` and ``id_transaccion``).

Each function reads the driving DataFrame of one reference step and returns
the set of keys it touches, with the new values where there are any, so the
effect is inspectable before it is applied (see :mod:`movrec.operators.apply`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from movrec.functions.predicates import all_truthy, column_or_null, is_blank
from movrec.operators.apply import Constant
from movrec.operators.requests import as_date, guard_requests
from movrec.operators.sizing import materialize
from movrec.schema import NO_MATCH, REPOSTED_STATE, STANDIN, STANDIN_PARKED, VERDICT_COLUMN, WRITE_KEY
from movrec.sources.layouts import IdIndex
from movrec.sources.snapshot import restrict_period


def _two_ids(df: DataFrame) -> Column:
    return F.explode(F.array(column_or_null(df, "guid_ordenante"), column_or_null(df, "guid_beneficiario")))


# --- P2: mark the stand-in legs of every request as reposted ----------------
def mark_reposted_changes(req: DataFrame, mov: DataFrame, index: IdIndex | None = None) -> DataFrame:
    """P2 change set: ``STANDIN`` movements whose id is one of the request's two
    ids, with ``periodo >= periodo_tope`` (no upper bound), get the request's
    original document and state 10.

    The two-id OR becomes an explode + equi join.  When several requests write
    different documents to one movement, the reference keeps whichever commits
    last; here the largest document wins and ``n_documentos`` reports the
    conflict.  With an ``index`` only the periods that hold one of the ids are read,
    instead of every period from the least bound on.
    """
    g = guard_requests(req)
    ids = (
        g.select(
            _two_ids(g).alias("mk_id"),
            as_date(g, "periodo_tope", strict=False).alias("mk_lo"),
            column_or_null(g, "numero_documento_original").alias("mk_doc"),
        )
        .filter(F.col("mk_id").isNotNull() & F.col("mk_lo").isNotNull())
        .distinct()
    )
    ids_m = materialize(ids, {"_lo": F.min("mk_lo")})
    if ids_m.rows == 0:
        return _empty_marks(mov)
    if index is not None:
        mov = index.restrict(mov, ids_m, "mk_id", "mk_lo")
    standins = restrict_period(mov, ids_m.extras["_lo"], None).filter(
        F.col("tipo_procesamiento") == F.lit(STANDIN)
    ).select("periodo", "id_transaccion", "tipo_procesamiento")
    side = ids_m.side()
    hits = standins.join(
        side, (standins["id_transaccion"] == side["mk_id"]) & (standins["periodo"] >= side["mk_lo"])
    )
    return hits.groupBy("periodo", "id_transaccion", "tipo_procesamiento").agg(
        F.max("mk_doc").alias("numero_comprobante_reposting"),
        F.lit(REPOSTED_STATE).alias("estado_transaccion"),
        F.countDistinct("mk_doc").alias("n_documentos"),
    )


def mark_hits(req: DataFrame, mov: DataFrame) -> DataFrame:
    """Requests of ``req`` (with a ``_row`` each) that mark at least one movement: distinct ``_row``."""
    g = guard_requests(req)
    ids = g.select("_row", _two_ids(g).alias("mk_id"), as_date(g, "periodo_tope", strict=False).alias("mk_lo")).filter(
        F.col("mk_id").isNotNull() & F.col("mk_lo").isNotNull()
    )
    ids_m = materialize(ids, {"_lo": F.min("mk_lo")})
    side = ids_m.side()
    standins = restrict_period(mov, ids_m.extras["_lo"], None).filter(F.col("tipo_procesamiento") == F.lit(STANDIN))
    standins = standins.select("periodo", "id_transaccion")
    hit = (standins["id_transaccion"] == side["mk_id"]) & (standins["periodo"] >= side["mk_lo"])
    return standins.join(side, hit).select("_row").distinct()


def _empty_marks(mov: DataFrame) -> DataFrame:
    spark = mov.sparkSession
    return spark.createDataFrame(
        [],
        "periodo date, id_transaccion string, tipo_procesamiento string, "
        "numero_comprobante_reposting string, estado_transaccion int, n_documentos bigint",
    )


MARK_KEYS = ("periodo", "id_transaccion", "tipo_procesamiento")
MARK_ASSIGN = {"numero_comprobante_reposting": "numero_comprobante_reposting", "estado_transaccion": "estado_transaccion"}


# --- P4: delete both legs of each request (O3) ------------------------------
def request_leg_delete_keys(req: DataFrame) -> DataFrame:
    """P4 keys: (periodo, id) for both ids of every request with a truthy
    ``periodo`` and ``guid_ordenante``; a NULL beneficiary id matches nothing, nor
    does a ``periodo`` that is no date."""
    g = req.filter(all_truthy(req, ("periodo", "guid_ordenante")))
    return (
        g.select(as_date(g, "periodo", strict=False).alias("periodo"), _two_ids(g).alias("id_transaccion"))
        .filter(F.col("id_transaccion").isNotNull() & F.col("periodo").isNotNull())
        .distinct()
    )


# --- keyed outputs over transform results (O4, O5, O6) -----------------------
def result_keys(rows: DataFrame) -> DataFrame:
    """Distinct (periodo, id) of result rows whose ``periodo`` and id are truthy (a ``periodo`` that is no date has no key)."""
    g = rows.filter(all_truthy(rows, WRITE_KEY))
    keys = g.select(as_date(g, "periodo", strict=False).alias("periodo"), column_or_null(g, "id_transaccion").alias("id_transaccion"))
    return keys.filter(F.col("periodo").isNotNull()).distinct()


def unmatched_rows(matched: DataFrame) -> DataFrame:
    """O4 input: NO MATCH rows of transform A, without the verdict."""
    return matched.filter(F.col(VERDICT_COLUMN) == F.lit(NO_MATCH)).drop(VERDICT_COLUMN)


def park_unmatched_keys(matched: DataFrame, only_standin: bool = False) -> DataFrame:
    """P5 keys: every (periodo, id) in a NO MATCH group is parked, whatever its
    current type (core rows included, as the original does).

    ``only_standin=True`` parks only the group's ``'STANDIN'`` rows; the keys
    then carry ``tipo_procesamiento`` and apply with :data:`PARK_STANDIN_KEYS`.
    """
    rows = unmatched_rows(matched)
    if not only_standin:
        return result_keys(rows)
    rows = rows.filter(F.col("tipo_procesamiento") == F.lit(STANDIN))
    g = rows.filter(all_truthy(rows, WRITE_KEY))
    keys = g.select(as_date(g, "periodo", strict=False).alias("periodo"), "id_transaccion", "tipo_procesamiento")
    return keys.filter(F.col("periodo").isNotNull()).distinct()


PARK_STANDIN_KEYS = ("periodo", "id_transaccion", "tipo_procesamiento")


PARK_ASSIGN = {"tipo_procesamiento": Constant(STANDIN_PARKED)}


def parked_rows(rows: DataFrame) -> DataFrame:
    """O6 input: result rows currently parked."""
    return rows.filter(F.col("tipo_procesamiento") == F.lit(STANDIN_PARKED))


def release_parked_keys(rows: DataFrame) -> DataFrame:
    """P7 keys: (periodo, id) of parked result rows go back to ``STANDIN``."""
    return result_keys(parked_rows(rows))


RELEASE_ASSIGN = {"tipo_procesamiento": Constant(STANDIN)}


def archive_rows(rows: DataFrame) -> DataFrame:
    """result rows whose repost reference or type is blank (NULL or ``''``),
    without the verdict column; rows with both filled stay in the hot table."""
    return rows.filter(is_blank("numero_comprobante_reposting") | is_blank("tipo_procesamiento")).drop(VERDICT_COLUMN)
