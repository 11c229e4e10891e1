"""Transform A: reconcile stand-in requests against the movement snapshot.

For every guarded request the reference runs one correlated query: find the
ordering leg by id inside the request's period range, build four
(account, document) keys from it, return every movement carrying one of those
keys inside the range, and label the whole group MATCH when it holds both a
core repost (type NULL) and a stand-in (type ``'STANDIN'``).

Here the per-request loop is decorrelated into set-based joins over all
requests at once:

    requests --guard/collapse--> request keys (one row per distinct request)
      --(id, period range)--> legs                    [N1]
      --explode 4 pairs-----> key pairs                [A3] (multiplicity counted)
      --(account, doc, range)--> matched movements     [N2] (checkpointed)
      matched --bool_or per request--> verdict         [A1]
      matched + verdict --> 50 text columns + verdict

Scale notes: the request side is checkpointed and measured, then broadcast
only under the byte cap; otherwise the joins shuffle and AQE splits skewed
partitions.  All scans of the snapshot are restricted to the requests' period
range and to the columns they need: five for the legs, four for the verdict.
The verdict is a partial (map-side) aggregate straight over that join, so one
request that matches a third of the table never lands in a single task; it is
attached to the key pairs, and the 50 columns are joined once, lazily, with
the verdict already on the small side.  No matched rows are staged, and a
consumer that reads three result columns (the park step) scans only what they
need.  Duplicate requests and duplicate key pairs are counted, not
materialised, until the final local ``explode``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from movrec.functions.formatting import format_movements
from movrec.functions.predicates import all_truthy, column_or_null, strip_leading_zeros
from movrec.operators.keyfilter import possible_rows
from movrec.operators.sizing import Measured, materialize
from movrec.schema import MATCH, MATCH_KEY, MOVEMENT_COLUMNS, NO_MATCH, STANDIN, VERDICT_COLUMN
from movrec.sources.layouts import SALT, IdIndex, KeyedSnapshot, salt_matches
from movrec.sources.snapshot import restrict_period

REQUEST_GUARD = ("producto_ordenante", "producto_beneficiario", "numero_documento_original")
REQ_KEY = ("rq_guid", "rq_doc", "rq_lo", "rq_hi")


def as_date(df: DataFrame, name: str, strict: bool = True) -> Column:
    """A driving bound as a date (text is parsed, empty text is NULL, timestamps are truncated).

    Text that is no date ends a transform, as a failed statement ends the
    original's; with ``strict=False`` it is NULL, and :func:`no_date` tells it.
    """
    if name not in df.columns:
        return F.lit(None).cast("date")
    dtype = df.schema[name].dataType
    if isinstance(dtype, T.DateType):
        return F.col(name)
    if isinstance(dtype, T.StringType):
        text = F.nullif(F.col(name), F.lit(""))
        return F.to_date(text) if strict else text.try_cast("date")
    return F.col(name).cast("date")


def no_date(df: DataFrame, name: str) -> Column:
    """True where the column holds text that is neither empty nor a date."""
    if name not in df.columns or not isinstance(df.schema[name].dataType, T.StringType):
        return F.lit(False)
    return (F.col(name).isNotNull() & (F.col(name) != "")) & as_date(df, name, strict=False).isNull()


def guard_requests(req: DataFrame) -> DataFrame:
    """keep requests whose products and original document are all truthy."""
    return req.filter(all_truthy(req, REQUEST_GUARD))


def request_keys(req: DataFrame) -> DataFrame:
    """Distinct effective requests with their multiplicity ``rq_n``.

    A request's result depends only on (guid_ordenante, numero_documento_original,
    periodo_tope, periodo); identical ones are computed once and re-expanded at
    the end.  Requests whose id or bounds are missing, or whose range is empty,
    cannot match anything and are dropped here.
    """
    g = guard_requests(req)
    keyed = g.select(
        column_or_null(g, "guid_ordenante").alias("rq_guid"),
        column_or_null(g, "numero_documento_original").alias("rq_doc"),
        as_date(g, "periodo_tope").alias("rq_lo"),
        as_date(g, "periodo").alias("rq_hi"),
    ).filter(
        F.col("rq_guid").isNotNull()
        & F.col("rq_lo").isNotNull()
        & F.col("rq_hi").isNotNull()
        & (F.col("rq_lo") <= F.col("rq_hi"))
    )
    return keyed.groupBy(*REQ_KEY).agg(F.count(F.lit(1)).alias("rq_n"))


def measure_keys(keys: DataFrame, lo: str, hi: str) -> Measured:
    return materialize(keys, {"_lo": F.min(lo), "_hi": F.max(hi)})


def _in_range(period: Column, lo: str = "rq_lo", hi: str = "rq_hi") -> Column:
    return (period >= F.col(lo)) & (period <= F.col(hi))


def request_legs(keys: Measured, mov: DataFrame, index: IdIndex | None = None) -> DataFrame:
    """N1: movements whose id is the request's ordering id, inside its period range.

    With an ``index`` only the periods that hold such an id are read.
    """
    if index is not None:
        mov = index.restrict(mov, keys, "rq_guid", "rq_lo", "rq_hi")
    m = restrict_period(mov, keys.extras["_lo"], keys.extras["_hi"]).filter(F.col("id_transaccion").isNotNull())
    m = possible_rows(m, ("id_transaccion",), keys, ("rq_guid",))
    m = m.select(
        F.col("id_transaccion").alias("lg_id"),
        F.col("periodo").alias("lg_periodo"),
        F.col("numero_cuenta_id").alias("cuenta_ordenante"),
        strip_leading_zeros("cuenta_beneficiario").alias("cuenta_beneficiario"),
        F.col("numero_documento").alias("numero_documento"),
    )
    k = keys.side()
    return m.join(k, (F.col("lg_id") == F.col("rq_guid")) & _in_range(F.col("lg_periodo"))).select(
        *REQ_KEY, "rq_n", "cuenta_ordenante", "cuenta_beneficiario", "numero_documento"
    )


def request_key_pairs(legs: DataFrame) -> DataFrame:
    """A3: the four (account, document) keys of every leg, with multiplicity ``kp_m``.

    Ordering and beneficiary account × the leg's document and the request's
    original document.  Equal pairs are kept as a count (the reference's
    ``UNION ALL``); NULL parts never match and are dropped.
    """
    pairs = F.array(
        F.struct(F.col("cuenta_ordenante").alias("c"), F.col("numero_documento").alias("d")),
        F.struct(F.col("cuenta_beneficiario").alias("c"), F.col("numero_documento").alias("d")),
        F.struct(F.col("cuenta_ordenante").alias("c"), F.col("rq_doc").alias("d")),
        F.struct(F.col("cuenta_beneficiario").alias("c"), F.col("rq_doc").alias("d")),
    )
    exploded = legs.select(*REQ_KEY, "rq_n", F.explode(pairs).alias("p")).select(
        *REQ_KEY, "rq_n", F.col("p.c").alias("kp_cuenta"), F.col("p.d").alias("kp_documento")
    )
    return (
        exploded.filter(F.col("kp_cuenta").isNotNull() & F.col("kp_documento").isNotNull())
        .groupBy(*REQ_KEY, "rq_n", "kp_cuenta", "kp_documento")
        .agg(F.count(F.lit(1)).alias("kp_m"))
    )


def measure_pairs(pairs: DataFrame) -> Measured:
    return materialize(pairs, {"_lo": F.min("rq_lo"), "_hi": F.max("rq_hi")})


def _pair_join(mov: DataFrame, pairs: DataFrame) -> Column:
    return (
        (mov["numero_cuenta_id"] == pairs["kp_cuenta"])
        & (mov["numero_documento"] == pairs["kp_documento"])
        & _in_range(mov["periodo"])
        & salt_matches(mov, pairs)
    )


def pair_rows(pairs: Measured, mov: DataFrame) -> DataFrame:
    """The movements of the key pairs' span joined to the pairs they meet; above the cap others are not shuffled."""
    wide = restrict_period(mov, pairs.extras["_lo"], pairs.extras["_hi"])
    if SALT not in mov.columns:  # a keyed snapshot stays where it lies
        wide = possible_rows(wide, MATCH_KEY, pairs, ("kp_cuenta", "kp_documento"))
    p = pairs.side()
    return wide.join(p, _pair_join(wide, p))


def request_movements(pairs: Measured, mov: DataFrame, dedupe: bool = False, columns: tuple[str, ...] = MOVEMENT_COLUMNS) -> DataFrame:
    """N2: every movement carrying one of the request's keys inside its range.

    Returns the movement ``columns`` (typed), the request key, the verdict where
    ``pairs`` carry one, and ``_rep`` = how many times the row repeats in the
    result (duplicate requests times duplicate keys).  A movement has one
    (account, document), so it meets exactly one distinct key of a request:
    ``dedupe`` drops the key multiplicity and keeps one row per driving row and
    movement.
    """
    joined = pair_rows(pairs, mov)
    p = pairs.df
    rep = F.col("rq_n") if dedupe else F.col("rq_n") * F.col("kp_m")
    verdict = [VERDICT_COLUMN] if VERDICT_COLUMN in p.columns else []
    return joined.select(*columns, *REQ_KEY, *verdict, rep.alias("_rep"))


def request_verdict(matched: DataFrame) -> DataFrame:
    """A1: per request, MATCH when its movements hold a NULL type and a ``'STANDIN'`` type.

    Every request with at least one movement gets a verdict.  ``bool_or``
    aggregates map-side first, so a request matching a huge share of the
    table stays spread over many tasks.
    """
    flags = matched.groupBy(*REQ_KEY).agg(
        F.bool_or(F.col("tipo_procesamiento").isNull()).alias("has_core"),
        F.bool_or(F.col("tipo_procesamiento") == F.lit(STANDIN)).alias("has_standin"),
    )
    return flags.select(
        *REQ_KEY,
        F.when(F.col("has_core") & F.col("has_standin"), F.lit(MATCH)).otherwise(F.lit(NO_MATCH)).alias(VERDICT_COLUMN),
    )


def request_verdicts(pairs: Measured, mov: DataFrame) -> DataFrame:
    """A1 over the snapshot: one verdict per request with a movement, from the type column alone."""
    return request_verdict(request_movements(pairs, mov, columns=("tipo_procesamiento",)))


def judged_pairs(pairs: Measured, mov: DataFrame) -> Measured:
    """The key pairs with their request's verdict (pairs of requests without movements go).

    Both sides are at most one row per key pair, so the measured pairs bound
    the size of the verdicts: broadcast under the cap, else a shuffle join.
    """
    verdict = request_verdicts(pairs, mov)
    v = F.broadcast(verdict) if pairs.broadcastable else verdict
    return measure_pairs(pairs.df.join(v, list(REQ_KEY)))


def expand(df: DataFrame, count_col: str = "_rep") -> DataFrame:
    """Repeat each row ``count_col`` times (a local generate, no shuffle)."""
    return df.withColumn("_i", F.explode(F.sequence(F.lit(1), F.col(count_col).cast("int")))).drop("_i")


def prepare_pairs(req: DataFrame, mov: DataFrame, index: IdIndex | None = None) -> Measured | None:
    """Request keys → legs → key pairs (checkpointed and measured); ``None`` when no request survives."""
    keys = measure_keys(request_keys(req), "rq_lo", "rq_hi")
    if keys.rows == 0:
        return None
    return measure_pairs(request_key_pairs(request_legs(keys, mov, index)))


def empty_result(spark, with_verdict: bool) -> DataFrame:
    from movrec.schema import result_schema

    return spark.createDataFrame([], result_schema(with_verdict))


def match_requests(req: DataFrame, mov: DataFrame, dedupe: bool = False) -> DataFrame:
    """P1: the 50 movement columns as text plus ``reposting_completo``, one row per
    (driving request row, key occurrence, movement), as transform A returns them.

    ``dedupe=True`` drops the repetition that comes from equal keys of one
    request (the four key branches), keeping one row per driving row and
    movement.
    """
    pairs = prepare_pairs(req, mov)
    if pairs is None or pairs.rows == 0:
        return empty_result(mov.sparkSession, True)
    judged = judged_pairs(pairs, mov)
    if judged.rows == 0:
        return empty_result(mov.sparkSession, True)
    return format_movements(request_movements(judged, mov, dedupe), extra=(VERDICT_COLUMN,), repeat="_rep")


def match_requests_keyed(req: DataFrame, snapshot: KeyedSnapshot, dedupe: bool = False, index: IdIndex | None = None) -> DataFrame:
    """P1 over a snapshot bucketed by account and document: its 50 columns are joined where they lie.

    The same rows as :func:`match_requests`.  Above the broadcast cap only the key
    pairs are dealt to the buckets; the legs are still found by id, over five
    columns and, with an ``index``, the periods that hold them.
    """
    mov = snapshot.rows()
    pairs = prepare_pairs(req, mov, index)
    if pairs is None or pairs.rows == 0:
        return empty_result(mov.sparkSession, True)
    judged = judged_pairs(measure_pairs(snapshot.salted(pairs.df)), mov)
    if judged.rows == 0:
        return empty_result(mov.sparkSession, True)
    return format_movements(request_movements(judged, mov, dedupe), extra=(VERDICT_COLUMN,), repeat="_rep")
