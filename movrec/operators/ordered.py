"""Transform A in the order of its requests: every request reads what the ones before it committed.

The original takes its requests one by one: a request reads, then marks its two
stand-in legs, then commits.  A mark changes two columns of a row, the reposting
reference and the state, and neither decides what a request matches or how it is
judged.  Which rows a request returns is therefore the same as without an order,
and only those two columns depend on it: each returned row shows the latest mark
of its movement by an earlier request.  That is an as-of lookup, not a loop over
conflicting requests: marks and reads of a movement are sorted together and the
last mark is carried forward.  The table ends with each movement's last mark.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from movrec.functions.formatting import format_movements
from movrec.functions.predicates import column_or_null
from movrec.operators import apply as ap
from movrec.operators import changes as ch
from movrec.operators import requests as rq
from movrec.operators.sizing import materialize
from movrec.schema import MOVEMENT_COLUMNS, REPOSTED_STATE, STANDIN, VERDICT_COLUMN, WRITE_KEY
from movrec.sources.snapshot import restrict_period

ORDER = "orden"


def carry_last(events: DataFrame, key: Sequence[str], order: Sequence[str], value: str, out: str) -> DataFrame:
    """Add ``out``: the last non-null ``value`` at or before each row of the same key, in ``order``.

    Rows are range-partitioned by key and order, so a key of any size is spread
    over as many tasks as its rows need.  Every part carries by itself; a key that
    goes on from one part into later ones needs the last value before the part, at
    most two keys a part, and those few rows are broadcast.  ``order`` must not be
    null and be total within a key.
    """
    parts = materialize(events.repartitionByRange(*key, *order).withColumn("_part", F.spark_partition_id())).df
    inside = Window.partitionBy("_part", *key).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    carried = parts.withColumn(out, F.last(value, ignorenulls=True).over(inside))
    place = F.struct(*order)
    per = parts.groupBy(*key, "_part").agg(F.max_by(value, F.when(F.col(value).isNotNull(), place)).alias("_v"))
    spread = parts.groupBy(*key).agg(F.min("_part").alias("_a"), F.max("_part").alias("_b")).filter("_a < _b").drop("_a", "_b")
    before = Window.partitionBy(*key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    few = per.join(F.broadcast(spread), list(key), "left_semi").withColumn("_carry", F.last("_v", ignorenulls=True).over(before)).drop("_v")
    both = carried.join(F.broadcast(few), [*key, "_part"], "left")
    return both.withColumn(out, F.coalesce(out, "_carry")).drop("_carry", "_part")


@dataclass
class OrderedResult:
    matched: DataFrame  # the 50 columns as text, the verdict, and the request's order
    marks: DataFrame  # the last mark of each movement
    snapshot: DataFrame  # the snapshot with these marks


def mark_events(req: DataFrame, mov: DataFrame) -> DataFrame:
    """``periodo, id_transaccion, orden, documento``: every mark of a movement, with its request's order."""
    g = rq.guard_requests(req)
    ids = g.select(
        ch._two_ids(g).alias("mk_id"), rq.as_date(g, "periodo_tope", strict=False).alias("mk_lo"),
        column_or_null(g, "numero_documento_original").alias("documento"), F.col(ORDER),
    ).filter(F.col("mk_id").isNotNull() & F.col("mk_lo").isNotNull())
    asked = materialize(ids, {"_lo": F.min("mk_lo")})
    standins = restrict_period(mov, asked.extras["_lo"], None).filter(F.col("tipo_procesamiento") == F.lit(STANDIN)).select(*WRITE_KEY).distinct()
    side = asked.side()
    hits = standins.join(side, (standins["id_transaccion"] == side["mk_id"]) & (standins["periodo"] >= side["mk_lo"]))
    # a request whose two ids are one movement marks it once
    return hits.select(*WRITE_KEY, ORDER, "documento").distinct()


def match_ordered(req: DataFrame, mov: DataFrame) -> OrderedResult:
    """Every request in the order of its ``orden`` (one number each), as if they were carried out one by one."""
    marks = materialize(mark_events(req, mov)).df
    last = materialize(
        marks.groupBy(*WRITE_KEY).agg(F.max_by("documento", ORDER).alias("numero_comprobante_reposting"), F.lit(REPOSTED_STATE).alias("estado_transaccion"))
        .withColumn("tipo_procesamiento", F.lit(STANDIN))
    )
    snapshot = ap.apply_updates(mov, last, ch.MARK_KEYS, ch.MARK_ASSIGN)
    pairs = rq.prepare_pairs(req, mov)
    judged = None if pairs is None or pairs.rows == 0 else rq.judged_pairs(pairs, mov)
    if judged is None or judged.rows == 0:
        return OrderedResult(rq.empty_result(mov.sparkSession, True).withColumn(ORDER, F.lit(None).cast("bigint")), last.df, snapshot)

    # one row for each request instead of one per distinct request and a count
    g = rq.guard_requests(req)
    orders = g.select(
        column_or_null(g, "guid_ordenante").alias("rq_guid"), column_or_null(g, "numero_documento_original").alias("rq_doc"),
        rq.as_date(g, "periodo_tope").alias("rq_lo"), rq.as_date(g, "periodo").alias("rq_hi"), F.col(ORDER),
    )
    asked = rq.measure_pairs(judged.df.drop("rq_n").join(orders, list(rq.REQ_KEY)).withColumn("rq_n", F.lit(1)))

    def found(pairs, columns):
        return rq.pair_rows(pairs, mov).select(*columns, VERDICT_COLUMN, ORDER, F.col("kp_m").alias("_rep"))

    standin = F.col("tipo_procesamiento") == F.lit(STANDIN)
    reads = found(asked, (*WRITE_KEY, "tipo_procesamiento")).filter(standin).select(*WRITE_KEY, ORDER).distinct()
    reads = reads.join(marks.select(*WRITE_KEY).distinct(), list(WRITE_KEY), "left_semi")  # the others never change
    events = reads.withColumn("_mark", F.lit(0)).withColumn("documento", F.lit(None).cast("string"))
    events = events.unionByName(marks.withColumn("_mark", F.lit(1)))  # a request reads before it marks
    seen = carry_last(events, WRITE_KEY, (ORDER, "_mark"), "documento", "_doc").filter("_mark = 0 and _doc is not null")
    shown = materialize(seen.select(*[F.col(k).alias(f"_{k}") for k in WRITE_KEY], F.col(ORDER).alias("_orden"), "_doc"))

    # only requests that see a mark take their rows, 50 columns wide, to the marks; most see none
    seers = shown.df.select(F.col("_orden").alias("_seer")).distinct()
    seers = F.broadcast(seers) if shown.broadcastable else seers
    seeing = rq.measure_pairs(asked.df.join(seers, F.col(ORDER) == F.col("_seer"), "left_semi"))
    plain = rq.measure_pairs(asked.df.join(seers, F.col(ORDER) == F.col("_seer"), "left_anti"))
    current = found(plain, MOVEMENT_COLUMNS)
    if seeing.rows:
        rows, side = found(seeing, MOVEMENT_COLUMNS), shown.side()
        on = standin & (rows["periodo"] == side["_periodo"]) & (rows["id_transaccion"] == side["_id_transaccion"]) & (rows[ORDER] == side["_orden"])
        both = rows.join(side, on, "left")
        marked = F.col("_doc").isNotNull()
        new = {"numero_comprobante_reposting": F.col("_doc"), "estado_transaccion": F.lit(REPOSTED_STATE)}
        columns = [F.when(marked, new[c]).otherwise(F.col(c)).alias(c) if c in new else F.col(c) for c in MOVEMENT_COLUMNS]
        current = current.unionByName(both.select(*columns, VERDICT_COLUMN, ORDER, "_rep"))
    return OrderedResult(format_movements(current, extra=(VERDICT_COLUMN, ORDER), repeat="_rep"), last.df, snapshot)
