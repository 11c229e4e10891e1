"""Verdicts kept up to date as movements arrive: only what an arrival touches is read and judged again.

Three append-only tables under one folder hold the state:

* ``flags``: for each account, document and period with a movement, whether it
  holds a core row (type NULL) and a stand-in;
* ``pairs``: the account and document keys of every request whose leg is known;
* ``judged``: for each request, which of the two kinds its keys have shown so far.

A movement can only add to what a request has seen, so an arrival appends the
kinds that the new movements show to the known keys, and those that all
movements show to the keys of newly found legs; a request's verdict is the
``bool_or`` of its rows.  Appending the same again changes nothing: an arrival
that a crash broke off is simply repeated.  (A later change of a movement's type
is no arrival: start a new state then.)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from movrec.operators import requests as rq
from movrec.operators.keyfilter import possible_rows
from movrec.operators.sizing import materialize
from movrec.schema import MATCH, NO_MATCH, STANDIN, VERDICT_COLUMN
from movrec.sources.layouts import IdIndex

FLAGS = "fl_cuenta string, fl_documento string, fl_periodo date, has_core boolean, has_standin boolean"
REQUEST = "rq_guid string, rq_doc string, rq_lo date, rq_hi date"
PAIRS = f"{REQUEST}, kp_cuenta string, kp_documento string"
PAIR_KEY, FLAG_KEY = ("kp_cuenta", "kp_documento"), ("fl_cuenta", "fl_documento")
JUDGED = f"{REQUEST}, has_core boolean, has_standin boolean"


class Verdicts:
    def __init__(self, spark: SparkSession, req: DataFrame, path: str):
        """State of the requests ``req`` in the folder ``path`` (an existing one is gone on with)."""
        self.spark, self.path = spark, path.rstrip("/")
        self.keys = rq.measure_keys(rq.request_keys(req), "rq_lo", "rq_hi")
        for name, schema in (("flags", FLAGS), ("pairs", PAIRS), ("judged", JUDGED)):
            spark.createDataFrame([], schema).write.mode("append").parquet(f"{self.path}/{name}")

    def _table(self, name: str, schema: str) -> DataFrame:
        return self.spark.read.schema(schema).parquet(f"{self.path}/{name}")

    def _append(self, name: str, rows: DataFrame) -> None:
        rows.write.mode("append").parquet(f"{self.path}/{name}")

    def arrive(self, new: DataFrame, index: IdIndex | None = None) -> DataFrame:
        """Take in movements that were not there before; returns the requests judged again (distinct)."""
        if self.keys.rows == 0:
            return self.spark.createDataFrame([], REQUEST)
        shown = materialize(kinds(new))
        pairs = self._table("pairs", PAIRS)
        found = rq.request_key_pairs(rq.request_legs(self.keys, new, index)).select(*pairs.columns).distinct()
        fresh = materialize(found.join(pairs, pairs.columns, "left_anti"))
        # legs first come to the keys known before; keys of new legs then look at every movement, these included
        known = possible_rows(pairs, PAIR_KEY, shown, FLAG_KEY)
        flags = possible_rows(self._table("flags", FLAGS).unionByName(shown.df), FLAG_KEY, fresh, PAIR_KEY)
        told = materialize(_seen(known, shown.side()).unionByName(_seen(fresh.side(), flags)))
        self._append("judged", told.df)
        self._append("flags", shown.df)
        self._append("pairs", fresh.df)
        return told.df.select(*rq.REQ_KEY).distinct()

    def verdicts(self) -> DataFrame:
        """One verdict per request with a movement, as :func:`requests.request_verdicts` gives over all movements."""
        both = self._table("judged", JUDGED).groupBy(*rq.REQ_KEY).agg(F.bool_or("has_core").alias("c"), F.bool_or("has_standin").alias("s"))
        return both.select(*rq.REQ_KEY, F.when(F.col("c") & F.col("s"), F.lit(MATCH)).otherwise(F.lit(NO_MATCH)).alias(VERDICT_COLUMN))


def kinds(mov: DataFrame) -> DataFrame:
    """The kinds of movement on each account, document and period (partial aggregates: a hot key collapses before the shuffle)."""
    keyed = mov.filter(F.col("numero_cuenta_id").isNotNull() & F.col("numero_documento").isNotNull() & F.col("periodo").isNotNull())
    key = (F.col("numero_cuenta_id").alias("fl_cuenta"), F.col("numero_documento").alias("fl_documento"), F.col("periodo").alias("fl_periodo"))
    tipo = F.col("tipo_procesamiento")
    return keyed.groupBy(*key).agg(F.bool_or(tipo.isNull()).alias("has_core"), F.coalesce(F.bool_or(tipo == F.lit(STANDIN)), F.lit(False)).alias("has_standin"))


def _seen(pairs: DataFrame, flags: DataFrame) -> DataFrame:
    """What each request of ``pairs`` finds in ``flags``: one row per request that finds anything."""
    on = (flags["fl_cuenta"] == pairs["kp_cuenta"]) & (flags["fl_documento"] == pairs["kp_documento"])
    on = on & (flags["fl_periodo"] >= pairs["rq_lo"]) & (flags["fl_periodo"] <= pairs["rq_hi"])
    return pairs.join(flags, on).groupBy(*rq.REQ_KEY).agg(F.bool_or("has_core").alias("has_core"), F.bool_or("has_standin").alias("has_standin"))
