"""Bucketed companions of a movement snapshot: an index from ids to periods, and a copy keyed for matching.

Both are tables of the session's catalog with files at a path of the caller's, so
their bucketing is known to the planner: a join on the bucketed columns moves
only the other side.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from movrec.operators.sizing import Measured, materialize
from movrec.schema import MOVEMENT_COLUMNS

INDEX_ROWS_PER_BUCKET = 20_000_000
MOVEMENTS_PER_BUCKET = 2_000_000


def _bucket_count(rows: int, per_bucket: int, least: int) -> int:
    """Buckets for a table of this size: a power of two, so that tables of different sizes still divide each other."""
    wanted = max(least, -(-rows // per_bucket))
    return 1 << (wanted - 1).bit_length()


def _table_name(kind: str) -> str:
    return f"movrec_{kind}_{uuid.uuid4().hex}"


# --- ids to periods -----------------------------------------------------------------
@dataclass
class IdIndex:
    """Which periods hold a movement id: one narrow row per (id, period), bucketed by id.

    Lookups by id alone (the ordering leg, the repost mark with its open upper
    bound) then read the snapshot's partitions of the found periods instead of
    every period of their range.  Rows of deleted movements may stay: they name a
    period too many, never one too few.
    """

    spark: SparkSession
    table: str
    buckets: int

    @staticmethod
    def _pairs(mov: DataFrame) -> DataFrame:
        return mov.filter(F.col("id_transaccion").isNotNull() & F.col("periodo").isNotNull()).select("id_transaccion", "periodo").distinct()

    @staticmethod
    def build(mov: DataFrame, path: str, rows: int | None = None, least: int = 8) -> IdIndex:
        """Index ``mov`` with files at ``path``; ``rows`` (about how many) sizes the buckets, counted if not given."""
        index = IdIndex(mov.sparkSession, _table_name("ids"), _bucket_count(mov.count() if rows is None else rows, INDEX_ROWS_PER_BUCKET, least))
        index._write(mov, path)
        return index

    def _write(self, mov: DataFrame, path: str | None, mode: str = "errorifexists") -> None:
        dealt = self._pairs(mov).repartition(self.buckets, "id_transaccion")
        writer = dealt.write.mode(mode).format("parquet").bucketBy(self.buckets, "id_transaccion").sortBy("id_transaccion")
        if path:
            writer = writer.option("path", path)
        writer.saveAsTable(self.table)

    def add(self, movements: DataFrame) -> None:
        """Index movements that come into the snapshot; only their own pairs are written."""
        self._write(movements, None, "append")

    def rows(self) -> DataFrame:
        return self.spark.table(self.table)

    def periods(self, wanted: Measured, id_col: str, lo: str, hi: str | None = None) -> list:
        """The periods from ``lo`` (to ``hi``) that hold a wanted id: at most one value for each period of the snapshot."""
        ix, w = self.rows(), wanted.side()
        on = (ix["id_transaccion"] == w[id_col]) & (ix["periodo"] >= w[lo])
        if hi is not None:
            on = on & (ix["periodo"] <= w[hi])
        return sorted(r[0] for r in ix.join(w, on, "left_semi").select("periodo").distinct().collect())

    def restrict(self, mov: DataFrame, wanted: Measured, id_col: str, lo: str, hi: str | None = None) -> DataFrame:
        """``mov`` limited to the periods that hold a wanted id, as literals that prune partitions."""
        found = self.periods(wanted, id_col, lo, hi)
        return mov.filter(F.col("periodo").isin(found)) if found else mov.limit(0)


# --- account and document ------------------------------------------------------------
SALT = "_salt"


@dataclass
class KeyedSnapshot:
    """A snapshot bucketed and sorted by account and document, so that key joins leave it where it is.

    A bucket is read by one task.  Keys with more rows than a bucket should hold
    are therefore spread over salts when the table is written, and a lookup of
    such a key asks for each of its salts; at most ``rows / rows per bucket`` keys
    can be that large, so the list of them is broadcast.
    """

    spark: SparkSession
    table: str
    hot: DataFrame  # hk_cuenta, hk_documento, hk_salts: few rows, see above
    buckets: int

    @staticmethod
    def write(mov: DataFrame, path: str, per_bucket: int = MOVEMENTS_PER_BUCKET, least: int = 8) -> KeyedSnapshot:
        spark = mov.sparkSession
        counts = mov.groupBy(F.col("numero_cuenta_id").alias("hk_cuenta"), F.col("numero_documento").alias("hk_documento")).agg(F.count(F.lit(1)).alias("n"))
        named = counts.filter(F.col("hk_cuenta").isNotNull() & F.col("hk_documento").isNotNull() & (F.col("n") > per_bucket))
        hot = materialize(named.select("hk_cuenta", "hk_documento", F.ceil(F.col("n") / per_bucket).cast("int").alias("hk_salts"))).df
        buckets = _bucket_count(mov.count(), per_bucket, least)
        key = (F.col("numero_cuenta_id") == F.col("hk_cuenta")) & (F.col("numero_documento") == F.col("hk_documento"))
        # rows without a key match nothing: they are spread by their content as well
        spread = F.pmod(F.xxhash64("id_transaccion", "orden_registro", "periodo", "valor_transaccion"), F.coalesce("hk_salts", F.lit(buckets))).cast("int")
        keyless = F.col("numero_cuenta_id").isNull() | F.col("numero_documento").isNull()
        salted = mov.join(F.broadcast(hot), key, "left").withColumn(SALT, F.when(F.col("hk_salts").isNotNull() | keyless, spread).otherwise(0))
        columns = ("numero_cuenta_id", "numero_documento", SALT)
        dealt = salted.select(*MOVEMENT_COLUMNS, SALT).repartition(buckets, *columns)
        table = _table_name("keyed")
        dealt.write.format("parquet").bucketBy(buckets, *columns).sortBy(*columns, "periodo").option("path", path).saveAsTable(table)
        return KeyedSnapshot(spark, table, hot, buckets)

    def rows(self) -> DataFrame:
        """The 50 columns and the salt."""
        return self.spark.table(self.table)

    def salted(self, pairs: DataFrame) -> DataFrame:
        """Key pairs with the salt they look for, a hot key once for each of its salts."""
        on = (F.col("kp_cuenta") == F.col("hk_cuenta")) & (F.col("kp_documento") == F.col("hk_documento"))
        salts = F.sequence(F.lit(0), F.coalesce(F.col("hk_salts"), F.lit(1)) - 1)
        return pairs.join(F.broadcast(self.hot), on, "left").withColumn("kp_salt", F.explode(salts)).drop("hk_cuenta", "hk_documento", "hk_salts")


def salt_matches(mov: DataFrame, pairs: DataFrame) -> Column:
    """The salt's part of a key join; true where the sides carry none."""
    return mov[SALT] == pairs["kp_salt"] if SALT in mov.columns and "kp_salt" in pairs.columns else F.lit(True)
