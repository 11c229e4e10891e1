"""Table access, folds, reliable materialisation and running sums."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable, Sequence
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from movrec.session import ensure_checkpoint_dir, scratch_path

UPPER, LOWERED = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Send this package's modules to the Python workers, once for each Spark application."""
    sc = spark.sparkContext
    if getattr(sc, "_movrec_shipped", False):
        return
    root = Path(__file__).resolve().parents[1]
    packed = Path(tempfile.mkdtemp()) / "movrec_modules.zip"
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as z:
        for path in sorted(root.rglob("*.py")):
            z.write(path, path.relative_to(root.parent))
    sc.addPyFile(str(packed))
    sc._movrec_shipped = True


def arrow_map(df: DataFrame, run: Callable, schema) -> DataFrame:
    """``mapInArrow`` with this package on the workers' path."""
    ship(df.sparkSession)
    return df.mapInArrow(run, schema)


def settle(df: DataFrame) -> DataFrame:
    """A reliable checkpoint in the shared folder: evaluated once, lineage cut."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """``df`` written as Parquet under the shared folder and read again: evaluated once, columnar, compressed."""
    path = scratch_path(df.sparkSession, "llm")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ascii_lower(c: Column) -> Column:
    return F.translate(c, UPPER, LOWERED)


def held_out(doc_id: str = "doc_id") -> Column:
    """True for rows kept away from every fit: crc32(doc_id as text) mod 3 is 1 (a null id: false)."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))


def text_key(c: str = "text") -> Column:
    """A 64-bit key of a text, null and empty alike; joins pair it with the id."""
    return F.xxhash64(F.coalesce(F.col(c), F.lit("")))


def keep_chosen(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """One row of ``docs`` for each ``(_id, _text)`` in ``chosen``, with the other columns of ``chosen`` added.

    ``_text`` is the text's key; rows of ``docs`` equal in id and text count once
    (the least row stays; rows with a map, which have no order, are compared as
    JSON).  Columns of ``docs`` keep their names and values.
    """
    key = [F.col("_i"), F.col("_k")]
    added = [c for c in chosen.columns if c not in ("_id", "_text")]
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    marked = docs.select(row.alias("_row"), text_key().alias("_k"), F.col("doc_id").alias("_i"))
    joined = marked.join(chosen, F.col("_i").eqNullSafe(F.col("_id")) & (F.col("_k") == F.col("_text")))
    names = docs.select(F.col("doc_id").alias("_i"), text_key().alias("_k"))
    repeated = settle(names.groupBy(*key).count().filter("count > 1").select(F.col("_i").alias("_ri"), F.col("_k").alias("_rk"), F.lit(True).alias("_r")))
    if repeated.isEmpty():
        return joined.select("_row.*", *added)
    both = joined.join(repeated, F.col("_i").eqNullSafe(F.col("_ri")) & (F.col("_k") == F.col("_rk")), "left")
    order = F.to_json("_row") if "map<" in docs.schema.simpleString() else F.col("_row")
    once = both.filter("_r is null").select("_row", *added)
    again = both.filter("_r").groupBy(*key).agg(F.min_by("_row", order).alias("_row"), *[F.first(c).alias(c) for c in added]).select("_row", *added)
    return once.unionByName(again).select("_row.*", *added)


def running_before(df: DataFrame, group: str, order: Sequence[str], value: str, out: str) -> DataFrame:
    """Add ``out``: the sum of ``value`` over the earlier rows of the same group.

    Rows are range-partitioned by group and order, so a group of any size is
    split over as many tasks as its rows need.  Each part is summed by itself;
    only groups that continue from one part into the next need an offset, at
    most one row for every border between parts, and those are broadcast.
    ``order`` must be total within a group; the result is materialised.
    """
    parts = settle(df.repartitionByRange(F.col(group), *[F.col(c) for c in order]).withColumn("_rb_part", F.spark_partition_id()))
    inner = Window.partitionBy("_rb_part", group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    summed = parts.withColumn(out, F.coalesce(F.sum(value).over(inner), F.lit(0)))
    per = parts.groupBy("_rb_part", group).agg(F.sum(value).alias("_rb_t"))
    across = Window.partitionBy(group).orderBy("_rb_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        per.withColumn("_rb_o", F.sum("_rb_t").over(across))
        .filter("_rb_o is not null")
        .select(F.col("_rb_part").alias("_rb_p"), F.col(group).alias("_rb_g"), "_rb_o")
    )
    joined = summed.join(F.broadcast(offsets), (F.col("_rb_part") == F.col("_rb_p")) & F.col(group).eqNullSafe(F.col("_rb_g")), "left")
    return joined.withColumn(out, F.col(out) + F.coalesce("_rb_o", F.lit(0))).drop("_rb_part", "_rb_p", "_rb_g", "_rb_o")
