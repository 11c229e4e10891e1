"""Lake sink for archived movements: append-only, one folder for each batch, schema may evolve.

Rows that carry :data:`BATCH_COLUMN` are laid out by it, so a batch is read,
completed or purged by its folder alone, whatever the lake has gathered before.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BATCH_COLUMN = "archive_batch_id"


def lake_path(bucket: str, table: str, prefix: str) -> str:
    """``<bucket>/<prefix>/<table>``: the archive location of one table (the prefix is the caller's)."""
    return f"{bucket.rstrip('/')}/{prefix.strip('/')}/{table}"


def append_to_lake(df: DataFrame, path: str, fmt: str = "delta", compression: str = "snappy", merge_schema: bool = True) -> None:
    """Append ``df`` with snappy compression; ``mergeSchema`` lets new columns in.

    Rows with a batch id go to the folder of their batch.
    ``fmt="delta"`` needs the Delta Lake package on the cluster; ``"parquet"``
    works everywhere (for Parquet, schema merging happens when reading).
    """
    writer = df.write.format(fmt).option("compression", compression).mode("append")
    if merge_schema:
        writer = writer.option("mergeSchema", "true")
    if BATCH_COLUMN in df.columns:
        writer = writer.partitionBy(BATCH_COLUMN)
    writer.save(path)


def read_lake(spark: SparkSession, path: str, fmt: str = "delta") -> DataFrame:
    reader = spark.read.format(fmt)
    if fmt == "parquet":
        reader = reader.option("mergeSchema", "true")
    return reader.load(path)


def batch_folder(spark: SparkSession, path: str, batch_id: str) -> str:
    """The folder of one batch in a Parquet lake, named as Spark names partitions."""
    names = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    return f"{path.rstrip('/')}/{BATCH_COLUMN}={names.escapePathName(batch_id)}"


def _data_files(spark: SparkSession, folder: str) -> bool:
    from movrec.session import hadoop_path

    fs, p = hadoop_path(spark, folder)
    if not fs.exists(p):
        return False
    return any(s.isFile() and not s.getPath().getName().startswith(("_", ".")) for s in fs.listStatus(p))


def read_batch(spark: SparkSession, path: str, batch_id: str, fmt: str = "delta") -> DataFrame | None:
    """The rows the lake holds for a batch; None if it holds none.

    Of a Parquet lake only the batch's folder is listed and read.  A lake whose
    files lie outside batch folders is refused: its batches could not be told apart
    without reading all of it.
    """
    from movrec.session import hadoop_path

    if fmt != "parquet":
        fs, log = hadoop_path(spark, f"{path.rstrip('/')}/_delta_log")
        if not fs.exists(log):
            return None
        return read_lake(spark, path, fmt).filter(F.col(BATCH_COLUMN) == F.lit(batch_id))
    if _data_files(spark, path):
        raise ValueError(f"{path} holds files outside the folders of its batches ({BATCH_COLUMN}=...)")
    folder = batch_folder(spark, path, batch_id)
    if not _data_files(spark, folder):
        return None
    return spark.read.option("mergeSchema", "true").parquet(folder).withColumn(BATCH_COLUMN, F.lit(batch_id))
