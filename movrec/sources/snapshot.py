"""Movement snapshot: read (Parquet or JDBC), restrict by period, write.

The hot table is read as a batch snapshot.  Every operator restricts it to
the period range its driving rows can touch with *literal* bounds, so the
filter reaches the scan: partition pruning when the snapshot is partitioned
by ``periodo``, row-group skipping on Parquet min/max statistics otherwise,
and a ``WHERE`` clause on the database for JDBC.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from movrec.schema import MOVEMENT_COLUMNS

MAX_ROWS_PER_FILE = 5_000_000


def load_snapshot(spark: SparkSession, path: str | list[str], fmt: str = "parquet", schema=None, **options) -> DataFrame:
    """Read a movement snapshot written by :func:`write_snapshot` (or any table with the 50 columns).

    Pass ``schema`` when it is known to skip schema inference on the files.
    """
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path).select(*MOVEMENT_COLUMNS)


def jdbc_options(
    url: str,
    table: str,
    user: str | None = None,
    password: str | None = None,
    root_cert: str | None = None,
    client_cert: str | None = None,
    key_cert: str | None = None,
    ssl_mode: str = "verify-ca",
    partition_column: str | None = None,
    lower_bound: str | None = None,
    upper_bound: str | None = None,
    num_partitions: int | None = None,
    fetch_size: int = 10000,
) -> dict[str, str]:
    """Options for ``spark.read.format("jdbc")`` from the pipeline parameters.

    The certificate paths map to the PostgreSQL driver's SSL properties.  A
    ``partition_column`` with bounds splits the read into ``num_partitions``
    parallel range queries instead of one connection.
    """
    # timestamps without time zone stay wall-clock values (rendered as stored)
    opts = {"url": url, "dbtable": table, "fetchsize": str(fetch_size), "preferTimestampNTZ": "true"}
    if user is not None:
        opts["user"] = user
    if password is not None:
        opts["password"] = password
    if root_cert or client_cert or key_cert:
        opts["ssl"] = "true"
        opts["sslmode"] = ssl_mode
        if root_cert:
            opts["sslrootcert"] = root_cert
        if client_cert:
            opts["sslcert"] = client_cert
        if key_cert:
            opts["sslkey"] = key_cert
    if partition_column is not None:
        if lower_bound is None or upper_bound is None or num_partitions is None:
            raise ValueError("partition_column needs lower_bound, upper_bound and num_partitions")
        opts.update(
            partitionColumn=partition_column,
            lowerBound=str(lower_bound),
            upperBound=str(upper_bound),
            numPartitions=str(num_partitions),
        )
    return opts


def read_jdbc_snapshot(spark: SparkSession, **kwargs) -> DataFrame:
    """Read the hot table over JDBC (see :func:`jdbc_options` for the arguments)."""
    return spark.read.format("jdbc").options(**jdbc_options(**kwargs)).load().select(*MOVEMENT_COLUMNS)


def jdbc_period_bounds(spark: SparkSession, table: str, **kwargs) -> tuple[str, str] | None:
    """The least and greatest ``periodo`` of a database table, asked of the database as one row."""
    columns = spark.read.format("jdbc").options(**jdbc_options(table=table, **kwargs)).load().columns
    name = next(c for c in columns if c.lower() == "periodo")  # as the database spells it
    query = f'(SELECT MIN("{name}") AS lo, MAX("{name}") AS hi FROM {table}) bounds'
    row = spark.read.format("jdbc").options(**jdbc_options(table=query, **kwargs)).load().first()
    return None if row[0] is None else (str(row[0]), str(row[1]))


def jdbc_period_histogram(spark: SparkSession, table: str, **kwargs) -> tuple[dict[str, str], list[tuple[_dt.date | None, int]]]:
    """``(column names as the database spells them, [(periodo, rows)] in order, NULL first)``, counted by the database.

    One row for each distinct period comes back.
    """
    columns = spark.read.format("jdbc").options(**jdbc_options(table=table, **kwargs)).load().columns
    names = {c.lower(): c for c in columns}
    period = f'"{names["periodo"]}"'
    query = f"(SELECT {period} AS p, COUNT(*) AS n FROM {table} GROUP BY {period}) histogram"
    found = [(r[0], int(r[1])) for r in spark.read.format("jdbc").options(**jdbc_options(table=query, **kwargs)).load().collect()]
    return names, sorted(found, key=lambda r: (r[0] is not None, r[0]))


def _pieces(counts: list[int], most: int, divisible: bool) -> list[list[tuple[int, int, int]]] | None:
    """Periods packed in order into parts of at most ``most`` rows: ``(period, piece, pieces)`` each; None if one does not fit."""
    parts: list[list[tuple[int, int, int]]] = []
    room = 0
    for i, n in enumerate(counts):
        if n > most:
            if not divisible:
                return None
            pieces = -(-n // most)
            parts.extend([(i, j, pieces)] for j in range(pieces))
            room = 0
        elif parts and n <= room:
            parts[-1].append((i, 0, 1))
            room -= n
        else:
            parts.append([(i, 0, 1)])
            room = most - n
    return parts


def equal_depth_parts(counts: list[int], parts: int, divisible: bool = True) -> list[list[tuple[int, int, int]]]:
    """At most ``parts`` parts with the least possible largest one.

    Neighbouring periods share a part; a period above the bound is cut in equal
    pieces if it is ``divisible``, else the largest one sets the bound.
    """
    if not counts:
        return []
    low, high = max(1, -(-sum(counts) // parts)), sum(counts)
    while low < high:
        mid = (low + high) // 2
        packed = _pieces(counts, mid, divisible)
        if packed is not None and len(packed) <= parts:
            high = mid
        else:
            low = mid + 1
    return _pieces(counts, low, divisible) or []


def jdbc_predicates(names: dict[str, str], histogram: list[tuple[_dt.date | None, int]], parts: int, hash_sql: str | None) -> list[str]:
    """One ``WHERE`` clause for each part; together they hold every row once.

    ``hash_sql`` is an expression of the database that spreads the ids of a hot day
    over whole numbers from 0 (NULL ids go to the first piece); without it no day is cut.
    """
    period = f'"{names["periodo"]}"'
    day = lambda d: f"{period} IS NULL" if d is None else f"{period} = {{d '{d}'}}"
    out = []
    for part in equal_depth_parts([n for _, n in histogram], parts, hash_sql is not None):
        first, piece, pieces = part[0]
        if pieces > 1:
            null = f" OR ({hash_sql}) IS NULL" if piece == 0 else ""
            out.append(f"{day(histogram[first][0])} AND (MOD({hash_sql}, {pieces}) = {piece}{null})")
            continue
        days = [histogram[i][0] for i, _, _ in part]
        dated = [d for d in days if d is not None]
        clause = f"{period} >= {{d '{dated[0]}'}} AND {period} <= {{d '{dated[-1]}'}}" if dated else ""
        out.append(f"({' OR '.join(filter(None, [f'({clause})' if clause else '', day(None) if None in days else '']))})")
    return out


def default_hash_sql(url: str, column: str) -> str | None:
    """A hash of a text column in the dialect of the database, where one is known."""
    if url.startswith("jdbc:postgresql:"):
        return f'(HASHTEXT("{column}") & 2147483647)'
    return None


def read_jdbc_equal_depth(spark: SparkSession, parts: int, hash_sql: str | None = None, **kwargs) -> DataFrame:
    """The hot table over JDBC in at most ``parts`` queries of about equal numbers of rows.

    The database counts its rows by period; quiet days are read together, and a
    day above a part's share is cut by a hash of the id, so one hot day is never
    one connection.
    """
    names, histogram = jdbc_period_histogram(spark, **kwargs)
    hash_sql = hash_sql or default_hash_sql(kwargs["url"], names["id_transaccion"])
    clauses = jdbc_predicates(names, histogram, parts, hash_sql)
    if not clauses:
        return read_jdbc_snapshot(spark, **kwargs)
    opts = jdbc_options(**kwargs)
    read = spark.read.jdbc(opts.pop("url"), opts.pop("dbtable"), predicates=clauses, properties=opts)
    return read.select(*MOVEMENT_COLUMNS)


def restrict_period(mov: DataFrame, lo: _dt.date | None, hi: _dt.date | None, column: str = "periodo") -> DataFrame:
    """Keep rows with ``lo <= periodo <= hi`` (either bound may be open) using literals."""
    cond = F.col(column).isNotNull()
    if lo is not None:
        cond = cond & (F.col(column) >= F.lit(lo))
    if hi is not None:
        cond = cond & (F.col(column) <= F.lit(hi))
    return mov.filter(cond)


def cluster_by_period(df: DataFrame, files: int | None = None) -> DataFrame:
    """Rows dealt by ``periodo`` and sorted in each part.

    The ``rebalance`` hint lets adaptive execution size the parts from the
    data and split a period that holds more than a part should, so one hot day
    never becomes one task or one file.
    """
    hint = ([files] if files else []) + ["periodo"]
    return df.hint("rebalance", *hint).sortWithinPartitions("periodo")


def write_clustered(df: DataFrame, path: str, partition_by: str | None = None, mode: str = "errorifexists", max_rows_per_file: int = MAX_ROWS_PER_FILE) -> str:
    """Write rows that are dealt already; no file gets more than ``max_rows_per_file`` rows."""
    writer = df.write.mode(mode).option("maxRecordsPerFile", max_rows_per_file)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    return path


def write_snapshot(df: DataFrame, path: str, files: int | None = None, partition_by: str | None = None, mode: str = "errorifexists") -> str:
    """Write a snapshot clustered by ``periodo`` so period filters skip files and row groups.

    With ``partition_by`` the folders are partitioned (pruned at planning
    time).  Otherwise each Parquet row group covers a narrow period range and
    min/max statistics skip the rest.  ``files`` is the number of shuffle
    partitions the rebalance starts from (default: the session's).  Always
    write to a new path; never overwrite the path being read.
    """
    return write_clustered(cluster_by_period(df, files), path, partition_by, mode)


def partitioned_by_period(spark: SparkSession, path: str) -> bool:
    """Whether the folders directly under ``path`` are ``periodo=`` partitions."""
    from movrec.session import hadoop_path

    fs, folder = hadoop_path(spark, path)
    return any(s.isDirectory() and s.getPath().getName().startswith("periodo=") for s in fs.listStatus(folder))


def stage_changes_jdbc(changes: DataFrame, table: str, partitions: int | None = None, mode: str = "overwrite", **jdbc_kw) -> None:
    """Bulk-load a change set into a staging table over JDBC.

    Executors write the keys (and new values) in parallel batches, so a
    database-resident hot table can apply the whole set with one set-based
    statement (for example ``UPDATE … FROM staging`` or ``DELETE … USING
    staging``) instead of one statement and commit per key.  ``jdbc_kw`` are
    the connection arguments of :func:`jdbc_options` (``url``, ``user``,
    certificates).
    """
    opts = jdbc_options(table=table, **jdbc_kw)
    for k in ("partitionColumn", "lowerBound", "upperBound", "numPartitions", "fetchsize", "preferTimestampNTZ"):
        opts.pop(k, None)
    out = changes.coalesce(partitions) if partitions else changes
    out.write.format("jdbc").options(**opts).option("batchsize", "10000").mode(mode).save()
