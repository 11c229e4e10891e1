"""Apply change sets to a snapshot, and audit what an output step did.

A keyed UPDATE becomes a left join of the snapshot with a change set that has
exactly one row per key; a keyed DELETE becomes a left anti join.  Both are
one pass over the snapshot.  The change set is broadcast only when its measured
size is under the cap.  Above it a key filter (:mod:`movrec.operators.keyfilter`)
tells the rows that no change touches: they stay where they are read, and only
the others are shuffled to the change set, where AQE splits skewed partitions.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from movrec.operators.keyfilter import possible_rows, split_by_keys
from movrec.operators.sizing import Measured, materialize
from movrec.schema import PREVIEW_ROWS, STATUS_COLUMN, WRITE_KEY


@dataclass(frozen=True)
class Constant:
    """A plain value to assign (a bare string names a column of the change set)."""

    value: object


@dataclass(frozen=True)
class Change:
    """A measured change set with the columns it is keyed on and what it assigns (nothing: it deletes)."""

    keys: Measured
    columns: Sequence[str]
    assign: Mapping[str, str | Column | Constant] | None = None

    def __call__(self, mov: DataFrame) -> DataFrame:
        return apply_changes(mov, [self])

    def on(self, mov: DataFrame) -> DataFrame:
        """The change joined to ``mov`` as a whole."""
        if self.assign is None:
            return _deleted(mov, self.keys, self.columns)
        return _updated(mov, self.keys, self.columns, self.assign)


def changed_and_kept(mov: DataFrame, changes: Sequence[Change]) -> tuple[DataFrame, DataFrame | None]:
    """``mov`` after the changes in their order, in two parts: the rows that went
    through a join, and those that no change touches (``None`` where all were joined)."""
    assigned = {c for change in changes for c in change.assign or ()}  # a later change sees other values there
    shared = [k for k in changes[0].columns if k not in assigned and all(k in c.columns for c in changes)]
    split = split_by_keys(mov, shared, [c.keys for c in changes])
    moved, kept = (mov, None) if split is None else split
    for change in changes:
        moved = change.on(moved)
    return moved, kept


def apply_changes(mov: DataFrame, changes: Sequence[Change]) -> DataFrame:
    """``mov`` after several changes in their order; rows that none of them touches meet no join."""
    moved, kept = changed_and_kept(mov, changes)
    return moved if kept is None else moved.unionByName(kept)


def _small(changes: DataFrame | Measured) -> DataFrame:
    if isinstance(changes, Measured):
        return changes.side()
    return changes


def apply_updates(
    mov: DataFrame,
    changes: DataFrame | Measured,
    keys: Sequence[str],
    assignments: Mapping[str, str | Column | Constant],
) -> DataFrame:
    """New snapshot: for rows whose ``keys`` appear in ``changes``, set ``assignments``.

    ``assignments`` maps a snapshot column to a column of ``changes`` (by name),
    a Column or a :class:`Constant`.  ``changes`` must hold one row per key.
    """
    if isinstance(changes, Measured):
        return apply_changes(mov, [Change(changes, keys, assignments)])
    return _updated(mov, changes, keys, assignments)


def _updated(mov: DataFrame, changes: DataFrame | Measured, keys: Sequence[str], assignments: Mapping[str, str | Column | Constant]) -> DataFrame:
    ch = _small(changes)
    sel = [F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]
    for i, (col, value) in enumerate(assignments.items()):
        if isinstance(value, str):
            v = F.col(value)
        elif isinstance(value, Constant):
            v = F.lit(value.value)
        else:
            v = value
        sel.append(v.alias(f"_v{i}"))
    sel.append(F.lit(True).alias("_hit"))
    ch = ch.select(*sel)
    cond = None
    for i, k in enumerate(keys):
        c = mov[k] == ch[f"_k{i}"]
        cond = c if cond is None else cond & c
    joined = mov.join(ch, cond, "left")
    targets = {col: i for i, col in enumerate(assignments)}
    out = []
    types = {f.name: f.dataType for f in mov.schema.fields}
    for c in types:
        if c in targets:
            new = F.col(f"_v{targets[c]}").cast(types[c])
            out.append(F.when(F.col("_hit"), new).otherwise(mov[c]).alias(c))
        else:
            out.append(mov[c])
    return joined.select(*out)


def apply_deletes(mov: DataFrame, keys_df: DataFrame | Measured, keys: Sequence[str]) -> DataFrame:
    """New snapshot without the rows whose ``keys`` appear in ``keys_df`` (NULL keys never match)."""
    return apply_changes(mov, [Change(keys_df, keys)]) if isinstance(keys_df, Measured) else _deleted(mov, keys_df, keys)


def _deleted(mov: DataFrame, keys_df: DataFrame | Measured, keys: Sequence[str]) -> DataFrame:
    k = _small(keys_df).select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(keys)])
    cond = None
    for i, c in enumerate(keys):
        e = mov[c] == k[f"_k{i}"]
        cond = e if cond is None else cond & e
    return mov.join(k, cond, "left_anti")


def touched_rows(mov: DataFrame, keys_df: DataFrame | Measured, keys: Sequence[str]) -> DataFrame:
    """The snapshot rows an update or delete with these keys touches."""
    if isinstance(keys_df, Measured):
        mov = possible_rows(mov, keys, keys_df)
    k = _small(keys_df).select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(keys)])
    cond = None
    for i, c in enumerate(keys):
        e = mov[c] == k[f"_k{i}"]
        cond = e if cond is None else cond & e
    return mov.join(k, cond, "left_semi")


def audit(
    inputs: DataFrame,
    key_cols: Mapping[str, Column],
    guard: Column,
    mov: DataFrame,
    keys: Sequence[str],
    reason: Column | None = None,
) -> DataFrame:
    """One status row per input row of an output step.

    ``outcome`` tells ``skipped`` (guard failed), ``failed`` (the row passes the
    guard and ``reason`` is not NULL: its statement could not have run),
    ``applied`` (the key exists in the snapshot) or ``not_found``.
    ``delete_status`` is NULL as in the reference, or ``ERROR: <reason>``; the
    other rows go on.
    The distinct input keys are measured; the snapshot streams against them
    (semi join, broadcast under the cap) and only the distinct hits - at most
    one per input key - come back, so the snapshot is never shuffled or
    aggregated.
    """
    ok = F.coalesce(guard, F.lit(False))
    why = F.when(ok, F.lit(None).cast("string") if reason is None else reason)
    rows = inputs.select(*[e.alias(n) for n, e in key_cols.items()], ok.alias("_ok"), why.alias("_why"))
    present = present_keys(rows.filter(F.col("_ok") & F.col("_why").isNull()).select(*keys), mov, keys)
    flagged = rows.join(present, list(keys), "left")
    return flagged.select(*keys, status_text("_why"), outcome(F.col("_ok"), F.col("_found"), F.col("_why")).alias("outcome"))


def status_text(why: str) -> Column:
    return F.when(F.col(why).isNotNull(), F.concat(F.lit("ERROR: "), F.col(why))).alias(STATUS_COLUMN)


def present_keys(wanted: DataFrame, mov: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The distinct ``wanted`` keys that the snapshot holds, with ``_found`` = true."""
    distinct_keys = materialize(wanted.distinct())
    present = touched_rows(mov, distinct_keys, keys).select(*keys).distinct().withColumn("_found", F.lit(True))
    return F.broadcast(present) if distinct_keys.broadcastable else present


def outcome(ok: Column, found: Column, why: Column) -> Column:
    return F.when(~ok, F.lit("skipped")).when(why.isNotNull(), F.lit("failed")).when(found, F.lit("applied")).otherwise(F.lit("not_found"))


def preview(status: DataFrame, rows: int = PREVIEW_ROWS) -> DataFrame:
    """The bounded console preview of an audit; the action itself is never limited."""
    return status.limit(rows)


def touched_periods(keys_df: DataFrame | Measured, partition_col: str = "periodo") -> list:
    """The distinct periods of a change set: at most one value per partition folder the driver lists anyway."""
    keys = keys_df.df if isinstance(keys_df, Measured) else keys_df
    return [r[0] for r in keys.select(partition_col).distinct().collect() if r[0] is not None]


def touched_partitions(
    spark, path: str, periods: Sequence, partition_col: str = "periodo", fmt: str = "parquet", schema=None
) -> DataFrame:
    """The rows of the partitions of the given periods (a literal ``IN`` partition
    filter, so only those folders are listed and read)."""
    from movrec.sources.snapshot import load_snapshot

    mov = load_snapshot(spark, path, fmt=fmt, schema=schema)
    return mov.filter(F.col(partition_col).isin(list(periods)))


def rewrite_touched_partitions(
    spark,
    path: str,
    keys_df: DataFrame | Measured,
    change: Callable[[DataFrame], DataFrame],
    partition_col: str = "periodo",
    schema=None,
    key_columns: Sequence[str] = WRITE_KEY,
) -> int:
    """Apply ``change`` to a Parquet snapshot partitioned by ``partition_col`` at ``path``,
    rewriting only the files that hold a row of ``keys_df``.

    The periods of the keys prune the partitions (a literal ``IN``), a semi join on
    the keys and the files' names finds the files, and only those are read in full.
    Their new rows and the list of the old files are written next to the table
    (``<path>.rewrite``), then switched in by :func:`finish_rewrite`.  Files that
    come into the table meanwhile, or hold none of the keys, are never read, moved
    or removed.  Returns the number of rows in the new files.  One writer at a time.
    """
    from movrec.session import remove_path
    from movrec.sources.snapshot import load_snapshot

    finish_rewrite(spark, path, partition_col)
    periods = touched_periods(keys_df, partition_col)
    files = touched_files(spark, path, keys_df, key_columns, periods, partition_col, schema)
    if not files:
        return 0
    part = load_snapshot(spark, files, schema=schema, basePath=path)
    aside = _aside(path)
    remove_path(spark, aside)
    moved, kept = changed_and_kept(part, [change]) if isinstance(change, Change) else (change(part), None)
    new = moved.select(*part.columns).hint("rebalance", partition_col)
    if kept is not None:  # these lie by period already
        new = new.unionByName(kept.select(*part.columns))
    new.write.partitionBy(partition_col).parquet(f"{aside}/rows")
    rows = load_snapshot(spark, f"{aside}/rows", schema=part.schema).count()
    spark.createDataFrame([(f,) for f in files], "file string").coalesce(1).write.parquet(f"{aside}/replaced")
    finish_rewrite(spark, path, partition_col)
    return rows


def touched_files(
    spark, path: str, keys_df: DataFrame | Measured, key_columns: Sequence[str], periods: Sequence, partition_col: str = "periodo", schema=None
) -> list[str]:
    """The files of the given periods that hold a row with one of the keys: at most the files the driver lists anyway."""
    if not periods:
        return []
    reader = spark.read if schema is None else spark.read.schema(schema)
    rows = reader.parquet(path).filter(F.col(partition_col).isin(list(periods)))
    named = rows.select(*key_columns, F.col("_metadata.file_path").alias("_file"))
    uris = touched_rows(named, keys_df, key_columns).select("_file").distinct().collect()
    jvm = spark._jvm
    return sorted(jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(r[0])).toString() for r in uris)


def _aside(path: str) -> str:
    return f"{path.rstrip('/')}.rewrite"


def finish_rewrite(spark, path: str, partition_col: str = "periodo") -> bool:
    """Switch in the rewritten files that lie next to ``path``, if they are complete.

    New files are moved into the table one by one, then the old ones that the list
    names are removed; whatever was done before a crash is passed over, so calling
    this again ends in the same table.  Between the two a reader may see a row
    twice, never lose one; outputs and transforms finish a pending switch before
    they read.  False if there was none (staging that never became complete is
    ignored, and replaced by the next rewrite).
    """
    from movrec.session import hadoop_path, remove_path

    aside = _aside(path)
    fs, ready = hadoop_path(spark, f"{aside}/replaced/_SUCCESS")  # written last
    if not fs.exists(ready):
        return False
    replaced = [r[0] for r in spark.read.schema("file string").parquet(f"{aside}/replaced").collect()]
    for name in staged_files(spark, f"{aside}/rows", partition_col):
        _, source = hadoop_path(spark, f"{aside}/rows/{name}")
        _, target = hadoop_path(spark, f"{path.rstrip('/')}/{name}")
        fs.mkdirs(target.getParent())
        if not fs.rename(source, target):
            raise OSError(f"could not move {source} to {target}")
    for name in replaced:
        _, old = hadoop_path(spark, name)
        fs.delete(old, False)
        folder = old.getParent()
        if fs.exists(folder) and not any(_is_data(f) for f in fs.listStatus(folder)):
            fs.delete(folder, True)  # a period without rows
    remove_path(spark, aside)
    spark.catalog.refreshByPath(path)
    return True


def _is_data(status) -> bool:
    return status.isFile() and not status.getPath().getName().startswith(("_", "."))


def staged_files(spark, folder: str, partition_col: str) -> list[str]:
    """``<partition>/<file>`` of every data file one level below ``folder``."""
    from movrec.session import hadoop_path

    fs, root = hadoop_path(spark, folder)
    parts = [p.getPath() for p in fs.listStatus(root) if p.isDirectory() and p.getPath().getName().startswith(f"{partition_col}=")]
    return [f"{p.getName()}/{f.getPath().getName()}" for p in parts for f in fs.listStatus(p) if _is_data(f)]
