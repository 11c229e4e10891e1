"""A change log over a snapshot: ordered change sets beside the table, laid over it when it is read.

A hot table that stays as it is on disk can still be marked, parked, released
and purged: every output commits its change set to the log, and a reader sees
the base with all committed changes applied in their order.  Reading costs one
join of the base with the folded changes of each key; the base is never
rewritten until :meth:`ChangeLog.compact` writes it anew as a step of its own.

Layout, below ``<table>.changes``::

    data/<id>/             the rows of one entry (Parquet)
    commits/<number>.<kind>.<through>.<id>     an empty file: the entry counts from here on

An entry's rows are written first; creating its commit file, one atomic call,
makes it visible.  A crash before that leaves rows that nothing refers to, a
crash after it leaves a finished entry: there is no state in between, at any
step, compaction included.  One writer at a time (a second commit with a number
that is taken raises and takes itself back); readers at any time.

Every row has a birth number: 0 in the original table, the entry's number for
appended movements, the last number folded in for a compacted base.  A change
applies to rows born before it, as a statement applies to the rows it finds: a
movement appended after a delete of its key stays.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from movrec.operators.apply import Change, Constant
from movrec.operators.keyfilter import split_by_keys
from movrec.operators.sizing import Measured, materialize
from movrec.schema import MOVEMENT_COLUMNS, WRITE_KEY, movement_schema
from movrec.session import hadoop_path, remove_path
from movrec.sources.snapshot import load_snapshot, partitioned_by_period, write_snapshot

TYPE = "tipo_procesamiento"
CHANGE, APPEND, BASE = "change", "append", "base"


@dataclass(frozen=True, order=True)
class Entry:
    number: int
    kind: str
    through: int  # of a base: the last entry folded into it
    id: str

    @property
    def name(self) -> str:
        return f"{self.number:012d}.{self.kind}.{self.through}.{self.id}"


class ChangeLog:
    def __init__(self, spark: SparkSession, path: str, log: str | None = None, schema=None):
        """``path``: the Parquet snapshot; ``log``: the log's folder (default ``<path>.changes``)."""
        self.spark, self.path = spark, path
        self.log = (log or f"{path.rstrip('/')}.changes").rstrip("/")
        self.schema = schema if schema is not None else movement_schema()

    # --- entries ----------------------------------------------------------------------
    def entries(self) -> list[Entry]:
        """All committed entries, in order: one small file each since the last :meth:`clean`."""
        fs, folder = hadoop_path(self.spark, f"{self.log}/commits")
        if not fs.exists(folder):
            return []
        names = [s.getPath().getName().split(".") for s in fs.listStatus(folder)]
        return sorted(Entry(int(n[0]), n[1], int(n[2]), n[3]) for n in names if len(n) == 4)

    def _folder(self, entry_id: str) -> str:
        return f"{self.log}/data/{entry_id}"

    def _commit(self, kind: str, entry_id: str, number: int, through: int = 0) -> Entry:
        entry = Entry(number, kind, through, entry_id)
        fs, file = hadoop_path(self.spark, f"{self.log}/commits/{entry.name}")
        fs.create(file, False).close()
        if sum(e.number == number for e in self.entries()) > 1:
            fs.delete(file, False)
            raise RuntimeError(f"another writer committed entry {number} of {self.log}; read again and retry")
        return entry

    def _next(self) -> int:
        return max((e.number for e in self.entries()), default=0) + 1

    def _add(self, rows: DataFrame, kind: str) -> Entry:
        number, entry_id = self._next(), uuid.uuid4().hex
        rows.write.parquet(self._folder(entry_id))
        return self._commit(kind, entry_id, number)

    # --- writing ----------------------------------------------------------------------
    def commit(self, change: Change) -> Entry:
        """Add a change set: an update if it assigns something, else a delete.

        Keyed on ``periodo`` and ``id_transaccion``, or on these and the processing
        type, which is then a condition on the row's type at that point of the log.
        One row per key and type.
        """
        if tuple(change.columns[:2]) != WRITE_KEY or tuple(change.columns[2:]) not in ((), (TYPE,)):
            raise ValueError(f"a change set is keyed on {WRITE_KEY}, or these and {TYPE}; got {tuple(change.columns)}")
        keys = change.keys.df if isinstance(change.keys, Measured) else change.keys
        when = F.col(TYPE) if len(change.columns) == 3 else F.lit(None).cast("string")
        values = self._values(change.assign or {})
        return self._add(keys.select(*WRITE_KEY, when.alias("_when"), F.lit(change.assign is None).alias("_gone"), *values), CHANGE)

    def _values(self, assign: Mapping[str, str | Column | Constant]) -> list[Column]:
        types = {f.name: f.dataType for f in self.schema.fields}
        given = lambda v: F.lit(v.value) if isinstance(v, Constant) else F.col(v) if isinstance(v, str) else v
        return [given(v).cast(types[c]).alias(f"_to_{c}") for c, v in assign.items()]

    def append(self, rows: DataFrame) -> Entry:
        """Add new movements."""
        return self._add(rows.select(*MOVEMENT_COLUMNS), APPEND)

    # --- reading ----------------------------------------------------------------------
    def _pending(self) -> tuple[Entry | None, list[Entry]]:
        """The newest base and the entries that it does not hold."""
        entries = self.entries()
        base = max((e for e in entries if e.kind == BASE), default=None, key=lambda e: (e.through, e.number))
        return base, [e for e in entries if e.kind != BASE and e.number > (base.through if base else 0)]

    def base_path(self) -> str:
        base, _ = self._pending()
        return self._folder(base.id) if base else self.path

    def read(self) -> DataFrame:
        """The table as of the last committed entry."""
        base, pending = self._pending()
        return self._overlay(base, pending)

    def _overlay(self, base: Entry | None, pending: Sequence[Entry]) -> DataFrame:
        read = lambda path: load_snapshot(self.spark, path, schema=self.schema)
        born = [read(self._folder(base.id) if base else self.path).withColumn("_born", F.lit(base.through if base else 0))]
        born += [read(self._folder(e.id)).withColumn("_born", F.lit(e.number)) for e in pending if e.kind == APPEND]
        rows = reduce(DataFrame.unionByName, born)
        changes = [(e.number, self.spark.read.parquet(self._folder(e.id))) for e in pending if e.kind == CHANGE]
        if not changes:
            return rows.drop("_born")
        return lay_over(rows, changes, list(MOVEMENT_COLUMNS))

    # --- maintenance ------------------------------------------------------------------
    def compact(self) -> str:
        """Write the table with all committed changes as a new base, partitioned as the old one, and return its path.

        Entries committed while it is written are not part of it and stay pending.
        """
        base, pending = self._pending()
        if not pending:
            return self.base_path()
        entry_id, through = uuid.uuid4().hex, pending[-1].number
        kept = "periodo" if partitioned_by_period(self.spark, self.base_path()) else None
        write_snapshot(self._overlay(base, pending), self._folder(entry_id), partition_by=kept)
        self._commit(BASE, entry_id, self._next(), through)
        return self._folder(entry_id)

    def clean(self) -> int:
        """Remove what no reader of the newest base needs: older entries and rows that were never committed.

        Commit files go first, then rows; repeated after a crash it goes on.  Not while
        an output is committing or an older state is still being read.
        """
        base, pending = self._pending()
        keep = {e.id for e in pending} | ({base.id} if base else set())
        fs, data = hadoop_path(self.spark, f"{self.log}/data")
        gone = [s.getPath().getName() for s in fs.listStatus(data) if s.getPath().getName() not in keep] if fs.exists(data) else []
        for entry in self.entries():
            if entry.id not in keep:
                remove_path(self.spark, f"{self.log}/commits/{entry.name}")
        for name in gone:
            remove_path(self.spark, self._folder(name))
        return len(gone)


def lay_over(rows: DataFrame, changes: Sequence[tuple[int, DataFrame]], columns: list[str]) -> DataFrame:
    """``columns`` of ``rows`` (with their ``_born`` number) after the numbered change sets.

    The change sets are united and measured; each key's changes become one array
    in order (at most one element per change set and type), and one left join
    brings it to the rows, broadcast under the cap; above it only rows that the key
    filter names are joined.  The changes are folded over
    the row's own values by a higher-order aggregate, so conditions see the type
    the row has at that point.
    """
    named = [f for _, df in changes for f in df.schema.fields if f.name.startswith("_to_")]
    assigned = list(dict.fromkeys(f.name for f in named))  # every column that some change assigns
    types = {f.name: f.dataType for f in named}

    def widened(number: int, df: DataFrame) -> DataFrame:
        values = [(F.col(c) if c in df.columns else F.lit(None).cast(types[c])).alias(c) for c in assigned]
        has = [F.lit(c in df.columns).alias(f"_has{c}") for c in assigned]
        return df.select(*[F.col(k).alias(f"_k{k}") for k in WRITE_KEY], F.lit(number).alias("_number"), "_when", "_gone", *values, *has)

    all_changes = materialize(reduce(DataFrame.unionByName, [widened(n, df) for n, df in changes]))
    step = F.struct(*[c for c in all_changes.df.columns if c not in [f"_k{k}" for k in WRITE_KEY]])
    folded = all_changes.df.groupBy(*[f"_k{k}" for k in WRITE_KEY]).agg(F.array_sort(F.collect_list(step)).alias("_steps"))
    side = F.broadcast(folded) if all_changes.broadcastable else folded
    keys = Measured(all_changes.df.select(*[F.col(f"_k{k}").alias(k) for k in WRITE_KEY]), all_changes.rows, all_changes.bytes, broadcastable=all_changes.broadcastable)
    split = split_by_keys(rows, WRITE_KEY, [keys])
    rows, untouched = (rows, None) if split is None else split
    joined = rows.join(side, reduce(Column.__and__, [rows[k] == side[f"_k{k}"] for k in WRITE_KEY]), "left")
    columns_after = [c.removeprefix("_to_") for c in assigned]
    start = F.struct(
        F.col("_born").alias("number"), F.col(TYPE).alias("type"), F.col(TYPE).alias("before"), F.lit(False).alias("gone"),
        *[F.col(c).cast(types[f"_to_{c}"]).alias(f"v_{c}") for c in columns_after],
    )

    def fold(state: Column, change: Column) -> Column:
        # conditions of one change set are judged on the type the row had before that set
        before = F.when(state["number"] == change["_number"], state["before"]).otherwise(state["type"])
        hit = ~state["gone"] & (F.col("_born") < change["_number"]) & (change["_when"].isNull() | F.coalesce(change["_when"] == before, F.lit(False)))
        value = {c: F.when(hit & change[f"_has_to_{c}"], change[f"_to_{c}"]).otherwise(state[f"v_{c}"]) for c in columns_after}
        kind = value.get(TYPE, state["type"])
        return F.struct(
            F.greatest(state["number"], change["_number"]).alias("number"), kind.alias("type"), before.alias("before"),
            (state["gone"] | (hit & change["_gone"])).alias("gone"), *[value[c].alias(f"v_{c}") for c in columns_after],
        )

    after = joined.withColumn("_after", F.when(F.col("_steps").isNotNull(), F.aggregate("_steps", start, fold)))
    left = after.filter(~F.coalesce(F.col("_after.gone"), F.lit(False)))
    touched = F.col("_after").isNotNull()
    laid = left.select(*[
        F.when(touched, F.col(f"_after.v_{c}")).otherwise(F.col(c)).alias(c) if c in columns_after else F.col(c) for c in columns
    ])
    return laid if untouched is None else laid.unionByName(untouched.select(*columns))
