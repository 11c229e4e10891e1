"""Column predicates used by the guards and filters.

All of them are built from ``pyspark.sql.functions`` so they stay inside
whole-stage codegen and can be pushed to the scan where Spark allows it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def is_blank(col: str | Column) -> Column:
    """NULL or the empty string ("blank" in the archive filter)."""
    c = F.col(col) if isinstance(col, str) else col
    return c.isNull() | (c == F.lit(""))


def truthy(df: DataFrame, name: str) -> Column:
    """Python-truthiness of a driving column, as a Spark predicate.

    A driving row skips when a guarded field is missing, NULL, ``''`` for
    text, ``0`` for numbers or ``False`` for booleans.  A column that does
    not exist in ``df`` is treated as always missing.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    if name not in types:
        return F.lit(False)
    dtype = types[name]
    c = F.col(name)
    if isinstance(dtype, T.StringType):
        return c.isNotNull() & (c != F.lit(""))
    if isinstance(dtype, T.NumericType):
        return c.isNotNull() & (c != F.lit(0))
    if isinstance(dtype, T.BooleanType):
        return F.coalesce(c, F.lit(False))
    return c.isNotNull()


def all_truthy(df: DataFrame, names) -> Column:
    cond = F.lit(True)
    for n in names:
        cond = cond & truthy(df, n)
    return cond


def strip_leading_zeros(col: str | Column) -> Column:
    """Remove leading ``'0'`` characters; ``'000'`` becomes ``''``, NULL stays NULL."""
    c = F.col(col) if isinstance(col, str) else col
    return F.ltrim(c, F.lit("0"))


def column_or_null(df: DataFrame, name: str, dtype: str = "string") -> Column:
    """The driving column ``name``, or a typed NULL when the column is absent."""
    if name in df.columns:
        return F.col(name)
    return F.lit(None).cast(dtype)
