"""Text rendering of movement columns (every result column is a string)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from movrec.schema import (
    DATE_COLUMNS,
    DATE_PATTERN,
    MILLI_PATTERN,
    MILLI_TIMESTAMP_COLUMNS,
    MOVEMENT_COLUMNS,
    SECOND_PATTERN,
    SECOND_TIMESTAMP_COLUMNS,
)

_TEMPORAL = (T.DateType, T.TimestampType, T.TimestampNTZType)


def pattern_for(name: str) -> str | None:
    if name in DATE_COLUMNS:
        return DATE_PATTERN
    if name in SECOND_TIMESTAMP_COLUMNS:
        return SECOND_PATTERN
    if name in MILLI_TIMESTAMP_COLUMNS:
        return MILLI_PATTERN
    return None


def column_types(df: DataFrame) -> dict[str, T.DataType]:
    """Column name -> type, fetched once (each ``df.schema`` call is a JVM round trip)."""
    return {f.name: f.dataType for f in df.schema.fields}


def as_text(df: DataFrame, name: str, source: str | None = None, types: dict | None = None) -> Column:
    """Render one movement column as text.

    Dates and timestamps use the column's fixed pattern (milliseconds are
    truncated, not rounded); everything else is a plain cast.  Dates and
    timestamps without zone are rendered from their own text, so the session's
    zone has no part in it.  A column that is already text passes through
    unchanged, so formatting is idempotent.
    """
    src = source or name
    dtype = (types or column_types(df))[src]
    return F.expr(_rendered(src, name, dtype)).alias(name)


def _rendered(src: str, name: str, dtype: T.DataType) -> str:
    """SQL text of one rendered column."""
    if isinstance(dtype, T.StringType):
        return f"`{src}`"
    text = f"CAST(`{src}` AS STRING)"
    pattern = pattern_for(name)
    if pattern is None or not isinstance(dtype, _TEMPORAL):
        return text
    if isinstance(dtype, T.TimestampType):  # an instant: shown in the session's zone
        return f"date_format(`{src}`, '{pattern}')"
    if isinstance(dtype, T.DateType):
        wall = f"concat({text}, ' 00:00:00')"
    else:
        wall = text
    if pattern == DATE_PATTERN:
        return f"substring({text}, 1, 10)"
    if pattern == SECOND_PATTERN:
        return f"substring({wall}, 1, 19)"
    # a whole second has no fraction in its text, others up to six digits without trailing zeros
    return f"substring(rpad(concat({wall}, CASE WHEN length({wall}) = 19 THEN '.' ELSE '' END), 23, '0'), 1, 23)"


def movement_text_columns(df: DataFrame) -> list[Column]:
    types = column_types(df)
    return [as_text(df, c, types=types) for c in MOVEMENT_COLUMNS]


def text_expr(name: str, dtype: T.DataType) -> str:
    """SQL text of :func:`as_text` for one column (one parse for the whole projection)."""
    return f"{_rendered(name, name, dtype)} AS `{name}`"


def in_pieces(df: DataFrame, count: str, most: int) -> DataFrame:
    """Each row once for every ``most`` of its ``count`` (at least 1), which becomes that of the piece; no shuffle."""
    others = [f"`{c}`" for c in df.columns if c != count]
    piece = f"transform(sequence(0L, `{count}` - 1L, {most}L), i -> least({most}L, `{count}` - i))"
    return df.selectExpr(*others, f"explode({piece}) AS `{count}`")


def format_movements(df: DataFrame, extra: tuple[str, ...] = (), repeat: str | None = None, handful: int | None = None) -> DataFrame:
    """Project the 50 movement columns as text, in output order, plus ``extra`` columns.

    With ``repeat``, each input row is rendered once, then emitted ``df[repeat]``
    times (a local generator, no shuffle).  The generator holds all copies of a
    row before it hands them on; with ``handful``, at most that many at a time.
    """
    types = column_types(df)
    rendered = [text_expr(c, types[c]) for c in MOVEMENT_COLUMNS] + [f"`{c}`" for c in extra]
    if repeat is None:
        return df.selectExpr(*rendered)
    if handful is None:
        counted = df.selectExpr(*rendered, f"CAST(`{repeat}` AS INT) AS _n")
    else:
        counted = in_pieces(df.selectExpr(*rendered, f"CAST(`{repeat}` AS BIGINT) AS _n"), "_n", handful)
        counted = counted.withColumn("_n", F.col("_n").cast("int"))
    return counted.selectExpr(*MOVEMENT_COLUMNS, *extra, "explode(sequence(1, _n)) AS _i").drop("_i")
