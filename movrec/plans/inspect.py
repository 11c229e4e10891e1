"""Plan inspection helpers: the text of ``explain`` and simple plan assertions."""

from __future__ import annotations

import contextlib
import io
import re

from pyspark.sql import DataFrame

# Operators that must not appear in a reconciliation plan.
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython")


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    """The physical plan as printed by ``df.explain(mode)``."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def plan_violations(df: DataFrame, forbidden=FORBIDDEN) -> list[str]:
    text = plan_text(df)
    return [op for op in forbidden if op in text]


def scans(df: DataFrame) -> list[dict[str, str]]:
    """Per Parquet scan: its ``ReadSchema``, ``PushedFilters`` and ``PartitionFilters`` lines."""
    out = []
    for block in plan_text(df).split("\n\n"):
        if "Scan parquet" not in block:
            continue
        info = {}
        for key in ("ReadSchema", "PushedFilters", "PartitionFilters", "Location"):
            m = re.search(rf"{key}: (.*)", block)
            if m:
                info[key] = m.group(1)
        out.append(info)
    return out
