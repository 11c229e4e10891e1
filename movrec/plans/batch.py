"""A whole reconciliation batch over one snapshot, in the reference's order.

1. transform A reads the pre-batch snapshot (matched rows + verdicts);
2. its UPDATE marks the stand-in legs of every request (change set P2);
3. the park step relabels every key of a NO MATCH group (change set P5) on
   the marked snapshot.

``read_after_mark=True`` instead lets step 1 see the marks (the reference's
outcome when its per-row statement had already committed).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from movrec.operators import apply as ap
from movrec.operators import changes as ch
from movrec.operators import requests as rq
from movrec.operators.sizing import materialize
from movrec.schema import WRITE_KEY


@dataclass
class BatchResult:
    matched: DataFrame  # transform A rows
    marked: DataFrame  # snapshot after the repost mark
    snapshot: DataFrame  # snapshot after mark + park


def reconcile_batch(req: DataFrame, mov: DataFrame, read_after_mark: bool = False) -> BatchResult:
    marks = materialize(ch.mark_reposted_changes(req, mov))
    mark = ap.Change(marks, ch.MARK_KEYS, ch.MARK_ASSIGN)
    marked = mark(mov)
    matched = rq.match_requests(req, marked if read_after_mark else mov)
    park = ap.Change(materialize(ch.park_unmatched_keys(matched)), WRITE_KEY, ch.PARK_ASSIGN)
    return BatchResult(matched, marked, ap.apply_changes(mov, [mark, park]))
