"""Stand-in / core movement reconciliation as set-based Spark jobs."""

from movrec.operators.apply import apply_deletes, apply_updates, audit, preview, rewrite_touched_partitions, touched_rows
from movrec.operators.archive import archive_and_purge
from movrec.operators.changes import (
    archive_rows,
    mark_reposted_changes,
    park_unmatched_keys,
    release_parked_keys,
    request_leg_delete_keys,
)
from movrec.operators.requests import match_requests
from movrec.operators.windows import match_windows
from movrec.plans.batch import reconcile_batch
from movrec.sources.snapshot import jdbc_options, load_snapshot, read_jdbc_snapshot, write_snapshot

__all__ = [
    "apply_deletes",
    "apply_updates",
    "archive_and_purge",
    "archive_rows",
    "audit",
    "jdbc_options",
    "load_snapshot",
    "mark_reposted_changes",
    "match_requests",
    "match_windows",
    "park_unmatched_keys",
    "preview",
    "read_jdbc_snapshot",
    "reconcile_batch",
    "release_parked_keys",
    "request_leg_delete_keys",
    "rewrite_touched_partitions",
    "touched_rows",
    "write_snapshot",
]
