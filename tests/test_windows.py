"""Transform B (window matching) against the brute-force model."""

from collections import Counter

import pytest

import brute
from movrec.operators import windows as wn
from movrec.schema import MOVEMENT_COLUMNS
from rows import LEDGER, WINDOWS, movements_df, windows_df


def counter(df):
    return Counter((r["id_transaccion"], r["periodo"]) for r in df.collect())


@pytest.mark.parametrize("path", ["broadcast", "shuffle"])
@pytest.mark.parametrize("bin_days", [1, 7, 32, 400])
def test_match_windows_equals_per_window_model(spark, request, path, bin_days):
    if path == "shuffle":
        request.getfixturevalue("no_broadcast")
    got = wn.match_windows(windows_df(spark, WINDOWS), movements_df(spark, LEDGER), bin_days=bin_days)
    assert got.columns == list(MOVEMENT_COLUMNS)
    assert counter(got) == brute.match_windows(LEDGER, WINDOWS)


def test_window_edge_cases(spark):
    got = counter(wn.match_windows(windows_df(spark, WINDOWS), movements_df(spark, LEDGER)))
    # overlapping + duplicated window: S6 pair appears once per window row
    assert got[("S6", "2024-02-01")] == 2
    # '' type is not a core row, but the row is returned through its key
    assert got[("C7", "2024-02-04")] == 2 and got[("C7b", "2024-02-05")] == 2
    # no stand-in references D1 (S1 has no repost reference)
    assert ("C1", "2024-01-12") not in got


def test_no_windows(spark):
    out = wn.match_windows(windows_df(spark, WINDOWS[3:]), movements_df(spark, LEDGER))
    assert out.count() == 0 and len(out.columns) == 50
