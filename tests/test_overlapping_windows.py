"""Overlapping windows by staircases: the rows of the per-window plan, with far fewer rows on the way."""

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

import brute
from movrec.functions.formatting import format_movements, in_pieces
from movrec.operators import staircases as st
from movrec.operators import windows as wn
from movrec.plans.inspect import plan_text, plan_violations
from movrec.schema import MOVEMENT_COLUMNS
from rows import LEDGER, WINDOWS, D, movements_df, mv, windows_df


def keys(df):
    return Counter((r["id_transaccion"], r["periodo"]) for r in df.collect())


def test_the_ledger_and_its_windows(spark):
    got = st.match_windows_overlapping(windows_df(spark, WINDOWS), movements_df(spark, LEDGER))
    assert keys(got) == brute.match_windows(LEDGER, WINDOWS)
    for none in ([], WINDOWS[3:]):  # no windows, only reversed and unbounded ones
        assert st.match_windows_overlapping(windows_df(spark, none), movements_df(spark, LEDGER)).count() == 0
    assert st.match_windows_overlapping(windows_df(spark, WINDOWS), movements_df(spark, [])).count() == 0


def random_case(seed):
    rnd = random.Random(seed)
    day = lambda: D(2024, 1, 1) + dt.timedelta(days=rnd.randrange(25))
    ledger = []
    for i in range(rnd.randrange(20, 60)):
        kind = rnd.choice(["STANDIN", "STANDIN_P", None, None, ""])
        doc = rnd.choice(["T1", "T2", "D1", "D2", None])
        ledger.append(mv(f"m{i}", rnd.choice(["A", "B", None]), doc, day() if rnd.random() < 0.95 else None, kind, ref=rnd.choice(["D1", "D2", "T1", None])))
    windows = [{"periodo_tope": day(), "periodo": day()} for _ in range(rnd.randrange(1, 40))]
    return ledger, windows + windows[:3] + [{"periodo": None, "periodo_tope": day()}]


@pytest.mark.parametrize("seed", range(6))
def test_random_windows_equal_brute_force(spark, request, seed):
    if seed % 2:
        request.getfixturevalue("no_broadcast")
    ledger, windows = random_case(seed)
    assert keys(st.match_windows_overlapping(windows_df(spark, windows), movements_df(spark, ledger))) == brute.match_windows(ledger, windows)


def test_dyadic_cover_is_exact_and_small(spark):
    rnd = random.Random(3)
    spans = [(a, a + rnd.choice([0, 1, 5, 31, 400, 70_000])) for a in (rnd.randrange(0, 3_000_000) for _ in range(200))]
    df = spark.createDataFrame(spans, "lo int, hi int").withColumn("c", st.dyadic_cover(F.col("lo"), F.col("hi")))
    for r in df.collect():
        pieces = sorted((x["place"] << x["level"], (x["place"] + 1) << x["level"]) for x in r["c"])
        assert pieces[0][0] == r["lo"] and pieces[-1][1] == r["hi"] + 1 and all(a[1] == b[0] for a, b in zip(pieces, pieces[1:]))
        assert len(pieces) <= 2 * (r["hi"] - r["lo"] + 1).bit_length()
    (r,) = spark.range(1).select(st.dyadic_stretches(F.lit(1000)).alias("s")).collect()
    assert [x["place"] for x in r["s"]] == [1000 >> k for k in range(st.LEVELS + 1)]


def test_staircase_keeps_what_contains_no_other(spark):
    rnd = random.Random(4)
    for _ in range(20):
        a = sorted(rnd.randrange(20) for _ in range(rnd.randrange(0, 8)))
        pairs = [(x, y) for x, y in zip(a, sorted(x + rnd.randrange(10) for x in a))]
        df = spark.createDataFrame([(pairs,)], "p array<struct<a:int,b:int>>")
        got = [tuple(x) for x in df.select(st.staircase(F.col("p")).alias("s")).first()["s"]]
        assert got == sorted({p for p in pairs if not any(q != p and q[0] >= p[0] and q[1] <= p[1] for q in pairs)})


def test_rows_do_not_grow_with_the_windows(spark):
    """Ten times the overlapping windows over the same days: intermediate rows stay, only the counts grow."""
    ledger = [mv(f"S{i}", f"A{i % 7}", f"T{i}", D(2024, 1, 1) + dt.timedelta(days=i % 28), "STANDIN", ref=f"D{i % 20}") for i in range(60)]
    ledger += [mv(f"C{i}", f"A{i % 7}", f"D{i % 20}", D(2024, 1, 1) + dt.timedelta(days=i % 30)) for i in range(140)]
    mov = movements_df(spark, ledger)
    sizes = []
    for repeat in (1, 10):
        windows = [{"periodo_tope": D(2024, 1, 1) + dt.timedelta(days=i % 5), "periodo": D(2024, 1, 20) + dt.timedelta(days=i % 11)} for i in range(40 * repeat)]
        measured = st.measure_windows(windows_df(spark, windows))
        stairs = st.key_staircases(st.pair_intervals(measured, mov))
        steps = st.movement_steps(measured, mov, stairs)
        counts = st.movement_counts(measured, mov)
        sizes.append((measured.rows, stairs.rows, steps.rows, counts.rows))
        assert keys(st.match_windows_overlapping(windows_df(spark, windows), mov)) == brute.match_windows(ledger, windows)
        assert sum(counts.df.agg(F.sum("_rep")).first()) > 20 * counts.rows
        per_window = wn.window_standins(wn.window_bins(wn.window_keys(windows_df(spark, windows)), "wn_lo", "wn_hi"), mov).count()
        assert steps.rows < per_window / 5
    assert sizes[0][1:] == sizes[1][1:]


def test_no_nested_loop(spark, no_broadcast):
    df = st.match_windows_overlapping(windows_df(spark, WINDOWS), movements_df(spark, LEDGER))
    assert plan_violations(df) == []


def test_copies_are_dealt_evenly(spark):
    """Two movements that 40,000 windows hold: no task makes all copies of one, and the counts stay exact."""
    ledger = [mv("S", "A", "T", D(2024, 1, 5), "STANDIN", ref="D"), mv("C", "A", "D", D(2024, 1, 7)), mv("C", "A", "D", D(2024, 1, 7)), mv("O", "A", "X", D(2024, 1, 7))]
    n = 4 * st.PIECE + 1
    windows = windows_df(spark, [{"periodo_tope": D(2024, 1, 1), "periodo": D(2024, 1, 31)}]).withColumn("i", F.explode(F.sequence(F.lit(1), F.lit(n)))).drop("i")
    mov = movements_df(spark, ledger).repartition(1)
    assert st.movement_counts(st.measure_windows(windows), mov).extras["_made"] == 3 * n
    got = st.match_windows_overlapping(windows, mov)
    assert {r["id_transaccion"]: r["count"] for r in got.groupBy("id_transaccion").count().collect()} == {"S": n, "C": 2 * n}
    tasks = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    assert max(tasks) <= 3 * n // 4


@pytest.mark.parametrize("n", [1, 2, 3, 4, 6, 7])
def test_copies_are_made_by_the_handful(spark, n):
    df = movements_df(spark, LEDGER[:3]).withColumn("_rep", F.lit(n).cast("long"))
    got = format_movements(df, extra=("_rep",), repeat="_rep", handful=3)
    assert Counter(r["id_transaccion"] for r in got.collect()) == {"S1": n, "B1": n, "C1": n}
    assert got.columns == [*MOVEMENT_COLUMNS, "_rep"]
    assert [r["_rep"] for r in in_pieces(df.select("_rep").limit(1), "_rep", 3).collect()] == [3] * (n // 3) + [n % 3] * (n % 3 > 0)


def test_the_generator_holds_no_more_than_a_handful(spark):
    """Copies are made in two steps, the last of which has a bounded count."""
    text = plan_text(st.match_windows_overlapping(windows_df(spark, WINDOWS), movements_df(spark, LEDGER)), "simple")
    assert f"least({st.HANDFUL}" in text and "RoundRobinPartitioning" in text
