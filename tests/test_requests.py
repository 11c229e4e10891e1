"""Transform A (request matching) and its repost mark against the brute-force model."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

import brute
from movrec.operators import changes as ch
from movrec.operators import requests as rq
from movrec.schema import MOVEMENT_COLUMNS, VERDICT_COLUMN
from rows import LEDGER, REQUESTS, movements_df, requests_df, rq as make_rq, D


def spark_counter(df):
    return Counter((r["id_transaccion"], r["periodo"], r[VERDICT_COLUMN]) for r in df.collect())


@pytest.fixture
def ledger(spark):
    return movements_df(spark, LEDGER), requests_df(spark, REQUESTS)


def test_match_requests_equals_per_request_model(spark, ledger):
    mov, req = ledger
    got = rq.match_requests(req, mov)
    assert got.columns == list(MOVEMENT_COLUMNS) + [VERDICT_COLUMN]
    assert all(t == "string" for _, t in got.dtypes)
    assert spark_counter(got) == brute.match_requests(LEDGER, REQUESTS)


def test_match_requests_shuffle_path_equals_broadcast_path(spark, ledger, no_broadcast):
    mov, req = ledger
    assert spark_counter(rq.match_requests(req, mov)) == brute.match_requests(LEDGER, REQUESTS)


def test_edge_cases_by_name(spark, ledger):
    mov, req = ledger
    rows = spark_counter(rq.match_requests(req, mov))
    verdict = {i: v for (i, _, v) in rows}
    # duplicate request doubles every row; stand-in + core -> MATCH
    assert rows[("C1", "2024-01-12", "MATCH")] == 2
    # parked-only group is NO MATCH ('STANDIN_P' does not count, '' is not NULL)
    assert verdict["S2"] == "NO MATCH" and verdict["P2"] == "NO MATCH"
    # stripped beneficiary '0000' -> '' matches the empty account
    assert ("E2", "2024-01-06", "NO MATCH") in rows
    # same account on both legs and documento == original: 4 identical keys
    assert rows[("C3", "2024-01-31", "MATCH")] == 4
    # inclusive lower bound; two legs share one id: leg 1 gives (A4, D4) twice
    # (own document = original document), leg 2 gives (A4, T4) once and (A4, D4) once
    assert rows[("C4", "2024-01-01", "MATCH")] == 3
    assert rows[("S4", "2024-01-01", "MATCH")] == 3
    assert rows[("S4", "2024-01-02", "MATCH")] == 1
    # out-of-range movement never appears
    assert not any(i == "X1" for (i, _, _) in rows)


def test_verdict_constant_per_request(spark, ledger):
    mov, req = ledger
    pairs = rq.prepare_pairs(req, mov)
    rows = rq.request_movements(rq.judged_pairs(pairs, mov), mov)
    n = rows.groupBy(*rq.REQ_KEY).agg(F.countDistinct(VERDICT_COLUMN).alias("n")).filter("n > 1").count()
    assert n == 0


def test_empty_and_missing_inputs(spark, ledger):
    mov, req = ledger
    empty = rq.match_requests(req.limit(0), mov)
    assert empty.count() == 0 and len(empty.columns) == 51
    # a driving frame without a guarded column skips every row
    assert rq.match_requests(req.drop("producto_beneficiario"), mov).count() == 0


def test_text_bounds_are_parsed(spark, ledger):
    mov, req = ledger
    as_text = req.withColumn("periodo", F.date_format("periodo", "yyyy-MM-dd")).withColumn(
        "periodo_tope", F.date_format("periodo_tope", "yyyy-MM-dd")
    )
    assert spark_counter(rq.match_requests(as_text, mov)) == brute.match_requests(LEDGER, REQUESTS)


def test_formatting_of_times_and_money(spark, ledger):
    mov, req = ledger
    r = rq.match_requests(req, mov).filter("id_transaccion = 'S1'").first()
    assert r["fecha_hora_transaccion_contable"] == "2024-01-02 03:04:05"
    assert r["kafka_timestamp_ec"] == "2024-01-02 03:04:05.987"  # truncated, not rounded
    assert r["valor_transaccion"] == "12.50"
    assert r["periodo"] == "2024-01-10"


def _marks(df):
    return {(str(r["periodo"]), r["id_transaccion"]): (r["numero_comprobante_reposting"], r["n_documentos"]) for r in df.collect()}


@pytest.mark.parametrize("path", ["broadcast", "shuffle"])
def test_mark_reposted_changes(spark, ledger, request, path):
    if path == "shuffle":
        request.getfixturevalue("no_broadcast")
    mov, req = ledger
    got = _marks(ch.mark_reposted_changes(req, mov))
    want = brute.mark_reposted(LEDGER, REQUESTS)
    assert set(got) == set(want)
    for k, docs in want.items():
        assert got[k] == (max(docs), len(docs))
    # conflict reported, deterministic winner
    assert got[("2024-02-01", "S6")] == ("DX", 2)
    # parked stand-in is never marked
    assert ("2024-01-05", "S2") not in got


def test_mark_apply_only_touches_standin_rows(spark):
    from movrec.operators.apply import apply_updates

    rows = [
        __import__("rows").mv("S1", "A", "T", D(2024, 1, 1), "STANDIN"),
        __import__("rows").mv("S1", "A", "T", D(2024, 1, 1), "STANDIN_P"),
    ]
    mov = movements_df(spark, rows)
    req = requests_df(spark, [make_rq("S1", "D1", D(2023, 12, 1), D(2023, 12, 2))])  # upper bound ignored
    marks = ch.mark_reposted_changes(req, mov)
    out = apply_updates(mov, marks, ch.MARK_KEYS, ch.MARK_ASSIGN).collect()
    by_type = {r["tipo_procesamiento"]: (r["numero_comprobante_reposting"], r["estado_transaccion"]) for r in out}
    assert by_type == {"STANDIN": ("D1", 10), "STANDIN_P": (None, 1)}


def test_invariant_under_partitioning(spark, ledger):
    mov, req = ledger
    want = spark_counter(rq.match_requests(req, mov))
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        got = spark_counter(rq.match_requests(req.repartition(5), mov.repartition(7)))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert got == want


def test_dedupe_option(spark, ledger):
    mov, req = ledger
    got = spark_counter(rq.match_requests(req, mov, dedupe=True))
    full = brute.match_requests(LEDGER, REQUESTS)
    assert set(got) == set(full)
    # C3 matched four times by equal keys of one request: once after dedupe
    assert got[("C3", "2024-01-31", "MATCH")] == 1
    # duplicate driving rows still repeat
    assert got[("C1", "2024-01-12", "MATCH")] == 2


def test_empty_snapshot(spark, ledger):
    from movrec.operators import windows as wn
    from rows import WINDOWS, windows_df

    mov, req = ledger
    empty = mov.limit(0)
    assert rq.match_requests(req, empty).count() == 0
    assert wn.match_windows(windows_df(spark, WINDOWS), empty).count() == 0
    assert ch.mark_reposted_changes(req, empty).count() == 0
