"""Requests in their order against a plain replay; verdicts by arrivals against the full ones."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

import brute
from movrec.operators import requests as rq
from movrec.operators.ordered import carry_last, match_ordered
from movrec.operators.verdicts import Verdicts
from movrec.session import scratch_path
from rows import LEDGER, REQ_SCHEMA, REQUESTS, D, movements_df, mv
from rows import rq as make_rq


def ordered_df(spark, requests):
    rows = [(r["producto_ordenante"], r["producto_beneficiario"], r["numero_documento_original"], r["periodo"], r["periodo_tope"], r["guid_ordenante"], r["guid_beneficiario"], o) for o, r in requests]
    return spark.createDataFrame(rows, REQ_SCHEMA + ", orden bigint")


def replay(ledger, requests):
    """One request after the other over a list of rows: read, then mark."""
    table = [dict(m) for m in ledger]
    out = Counter()
    for order, r in sorted(requests, key=lambda x: x[0]):
        for (i, periodo, verdict), n in brute.match_requests(table, [r]).items():
            rows = [m for m in table if m["id_transaccion"] == i and str(m["periodo"]) == periodo]
            assert len({(m["numero_comprobante_reposting"], m["estado_transaccion"]) for m in rows}) == 1
            out[order, i, periodo, verdict, rows[0]["numero_comprobante_reposting"], str(rows[0]["estado_transaccion"])] += n
        if r["producto_ordenante"] and r["producto_beneficiario"] and r["numero_documento_original"]:
            for m in table:
                if m["id_transaccion"] in (r["guid_ordenante"], r["guid_beneficiario"]) and m["id_transaccion"] is not None:
                    if m["tipo_procesamiento"] == "STANDIN" and r["periodo_tope"] and m["periodo"] >= r["periodo_tope"]:
                        m.update(numero_comprobante_reposting=r["numero_documento_original"], estado_transaccion=10)
    return out, Counter((str(m["id_transaccion"]), str(m["periodo"]), m["numero_comprobante_reposting"], m["estado_transaccion"]) for m in table)


def ran(spark, ledger, requests):
    done = match_ordered(ordered_df(spark, requests), movements_df(spark, ledger))
    rows = Counter((r["orden"], r["id_transaccion"], r["periodo"], r["reposting_completo"], r["numero_comprobante_reposting"], r["estado_transaccion"]) for r in done.matched.collect())
    table = Counter((str(r["id_transaccion"]), str(r["periodo"]), r["numero_comprobante_reposting"], r["estado_transaccion"]) for r in done.snapshot.collect())
    return rows, table


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_ordered_requests_equal_a_plain_replay(spark, request, seed):
    if seed == 2:
        request.getfixturevalue("no_broadcast")
    orders = list(range(len(REQUESTS)))
    random.Random(seed).shuffle(orders)
    requests = list(zip(orders, REQUESTS))
    assert ran(spark, LEDGER, requests) == replay(LEDGER, requests)


def test_a_movement_that_every_request_marks(spark, no_broadcast):
    """One stand-in carries all marks: each request sees the document of the one before it."""
    ledger = [mv("S", "A", "T", D(2024, 1, 1), "STANDIN"), mv("C", "A", "T", D(2024, 1, 2)), mv("S", "A", "T", D(2024, 1, 3), "STANDIN_P")]
    requests = [(o, make_rq("S", f"D{o}", D(2024, 1, 1), D(2024, 1, 9), ben_id="S")) for o in random.Random(1).sample(range(100), 60)]
    got = ran(spark, ledger, requests)
    assert got == replay(ledger, requests)
    assert len({k[4] for k in got[0]}) == 60  # every document but the last, and none


def test_no_requests_or_no_matches(spark):
    assert ran(spark, LEDGER, []) == replay(LEDGER, [])
    assert ran(spark, LEDGER, [(1, make_rq("NOPE", "D", D(2024, 1, 1), D(2024, 1, 2)))])[0] == Counter()


def test_carry_last_over_many_parts(spark):
    """A key with two thirds of the rows, cut over many parts, and stretches of parts without a value."""
    rnd = random.Random(2)
    rows = [(rnd.choice("hhhhab"), i, str(i) if rnd.random() < 0.02 else None) for i in range(3000)]
    spark.conf.set("spark.sql.shuffle.partitions", "37")
    try:
        got = carry_last(spark.createDataFrame(rows, "k string, o int, v string"), ("k",), ("o",), "v", "last").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    last, want = {}, []
    for k, o, v in rows:
        last[k] = v or last.get(k)
        want.append((k, o, v, last[k]))
    assert sorted((r["k"], r["o"], str(r["v"]), str(r["last"])) for r in got) == sorted((k, o, str(v), str(x)) for k, o, v, x in want)


# --- verdicts ---------------------------------------------------------------------------
def verdicts_of(df):
    return sorted(map(tuple, df.select(*rq.REQ_KEY, "reposting_completo").collect()))


def full(spark, req, ledger):
    mov = movements_df(spark, ledger)
    pairs = rq.prepare_pairs(req, mov)
    return [] if pairs is None or pairs.rows == 0 else verdicts_of(rq.request_verdicts(pairs, mov))


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_verdicts_after_each_arrival_equal_the_full_ones(spark, request, seed):
    if seed == 2:
        request.getfixturevalue("no_broadcast")
    rnd = random.Random(seed)
    req = ordered_df(spark, list(enumerate(REQUESTS)))
    state, so_far = Verdicts(spark, req, scratch_path(spark, "verdicts")), []
    for part in range(3):
        new = [m for m in LEDGER if m not in so_far and (part == 2 or rnd.random() < 0.4)]
        state.arrive(movements_df(spark, new))
        so_far += new
        assert verdicts_of(state.verdicts()) == full(spark, req, so_far)
    assert verdicts_of(Verdicts(spark, req, state.path).verdicts()) == full(spark, req, LEDGER)  # the folder is the state


def test_only_touched_requests_are_judged_again(spark):
    req = ordered_df(spark, list(enumerate(REQUESTS)))
    state = Verdicts(spark, req, scratch_path(spark, "verdicts"))
    state.arrive(movements_df(spark, LEDGER))
    touched = state.arrive(movements_df(spark, [mv("C9", "A2", "D2", D(2024, 1, 9)), mv("far", "ZZ", "ZZ", D(2024, 1, 9))]))
    assert {r["rq_guid"] for r in touched.collect()} == {"S2"}
    assert state.arrive(movements_df(spark, [mv("late", "A2", "D2", D(2025, 1, 9)), mv("null", None, "D2", D(2024, 1, 9))])).count() == 0


def test_a_broken_arrival_is_repeated(spark, monkeypatch):
    req = ordered_df(spark, list(enumerate(REQUESTS)))
    for stop in range(3):
        state = Verdicts(spark, req, scratch_path(spark, "verdicts"))
        append, calls = state._append, []

        def failing(name, rows):
            if len(calls) == stop:
                raise RuntimeError("crash")
            calls.append(name)
            append(name, rows)

        half, rest = movements_df(spark, LEDGER[::2]), movements_df(spark, LEDGER[1::2])
        state.arrive(half)
        state._append = failing
        with pytest.raises(RuntimeError):
            state.arrive(rest)
        state._append = append
        state.arrive(rest)
        assert verdicts_of(state.verdicts()) == full(spark, req, LEDGER)
    empty = Verdicts(spark, req.limit(0), scratch_path(spark, "verdicts"))
    assert empty.arrive(half).count() == 0 and empty.verdicts().count() == 0
