"""The id index and the snapshot bucketed by account and document: same results, less read, no exchange."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

import brute
from movrec.operators import changes as ch
from movrec.operators import requests as rq
from movrec.operators.sizing import materialize
from movrec.plans.inspect import plan_text, scans
from movrec.schema import movement_schema
from movrec.session import scratch_path
from movrec.sources.layouts import SALT, IdIndex, KeyedSnapshot
from movrec.sources.snapshot import load_snapshot, write_snapshot
from rows import LEDGER, REQUESTS, D, movements_df, mv, requests_df
from rows import rq as make_rq


def matched(df):
    return Counter((r["id_transaccion"], r["periodo"], r["reposting_completo"]) for r in df.collect())


@pytest.fixture
def days(spark):
    """A snapshot partitioned by period: 60 days of stand-ins, one id on three of them."""
    rows = [mv(f"S{i}", "A", f"T{i}", D(2024, 1 + i // 30, 1 + i % 28), "STANDIN") for i in range(60)]
    rows += [mv("MANY", "A", "T", D(2024, m, 7), "STANDIN") for m in (1, 2, 3)] + [mv(None, "A", "T", D(2024, 3, 8), "STANDIN")]
    path = scratch_path(spark, "days")
    write_snapshot(movements_df(spark, rows), path, partition_by="periodo")
    return load_snapshot(spark, path, schema=movement_schema())


def read_periods(df):
    """How many period folders the scans of the plan list."""
    df.collect()
    return {s["PartitionFilters"] for s in scans(df) if "PartitionFilters" in s and "periodo" in s.get("PartitionFilters", "")}


def test_the_mark_reads_the_periods_of_its_ids_only(spark, days):
    index = IdIndex.build(days, scratch_path(spark, "ids"))
    req = requests_df(spark, [make_rq("MANY", "D", D(2024, 2, 1), D(2024, 2, 10)), make_rq("S3", "D", D(2024, 1, 1), D(2024, 1, 31), ben_id="none")])
    ids = materialize(spark.createDataFrame([("MANY", D(2024, 2, 1)), ("S3", D(2024, 1, 1))], "mk_id string, mk_lo date"))
    assert index.periods(ids, "mk_id", "mk_lo") == [D(2024, 1, 4), D(2024, 2, 7), D(2024, 3, 7)]
    marks = ch.mark_reposted_changes(req, days, index)
    assert sorted(map(tuple, marks.collect())) == sorted(map(tuple, ch.mark_reposted_changes(req, days).collect()))
    filters = next(iter(read_periods(marks)))
    assert "IN" in filters and all(d in filters for d in ("2024-01-04", "2024-02-07", "2024-03-07")) and "2024-01-05" not in filters


def test_the_index_follows_new_movements_and_never_misses(spark, days):
    index = IdIndex.build(days, scratch_path(spark, "ids"), rows=10)
    late = movements_df(spark, [mv("S3", "A", "T", D(2025, 1, 1), "STANDIN"), mv("NEW", "A", "T", D(2025, 1, 2), "STANDIN"), mv("GONE", "A", "T", None)])
    index.add(late)
    every = days.unionByName(late)
    req = requests_df(spark, [make_rq(i, "D", D(2024, 1, 1), D(2025, 12, 31)) for i in ("S3", "NEW", "MANY", "GONE", "nothing")])
    key = lambda df: sorted(map(tuple, df.collect()))
    assert key(ch.mark_reposted_changes(req, every, index)) == key(ch.mark_reposted_changes(req, every))
    keys = rq.measure_keys(rq.request_keys(req), "rq_lo", "rq_hi")
    assert key(rq.request_legs(keys, every, index)) == key(rq.request_legs(keys, every))
    none = rq.measure_keys(rq.request_keys(requests_df(spark, [make_rq("nothing", "D", D(2024, 1, 1), D(2024, 2, 1))])), "rq_lo", "rq_hi")
    assert rq.request_legs(none, every, index).count() == 0


def test_an_index_lookup_moves_only_the_ids(spark, days, no_broadcast):
    index = IdIndex.build(days, scratch_path(spark, "ids"))
    ids = materialize(spark.createDataFrame([("MANY", D(2024, 2, 1))], "mk_id string, mk_lo date"))
    ix, w = index.rows(), ids.side()
    text = plan_text(ix.join(w, (ix["id_transaccion"] == w["mk_id"]) & (ix["periodo"] >= w["mk_lo"]), "left_semi"))
    assert text.count("hashpartitioning(mk_id") >= 1 and "hashpartitioning(id_transaccion" not in text


@pytest.mark.parametrize("per_bucket", [2, 2_000_000])
def test_keyed_snapshot_gives_the_same_matches(spark, no_broadcast, per_bucket):
    """Also where a key is hot: with two rows a bucket the 22 rows of (A1, D1) get eleven salts."""
    extra = [mv(f"H{i}", "A1", "D1", D(2024, 1, 13)) for i in range(20)] + [mv("K", None, None, D(2024, 1, 13)), mv("K2", "A1", None, D(2024, 1, 13))]
    keyed = KeyedSnapshot.write(movements_df(spark, LEDGER + extra), scratch_path(spark, "keyed"), per_bucket=per_bucket)
    req = requests_df(spark, REQUESTS)
    assert keyed.hot.count() == (0 if per_bucket > 2 else 1)
    assert keyed.rows().count() == len(LEDGER) + len(extra)
    if per_bucket == 2:
        assert keyed.rows().filter("numero_documento = 'D1'").select(SALT).distinct().count() > 3
    for index in (None, IdIndex.build(keyed.rows(), scratch_path(spark, "ids"))):
        assert matched(rq.match_requests_keyed(req, keyed, index=index)) == brute.match_requests(LEDGER + extra, REQUESTS)
    plain = rq.match_requests(req, movements_df(spark, LEDGER + extra), dedupe=True)
    assert matched(rq.match_requests_keyed(req, keyed, dedupe=True)) == matched(plain)


def test_key_joins_leave_the_bucketed_snapshot_where_it_lies(spark, no_broadcast):
    from conftest import SF001
    from movrec.plans import catalog as C

    keyed = KeyedSnapshot.write(C.movements(spark, SF001), scratch_path(spark, "keyed"))
    pairs = rq.measure_pairs(keyed.salted(rq.prepare_pairs(C.requests(spark, SF001), keyed.rows()).df))
    for df in (rq.request_movements(pairs, keyed.rows()), rq.request_verdicts(pairs, keyed.rows())):
        text = plan_text(df)
        assert "SelectedBucketsCount" in text and "SortMergeJoin" in text
        assert "hashpartitioning(kp_cuenta" in text and "hashpartitioning(numero_cuenta_id" not in text
    columns = [f.name for f in keyed.rows().schema.fields]
    assert columns[-1] == SALT and keyed.rows().select(F.max(SALT)).first()[0] == 0
