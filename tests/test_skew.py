"""A hot key holding a third of the rows: results stay whole and exact on the shuffle path."""

from collections import Counter

import pytest

import brute
from movrec.operators import requests as rq
from movrec.operators import windows as wn
from rows import D, movements_df, mv, requests_df, rq as make_rq, windows_df


def hot_ledger(n=900):
    rows = []
    for i in range(n):
        day = D(2024, 1, 1 + i % 28)
        rows.append(mv(f"S{i}", f"A{i % 50}", f"T{i}", day, "STANDIN", ref=f"D{i}", ben=f"00A{i % 7}"))
        rows.append(mv(f"C{i}", f"A{i % 50}", f"D{i}", day))
    # one third of all rows on one (account, document) key and one date
    for i in range(n):
        rows.append(mv(f"H{i}", "HOT", "HOTDOC", D(2024, 1, 15), None if i % 2 else "STANDIN"))
    rows.append(mv("SH", "HOT", "T-HOT", D(2024, 1, 15), "STANDIN", ref="HOTDOC"))
    return rows


@pytest.fixture
def skewed(spark, no_broadcast):
    keys = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
    }
    old = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def test_hot_key_requests(spark, skewed):
    rows = hot_ledger()
    reqs = [make_rq("SH", "HOTDOC", D(2024, 1, 1), D(2024, 1, 31))] * 3 + [
        make_rq(f"S{i}", f"D{i}", D(2024, 1, 1), D(2024, 1, 31)) for i in range(0, 900, 37)
    ]
    got = rq.match_requests(requests_df(spark, reqs), movements_df(spark, rows))
    counter = Counter((r["id_transaccion"], r["periodo"], r["reposting_completo"]) for r in got.collect())
    assert counter == brute.match_requests(rows, reqs)
    assert sum(v for (i, _, _), v in counter.items() if i.startswith("H")) == 3 * 900


def test_hot_key_windows(spark, skewed):
    rows = hot_ledger()
    wins = [{"periodo": D(2024, 1, 31), "periodo_tope": D(2024, 1, 1)}, {"periodo": D(2024, 1, 20), "periodo_tope": D(2024, 1, 10)}]
    got = wn.match_windows(windows_df(spark, wins), movements_df(spark, rows))
    counter = Counter((r["id_transaccion"], r["periodo"]) for r in got.collect())
    assert counter == brute.match_windows(rows, wins)


def test_many_windows_on_the_shuffle_path(spark, skewed):
    rows = hot_ledger(120)
    wins = [{"periodo": D(2024, 1, 1 + (i * 7) % 28), "periodo_tope": D(2024, 1, 1 + (i * 3) % 28)} for i in range(300)]
    got = wn.match_windows(windows_df(spark, wins), movements_df(spark, rows))
    counter = Counter((r["id_transaccion"], r["periodo"]) for r in got.collect())
    assert counter == brute.match_windows(rows, wins)


def test_hot_day_is_written_to_even_files(spark):
    """Nine rows in ten on one day: the parts are sized by rows, not by days."""
    import pyarrow.parquet as pq
    from pathlib import Path

    from pyspark.sql import functions as F
    from movrec.session import local_path, scratch_path
    from movrec.sources.snapshot import load_snapshot, write_snapshot

    one = mv("S", "A", "T", D(2024, 1, 1), "STANDIN")
    day = F.when(F.col("id") % 10 == 0, F.date_add(F.lit(D(2024, 1, 1)), (F.col("id") % 300).cast("int"))).otherwise(F.lit(D(2024, 6, 1)))
    made = {"periodo": day, "id_transaccion": F.sha2(F.col("id").cast("string"), 256)}
    schema = movements_df(spark, [one]).schema
    big = spark.range(0, 60000, 1, 8).select(*[made.get(f.name, F.lit(one[f.name])).cast(f.dataType).alias(f.name) for f in schema.fields])
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "512k")
    try:
        path = write_snapshot(big, scratch_path(spark, "hot-day"), files=16)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    sizes = [pq.read_metadata(f).num_rows for f in Path(local_path(path)).glob("*.parquet")]
    assert sum(sizes) == 60000 and len(sizes) >= 6
    assert max(sizes) <= 2.2 * sum(sizes) / len(sizes), sizes
    assert load_snapshot(spark, path).count() == 60000
