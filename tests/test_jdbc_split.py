"""The equal-depth split of a JDBC read, on Derby embedded in the Spark JVM (no server, no port)."""

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from movrec.plans import host
from movrec.sources.snapshot import equal_depth_parts, jdbc_predicates, read_jdbc_equal_depth
from rows import LEDGER, D, movements_df, mv

HASH = 'CAST(CAST(SUBSTR("id_transaccion", 2) AS VARCHAR(20)) AS INTEGER)'


def stored(spark, rows):
    url = f"jdbc:derby:memory:depth{dt.datetime.now().strftime('%H%M%S%f')};create=true"
    movements_df(spark, rows).write.format("jdbc").options(url=url, dbtable="MOVIMIENTOS", driver="org.apache.derby.jdbc.EmbeddedDriver").save()
    return url


def sizes(df):
    return [r["n"] for r in df.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()]


def test_a_hot_day_is_many_parts(spark):
    """Four fifths of the rows on one day: no part holds over twice the mean, every row is read once."""
    rows = [mv(f"S{i}", "A", str(i), D(2024, 3, 15), "STANDIN") for i in range(800)]
    rows += [mv(f"S{800 + i}", "A", str(i), D(2024, 1, 1) + dt.timedelta(days=i % 150), "STANDIN") for i in range(190)]
    rows += [mv(None, "A", "n", D(2024, 3, 15)) for _ in range(5)] + [mv(f"S{2000 + i}", "A", "n", None) for i in range(5)]
    url = stored(spark, rows)
    df = read_jdbc_equal_depth(spark, 10, HASH, url=url, table="MOVIMIENTOS")
    counts = sizes(df)
    assert sum(counts) == 1000 and 5 <= len(counts) <= 10 and max(counts) <= 2 * sum(counts) / len(counts)
    assert Counter(r["id_transaccion"] for r in df.select("id_transaccion").collect()) == Counter(r["id_transaccion"] for r in rows)
    through_host = host.snapshot_from_params(spark, {"JDBC_URL": url, "JDBC_TABLE": "MOVIMIENTOS", "JDBC_PARTITIONS": 10, "JDBC_HASH": HASH})
    assert sorted(sizes(through_host)) == sorted(counts)
    whole = read_jdbc_equal_depth(spark, 10, None, url=url, table="MOVIMIENTOS")  # Derby has no hash of text
    assert max(sizes(whole)) >= sum(r["periodo"] == D(2024, 3, 15) for r in rows) and sum(sizes(whole)) == 1000


def test_tables_without_rows_or_periods(spark):
    assert read_jdbc_equal_depth(spark, 4, HASH, url=stored(spark, []), table="MOVIMIENTOS").count() == 0
    assert sizes(read_jdbc_equal_depth(spark, 4, HASH, url=stored(spark, [mv(f"S{i}", "A", "n", None) for i in range(40)]), table="MOVIMIENTOS")) == [10] * 4
    assert read_jdbc_equal_depth(spark, 4, None, url=stored(spark, LEDGER), table="MOVIMIENTOS").count() == len(LEDGER)


def test_parts_are_the_best_there_are():
    """Against every way to cut short histograms, and random long ones."""

    def best(counts, parts):
        if not counts:
            return 0
        if parts == 0:
            return None
        options = []
        for i in range(1, len(counts) + 1):
            rest = best(counts[i:], parts - 1)
            if rest is not None:
                options.append(max(sum(counts[:i]), rest))
        return min(options)

    rnd = random.Random(5)
    for _ in range(200):
        counts = [rnd.randrange(1, 30) for _ in range(rnd.randrange(1, 7))]
        parts = rnd.randrange(1, 6)
        got = equal_depth_parts(counts, parts, divisible=False)
        assert [i for p in got for i, _, _ in p] == list(range(len(counts))) and len(got) <= parts
        assert max(sum(counts[i] for i, _, _ in p) for p in got) == best(counts, parts)
    for _ in range(200):
        counts = [rnd.choice([1, 5, 50, 5000]) for _ in range(rnd.randrange(1, 200))]
        got = equal_depth_parts(counts, 16)
        share = lambda p: sum(-(-counts[i] // pieces) for i, _, pieces in p)
        assert len(got) <= 16 and max(map(share, got)) <= max(2 * sum(counts) / len(got), 1) + 1
        assert sorted({(i, j) for p in got for i, j, _ in p}) == sorted({(i, j) for p in got for i, _, m in p for j in range(m)})
    assert equal_depth_parts([], 4) == []


@pytest.mark.parametrize("hash_sql", [None, "h"])
def test_clauses_cover_every_period_once(hash_sql):
    days = [(None, 3)] + [(D(2024, 1, 1 + i), 1 + 50 * (i == 7)) for i in range(20)]
    clauses = jdbc_predicates({"periodo": "PERIODO"}, days, 6, hash_sql)
    assert len(clauses) <= 6 and sum('"PERIODO" IS NULL' in c for c in clauses) == 1
    pieces = [c for c in clauses if "MOD(h" in c]
    assert bool(pieces) == (hash_sql is not None) and sum("(h) IS NULL" in c for c in pieces) == min(1, len(pieces))
