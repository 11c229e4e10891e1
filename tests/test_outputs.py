"""Output steps: delete legs, park, release, archive + purge, audit."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from movrec.operators import apply as ap
from movrec.operators import changes as ch
from movrec.operators import requests as rq
from movrec.operators.archive import archive_and_purge
from movrec.schema import WRITE_KEY
from movrec.session import scratch_path
from movrec.sources.lake import append_to_lake, lake_path, read_lake
from rows import LEDGER, REQUESTS, D, movements_df, mv, requests_df


def ids(df):
    return sorted(r["id_transaccion"] for r in df.select("id_transaccion").collect())


def test_delete_request_legs_and_idempotence(spark):
    mov = movements_df(spark, LEDGER)
    # O3 keys on the request's upper period, so legs dated on it are deleted
    req = requests_df(spark, [
        {"producto_ordenante": None, "producto_beneficiario": None, "numero_documento_original": None,
         "periodo": D(2024, 1, 10), "periodo_tope": None, "guid_ordenante": "S1", "guid_beneficiario": "B1"},
        {"producto_ordenante": None, "producto_beneficiario": None, "numero_documento_original": None,
         "periodo": D(2024, 1, 3), "periodo_tope": None, "guid_ordenante": "S5", "guid_beneficiario": None},
        {"producto_ordenante": None, "producto_beneficiario": None, "numero_documento_original": None,
         "periodo": D(2024, 1, 12), "periodo_tope": None, "guid_ordenante": "", "guid_beneficiario": "C1"},  # guard
    ])
    keys = ch.request_leg_delete_keys(req)
    once = ap.apply_deletes(mov, keys, WRITE_KEY)
    assert set(ids(mov)) - set(ids(once)) == {"S1", "B1", "S5"}
    twice = ap.apply_deletes(once, keys, WRITE_KEY)
    assert ids(twice) == ids(once)


def test_park_then_release_restores_standin(spark):
    mov = movements_df(spark, LEDGER)
    matched = rq.match_requests(requests_df(spark, REQUESTS), mov)
    parked = ap.apply_updates(mov, ch.park_unmatched_keys(matched), WRITE_KEY, ch.PARK_ASSIGN)
    park_keys = {(str(r["periodo"]), r["id_transaccion"]) for r in ch.park_unmatched_keys(matched).collect()}
    # NO MATCH group of S2 contains S2, P2 and E2; E2 had type ''
    assert {("2024-01-05", "S2"), ("2024-01-06", "P2"), ("2024-01-06", "E2")} <= park_keys
    p = {(str(r["periodo"]), r["id_transaccion"]): r["tipo_procesamiento"] for r in parked.collect()}
    assert all(p[k] == "STANDIN_P" for k in park_keys)
    # release everything parked, reading the parked snapshot as the result rows
    released = ap.apply_updates(parked, ch.release_parked_keys(parked), WRITE_KEY, ch.RELEASE_ASSIGN)
    r = {(str(x["periodo"]), x["id_transaccion"]): x["tipo_procesamiento"] for x in released.collect()}
    assert all(r[k] == "STANDIN" for k in park_keys)


def test_release_processes_more_than_preview_rows(spark):
    # the reference's status preview stops at 10,000 rows; every key must still be applied
    n = 12000
    template = movements_df(spark, [mv("seed", "A", "T", D(2024, 1, 1), "STANDIN_P")]).first().asDict()
    big = spark.range(n).select(
        *[
            (F.concat(F.lit("P"), F.col("id").cast("string")) if c == "id_transaccion" else F.lit(v)).alias(c)
            for c, v in template.items()
        ]
    )
    released = ap.apply_updates(big, ch.release_parked_keys(big), WRITE_KEY, ch.RELEASE_ASSIGN)
    assert released.filter(F.col("tipo_procesamiento") == "STANDIN").count() == n


def test_archive_covers_input(spark):
    rows = [
        mv("A", "X", "1", D(2024, 1, 1), "STANDIN", ref="R"),  # both filled: stays
        mv("B", "X", "2", D(2024, 1, 1), "STANDIN", ref=None),
        mv("C", "X", "3", D(2024, 1, 1), "STANDIN", ref=""),
        mv("E", "X", "4", D(2024, 1, 1), None, ref="R"),
        mv("F", "X", "5", D(2024, 1, 1), "", ref="R"),
        mv("G", "X", "6", None, None, ref=None),  # archived, but a NULL period is never purged
    ]
    mov = movements_df(spark, rows)
    lake = scratch_path(spark, "lake-test")
    res = archive_and_purge(mov, mov, lake, fmt="parquet", batch_id="b1")
    assert sorted(ids(res.archived)) == ["B", "C", "E", "F", "G"]
    assert sorted(ids(res.remaining)) == ["A", "G"]
    assert res.rows == 5
    # archive and remaining together cover every input row
    assert set(ids(res.archived)) | set(ids(res.remaining)) == {r["id_transaccion"] for r in rows}
    # a rerun of the same batch does not append twice
    again = archive_and_purge(mov, mov, lake, fmt="parquet", batch_id="b1")
    assert sorted(ids(again.archived)) == ["B", "C", "E", "F", "G"]
    assert read_lake(spark, lake, fmt="parquet").count() == 5
    assert again.rows == 0 and sorted(ids(again.remaining)) == ["A", "G"]


@pytest.mark.parametrize("first,second", [(["S1"], ["S1", "B1", "S2"]), (["S1", "B1", "S2"], ["S1"]), ([], ["S1", "B1"])])
def test_archive_rerun_loses_nothing(spark, first, second):
    """A rerun with more, fewer or other rows: the lake and the hot table cover every row once."""
    mov = movements_df(spark, [mv(i, "X", i, D(2024, 1, 1), "STANDIN") for i in ("S1", "B1", "S2")])
    lake = scratch_path(spark, "lake-rerun")
    pick = lambda names: mov.filter(F.col("id_transaccion").isin(names)) if names else mov.limit(0)
    archive_and_purge(pick(first), mov, lake, fmt="parquet", batch_id="b1")
    res = archive_and_purge(pick(second), mov, lake, fmt="parquet", batch_id="b1")
    assert ids(res.archived) == sorted(set(first) | set(second))
    assert sorted(ids(res.archived) + ids(res.remaining)) == ["B1", "S1", "S2"]


def test_archive_completes_a_half_written_append(spark):
    mov = movements_df(spark, [mv(f"S{i}", "X", str(i), D(2024, 1, 1), "STANDIN") for i in range(6)])
    lake = scratch_path(spark, "lake-half")
    rows = mov.union(mov.filter("id_transaccion = 'S5'"))  # one row stands twice
    append_to_lake(rows.limit(3).withColumn("archive_batch_id", F.lit("b1")), lake, fmt="parquet")
    append_to_lake(mov.filter("id_transaccion = 'S0'").withColumn("archive_batch_id", F.lit("b0")), lake, fmt="parquet")
    res = archive_and_purge(rows, mov, lake, fmt="parquet", batch_id="b1")
    assert ids(res.archived) == ["S0", "S1", "S2", "S3", "S4", "S5", "S5"] and ids(res.remaining) == []
    assert read_lake(spark, lake, fmt="parquet").count() == 8


def test_archive_raises_what_is_not_a_missing_lake(spark, tmp_path):
    (tmp_path / "broken").mkdir()
    (tmp_path / "broken" / "part-0.parquet").write_text("no parquet")
    mov = movements_df(spark, LEDGER)
    with pytest.raises(Exception):
        archive_and_purge(mov, mov, str(tmp_path / "broken"), fmt="parquet", batch_id="b1")


def test_a_batch_touches_its_own_folder_only(spark):
    """A rerun neither reads nor writes other batches, whatever they hold; ids keep their text."""
    import os

    from movrec.operators.archive import BATCH_COLUMN
    from movrec.plans.inspect import plan_text
    from movrec.session import local_path
    from movrec.sources.lake import batch_folder, read_batch

    mov = movements_df(spark, [mv(f"S{i}", "X", str(i), D(2024, 1, 1), "STANDIN") for i in range(6)])
    lake = scratch_path(spark, "lake-batches")
    for n, b in enumerate(("b/0", "001")):
        archive_and_purge(mov.filter(f"id_transaccion < 'S{n + 2}'"), mov, lake, fmt="parquet", batch_id=b)
    folders = {b: local_path(batch_folder(spark, lake, b)) for b in ("b/0", "001")}
    assert all(os.path.isdir(f) for f in folders.values())
    with open(os.path.join(folders["b/0"], "part-broken.parquet"), "w") as f:
        f.write("no parquet")  # another batch cannot be read at all
    again = archive_and_purge(mov, mov, lake, fmt="parquet", batch_id="001")
    assert again.rows == 3 and ids(again.archived) == [f"S{i}" for i in range(6)] and ids(again.remaining) == []
    assert {r[0] for r in again.archived.select(BATCH_COLUMN).collect()} == {"001"}
    text = plan_text(read_batch(spark, lake, "001", fmt="parquet"))
    assert f"{BATCH_COLUMN}=001" in text and f"{BATCH_COLUMN}=b" not in text


def test_a_rerun_reads_two_columns_for_its_keys_and_compares_digests(spark):
    from movrec.operators.archive import missing_rows
    from movrec.operators.changes import result_keys
    from movrec.plans.inspect import plan_text, scans
    from movrec.sources.lake import read_batch

    mov = movements_df(spark, [mv(f"S{i % 3}", "X", str(i), D(2024, 1, 1), "STANDIN", ref="" if i % 2 else None) for i in range(6)])
    lake = scratch_path(spark, "lake-digest")
    archive_and_purge(mov, mov, lake, fmt="parquet", batch_id="b")
    held = read_batch(spark, lake, "b", fmt="parquet")
    scan = next(s for s in scans(result_keys(held)) if "ReadSchema" in s)
    assert scan["ReadSchema"].count(":") == 2
    twice = mov.unionByName(mov)
    assert missing_rows(twice, held).count() == 6 and missing_rows(mov, held).count() == 0
    assert "Window" not in plan_text(missing_rows(twice, held)) and "Except" not in plan_text(missing_rows(twice, held))
    other = mov.filter("id_transaccion = 'S0'").withColumn("numero_comprobante_reposting", F.lit("R"))
    assert missing_rows(other, held).count() == 2  # only a null became text


def test_lake_path_has_no_default_place():
    assert lake_path("s3://bucket/", "moves", "/archive/cold/") == "s3://bucket/archive/cold/moves"
    with pytest.raises(TypeError):
        lake_path("s3://bucket", "moves")


def test_lake_schema_evolution(spark):
    lake = scratch_path(spark, "lake-evolve")
    first = spark.createDataFrame([("1", "a")], "id_transaccion string, x string")
    second = spark.createDataFrame([("2", "b", 7)], "id_transaccion string, x string, extra int")
    append_to_lake(first, lake, fmt="parquet")
    append_to_lake(second, lake, fmt="parquet")
    back = {r["id_transaccion"]: r["extra"] for r in read_lake(spark, lake, fmt="parquet").collect()}
    assert back == {"1": None, "2": 7}


def test_audit_outcomes(spark):
    mov = movements_df(spark, LEDGER)
    inputs = spark.createDataFrame(
        [("2024-01-05", "S2"), ("2024-01-05", "S2"), ("2024-01-05", "NOPE"), (None, "S1"), ("2024-01-10", "")],
        "periodo string, id_transaccion string",
    )
    from movrec.functions.predicates import all_truthy

    status = ap.audit(
        inputs,
        {"periodo": rq.as_date(inputs, "periodo"), "id_transaccion": F.col("id_transaccion")},
        all_truthy(inputs, WRITE_KEY),
        mov,
        WRITE_KEY,
    ).collect()
    outcomes = sorted(r["outcome"] for r in status)
    assert outcomes == ["applied", "applied", "not_found", "skipped", "skipped"]
    assert all(r["delete_status"] is None for r in status)
    assert ap.preview(ap.audit(inputs, {"periodo": rq.as_date(inputs, "periodo"), "id_transaccion": F.col("id_transaccion")},
                              all_truthy(inputs, WRITE_KEY), mov, WRITE_KEY), 2).count() == 2


def test_jdbc_round_trip_embedded_derby(spark):
    """JDBC reader options on Derby embedded in the Spark JVM (no server, no port)."""
    from movrec.sources.snapshot import jdbc_options, read_jdbc_snapshot

    url = f"jdbc:derby:memory:movrec{dt.datetime.now().strftime('%H%M%S%f')};create=true"
    mov = movements_df(spark, LEDGER)
    mov.write.format("jdbc").options(url=url, dbtable="MOVIMIENTOS", driver="org.apache.derby.jdbc.EmbeddedDriver").save()
    back = read_jdbc_snapshot(spark, url=url, table="MOVIMIENTOS")
    assert back.count() == len(LEDGER)
    opts = jdbc_options(url="jdbc:postgresql://h:5432/db", table="movements", user="u",
                        root_cert="/r", client_cert="/c", key_cert="/k", partition_column="periodo",
                        lower_bound="2024-01-01", upper_bound="2024-12-31", num_partitions=12)
    assert opts["sslmode"] == "verify-ca" and opts["sslkey"] == "/k" and opts["numPartitions"] == "12"


def test_rewrite_only_touched_partitions(spark):
    import os

    from movrec.schema import movement_schema
    from movrec.session import local_path
    from movrec.sources.snapshot import load_snapshot, write_snapshot

    path = scratch_path(spark, "partitioned")
    mov = movements_df(spark, LEDGER)
    write_snapshot(mov, path, partition_by="periodo", files=2)
    base = local_path(path)
    untouched = os.path.join(base, "periodo=2024-02-05")
    before = {f: os.path.getmtime(os.path.join(untouched, f)) for f in os.listdir(untouched)}
    keys = spark.createDataFrame([(D(2024, 1, 5), "S2"), (D(2024, 1, 6), "P2")], "periodo date, id_transaccion string")
    n = ap.rewrite_touched_partitions(
        spark, path, keys, lambda part: ap.apply_updates(part, keys, WRITE_KEY, ch.RELEASE_ASSIGN), schema=movement_schema()
    )
    assert n == 3  # the rows of 2024-01-05 (S2) and 2024-01-06 (P2, E2)
    after = load_snapshot(spark, path, schema=movement_schema())
    want = ap.apply_updates(mov, keys, WRITE_KEY, ch.RELEASE_ASSIGN)
    as_set = lambda df: sorted((r["id_transaccion"], str(r["periodo"]), r["tipo_procesamiento"]) for r in df.collect())
    assert as_set(after) == as_set(want)
    assert {f: os.path.getmtime(os.path.join(untouched, f)) for f in os.listdir(untouched)} == before


def test_park_only_standin_rows(spark):
    mov = movements_df(spark, LEDGER)
    matched = rq.match_requests(requests_df(spark, REQUESTS), mov)
    keys = ch.park_unmatched_keys(matched, only_standin=True)
    out = {r["id_transaccion"]: r["tipo_procesamiento"] for r in ap.apply_updates(mov, keys, ch.PARK_STANDIN_KEYS, ch.PARK_ASSIGN).collect()}
    full = {r["id_transaccion"]: r["tipo_procesamiento"] for r in ap.apply_updates(mov, ch.park_unmatched_keys(matched), WRITE_KEY, ch.PARK_ASSIGN).collect()}
    # the empty-type row E2 of the NO MATCH group is parked only in the faithful mode
    assert full["E2"] == "STANDIN_P" and out["E2"] == ""


def test_stage_change_set_over_jdbc(spark):
    from movrec.sources.snapshot import stage_changes_jdbc

    url = f"jdbc:derby:memory:stage{dt.datetime.now().strftime('%H%M%S%f')};create=true"
    matched = rq.match_requests(requests_df(spark, REQUESTS), movements_df(spark, LEDGER))
    keys = ch.park_unmatched_keys(matched)
    stage_changes_jdbc(keys, "PARK_KEYS", partitions=2, url=url)
    back = spark.read.format("jdbc").options(url=url, dbtable="PARK_KEYS").load()
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, keys.collect()))
