"""Large change sets: rows that no change touches are told apart by a bit set and meet no join."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from movrec.operators import apply as ap
from movrec.operators import changes as ch
from movrec.operators import keyfilter as kf
from movrec.operators import ordered as od
from movrec.operators.sizing import materialize
from movrec.plans import catalog as C
from movrec.plans.inspect import plan_text
from movrec.schema import STANDIN, WRITE_KEY
from rows import D, movements_df, mv


def ledger(n=400, seed=5):
    rnd = random.Random(seed)
    kinds = ["STANDIN", "STANDIN_P", None, ""]
    rows = [mv(f"m{i}" if i % 9 else None, f"A{i % 7}", f"T{i}", D(2024, 1, 1 + i % 25) if i % 11 else None, rnd.choice(kinds)) for i in range(n)]
    return rows + rows[:40]


def found(df):
    return Counter(df.select("periodo", "id_transaccion", "numero_documento", "tipo_procesamiento", "numero_comprobante_reposting").collect())


def keys_of(mov, share):
    picked = mov.filter(F.pmod(F.xxhash64("numero_documento"), F.lit(share)) == 0)
    return picked.select("periodo", "id_transaccion", "tipo_procesamiento", F.lit("D9").alias("doc")).dropDuplicates(list(WRITE_KEY))


def test_deletes_and_updates_move_few_rows(spark, no_broadcast):
    mov = movements_df(spark, ledger())
    keys = materialize(keys_of(mov, 10))
    for change in (ap.Change(keys, WRITE_KEY), ap.Change(keys, WRITE_KEY, {"numero_comprobante_reposting": "doc"})):
        moved, kept = ap.changed_and_kept(mov, [change])
        assert kept.count() > 300 and moved.count() + kept.count() <= mov.count()
        assert found(ap.apply_changes(mov, [change])) == found(change.on(mov))
    assert found(ap.touched_rows(mov, keys, WRITE_KEY)) == found(mov.join(keys.df.select(*WRITE_KEY), list(WRITE_KEY), "left_semi").select(mov.columns))


def test_later_changes_see_what_earlier_ones_assigned(spark, no_broadcast):
    mov = movements_df(spark, ledger())
    park = ap.Change(materialize(keys_of(mov, 3)), WRITE_KEY, ch.RELEASE_ASSIGN)
    marks = keys_of(mov, 2).withColumn("tipo_procesamiento", F.lit(STANDIN))
    mark = ap.Change(materialize(marks), ch.MARK_KEYS, {"numero_comprobante_reposting": "doc"})
    for changes in ([park, mark], [mark, park]):
        got = ap.apply_changes(mov, changes)
        assert found(got) == found(changes[1].on(changes[0].on(mov)))
    typed = ap.Change(materialize(keys_of(mov, 3)), ch.MARK_KEYS, ch.RELEASE_ASSIGN)  # assigns a column both are keyed on
    assert found(ap.apply_changes(mov, [typed, mark])) == found(mark.on(typed.on(mov)))


def test_bits_hold_every_key_and_few_others(spark):
    ids = spark.range(40_000).select(F.concat(F.lit("S"), F.col("id")).alias("id"))
    keys = materialize(ids.filter("length(id) > 0 and cast(substr(id, 2) as int) % 10 = 0"))
    keys.broadcastable = False
    named, rest = kf.split_by_keys(ids, ["id"], [keys])
    assert named.join(keys.df, "id", "left_semi").count() == keys.rows
    assert named.count() + rest.count() == 40_000 and named.count() < 1.25 * 36_000 / 10 + 4_000
    assert kf.filter_bits(1) == kf.MIN_BITS and kf.filter_bits(10**8) == kf.MAX_BITS and kf.filter_bits(1 << 28) is None


def test_keys_of_another_type_are_joined_without_a_filter(spark, no_broadcast):
    mov = movements_df(spark, ledger())
    keys = materialize(keys_of(mov, 4).withColumn("periodo", F.col("periodo").cast("timestamp_ntz")))
    assert ap.changed_and_kept(mov, [ap.Change(keys, WRITE_KEY)])[1] is None
    assert found(ap.apply_deletes(mov, keys, WRITE_KEY)) == found(ap.apply_deletes(mov, keys_of(mov, 4), WRITE_KEY))


@pytest.mark.parametrize("name", ["request_leg_delete", "reconcile_batch", "overlay_snapshot"])
def test_outputs_above_the_cap(spark, request, name):
    small = Counter(C.PLANS[name](spark, SF001).collect())
    request.getfixturevalue("no_broadcast")
    large = C.PLANS[name](spark, SF001)
    assert "_bits" in plan_text(large) and Counter(large.collect()) == small


@pytest.mark.parametrize("name", ["reconcile_ordered", "match_requests_after_mark", "verdict_incremental"])
def test_same_rows_above_the_cap(spark, request, name):
    small = Counter(C.PLANS[name](spark, SF001).collect())
    request.getfixturevalue("no_broadcast")
    assert Counter(C.PLANS[name](spark, SF001).collect()) == small


def test_only_requests_that_see_a_mark_meet_the_marks(spark, no_broadcast):
    done = od.match_ordered(C.requests(spark, SF001), C.movements(spark, SF001))
    text = plan_text(done.matched, "simple")
    assert "Union" in text and "_seer" not in text
