"""Zone-less timestamps are rendered as stored, whatever the session's zone."""

import datetime as dt

from movrec.functions.formatting import format_movements
from rows import D, movements_df, mv


def test_wall_clock_text_in_a_zone_with_summer_time(spark):
    gap = dt.datetime(2024, 3, 10, 2, 30, 0)  # does not exist in New York
    rows = [
        mv("a", "A", "T", D(2024, 3, 10), fecha_carga=gap, fecha_hora_operacion=gap, kafka_timestamp_ec=gap, fecha_proceso_nrt=gap.replace(microsecond=120)),
        mv("b", "A", "T", None, fecha_carga=None, kafka_timestamp_ec=gap.replace(microsecond=987654), fecha_proceso_nrt=gap.replace(microsecond=100000)),
    ]
    old = spark.conf.get("spark.sql.session.timeZone")
    df = movements_df(spark, rows)
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        got = {r["id_transaccion"]: r for r in format_movements(df).collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got["a"]["periodo"] == "2024-03-10" and got["b"]["periodo"] is None
    assert got["a"]["fecha_carga"] == got["a"]["fecha_hora_operacion"] == "2024-03-10 02:30:00"
    assert got["a"]["kafka_timestamp_ec"] == "2024-03-10 02:30:00.000" and got["a"]["fecha_proceso_nrt"] == "2024-03-10 02:30:00.000"
    assert got["b"]["kafka_timestamp_ec"] == "2024-03-10 02:30:00.987" and got["b"]["fecha_proceso_nrt"] == "2024-03-10 02:30:00.100"
    assert got["b"]["fecha_carga"] is None
