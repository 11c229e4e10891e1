"""Repeated result rows are rendered once."""

from pyspark.sql import functions as F

from movrec.functions.formatting import format_movements
from movrec.operators import staircases as st
from movrec.plans.inspect import plan_text
from rows import LEDGER, WINDOWS, movements_df, windows_df


def test_repeated_rows_are_rendered_once(spark):
    text = plan_text(st.match_windows_overlapping(windows_df(spark, WINDOWS), movements_df(spark, LEDGER)), "simple")
    assert text.index("Generate") < text.index("substring(")
    one = movements_df(spark, LEDGER[:3]).withColumn("_rep", F.lit(2))
    assert format_movements(one, repeat="_rep").count() == 6
