"""The status preview is that of the audit of transform B's parked rows."""

from conftest import SF001
from movrec.plans import catalog as C


def test_preview_counts_the_audit(spark):
    audited = C.PLANS["action_audit"](spark, SF001).count()
    assert [r[0] for r in C.PLANS["status_preview"](spark, SF001).collect()] == [min(audited, 10_000)]
