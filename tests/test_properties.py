"""Random ledgers: the set-based plans equal the per-row model."""

from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

import brute
from movrec.operators import changes as ch
from movrec.operators import requests as rq
from movrec.operators import windows as wn
from rows import D, movements_df, mv, requests_df, rq as make_rq, windows_df

ACCOUNTS = ["A", "B", "0A", "", None]
DOCS = ["T1", "T2", "D1", "D2", None]
TYPES = [None, "", "STANDIN", "STANDIN_P"]
DAYS = [D(2024, 1, d) for d in (1, 2, 3, 5, 8)]
IDS = ["S1", "S2", "C1", "B1"]

movement = st.builds(
    lambda i, a, d, p, t, r, b: mv(i, a, d, p, t, ref=r, ben=b),
    st.sampled_from(IDS),
    st.sampled_from(ACCOUNTS),
    st.sampled_from(DOCS),
    st.sampled_from(DAYS + [None]),
    st.sampled_from(TYPES),
    st.sampled_from(DOCS + [""]),
    st.sampled_from(["000A", "00B", "A", "000", None]),
)
request = st.builds(
    lambda g, doc, lo, hi, b, po: make_rq(g, doc, lo, hi, ben_id=b, po=po),
    st.sampled_from(IDS + [None]),
    st.sampled_from(["D1", "D2", "T1", ""]),
    st.sampled_from(DAYS + [None]),
    st.sampled_from(DAYS),
    st.sampled_from(IDS + [None]),
    st.sampled_from(["AHO", "", None]),
)
window = st.builds(lambda lo, hi: {"periodo": hi, "periodo_tope": lo}, st.sampled_from(DAYS + [None]), st.sampled_from(DAYS))


@settings(max_examples=12, deadline=None, derandomize=True, suppress_health_check=list(HealthCheck))
@given(st.lists(movement, min_size=1, max_size=14), st.lists(request, min_size=1, max_size=5), st.lists(window, min_size=1, max_size=3))
def test_random_ledgers(spark, movs, reqs, wins):
    mov = movements_df(spark, movs)
    req = requests_df(spark, reqs)
    a = rq.match_requests(req, mov)
    assert Counter((r["id_transaccion"], r["periodo"], r["reposting_completo"]) for r in a.collect()) == brute.match_requests(movs, reqs)
    b = wn.match_windows(windows_df(spark, wins), mov, bin_days=2)
    want_b = brute.match_windows(movs, wins)
    assert Counter((r["id_transaccion"], r["periodo"]) for r in b.collect()) == Counter({k: v for k, v in want_b.items()})
    marks = {(str(r["periodo"]), r["id_transaccion"]): r["numero_comprobante_reposting"] for r in ch.mark_reposted_changes(req, mov).collect()}
    assert marks == {k: max(v) for k, v in brute.mark_reposted(movs, reqs).items()}
