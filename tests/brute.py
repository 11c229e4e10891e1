"""Brute-force model of the reconciliation steps, one driving row at a time.

Plain Python over small lists of dicts: each function states what one call
of the corresponding step does for one driving row, and the results of all
rows are concatenated.  Used to check the set-based Spark plans on
hand-written edge cases.
"""

from __future__ import annotations

from collections import Counter


def truthy(v):
    return bool(v)


def ltrim0(s):
    return None if s is None else s.lstrip("0")


def in_range(p, lo, hi):
    return p is not None and lo is not None and hi is not None and lo <= p <= hi


def match_requests(movs, reqs):
    """Counter of (id_transaccion, periodo, verdict) rows of transform A."""
    out = Counter()
    for r in reqs:
        if not (truthy(r.get("producto_ordenante")) and truthy(r.get("producto_beneficiario")) and truthy(r.get("numero_documento_original"))):
            continue
        lo, hi, guid, doc = r.get("periodo_tope"), r.get("periodo"), r.get("guid_ordenante"), r["numero_documento_original"]
        legs = [m for m in movs if in_range(m["periodo"], lo, hi) and guid is not None and m["id_transaccion"] == guid]
        keys = []
        for u in legs:
            a, b = u["numero_cuenta_id"], ltrim0(u["cuenta_beneficiario"])
            keys += [(a, u["numero_documento"]), (b, u["numero_documento"]), (a, doc), (b, doc)]
        rows = []
        for c, d in keys:
            for m in movs:
                if c is not None and d is not None and m["numero_cuenta_id"] == c and m["numero_documento"] == d and in_range(m["periodo"], lo, hi):
                    rows.append(m)
        has_core = any(m["tipo_procesamiento"] is None for m in rows)
        has_standin = any(m["tipo_procesamiento"] == "STANDIN" for m in rows)
        verdict = "MATCH" if has_core and has_standin else "NO MATCH"
        for m in rows:
            out[(m["id_transaccion"], str(m["periodo"]), verdict)] += 1
    return out


def mark_reposted(movs, reqs):
    """{(periodo, id): set of documents written} by the UPDATE of transform A."""
    writes = {}
    for r in reqs:
        if not (truthy(r.get("producto_ordenante")) and truthy(r.get("producto_beneficiario")) and truthy(r.get("numero_documento_original"))):
            continue
        lo = r.get("periodo_tope")
        ids = {r.get("guid_ordenante"), r.get("guid_beneficiario")} - {None}
        for m in movs:
            if lo is not None and m["periodo"] is not None and m["periodo"] >= lo and m["id_transaccion"] in ids and m["tipo_procesamiento"] == "STANDIN":
                writes.setdefault((str(m["periodo"]), m["id_transaccion"]), set()).add(r["numero_documento_original"])
    return writes


def match_windows(movs, wins):
    """Counter of (id_transaccion, periodo) rows of transform B."""
    out = Counter()
    for w in wins:
        hi, lo = w.get("periodo"), w.get("periodo_tope")
        if not (truthy(hi) and truthy(lo)):
            continue
        standins = [m for m in movs if in_range(m["periodo"], lo, hi) and m["tipo_procesamiento"] in ("STANDIN_P", "STANDIN")]
        pairs = []
        for m in movs:
            if not (in_range(m["periodo"], lo, hi) and m["tipo_procesamiento"] is None):
                continue
            for s in standins:
                if m["numero_cuenta_id"] is not None and m["numero_cuenta_id"] == s["numero_cuenta_id"] and s["numero_comprobante_reposting"] is not None and m["numero_documento"] == s["numero_comprobante_reposting"]:
                    pairs.append((m["numero_cuenta_id"], m["numero_documento"], s["numero_documento"]))
        keys = {(c, d) for c, d, _ in pairs} | {(c, s) for c, _, s in pairs}
        for m in movs:
            if m["numero_documento"] is not None and (m["numero_cuenta_id"], m["numero_documento"]) in keys and in_range(m["periodo"], lo, hi):
                out[(m["id_transaccion"], str(m["periodo"]))] += 1
    return out
