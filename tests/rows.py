"""Hand-written movement, request and window rows for unit tests."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from movrec.schema import MOVEMENT_COLUMNS, movement_schema

D = dt.date


def mv(id_, cuenta, doc, periodo, tipo=None, ref=None, ben=None, **extra):
    row = {c: None for c in MOVEMENT_COLUMNS}
    row.update(
        id_transaccion=id_,
        numero_cuenta_id=cuenta,
        numero_documento=doc,
        periodo=periodo,
        tipo_procesamiento=tipo,
        numero_comprobante_reposting=ref,
        cuenta_beneficiario=ben,
        fecha_transaccion_contable=periodo,
        fecha_hora_transaccion_contable=dt.datetime(2024, 1, 2, 3, 4, 5, 987654),
        kafka_timestamp_ec=dt.datetime(2024, 1, 2, 3, 4, 5, 987654),
        valor_transaccion=Decimal("12.50"),
        estado_transaccion=1,
    )
    row.update(extra)
    return row


def movements_df(spark, rows):
    schema = movement_schema()
    return spark.createDataFrame([tuple(r[c] for c in MOVEMENT_COLUMNS) for r in rows], schema)


REQ_SCHEMA = (
    "producto_ordenante string, producto_beneficiario string, numero_documento_original string, "
    "periodo date, periodo_tope date, guid_ordenante string, guid_beneficiario string"
)


def rq(guid, doc, lo, hi, ben_id=None, po="AHO", pb="CTE"):
    return {
        "producto_ordenante": po,
        "producto_beneficiario": pb,
        "numero_documento_original": doc,
        "periodo": hi,
        "periodo_tope": lo,
        "guid_ordenante": guid,
        "guid_beneficiario": ben_id,
    }


def requests_df(spark, rows):
    cols = ["producto_ordenante", "producto_beneficiario", "numero_documento_original", "periodo", "periodo_tope", "guid_ordenante", "guid_beneficiario"]
    return spark.createDataFrame([tuple(r[c] for c in cols) for r in rows], REQ_SCHEMA)


def windows_df(spark, rows):
    return spark.createDataFrame([(w.get("periodo"), w.get("periodo_tope")) for w in rows], "periodo date, periodo_tope date")


# --- an edge-case ledger --------------------------------------------------------
# Account A1 posts stand-in S1 (doc T1) with beneficiary 000B1, the core repost
# C1 (doc D1) arrives later; account A2 only has a parked stand-in; account A3
# has the same account on both legs; S4 shares its id with a second movement.
LEDGER = [
    mv("S1", "A1", "T1", D(2024, 1, 10), "STANDIN", ben="000B1"),
    mv("B1", "B1", "T1", D(2024, 1, 10), "STANDIN"),
    mv("C1", "A1", "D1", D(2024, 1, 12)),
    mv("X1", "A1", "D1", D(2024, 3, 1)),  # outside every range
    mv("S2", "A2", "T2", D(2024, 1, 5), "STANDIN_P", ben="0000"),  # stripped beneficiary is ''
    mv("P2", "A2", "D2", D(2024, 1, 6), "STANDIN_P"),
    mv("E2", "", "T2", D(2024, 1, 6), ""),  # empty account and empty type
    mv("S3", "A3", "T3", D(2024, 1, 1), "STANDIN", ben="A3"),  # same account on both legs
    mv("C3", "A3", "T3", D(2024, 1, 31)),  # core on the leg's own document, on the upper bound
    mv("S4", "A4", "D4", D(2024, 1, 1), "STANDIN"),  # document equals the original document
    mv("S4", "A4", "T4", D(2024, 1, 2), "STANDIN"),  # second movement sharing the id
    mv("C4", "A4", "D4", D(2024, 1, 1)),  # on the lower bound
    mv("S5", "A5", "T5", D(2024, 1, 3), "STANDIN", ben=None),
    mv("C5", "A5", "D5", D(2024, 1, 4), ref="D5"),
    mv("S6", "A6", "T6", D(2024, 2, 1), "STANDIN", ref="D6"),
    mv("C6", "A6", "D6", D(2024, 2, 2)),
    mv("S7", "A7", "T7", D(2024, 2, 3), "STANDIN_P", ref="D7"),
    mv("C7", "A7", "D7", D(2024, 2, 4), ""),  # '' is not a core row
    mv("C7b", "A7", "D7", D(2024, 2, 5)),
]

REQUESTS = [
    rq("S1", "D1", D(2024, 1, 1), D(2024, 1, 31), ben_id="B1"),
    rq("S1", "D1", D(2024, 1, 1), D(2024, 1, 31), ben_id="B1"),  # exact duplicate
    rq("S2", "D2", D(2024, 1, 1), D(2024, 1, 31)),  # parked only -> NO MATCH
    rq("S3", "T3", D(2024, 1, 1), D(2024, 1, 31)),  # documento == documento_original
    rq("S4", "D4", D(2024, 1, 1), D(2024, 1, 31)),
    rq("S5", "D5", D(2024, 1, 1), D(2024, 1, 31)),
    rq("S1", "D1", D(2024, 1, 11), D(2024, 1, 31)),  # leg outside the range
    rq("S1", "D9", D(2024, 1, 31), D(2024, 1, 1)),  # reversed range
    rq(None, "D1", D(2024, 1, 1), D(2024, 1, 31), ben_id="B1"),  # no ordering id
    rq("S1", "D1", D(2024, 1, 1), D(2024, 1, 31), po=None),  # guard: NULL product
    rq("S1", "D1", D(2024, 1, 1), D(2024, 1, 31), pb=""),  # guard: empty product
    rq("S6", "D6", D(2024, 1, 1), D(2024, 2, 28)),
    rq("S6", "DX", D(2024, 1, 15), D(2024, 2, 28)),  # conflicting document for S6
]

WINDOWS = [
    {"periodo": D(2024, 1, 31), "periodo_tope": D(2024, 1, 1)},
    {"periodo": D(2024, 2, 28), "periodo_tope": D(2024, 1, 20)},  # overlaps the first
    {"periodo": D(2024, 2, 28), "periodo_tope": D(2024, 1, 20)},  # duplicate window
    {"periodo": D(2024, 1, 1), "periodo_tope": D(2024, 1, 31)},  # reversed
    {"periodo": None, "periodo_tope": D(2024, 1, 1)},  # guard
]
