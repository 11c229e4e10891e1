"""DuckDB oracle SQL for every registered query.

Only the raw tables are registered in the oracle, so each statement starts
with the fixture views of FIXTURES.md as CTEs.  The reconciliation is stated
from its meaning, not by the steps of the Spark operators: a movement belongs to
a request as often as one of its four key conditions holds, and to a window if
the window holds a stand-in and core pair one of whose documents it carries.
"""

from __future__ import annotations

from movrec.schema import DATE_COLUMNS, MILLI_TIMESTAMP_COLUMNS, MOVEMENT_COLUMNS, SECOND_TIMESTAMP_COLUMNS

FIXTURE_CTES = """
fx_base AS (
  SELECT o_orderkey AS k,
         CAST(o_custkey AS STRING) AS acct,
         CAST(CASE WHEN o_orderkey % 10 = 0 THEN o_custkey
                   ELSE (o_custkey * 7 + 3) % 150 END AS STRING) AS ben,
         CAST(o_orderdate AS DATE) AS d,
         o_orderdate AS ts,
         CAST(o_totalprice AS DECIMAL(18,2)) AS v,
         o_orderpriority AS pri
  FROM orders
),
fx_legs AS (
  SELECT k, v, pri, ts, CASE WHEN k % 132 = 0 THEN '' WHEN k % 156 <> 0 THEN concat('S', CAST(k AS STRING)) END AS id_transaccion, acct AS numero_cuenta_id,
         lpad(ben, 10, '0') AS cuenta_beneficiario, concat('T', CAST(k AS STRING)) AS numero_documento, d AS periodo,
         CASE WHEN k % 6 = 0 THEN 'STANDIN_P' ELSE 'STANDIN' END AS tipo_procesamiento,
         CASE WHEN k % 3 = 0 THEN concat('D', CAST(k AS STRING)) END AS numero_comprobante_reposting
  FROM fx_base WHERE k % 2 = 0
  UNION ALL
  SELECT k, v, pri, ts, concat('C', CAST(k AS STRING)), acct, CAST(NULL AS STRING), concat('D', CAST(k AS STRING)),
         d + CAST(k % 9 AS INT), CASE WHEN k % 2 = 1 AND (k % 4 = 3 OR k % 7 = 0) THEN '' END, CAST(NULL AS STRING)
  FROM fx_base WHERE k % 2 = 1 OR k % 7 <> 0
  UNION ALL
  SELECT k, v, pri, ts, concat('E', CAST(k AS STRING)), acct, CAST(NULL AS STRING), concat('D', CAST(k AS STRING)),
         d + CAST(k % 9 + 1 AS INT), CAST(NULL AS STRING), CAST(NULL AS STRING)
  FROM fx_base WHERE k % 26 = 0
  UNION ALL
  SELECT k, v, pri, ts, concat('B', CAST(k AS STRING)), ben, CAST(NULL AS STRING), concat('T', CAST(k AS STRING)),
         d, CASE WHEN k % 4 = 0 THEN 'STANDIN' WHEN k % 22 = 0 THEN '' END, CASE WHEN k % 12 = 0 THEN '' END
  FROM fx_base WHERE k % 2 = 0
),
movimientos AS (
  SELECT id_transaccion, numero_cuenta_id, periodo AS fecha_transaccion_contable,
    CAST(k % 1000 AS STRING) AS contrapartida, CAST(k AS STRING) AS orden_registro, CAST(k % 97 AS STRING) AS orden_registro_cuenta_id,
    numero_documento, concat('K', CAST(k AS STRING)) AS numero_comprobante,
    ts + INTERVAL '13' HOUR AS fecha_hora_transaccion_contable,
    pri AS descripcion, concat('x-', pri) AS descripcion_enriquecida, v AS valor_transaccion, 'USD' AS moneda_origen,
    CASE WHEN k % 2 = 0 THEN 'D' ELSE 'C' END AS tipo_transaccion, numero_documento AS numero_documento_comprobante,
    CAST(v * 2 AS DECIMAL(18,2)) AS saldo, CAST(k % 25 AS STRING) AS codigo_agencia, concat('AG', CAST(k % 25 AS STRING)) AS agencia, 'FX' AS origen,
    CAST(NULL AS STRING) AS codigo_cif_ordenante, CAST(NULL AS STRING) AS identificacion_ordenante, CAST(NULL AS STRING) AS nombre_ordenante,
    CAST(NULL AS STRING) AS cuenta_ordenante, CAST(NULL AS STRING) AS banco_ordenante, 'EC' AS pais_ordenante,
    CAST(NULL AS STRING) AS codigo_cif_beneficiario, CAST(NULL AS STRING) AS identificacion_beneficiario, CAST(NULL AS STRING) AS nombre_beneficiario,
    cuenta_beneficiario, CAST(NULL AS STRING) AS banco_beneficiario, 'EC' AS pais_beneficiario,
    CAST(k % 3 AS INT) AS estado_transaccion, CAST(NULL AS STRING) AS descripcion_ordenante, CAST(NULL AS STRING) AS descripcion_servicio,
    periodo AS fecha_transaccion_origen, periodo, ts + INTERVAL '14' HOUR AS fecha_carga, 'N' AS tiene_detalle_extendido,
    numero_cuenta_id AS numero_cuenta, ts + INTERVAL '12' HOUR AS fecha_hora_operacion,
    ts + INTERVAL '987654' MICROSECOND AS kafka_timestamp_ec, concat('{"k": ', CAST(k AS STRING), '}') AS detalle_extendido_json,
    'U1' AS codigo_usuario_transaccion, 'user' AS usuario_transaccion, 'TX' AS codigo_transaccion, CAST(NULL AS STRING) AS numero_contrapartida_id,
    ts + INTERVAL '1234567' MICROSECOND AS fecha_proceso_nrt, 'N' AS completar_detalle_enriquecido, tipo_procesamiento, numero_comprobante_reposting
  FROM fx_legs
),
solicitudes AS (
  SELECT CASE WHEN k % 45 = 0 THEN CAST(NULL AS STRING) ELSE 'AHO' END AS producto_ordenante,
         CASE WHEN k % 35 = 0 THEN '' ELSE 'CTE' END AS producto_beneficiario,
         concat('D', CAST(k AS STRING)) AS numero_documento_original, d + CAST(CASE WHEN k % 3 = 0 THEN 0 ELSE 5 END AS INT) AS periodo, d - 30 AS periodo_tope,
         CASE WHEN k % 65 <> 0 THEN concat('S', CAST(k AS STRING)) END AS guid_ordenante, CASE WHEN k % 4 = 0 THEN concat('B', CAST(k AS STRING)) END AS guid_beneficiario, k * 2 AS orden
  FROM fx_base WHERE k % 2 = 0
  UNION ALL
  SELECT 'AHO', 'CTE', concat(CASE WHEN k % 200 = 6 THEN 'X' ELSE 'D' END, CAST(k AS STRING)), d + CAST(CASE WHEN k % 3 = 0 THEN 0 ELSE 5 END AS INT), d - 30,
         CASE WHEN k % 65 <> 0 THEN concat('S', CAST(k AS STRING)) END, CASE WHEN k % 4 = 0 THEN concat('B', CAST(k AS STRING)) END,
         k * 2 + CASE WHEN k % 400 < 200 THEN -1 ELSE 1 END
  FROM fx_base WHERE k % 100 = 6
),
ventanas AS (
  SELECT DATE '1996-06-30' + CAST(r_regionkey * 180 AS INT) AS periodo,
         DATE '1996-06-30' + CAST(r_regionkey * 180 - 200 AS INT) AS periodo_tope
  FROM region
),
ventanas_clientes AS (
  SELECT CASE WHEN c_custkey % 7 = 0 THEN '' WHEN c_custkey % 11 <> 0
              THEN strftime(DATE '1992-01-01' + CAST(c_custkey % 2400 + 30 AS INT), '%Y-%m-%d') END AS periodo,
         CASE WHEN c_custkey % 13 = 0 THEN '' WHEN c_custkey % 5 <> 0
              THEN strftime(DATE '1992-01-01' + CAST(c_custkey % 2400 AS INT), '%Y-%m-%d') END AS periodo_tope
  FROM customer
)"""

def text_columns(alias: str) -> str:
    """The 50 movement columns of ``alias`` rendered as text (DuckDB)."""
    out = []
    for c in MOVEMENT_COLUMNS:
        ref = f"{alias}.{c}"
        if c in DATE_COLUMNS:
            out.append(f"strftime({ref}, '%Y-%m-%d') AS {c}")
        elif c in SECOND_TIMESTAMP_COLUMNS:
            out.append(f"strftime({ref}, '%Y-%m-%d %H:%M:%S') AS {c}")
        elif c in MILLI_TIMESTAMP_COLUMNS:
            out.append(f"strftime({ref}, '%Y-%m-%d %H:%M:%S.%g') AS {c}")
        else:
            out.append(f"CAST({ref} AS VARCHAR) AS {c}")
    return ",\n  ".join(out)


def with_fixtures(body_ctes: str, final: str) -> str:
    ctes = FIXTURE_CTES + ("," + body_ctes if body_ctes.strip() else "")
    return f"WITH {ctes}\n{final}"


# --- transform A, stated per driving row -------------------------------------
REQ_BASE = """
req AS (
  SELECT row_number() OVER () AS rid, *
  FROM solicitudes
  WHERE producto_ordenante IS NOT NULL AND producto_ordenante <> ''
    AND producto_beneficiario IS NOT NULL AND producto_beneficiario <> ''
    AND numero_documento_original IS NOT NULL AND numero_documento_original <> ''
)"""


def requests_over(source: str = "movimientos", suffix: str = "") -> str:
    """Transform A over the movement view ``source``; CTE names get ``suffix``.

    ``times`` is how many of the four conditions (ordering or beneficiary
    account, the leg's or the request's document) hold for a movement and a
    leg: the accounts that are equal times the documents that are equal.
    """
    return f"""
legs{suffix} AS (
  SELECT r.rid, r.numero_documento_original AS asked_doc, r.periodo_tope AS lo, r.periodo AS hi,
         leg.numero_cuenta_id AS own_acct, ltrim(leg.cuenta_beneficiario, '0') AS other_acct, leg.numero_documento AS leg_doc
  FROM {source} leg JOIN req r ON leg.id_transaccion = r.guid_ordenante
  WHERE leg.periodo >= r.periodo_tope AND leg.periodo <= r.periodo
),
counted{suffix} AS (
  SELECT l.rid, m AS mov,
         (coalesce((m.numero_cuenta_id = own_acct)::INT, 0) + coalesce((m.numero_cuenta_id = other_acct)::INT, 0))
         * (coalesce((m.numero_documento = leg_doc)::INT, 0) + coalesce((m.numero_documento = asked_doc)::INT, 0)) AS times
  FROM (SELECT *, unnest(list_distinct([leg_doc, asked_doc])) AS either_doc FROM legs{suffix}) l
  JOIN {source} m ON m.numero_documento = l.either_doc AND m.periodo BETWEEN l.lo AND l.hi
),
judged{suffix} AS (
  SELECT rid, CASE WHEN count(*) FILTER (mov.tipo_procesamiento IS NULL) > 0
                    AND count(*) FILTER (mov.tipo_procesamiento = 'STANDIN') > 0 THEN 'MATCH' ELSE 'NO MATCH' END AS reposting_completo
  FROM counted{suffix} WHERE times > 0 GROUP BY rid
),
matched{suffix} AS (
  SELECT rid, unnest(mov), reposting_completo
  FROM (SELECT rid, mov, unnest(range(times)) FROM counted{suffix} WHERE times > 0) JOIN judged{suffix} USING (rid)
)"""


REQ_CTES = REQ_BASE + "," + requests_over()


WINDOWS = "SELECT row_number() OVER () AS wid, periodo_tope AS lo, periodo AS hi FROM ventanas WHERE periodo IS NOT NULL AND periodo_tope IS NOT NULL"
TEXT_WINDOWS = """SELECT row_number() OVER () AS wid, CAST(periodo_tope AS DATE) AS lo, CAST(periodo AS DATE) AS hi
  FROM ventanas_clientes WHERE length(periodo) > 0 AND length(periodo_tope) > 0"""


def windows_over(source: str = "movimientos", suffix: str = "", given: str = WINDOWS) -> str:
    """Transform B over the movement view ``source`` and the windows ``given``; CTE names but ``win`` get ``suffix``."""
    return f"""
win AS ({given}),
pairs{suffix} AS (
  SELECT w.wid, w.lo, w.hi, standin.numero_cuenta_id AS acct, core.numero_documento AS core_doc, standin.numero_documento AS standin_doc
  FROM {source} standin JOIN {source} core
    ON standin.numero_cuenta_id = core.numero_cuenta_id AND standin.numero_comprobante_reposting = core.numero_documento
  JOIN win w ON standin.periodo BETWEEN w.lo AND w.hi AND core.periodo BETWEEN w.lo AND w.hi
  WHERE standin.tipo_procesamiento LIKE 'STANDIN%' AND core.tipo_procesamiento IS NULL
),
discovered{suffix} AS (
  SELECT w.wid, m.* FROM win w JOIN {source} m ON m.periodo >= w.lo AND m.periodo <= w.hi
  WHERE (w.wid, m.numero_cuenta_id, m.numero_documento) IN (SELECT wid, acct, core_doc FROM pairs{suffix})
     OR (w.wid, m.numero_cuenta_id, m.numero_documento) IN (SELECT wid, acct, standin_doc FROM pairs{suffix})
)"""


WIN_CTES = windows_over()

MARK_CTES = """
marks AS (
  SELECT m.periodo, m.id_transaccion, m.tipo_procesamiento,
         max(r.numero_documento_original) AS numero_comprobante_reposting,
         10 AS estado_transaccion,
         count(DISTINCT r.numero_documento_original) AS n_documentos
  FROM req r JOIN movimientos m
    ON (m.id_transaccion = r.guid_ordenante OR m.id_transaccion = r.guid_beneficiario)
   AND m.periodo >= r.periodo_tope AND m.tipo_procesamiento = 'STANDIN'
  GROUP BY m.periodo, m.id_transaccion, m.tipo_procesamiento
)"""


MARKED_CTES = """
movimientos_marked AS (
  SELECT m.* REPLACE (
    CASE WHEN c.id_transaccion IS NOT NULL THEN c.numero_comprobante_reposting ELSE m.numero_comprobante_reposting END
      AS numero_comprobante_reposting,
    CASE WHEN c.id_transaccion IS NOT NULL THEN c.estado_transaccion ELSE m.estado_transaccion END AS estado_transaccion)
  FROM movimientos m LEFT JOIN marks c
    ON m.periodo = c.periodo AND m.id_transaccion = c.id_transaccion AND m.tipo_procesamiento = c.tipo_procesamiento
)"""


def day(ref: str, name: str) -> str:
    return f"strftime({ref}, '%Y-%m-%d') AS {name}"


def _leg_delete_match(alias: str) -> str:
    return f"""EXISTS (
  SELECT 1 FROM solicitudes r
  WHERE r.periodo IS NOT NULL AND r.guid_ordenante IS NOT NULL AND r.guid_ordenante <> ''
    AND r.periodo = {alias}.periodo
    AND ({alias}.id_transaccion = r.guid_ordenante OR {alias}.id_transaccion = r.guid_beneficiario))"""


ARCHIVE_COND = """(b.numero_comprobante_reposting IS NULL OR b.numero_comprobante_reposting = ''
   OR b.tipo_procesamiento IS NULL OR b.tipo_procesamiento = '')"""

KEY_GUARD = "{a}.periodo IS NOT NULL AND {a}.id_transaccion IS NOT NULL AND {a}.id_transaccion <> ''"


def _keyed_type_update(source: str, source_filter: str, new_type: str) -> str:
    return f"""SELECT {text_columns('x')}
FROM (
  SELECT m.* REPLACE (
    CASE WHEN EXISTS (
      SELECT 1 FROM {source} s
      WHERE {source_filter} AND {KEY_GUARD.format(a='s')}
        AND s.periodo = m.periodo AND s.id_transaccion = m.id_transaccion)
    THEN '{new_type}' ELSE m.tipo_procesamiento END AS tipo_procesamiento)
  FROM movimientos m
) x"""


def _sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["format_movements"] = with_fixtures("", f"SELECT {text_columns('m')} FROM movimientos m")
    q["strip_leading_zeros"] = with_fixtures(
        "",
        "SELECT id_transaccion, cuenta_beneficiario, ltrim(cuenta_beneficiario, '0') AS cuenta_beneficiario_sin_ceros FROM movimientos",
    )
    q["guard_requests"] = with_fixtures(
        REQ_CTES,
        f"""SELECT producto_ordenante, producto_beneficiario, numero_documento_original,
  {day('periodo', 'periodo')}, {day('periodo_tope', 'periodo_tope')}, guid_ordenante, guid_beneficiario FROM req""",
    )
    q["request_leg_lookup"] = with_fixtures(
        REQ_CTES,
        f"""SELECT r.guid_ordenante, r.numero_documento_original, {day('l.lo', 'periodo_tope')}, {day('l.hi', 'periodo')},
  l.own_acct AS cuenta_ordenante, l.other_acct AS cuenta_beneficiario, l.leg_doc AS numero_documento FROM legs l JOIN req r USING (rid)""",
    )
    q["request_key_pairs"] = with_fixtures(
        REQ_CTES,
        f"""SELECT r.guid_ordenante, r.numero_documento_original, {day('l.lo', 'periodo_tope')}, {day('l.hi', 'periodo')}, cuenta, documento
FROM legs l JOIN req r USING (rid), unnest([own_acct, other_acct]) AS a(cuenta), unnest([leg_doc, asked_doc]) AS d(documento)
WHERE cuenta IS NOT NULL AND documento IS NOT NULL""",
    )
    q["request_movements"] = with_fixtures(
        REQ_CTES,
        f"""SELECT r.guid_ordenante, r.numero_documento_original, {day('r.periodo_tope', 'periodo_tope')}, {day('r.periodo', 'periodo')},
  b.id_transaccion, {day('b.periodo', 'periodo_movimiento')}, b.tipo_procesamiento
FROM matched b JOIN req r USING (rid)""",
    )
    q["request_verdict"] = with_fixtures(
        REQ_CTES,
        f"""SELECT DISTINCT r.guid_ordenante, r.numero_documento_original, {day('r.periodo_tope', 'periodo_tope')},
  {day('r.periodo', 'periodo')}, v.reposting_completo
FROM judged v JOIN req r USING (rid)""",
    )
    q["match_requests"] = with_fixtures(
        REQ_CTES, f"SELECT {text_columns('a')},\n  a.reposting_completo FROM matched a"
    )
    q["mark_reposted_changes"] = with_fixtures(
        REQ_CTES + "," + MARK_CTES,
        f"""SELECT {day('periodo', 'periodo')}, id_transaccion, tipo_procesamiento, numero_comprobante_reposting,
  estado_transaccion, n_documentos FROM marks""",
    )
    q["guard_windows"] = with_fixtures(
        "",
        "SELECT periodo, periodo_tope FROM ventanas_clientes WHERE length(periodo) > 0 AND length(periodo_tope) > 0",
    )
    q["window_standins"] = with_fixtures(
        WIN_CTES,
        f"""SELECT {day('lo', 'periodo_tope')}, {day('hi', 'periodo')}, numero_cuenta_id, numero_documento,
  numero_comprobante_reposting FROM movimientos m JOIN win ON m.periodo BETWEEN lo AND hi AND tipo_procesamiento LIKE 'STANDIN%'""",
    )
    q["window_core_pairs"] = with_fixtures(
        WIN_CTES,
        f"""SELECT DISTINCT {day('lo', 'periodo_tope')}, {day('hi', 'periodo')}, acct AS cuenta,
  core_doc AS numero_documento, standin_doc AS numero_comprobante_standin FROM pairs""",
    )
    q["window_key_union"] = with_fixtures(
        WIN_CTES,
        f"""SELECT DISTINCT {day('lo', 'periodo_tope')}, {day('hi', 'periodo')}, acct AS cuenta, documento
FROM pairs, unnest([core_doc, standin_doc]) AS d(documento)""",
    )
    q["match_windows"] = with_fixtures(WIN_CTES, f"SELECT {text_columns('b')} FROM discovered b")
    q["request_leg_delete"] = with_fixtures(
        "", f"SELECT {text_columns('m')} FROM movimientos m WHERE NOT {_leg_delete_match('m')}"
    )
    q["request_leg_delete_rows"] = with_fixtures(
        "", f"SELECT {text_columns('m')} FROM movimientos m WHERE {_leg_delete_match('m')}"
    )
    q["park_unmatched"] = with_fixtures(
        REQ_CTES, _keyed_type_update("matched", "s.reposting_completo = 'NO MATCH'", "STANDIN_P")
    )
    q["release_parked"] = with_fixtures(
        WIN_CTES, _keyed_type_update("discovered", "s.tipo_procesamiento = 'STANDIN_P'", "STANDIN")
    )
    q["archive_rows"] = with_fixtures(
        WIN_CTES, f"SELECT {text_columns('b')} FROM discovered b WHERE {ARCHIVE_COND}"
    )
    q["purge_archived"] = with_fixtures(
        WIN_CTES,
        f"""SELECT {text_columns('m')} FROM movimientos m
WHERE NOT EXISTS (
  SELECT 1 FROM discovered b
  WHERE {ARCHIVE_COND} AND {KEY_GUARD.format(a='b')}
    AND b.periodo = m.periodo AND b.id_transaccion = m.id_transaccion)""",
    )
    audited = f"""SELECT {day('b.periodo', 'periodo')}, b.id_transaccion, CAST(NULL AS VARCHAR) AS delete_status,
  CASE WHEN NOT ({KEY_GUARD.format(a='b')}) THEN 'skipped'
       WHEN EXISTS (SELECT 1 FROM movimientos m WHERE m.periodo = b.periodo AND m.id_transaccion = b.id_transaccion AND NOT {_leg_delete_match('m')})
       THEN 'applied' ELSE 'not_found' END AS outcome
FROM discovered b WHERE b.tipo_procesamiento = 'STANDIN_P'"""
    q["action_audit"] = with_fixtures(WIN_CTES, audited)
    q["status_preview"] = with_fixtures(WIN_CTES, f"SELECT least(count(*), 10000) AS n_rows FROM ({audited}) shown")
    dated = """borrados_texto AS (
  SELECT CASE WHEN k % 14 = 0 THEN '2024-13-45' WHEN k % 22 = 0 THEN '' WHEN k % 26 = 0 THEN concat('day ', CAST(k AS VARCHAR)) WHEN k % 34 <> 0 THEN strftime(d, '%Y-%m-%d') END AS periodo,
         CASE WHEN k % 38 = 0 THEN '' ELSE concat('S', CAST(k AS VARCHAR)) END AS guid_ordenante, CASE WHEN k % 4 = 0 THEN concat('B', CAST(k AS VARCHAR)) END AS guid_beneficiario
  FROM fx_base WHERE k % 2 = 0
), asked AS (
  SELECT *, coalesce(length(periodo) > 0 AND length(guid_ordenante) > 0, false) AS ok, TRY_CAST(periodo AS DATE) AS day FROM borrados_texto
)"""
    q["action_failures"] = with_fixtures(
        dated,
        f"""SELECT periodo, guid_ordenante, guid_beneficiario, CASE WHEN ok AND day IS NULL THEN concat('ERROR: periodo is no date: ', periodo) END AS delete_status,
  CASE WHEN NOT ok THEN 'skipped' WHEN day IS NULL THEN 'failed'
       WHEN EXISTS (SELECT 1 FROM movimientos m WHERE m.periodo = a.day AND (m.id_transaccion = a.guid_ordenante OR m.id_transaccion = a.guid_beneficiario)) THEN 'applied'
       ELSE 'not_found' END AS outcome
FROM asked a
UNION ALL SELECT {day('m.periodo', 'periodo')}, m.id_transaccion, NULL, NULL, 'left' FROM movimientos m
WHERE NOT EXISTS (SELECT 1 FROM asked a WHERE ok AND a.day = m.periodo AND (m.id_transaccion = a.guid_ordenante OR m.id_transaccion = a.guid_beneficiario))""",
    )
    q["request_leg_delete_in_place"] = q["request_leg_delete"]
    q["purge_in_place"] = q["purge_archived"]
    q["archive_rerun"] = with_fixtures(
        WIN_CTES,
        f"""SELECT {text_columns('b')}, 'lake' AS place FROM discovered b WHERE {ARCHIVE_COND}
UNION ALL SELECT {text_columns('m')}, 'hot' FROM movimientos m
WHERE NOT EXISTS (SELECT 1 FROM discovered b WHERE {ARCHIVE_COND} AND {KEY_GUARD.format(a='b')}
                  AND b.periodo = m.periodo AND b.id_transaccion = m.id_transaccion)""",
    )
    marked = REQ_CTES + "," + MARK_CTES + "," + MARKED_CTES
    q["mark_reposted_apply"] = with_fixtures(marked, f"SELECT {text_columns('x')} FROM movimientos_marked x")
    q["match_requests_after_mark"] = with_fixtures(
        marked + "," + requests_over("movimientos_marked", "_m"),
        f"SELECT {text_columns('a')},\n  a.reposting_completo FROM matched_m a",
    )
    q["reconcile_batch"] = with_fixtures(
        marked,
        f"""SELECT {text_columns('x')}
FROM (
  SELECT m.* REPLACE (
    CASE WHEN EXISTS (
      SELECT 1 FROM matched s
      WHERE s.reposting_completo = 'NO MATCH' AND {KEY_GUARD.format(a='s')}
        AND s.periodo = m.periodo AND s.id_transaccion = m.id_transaccion)
    THEN 'STANDIN_P' ELSE m.tipo_procesamiento END AS tipo_procesamiento)
  FROM movimientos_marked m
) x""",
    )
    q["match_requests_dedupe"] = with_fixtures(
        REQ_CTES,
        f"SELECT {text_columns('a')},\n  a.reposting_completo FROM (SELECT DISTINCT * FROM matched) a",
    )
    q["park_unmatched_standin_only"] = with_fixtures(
        REQ_CTES,
        f"""SELECT {text_columns('x')}
FROM (
  SELECT m.* REPLACE (
    CASE WHEN m.tipo_procesamiento = 'STANDIN' AND EXISTS (
      SELECT 1 FROM matched s
      WHERE s.reposting_completo = 'NO MATCH' AND s.tipo_procesamiento = 'STANDIN' AND {KEY_GUARD.format(a='s')}
        AND s.periodo = m.periodo AND s.id_transaccion = m.id_transaccion)
    THEN 'STANDIN_P' ELSE m.tipo_procesamiento END AS tipo_procesamiento)
  FROM movimientos m
) x""",
    )
    q["leg_lookup_indexed"], q["mark_indexed"] = q["request_leg_lookup"], q["mark_reposted_changes"]
    q["match_requests_bucketed"] = q["match_requests"]
    standin_key = "e.periodo = {a}.periodo AND e.id_transaccion = {a}.id_transaccion AND {a}.tipo_procesamiento = 'STANDIN'"
    q["reconcile_ordered"] = with_fixtures(
        REQ_CTES
        + f""",
events AS MATERIALIZED (
  SELECT DISTINCT m.periodo, m.id_transaccion, r.orden, r.numero_documento_original AS doc
  FROM req r JOIN movimientos m ON (m.id_transaccion = r.guid_ordenante OR m.id_transaccion = r.guid_beneficiario)
   AND m.periodo >= r.periodo_tope AND m.tipo_procesamiento = 'STANDIN'
),
seen AS (
  SELECT a.*, r.orden, (SELECT arg_max(e.doc, e.orden) FROM events e WHERE {standin_key.format(a='a')} AND e.orden < r.orden) AS doc
  FROM matched a JOIN req r USING (rid)
),
final AS (
  SELECT m.*, (SELECT arg_max(e.doc, e.orden) FROM events e WHERE {standin_key.format(a='m')}) AS doc FROM movimientos m
)""",
        f"""SELECT {text_columns('x')}, x.reposting_completo, x.orden, 'matched' AS place
FROM (SELECT s.* REPLACE (coalesce(doc, numero_comprobante_reposting) AS numero_comprobante_reposting,
                          CASE WHEN doc IS NULL THEN estado_transaccion ELSE 10 END AS estado_transaccion) FROM seen s) x
UNION ALL
SELECT {text_columns('x')}, NULL, NULL, 'snapshot'
FROM (SELECT s.* REPLACE (coalesce(doc, numero_comprobante_reposting) AS numero_comprobante_reposting,
                          CASE WHEN doc IS NULL THEN estado_transaccion ELSE 10 END AS estado_transaccion) FROM final s) x""",
    )
    came = """movimientos_{n} AS (
  SELECT * FROM movimientos WHERE (orden_registro::BIGINT + CASE WHEN id_transaccion LIKE 'S%' THEN 0 WHEN id_transaccion LIKE 'C%' THEN 1 ELSE 2 END) % 3 < {n})"""
    q["verdict_incremental"] = with_fixtures(
        ",\n".join([REQ_BASE] + [came.format(n=n) + "," + requests_over(f"movimientos_{n}", f"_{n}") for n in (1, 2, 3)]),
        "\nUNION ALL\n".join(
            f"""SELECT DISTINCT {n} AS arrival, r.guid_ordenante, r.numero_documento_original, {day('r.periodo_tope', 'periodo_tope')}, {day('r.periodo', 'periodo')}, v.reposting_completo
FROM judged_{n} v JOIN req r USING (rid)"""
            for n in (1, 2, 3)
        ),
    )
    q["match_windows_overlapping"] = with_fixtures(windows_over(given=TEXT_WINDOWS), f"SELECT {text_columns('b')} FROM discovered b")
    q["park_in_place"] = q["park_unmatched"]
    touched = lambda rows: f"""EXISTS (SELECT 1 FROM {rows} s WHERE {KEY_GUARD.format(a='s')}
        AND s.periodo = m.periodo AND s.id_transaccion = m.id_transaccion)"""  # noqa: E731
    steps = f"""
unmatched AS MATERIALIZED (SELECT DISTINCT periodo, id_transaccion FROM matched WHERE reposting_completo = 'NO MATCH'),
deleted AS MATERIALIZED (
  SELECT m.* REPLACE (CASE WHEN {touched('unmatched')} THEN 'STANDIN_P' ELSE m.tipo_procesamiento END AS tipo_procesamiento)
  FROM movimientos_marked m WHERE NOT {_leg_delete_match('m')}
),{windows_over('deleted', '_d')},
parked AS MATERIALIZED (SELECT DISTINCT periodo, id_transaccion FROM discovered_d WHERE tipo_procesamiento = 'STANDIN_P')"""
    q["overlay_snapshot"] = with_fixtures(
        marked + "," + steps,
        f"""SELECT {text_columns('x')} FROM (
  SELECT m.* REPLACE (CASE WHEN {touched('parked')} THEN 'STANDIN' ELSE m.tipo_procesamiento END AS tipo_procesamiento) FROM deleted m
) x""",
    )
    q["overlay_compacted"] = q["overlay_snapshot"]
    return q


ORACLE_SQL = _sql()
