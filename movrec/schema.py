"""Fixed names and values of the movement data model.

Everything in this module is a fixed value: the column names, their order and
the state literals must equal what the upstream movement table uses, so they
are stated verbatim and in their natural order.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: the 50 movement columns, in output order -----------------
MOVEMENT_COLUMNS: tuple[str, ...] = (
    "id_transaccion",
    "numero_cuenta_id",
    "fecha_transaccion_contable",
    "contrapartida",
    "orden_registro",
    "orden_registro_cuenta_id",
    "numero_documento",
    "numero_comprobante",
    "fecha_hora_transaccion_contable",
    "descripcion",
    "descripcion_enriquecida",
    "valor_transaccion",
    "moneda_origen",
    "tipo_transaccion",
    "numero_documento_comprobante",
    "saldo",
    "codigo_agencia",
    "agencia",
    "origen",
    "codigo_cif_ordenante",
    "identificacion_ordenante",
    "nombre_ordenante",
    "cuenta_ordenante",
    "banco_ordenante",
    "pais_ordenante",
    "codigo_cif_beneficiario",
    "identificacion_beneficiario",
    "nombre_beneficiario",
    "cuenta_beneficiario",
    "banco_beneficiario",
    "pais_beneficiario",
    "estado_transaccion",
    "descripcion_ordenante",
    "descripcion_servicio",
    "fecha_transaccion_origen",
    "periodo",
    "fecha_carga",
    "tiene_detalle_extendido",
    "numero_cuenta",
    "fecha_hora_operacion",
    "kafka_timestamp_ec",
    "detalle_extendido_json",
    "codigo_usuario_transaccion",
    "usuario_transaccion",
    "codigo_transaccion",
    "numero_contrapartida_id",
    "fecha_proceso_nrt",
    "completar_detalle_enriquecido",
    "tipo_procesamiento",
    "numero_comprobante_reposting",
)

# --- fixed values: how non-text columns are rendered as text -----------------
DATE_COLUMNS = ("fecha_transaccion_contable", "fecha_transaccion_origen", "periodo")
SECOND_TIMESTAMP_COLUMNS = ("fecha_hora_transaccion_contable", "fecha_carga", "fecha_hora_operacion")
MILLI_TIMESTAMP_COLUMNS = ("kafka_timestamp_ec", "fecha_proceso_nrt")
DATE_PATTERN = "yyyy-MM-dd"
SECOND_PATTERN = "yyyy-MM-dd HH:mm:ss"
MILLI_PATTERN = "yyyy-MM-dd HH:mm:ss.SSS"

# --- fixed values: processing states and verdicts ----------------------------
STANDIN = "STANDIN"
STANDIN_PARKED = "STANDIN_P"
MATCH = "MATCH"
NO_MATCH = "NO MATCH"
REPOSTED_STATE = 10  # estado_transaccion written by the repost mark

VERDICT_COLUMN = "reposting_completo"
STATUS_COLUMN = "delete_status"
PREVIEW_ROWS = 10000

# --- fixed values: driving-row columns ---------------------------------------
REQUEST_COLUMNS = (
    "producto_ordenante",
    "producto_beneficiario",
    "numero_documento_original",
    "periodo",
    "periodo_tope",
    "guid_ordenante",
    "guid_beneficiario",
)
WINDOW_COLUMNS = ("periodo", "periodo_tope")

# Movement keys.
WRITE_KEY = ("periodo", "id_transaccion")
MATCH_KEY = ("numero_cuenta_id", "numero_documento")

# Types we expect for a movement snapshot (all other columns are strings).
MOVEMENT_TYPES: dict[str, T.DataType] = {
    **{c: T.DateType() for c in DATE_COLUMNS},
    **{c: T.TimestampNTZType() for c in SECOND_TIMESTAMP_COLUMNS + MILLI_TIMESTAMP_COLUMNS},
    "valor_transaccion": T.DecimalType(18, 2),
    "saldo": T.DecimalType(18, 2),
    "estado_transaccion": T.IntegerType(),
}


def movement_schema() -> T.StructType:
    """Schema of a movement snapshot (the hot table's 50 columns)."""
    return T.StructType(
        [T.StructField(c, MOVEMENT_TYPES.get(c, T.StringType()), True) for c in MOVEMENT_COLUMNS]
    )


def result_schema(with_verdict: bool) -> T.StructType:
    """All-text schema of a match result (50 columns, plus the verdict for requests)."""
    cols = list(MOVEMENT_COLUMNS) + ([VERDICT_COLUMN] if with_verdict else [])
    return T.StructType([T.StructField(c, T.StringType(), True) for c in cols])
