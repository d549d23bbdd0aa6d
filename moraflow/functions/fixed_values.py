"""Labels, rates, patterns and dates that results must reproduce exactly."""

from datetime import date

# Portfolio types and the file-name fragments that select them, in order of precedence.
PORTFOLIO_FRAGMENTS = [
    ("TEMPRANA", ["TEMPRANA"]),
    ("CUOTA_FIJA_ANUAL", ["CF_ANN", "CUOTA_FIJA"]),
    ("ALTAS_NUEVAS", ["_AN_", "ALTAS_NUEVAS"]),
    ("COBRANDING", ["COBRANDING"]),
]
PORTFOLIO_OTHER = "OTRAS"

# Recovery objective by management segment.
OBJECTIVE_BY_SEGMENT = {
    "AL VCTO": 0.15,
    "ENTRE 4 Y 15D": 0.25,
    "TEMPRANA": 0.20,
    "TARDIA": 0.30,
}
OBJECTIVE_DEFAULT = 0.20

# Due-date categories.
DUE_NONE = "SIN_VENCIMIENTO"
DUE_PAST = "VENCIDO"
DUE_WITHIN = [(30, "POR_VENCER_30D"), (60, "POR_VENCER_60D"), (90, "POR_VENCER_90D")]
DUE_LATER = "VIGENTE_MAS_90D"

# Defaults for missing dimensions.
NO_SERVICE = "SIN_SERVICIO"
NO_SEGMENT = "SIN_SEGMENTO"
NO_ZONE = "SIN_ZONA"
NO_FILE = "SIN_ARCHIVO"
NO_MANAGEMENT = "SIN_MANAGEMENT"
NO_AGENT = "SIN_AGENTE"
NO_LEVEL_1 = "SIN_N1"
NO_LEVEL_2 = "SIN_N2"
NO_PORTFOLIO = "SIN_CARTERA"
NO_CATEGORY = "SIN_CATEGORIA"
NO_PRIOR_CONTACT = "SIN_GESTION_PREVIA"
NOT_AVAILABLE = "NO_DISPONIBLE"
NOT_SPECIFIED = "NO_ESPECIFICADO"
NOT_IDENTIFIED = "NO_IDENTIFICADO"
BOT_OPERATOR = "SISTEMA_BOT"
CHANNEL_TOTAL = "TOTAL"
MISSING_DUE_DATE = date(1900, 1, 1)
OPEN_PERIOD_END = date(2099, 12, 31)
BOT_FIRST_VALID_DAY = date(2025, 1, 1)

# Spellings of an effective contact, and fragments of a declared commitment.
EFFECTIVE_SPELLINGS = ["CONTACTO_EFECTIVO", "Contacto_Efectivo"]
EFFECTIVE_FRAGMENT = "EFECTIVO"
COMMITMENT_PATTERN = "COMPROMISO|Compromiso"

# Status labels.
STATUS_EXCEEDED = "🟢 SUPERADO"
STATUS_IN_RANGE = "🟡 EN RANGO"
STATUS_BELOW = "🔴 BAJO OBJETIVO"
CHECK_OK = "✅ OK"
CHECK_REVIEW = "⚠️ REVISAR"
CHECK_PROBLEM = "❌ PROBLEMA"
CHECK_PERIODS = "Consistencia archivos calendario vs asignacion"
CHECK_UNASSIGNED = "Cuentas con gestiones sin asignacion"
CHECK_OUTSIDE = "Fechas de gestion fuera del periodo de asignacion"

# Public holidays of Peru, by month and day, and by days before Easter.
HOLIDAYS_BY_DAY = [
    (1, 1, "Año Nuevo"),
    (5, 1, "Día del Trabajo"),
    (7, 28, "Fiestas Patrias"),
    (7, 29, "Fiestas Patrias"),
    (8, 30, "Santa Rosa de Lima"),
    (10, 8, "Combate de Angamos"),
    (11, 1, "Todos los Santos"),
    (12, 8, "Inmaculada Concepción"),
    (12, 25, "Navidad"),
]
HOLIDAYS_BEFORE_EASTER = [(3, "Jueves Santo"), (2, "Viernes Santo")]

# The shorter holiday list of the stored business-day table.
STORED_TABLE_HOLIDAYS = [
    (1, 1, "Año Nuevo"),
    (5, 1, "Día del Trabajador"),
    (7, 28, "Fiestas Patrias - Independencia"),
    (7, 29, "Fiestas Patrias - Proclamación"),
    (12, 25, "Navidad"),
]

# Output tables, their day column and clustering columns.
TABLE_LAYOUT = {
    "agregada": ("FECHA_SERVICIO", ["CARTERA", "CANAL", "OPERADOR"]),
    "comparativas": ("fecha_actual", ["CARTERA", "CANAL"]),
    "primera_vez": ("FECHA_SERVICIO", ["CARTERA", "CANAL", "cliente"]),
    "base_cartera": ("FECHA_ASIGNACION", ["CARTERA", "MOVIL_FIJA"]),
    "asignacion_universo": ("FECHA_ASIGNACION", ["CARTERA", "CATEGORIA_VENCIMIENTO", "SERVICIO"]),
    "gestion_agregada": ("FECHA_SERVICIO", ["CARTERA", "CATEGORIA_VENCIMIENTO", "CANAL"]),
    "recupero_atribuido": ("FECHA_PAGO", ["CARTERA", "CATEGORIA_VENCIMIENTO", "CANAL_ATRIBUIDO"]),
    "kpis_ejecutivos": ("FECHA_CALCULO", ["CARTERA", "CATEGORIA_VENCIMIENTO", "CANAL"]),
    "primera_vez_tracking": ("FECHA_PRIMERA_VEZ_CONTACTADO", ["CARTERA", "CANAL", "cliente"]),
    "dias_habiles": ("FECHA", ["AÑO", "MES", "ES_DIA_HABIL"]),
}

# Columns each output must have, and columns checked for nulls.
REQUIRED_COLUMNS = {
    "agregada": ["FECHA_SERVICIO", "CARTERA", "CANAL", "total_interacciones"],
    "comparativas": ["fecha_actual", "fecha_comparacion", "CARTERA"],
    "primera_vez": ["cliente", "FECHA_SERVICIO", "CARTERA", "CANAL"],
    "base_cartera": ["CARTERA", "FECHA_ASIGNACION", "total_cod_lunas"],
}
NULL_CHECKED_COLUMNS = {
    "agregada": ["FECHA_SERVICIO", "CARTERA", "CANAL"],
    "comparativas": ["fecha_actual", "CARTERA"],
    "primera_vez": ["cliente", "CARTERA"],
    "base_cartera": ["CARTERA", "FECHA_ASIGNACION"],
}
DUPLICATE_KEYS = ["FECHA_SERVICIO", "CARTERA", "CANAL", "OPERADOR", "GRUPO_RESPUESTA"]
