"""Schemas of the inputs and of the written tables, and the contract check for NOT NULL columns."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


TYPES = {
    "string": T.StringType(), "bigint": T.LongType(), "int": T.IntegerType(), "double": T.DoubleType(),
    "boolean": T.BooleanType(), "date": T.DateType(), "timestamp": T.TimestampType(),
}


def _struct(columns: str) -> T.StructType:
    """Schema from 'name type [NOT NULL], ...'; needs no running session, unlike the DDL parser."""
    fields = []
    for column in columns.split(","):
        name, kind, *constraint = column.split()
        fields.append(T.StructField(name, TYPES[kind], nullable=not constraint))
    return T.StructType(fields)


INPUTS = {
    "calendario": _struct(
        "ARCHIVO string, cant_cod_luna_unique bigint, cant_registros_archivo bigint, FECHA_ASIGNACION date, "
        "FECHA_TRANDEUDA date, FECHA_CIERRE date, VENCIMIENTO date, DIAS_GESTION double, DIAS_PARA_CIERRE double, "
        "ESTADO string"
    ),
    "asignacion": _struct(
        "cod_luna bigint, cuenta bigint, cliente bigint, telefono bigint, dni string, tramo_gestion string, "
        "negocio string, zona string, archivo string, min_vto date, fraccionamiento string, cuota_fracc_act string, "
        "rango_renta string, decil_contacto int, decil_pago int, tipo_linea string, creado_el timestamp"
    ),
    "gestiones_bot": _struct(
        "document string, date timestamp, management string, sub_management string, compromiso string, "
        "fecha_compromiso date, duracion double, phone string, campaign_name string, origin string, weight double"
    ),
    "gestiones_humano": _struct(
        "document string, date timestamp, management string, sub_management string, n1 string, n2 string, n3 string, "
        "monto_compromiso double, fecha_compromiso date, nombre_agente string, correo_agente string, "
        "duracion double, phone string, campaign_name string, origin string, weight double"
    ),
    "tran_deuda": _struct(
        "cod_cuenta string, nro_documento string, fecha_vencimiento date, monto_exigible double, archivo string, "
        "creado_el timestamp"
    ),
    "pagos": _struct(
        "cod_sistema string, nro_documento string, monto_cancelado double, fecha_pago timestamp, archivo string"
    ),
}

OUTPUTS = {
    "asignacion_universo": _struct(
        "FECHA_ASIGNACION date NOT NULL, CARTERA string NOT NULL, SERVICIO string NOT NULL, "
        "SEGMENTO_GESTION string NOT NULL, VENCIMIENTO date NOT NULL, CATEGORIA_VENCIMIENTO string NOT NULL, "
        "ID_ARCHIVO_ASIGNACION string NOT NULL, ZONA_GEOGRAFICA string NOT NULL, "
        "TIPO_FRACCIONAMIENTO string NOT NULL, OBJ_RECUPERO double NOT NULL, Q_CUENTAS_ASIGNADAS bigint NOT NULL, "
        "Q_CLIENTES_ASIGNADOS bigint NOT NULL, MONTO_EXIGIBLE_ASIGNADO double NOT NULL, "
        "DIAS_GESTION_DISPONIBLES double NOT NULL"
    ),
    "gestion_agregada": _struct(
        "FECHA_SERVICIO date NOT NULL, CARTERA string NOT NULL, CANAL string NOT NULL, "
        "OPERADOR_FINAL string NOT NULL, GRUPO_RESPUESTA string NOT NULL, NIVEL_1 string NOT NULL, "
        "NIVEL_2 string NOT NULL, SERVICIO string NOT NULL, SEGMENTO_GESTION string NOT NULL, "
        "VENCIMIENTO date NOT NULL, CATEGORIA_VENCIMIENTO string NOT NULL, ZONA_GEOGRAFICA string NOT NULL, "
        "Q_INTERACCIONES_TOTAL bigint NOT NULL, Q_CONTACTOS_EFECTIVOS bigint NOT NULL, "
        "Q_PROMESAS_DE_PAGO bigint NOT NULL, MONTO_COMPROMETIDO double NOT NULL, "
        "Q_CLIENTES_UNICOS_CONTACTADOS bigint NOT NULL, Q_CLIENTES_PRIMERA_VEZ_DIA bigint NOT NULL, "
        "Q_CLIENTES_CON_PROMESA bigint NOT NULL, EFECTIVIDAD_CONTACTO double, TASA_COMPROMISO double, "
        "MONTO_PROMEDIO_COMPROMISO double"
    ),
    "recupero_atribuido": _struct(
        "FECHA_PAGO date NOT NULL, CARTERA string NOT NULL, SERVICIO string NOT NULL, VENCIMIENTO date NOT NULL, "
        "CATEGORIA_VENCIMIENTO string NOT NULL, ID_ARCHIVO_ASIGNACION string NOT NULL, "
        "CANAL_ATRIBUIDO string NOT NULL, OPERADOR_ATRIBUIDO string NOT NULL, FECHA_GESTION_ATRIBUIDA date, "
        "FECHA_COMPROMISO date, MONTO_PAGADO double NOT NULL, ES_PAGO_CON_PDP boolean NOT NULL, "
        "PDP_ESTABA_VIGENTE boolean NOT NULL, PAGO_ES_PUNTUAL boolean NOT NULL, DIAS_ENTRE_GESTION_Y_PAGO bigint, "
        "EFECTIVIDAD_ATRIBUCION double NOT NULL"
    ),
    "kpis_ejecutivos": _struct(
        "FECHA_CALCULO date NOT NULL, CARTERA string NOT NULL, SERVICIO string NOT NULL, VENCIMIENTO date NOT NULL, "
        "CATEGORIA_VENCIMIENTO string NOT NULL, CANAL string NOT NULL, UNIVERSO_CUENTAS bigint NOT NULL, "
        "UNIVERSO_MONTO double NOT NULL, OBJ_RECUPERO_PROMEDIO double NOT NULL, CUENTAS_CONTACTADAS bigint NOT NULL, "
        "TASA_CONTACTABILIDAD double, EFECTIVIDAD_PROMEDIO double, MONTO_COMPROMETIDO double NOT NULL, "
        "TASA_COMPROMISO_PROMEDIO double, MONTO_RECUPERADO double NOT NULL, TASA_RECUPERACION double, "
        "CUMPLIMIENTO_OBJETIVO double"
    ),
    "primera_vez_tracking": _struct(
        "cliente bigint NOT NULL, CARTERA string NOT NULL, CANAL string NOT NULL, GRUPO_RESPUESTA string, "
        "FECHA_PRIMERA_VEZ_CONTACTADO date, FECHA_PRIMERA_VEZ_EFECTIVO date, FECHA_PRIMERA_VEZ_COMPROMISO date, "
        "TOTAL_CONTACTOS_ACUMULADOS bigint, TOTAL_EFECTIVOS_ACUMULADOS bigint, TOTAL_COMPROMISOS_ACUMULADOS bigint, "
        "FECHA_ULTIMA_ACTUALIZACION timestamp"
    ),
    "dias_habiles": _struct(
        "FECHA date NOT NULL, AÑO bigint NOT NULL, MES bigint NOT NULL, DIA bigint NOT NULL, "
        "ES_DIA_HABIL boolean NOT NULL, DIA_HABIL_DEL_MES bigint, DIA_HABIL_DEL_AÑO bigint, "
        "NOMBRE_DIA_SEMANA string, ES_FERIADO boolean, NOMBRE_FERIADO string, "
        "FECHA_MISMO_DIA_HABIL_MES_ANTERIOR date, FECHA_MISMO_DIA_HABIL_AÑO_ANTERIOR date"
    ),
}


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of schema, by name, cast and in order; a null in a NOT NULL column fails the job.

    The check is an expression on the row, so it costs no extra pass over the data.
    """
    columns = []
    for field in schema.fields:
        value = F.col(f"`{field.name}`").cast(field.dataType)
        if not field.nullable:
            refuse = F.raise_error(F.lit(f"null in NOT NULL column {field.name}")).cast(field.dataType)
            value = F.when(value.isNotNull(), value).otherwise(refuse)
        columns.append(value.alias(field.name))
    return df.select(*columns)
