"""First-contact flags of clients within their assignment periods.

A flag holds for the rows whose timestamp equals the minimum of their group, so ties are all flagged. Minima are taken
by aggregation with map-side combine and compared afterwards; raw rows never gather by client in a window.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from moraflow.functions import fixed_values as fv
from moraflow.functions import rules
from moraflow.operators import periods

RESPONSE = ["CANAL", "OPERADOR", "GRUPO_RESPUESTA", "GLOSA_RESPUESTA", "NIVEL_1", "NIVEL_2", "NIVEL_3"]
# Key combinations that get a first-time flag.
FLAG_KEYS = {
    "es_primera_vez_cliente_cartera_canal": ["cliente", "CARTERA", "CANAL"],
    "es_primera_vez_cliente_cartera_canal_operador": ["cliente", "CARTERA", "CANAL", "OPERADOR"],
    "es_primera_vez_cliente_canal": ["cliente", "CANAL"],
    "es_primera_vez_cliente_grupo_respuesta": ["cliente", "GRUPO_RESPUESTA"],
    "es_primera_vez_cliente": ["cliente"],
}


def base_dimensions(asignacion: DataFrame, calendario: DataFrame, segment_as_portfolio: bool = False) -> DataFrame:
    """Assignment rows with period and derived dimensions; rows of files without a period are kept.

    `segment_as_portfolio` reports the management segment in CARTERA instead of the portfolio type.
    """
    segment = rules.segment_label(F.col("tramo_gestion"), F.col("fraccionamiento"), F.col("cuota_fracc_act"))
    kind = rules.portfolio(F.col("archivo"))
    matched = periods.with_period(asignacion, periods.period_columns(calendario), "left")
    return matched.select(
        "cod_luna",
        "cuenta",
        "cliente",
        "archivo",
        (segment if segment_as_portfolio else kind).alias("CARTERA"),
        segment.alias("SEGMENTO"),
        F.col("negocio").alias("SERVICIO"),
        "FECHA_ASIGNACION",
        F.col("FECHA_ASIGNACION").alias("FECHA_INICIO_GESTION"),
        "FECHA_CIERRE",
        "FECHA_TRANDEUDA",
        F.col("min_vto").alias("VENCIMIENTO"),
        rules.objective(F.col("tramo_gestion")).alias("OBJ_RECUPERO"),
    )


def ensure_dimensions(df: DataFrame, dims: list[str]) -> DataFrame:
    """Add the dimensions a table lacks, filled with the default text."""
    missing = {d: F.lit(fv.NOT_AVAILABLE) for d in dims if d not in df.columns}
    return df.withColumns(missing) if missing else df


def detailed_responses(interactions: DataFrame) -> DataFrame:
    """Shaped interactions per client, day and detailed response.

    Grouped by timestamp first: that step counts the ties of each group's minimum and spreads any client over all
    tasks. The second grouping combines on the map side.
    """
    keys = ["cod_luna", *RESPONSE]
    duration = F.col("duracion").cast("decimal(18,6)")
    amount = rules.cents(F.col("monto_compromiso"))
    management = F.col("management")
    per_instant = interactions.groupBy(*keys, "date").agg(
        F.count(F.lit(1)).alias("q"),
        F.sum(duration).alias("duracion"),
        F.count(duration).alias("q_duracion"),
        F.count_if(rules.is_effective_exact(management)).alias("q_efectivos"),
        F.count_if(rules.declares_commitment(management)).alias("q_compromisos"),
        F.sum(amount).alias("centavos"),
        F.count_if(F.col("monto_compromiso") > 0).alias("q_montos"),
    )
    sums = ["q", "duracion", "q_duracion", "q_efectivos", "q_compromisos", "centavos", "q_montos"]
    return per_instant.groupBy(*keys, F.to_date("date").alias("FECHA_SERVICIO")).agg(
        *[F.sum(c).alias(c) for c in sums],
        F.min("date").alias("primera"),
        F.min_by("q", "date").alias("q_primera"),
    )


def _first_by_portfolio(responses: DataFrame, base: DataFrame) -> DataFrame:
    """First contact per (file, channel, client, portfolio) and per (file, channel, client), and whether the client has
    an effective contact there.

    The window over a client holds one row per portfolio: everything below that is already combined.
    """
    held = base.select("cod_luna", "cliente", "archivo", "CARTERA", "FECHA_ASIGNACION", "FECHA_CIERRE").distinct()
    daily = responses.groupBy("cod_luna", "FECHA_SERVICIO", "CANAL").agg(
        F.min("primera").alias("primera"), F.sum("q_efectivos").alias("q_efectivos")
    )
    keys = ["archivo", "CANAL", "cliente"]
    firsts = periods.match_periods(daily, held).where(F.col("cliente").isNotNull()).groupBy(*keys, "CARTERA").agg(
        F.min("primera").alias("primera_cartera"), F.sum("q_efectivos").alias("q_efectivos_cartera")
    )
    client = W.partitionBy(*keys)
    return firsts.select(
        *keys,
        "CARTERA",
        "primera_cartera",
        F.min("primera_cartera").over(client).alias("primera_cliente"),
        (F.max("q_efectivos_cartera").over(client) > 0).alias("tiene_efectivo"),
    )


def contacts_in_period(responses: DataFrame, base: DataFrame, dims: list[str]) -> DataFrame:
    """Grouped responses x grouped accounts of the same client within the period, with first-time row counts.

    A period is handled on its own and per channel, so the file and the channel are part of every first-time key.
    """
    accounts = base.groupBy("cod_luna", "cliente", "archivo", "FECHA_ASIGNACION", "FECHA_CIERRE", *dims).agg(
        F.count(F.lit(1)).alias("q_cuentas")
    )
    # The first contacts are one row per key, so the join keeps the rows, and a client with many of them can be split.
    matched = periods.match_periods(responses, accounts).join(
        _first_by_portfolio(responses, base), ["archivo", "CANAL", "cliente", "CARTERA"], "left"
    )
    tied = F.col("q_primera") * F.col("q_cuentas")

    def rows_where(flag: Column) -> Column:
        return F.when(flag, tied).otherwise(F.lit(0))

    first = F.col("primera") == F.col("primera_cliente")
    return matched.withColumns(
        {
            "q_primera_cliente": rows_where(first),
            "q_primera_cartera": rows_where(F.col("primera") == F.col("primera_cartera")),
            "q_primera_efectiva": rows_where(first & F.col("tiene_efectivo")),
        }
    )


def flag_first_contacts(interactions: DataFrame, base: DataFrame, effective_only: bool = False) -> DataFrame:
    """Interactions per period with the six first-contact flags.

    One row per interaction, period and portfolio of its client; `q_cuentas` is the number of assignment rows it
    stands for. `effective_only` measures the first effective contact over effective interactions alone.
    """
    held = base.groupBy("cod_luna", "cliente", "archivo", "CARTERA", "FECHA_ASIGNACION", "FECHA_CIERRE").agg(
        F.count(F.lit(1)).alias("q_cuentas")
    )
    dated = interactions.withColumn("FECHA_SERVICIO", F.to_date("date")).withColumn(
        "efectivo", rules.is_effective_exact(F.col("management"))
    )
    # Minima start from (client, day, response) groups, combined on the map side, before the period match.
    daily = dated.groupBy("cod_luna", "FECHA_SERVICIO", "CANAL", "OPERADOR", "GRUPO_RESPUESTA").agg(
        F.min("date").alias("primera"), F.min(F.when(F.col("efectivo"), F.col("date"))).alias("primera_efectiva")
    )
    finest = ["archivo", "CANAL", "cliente", "CARTERA", "OPERADOR", "GRUPO_RESPUESTA"]
    grouped = periods.match_periods(daily, held).groupBy(*finest).agg(
        F.min("primera").alias("primera"), F.min("primera_efectiva").alias("primera_efectiva")
    )
    minima = {
        f"min_{flag}": F.min("primera").over(W.partitionBy(*dict.fromkeys(["archivo", "CANAL", *keys])))
        for flag, keys in FLAG_KEYS.items()
    }
    client = W.partitionBy("archivo", "CANAL", "cliente")
    minima["min_efectiva"] = F.min("primera_efectiva").over(client)
    firsts = grouped.withColumns(minima).select(*finest, *minima).where(F.col("cliente").isNotNull())

    rows = periods.match_periods(dated, held).join(firsts, finest, "left")
    flags = {flag: F.coalesce(F.col("date") == F.col(f"min_{flag}"), F.lit(False)) for flag in FLAG_KEYS}
    if effective_only:
        first_effective = F.col("efectivo") & (F.col("date") == F.col("min_efectiva"))
    else:
        first_effective = F.col("min_efectiva").isNotNull() & (F.col("date") == F.col("min_es_primera_vez_cliente"))
    return rows.select(
        "cod_luna", "cliente", "archivo", "CARTERA", "CANAL", "OPERADOR", "GRUPO_RESPUESTA", "FECHA_SERVICIO", "date",
        "q_cuentas",
        *[value.alias(flag) for flag, value in flags.items()],
        F.coalesce(first_effective, F.lit(False)).alias("es_primer_contacto_efectivo"),
    )


def tracking(interactions: DataFrame, base: DataFrame, updated_at) -> DataFrame:
    """First contact, effective contact and commitment of each client per portfolio, channel and response group."""
    held = base.select("cod_luna", "cliente", "archivo", "CARTERA", "FECHA_ASIGNACION", "FECHA_CIERRE").distinct()
    day = F.to_date("date")
    daily = interactions.groupBy("cod_luna", "CANAL", "GRUPO_RESPUESTA", day.alias("FECHA_SERVICIO")).agg(
        F.count(F.lit(1)).alias("q"),
        F.count_if(rules.is_effective_exact(F.col("management"))).alias("q_efectivos"),
        F.count_if(rules.declares_commitment(F.col("management"))).alias("q_compromisos"),
    )
    served = F.col("FECHA_SERVICIO")
    return (
        periods.match_periods(daily, held)
        .where(F.col("cliente").isNotNull())
        .groupBy("cliente", "CARTERA", "CANAL", "GRUPO_RESPUESTA")
        .agg(
            F.min(served).alias("FECHA_PRIMERA_VEZ_CONTACTADO"),
            F.min(F.when(F.col("q_efectivos") > 0, served)).alias("FECHA_PRIMERA_VEZ_EFECTIVO"),
            F.min(F.when(F.col("q_compromisos") > 0, served)).alias("FECHA_PRIMERA_VEZ_COMPROMISO"),
            F.sum("q").alias("TOTAL_CONTACTOS_ACUMULADOS"),
            F.sum("q_efectivos").alias("TOTAL_EFECTIVOS_ACUMULADOS"),
            F.sum("q_compromisos").alias("TOTAL_COMPROMISOS_ACUMULADOS"),
        )
        .withColumn("FECHA_ULTIMA_ACTUALIZACION", updated_at)
    )
