"""One layout for bot and human interactions, mapped to the common response vocabulary."""

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moraflow.functions import fixed_values as fv
from moraflow.functions import rules


def _numeric_documents(gestiones: DataFrame) -> DataFrame:
    return gestiones.withColumn("cod_luna", rules.safe_long(F.col("document"))).where(F.col("cod_luna").isNotNull())


def normalise_bot(gestiones: DataFrame, first_valid_day: date = fv.BOT_FIRST_VALID_DAY) -> DataFrame:
    """Bot interactions in the common layout; days before `first_valid_day` are dropped."""
    recent = gestiones.where(F.col("date") >= F.lit(first_valid_day))
    return _numeric_documents(recent).select(
        "cod_luna",
        F.col("date").alias("fecha_gestion"),
        rules.or_default(F.col("management"), fv.NO_MANAGEMENT).alias("management"),
        F.lit("").alias("sub_management"),
        rules.or_default(F.col("compromiso"), "").alias("compromiso"),
        F.lit(fv.BOT_OPERATOR).alias("nombre_agente"),
        F.lit(0.0).alias("monto_compromiso"),
        F.lit(None).cast("date").alias("fecha_compromiso"),
        F.lit("BOT").alias("canal_origen"),
    )


def normalise_human(gestiones: DataFrame) -> DataFrame:
    """Human interactions in the common layout."""
    return _numeric_documents(gestiones).select(
        "cod_luna",
        F.col("date").alias("fecha_gestion"),
        rules.or_default(F.col("management"), fv.NO_MANAGEMENT).alias("management"),
        F.lit("").alias("sub_management"),
        F.lit("").alias("compromiso"),
        rules.or_default(F.col("nombre_agente"), fv.NO_AGENT).alias("nombre_agente"),
        rules.or_default(F.col("monto_compromiso").cast("double"), 0.0).alias("monto_compromiso"),
        F.col("fecha_compromiso").cast("date").alias("fecha_compromiso"),
        F.lit("HUMANO").alias("canal_origen"),
    )


def unify(bot: DataFrame, human: DataFrame) -> DataFrame:
    """All interactions of both channels, by column name."""
    return bot.unionByName(human)


def _key_match(pairs: list[tuple[Column, Column]], null_tolerant: bool) -> Column:
    match = F.lit(True)
    for left, right in pairs:
        if null_tolerant:
            left, right = rules.or_default(left, ""), rules.or_default(right, "")
        match = match & (left == right)
    return match


def _layout(operator: Column, group: Column, level_1: Column, level_2: Column, promise: Column) -> list[Column]:
    effective = rules.is_effective_like(F.col("g.management"))
    return [
        F.col("g.cod_luna").alias("cod_luna"),
        F.col("g.fecha_gestion").alias("fecha_gestion"),
        F.col("g.monto_compromiso").alias("monto_compromiso"),
        F.col("g.fecha_compromiso").alias("fecha_compromiso"),
        F.col("g.canal_origen").alias("CANAL"),
        operator.alias("OPERADOR_FINAL"),
        F.coalesce(group, F.col("g.management"), F.lit(fv.NOT_IDENTIFIED)).alias("GRUPO_RESPUESTA"),
        rules.or_default(level_1, fv.NO_LEVEL_1).alias("NIVEL_1"),
        rules.or_default(level_2, fv.NO_LEVEL_2).alias("NIVEL_2"),
        promise.cast("bigint").alias("es_compromiso"),
        effective.cast("bigint").alias("es_contacto_efectivo"),
    ]


def harmonise_bot(normalised: DataFrame, homolog_bot: DataFrame, null_tolerant: bool = False) -> DataFrame:
    match = _key_match(
        [
            (F.col("g.management"), F.col("h.bot_management")),
            (F.col("g.sub_management"), F.col("h.bot_sub_management")),
            (F.col("g.compromiso"), F.col("h.bot_compromiso")),
        ],
        null_tolerant,
    )
    return normalised.alias("g").join(homolog_bot.alias("h"), match, "left").select(
        *_layout(
            operator=F.lit(fv.BOT_OPERATOR),
            group=F.col("h.contactabilidad_homologada"),
            level_1=F.col("h.n1_homologado"),
            level_2=F.col("h.n2_homologado"),
            promise=rules.or_default(F.col("h.es_pdp_homologado"), 0),
        )
    )


def harmonise_human(
    normalised: DataFrame, homolog_humano: DataFrame, homolog_usuarios: DataFrame, null_tolerant: bool = False
) -> DataFrame:
    response = _key_match([(F.col("g.management"), F.col("h.management"))], null_tolerant)
    agent = _key_match([(F.col("g.nombre_agente"), F.col("u.usuario"))], null_tolerant)
    return (
        normalised.alias("g")
        .join(homolog_humano.alias("h"), response, "left")
        .join(homolog_usuarios.alias("u"), agent, "left")
        .select(
            *_layout(
                operator=F.coalesce("u.usuario_homologado", "g.nombre_agente", F.lit(fv.NO_AGENT)),
                group=F.col("h.contactabilidad"),
                level_1=F.col("h.n_1"),
                level_2=F.col("h.n_2"),
                promise=F.coalesce(F.upper("h.pdp") == "SI", F.lit(False)),
            )
        )
    )


def harmonise(
    gestiones_bot: DataFrame,
    gestiones_humano: DataFrame,
    homolog_bot: DataFrame,
    homolog_humano: DataFrame,
    homolog_usuarios: DataFrame,
    first_valid_day: date = fv.BOT_FIRST_VALID_DAY,
    null_tolerant: bool = False,
) -> DataFrame:
    """Harmonised interactions of both channels.

    Each channel meets only its own lookup before the union, so no row is tested against a mapping of the other
    channel. The lookups carry no broadcast hint: small ones are broadcast by their size, large ones shuffle.
    """
    bot = harmonise_bot(normalise_bot(gestiones_bot, first_valid_day), homolog_bot, null_tolerant)
    human = harmonise_human(normalise_human(gestiones_humano), homolog_humano, homolog_usuarios, null_tolerant)
    return unify(bot, human)


def shape_bot(gestiones: DataFrame) -> DataFrame:
    """Bot interactions in the detailed layout: response text in every level slot the bot fills, no amounts."""
    response = rules.or_default(F.col("management"), fv.NOT_AVAILABLE)
    return _numeric_documents(gestiones).select(
        "cod_luna",
        "date",
        "management",
        "duracion",
        F.lit("BOT").alias("CANAL"),
        F.lit(fv.BOT_OPERATOR).alias("OPERADOR"),
        response.alias("GRUPO_RESPUESTA"),
        response.alias("GLOSA_RESPUESTA"),
        response.alias("NIVEL_1"),
        F.lit("").alias("NIVEL_2"),
        F.lit("").alias("NIVEL_3"),
        F.lit(0.0).alias("monto_compromiso"),
    )


def shape_human(gestiones: DataFrame) -> DataFrame:
    """Human interactions in the detailed layout."""
    gloss = rules.detailed_response(F.col("n1"), F.col("n2"), F.col("n3"), F.col("management"))
    return _numeric_documents(gestiones).select(
        "cod_luna",
        "date",
        "management",
        "duracion",
        F.lit("HUMANO").alias("CANAL"),
        rules.or_default(F.col("nombre_agente"), fv.NO_AGENT).alias("OPERADOR"),
        rules.or_default(F.col("management"), fv.NOT_AVAILABLE).alias("GRUPO_RESPUESTA"),
        gloss.alias("GLOSA_RESPUESTA"),
        rules.or_default(F.col("n1"), "").alias("NIVEL_1"),
        rules.or_default(F.col("n2"), "").alias("NIVEL_2"),
        rules.or_default(F.col("n3"), "").alias("NIVEL_3"),
        rules.or_default(F.col("monto_compromiso").cast("double"), 0.0).alias("monto_compromiso"),
    )
