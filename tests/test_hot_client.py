"""One client with a large share of all rows: grouped operators against plain joins and windows."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from moraflow.operators import attribution, first_contact, periods
from moraflow.plans import facts

START = datetime(2025, 6, 1)
WINDOW = facts.RunWindow(date(2025, 6, 1), date(2025, 6, 30), date(2025, 6, 30))


@pytest.fixture(scope="module")
def harmonised(spark):
    rows = []
    for i in range(900):
        client = 7 if i % 2 == 0 else i % 40  # client 7 has half of the rows
        stamp = START + timedelta(minutes=37 * (i // 3))  # ties: three rows share a timestamp
        promise = int(i % 5 == 0)
        rows.append(
            (client, stamp, float(i % 13), stamp.date() if promise else None, "BOT" if i % 3 else "HUMANO",
             f"OP{i % 4}", f"G{i % 3}", "N1", "N2", promise, int(i % 4 == 0))
        )
    return spark.createDataFrame(
        rows,
        "cod_luna bigint, fecha_gestion timestamp_ntz, monto_compromiso double, fecha_compromiso date, CANAL string, "
        "OPERADOR_FINAL string, GRUPO_RESPUESTA string, NIVEL_1 string, NIVEL_2 string, es_compromiso bigint, "
        "es_contacto_efectivo bigint",
    )


@pytest.fixture(scope="module")
def universe(spark):
    rows = []
    for i in range(200):
        client = 7 if i % 3 == 0 else i % 40
        opened = date(2025, 6, 1) + timedelta(days=7 * (i % 3))
        closed = None if i % 4 == 0 else opened + timedelta(days=10)
        rows.append(
            (client, 1000 + i, client, "S", f"T{i % 2}", "Z", date(2025, 6, 15), "VENCIDO", opened, closed, opened, 14.0,
             f"F{i % 3}", f"C{i % 2}", 0.2, "NORMAL")
        )
    return spark.createDataFrame(
        rows,
        "cod_luna bigint, cuenta bigint, cliente bigint, SERVICIO string, SEGMENTO_GESTION string, "
        "ZONA_GEOGRAFICA string, VENCIMIENTO date, CATEGORIA_VENCIMIENTO string, FECHA_ASIGNACION date, "
        "FECHA_CIERRE date, FECHA_TRANDEUDA date, DIAS_GESTION double, ID_ARCHIVO_ASIGNACION string, CARTERA string, "
        "OBJ_RECUPERO double, TIPO_FRACCIONAMIENTO string",
    )


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_daily_management(harmonised, universe):
    day = F.to_date("fecha_gestion")
    inside = day.between(F.col("FECHA_ASIGNACION"), F.coalesce("FECHA_CIERRE", F.lit(date(2099, 12, 31))))
    order = W.partitionBy("cliente", "FECHA_SERVICIO").orderBy("fecha_gestion", *periods.RESPONSE, "cuenta")
    plain = (
        universe.join(harmonised, "cod_luna").where(inside).withColumn("FECHA_SERVICIO", day)
        .withColumn("primera", F.row_number().over(order) == 1)
        .groupBy(*facts.DAILY_KEYS)
        .agg(
            F.count("*"), F.sum("es_contacto_efectivo"), F.sum("es_compromiso"), F.sum("monto_compromiso"),
            F.count_if("primera"), F.count_distinct(F.when(F.col("es_compromiso") == 1, F.col("cliente"))),
        )
    )
    fact = facts.daily_management(universe, harmonised, WINDOW).select(
        *facts.DAILY_KEYS, "Q_INTERACCIONES_TOTAL", "Q_CONTACTOS_EFECTIVOS", "Q_PROMESAS_DE_PAGO", "MONTO_COMPROMETIDO",
        "Q_CLIENTES_UNICOS_CONTACTADOS", "Q_CLIENTES_CON_PROMESA",
    )
    assert rows_of(fact) == rows_of(plain)


@pytest.fixture(scope="module")
def payments(spark):
    rows = [
        (f"P{i}", 7 if i % 2 else i % 60, float(i), START + timedelta(hours=5 * (i % 140) - 48)) for i in range(400)
    ]
    return spark.createDataFrame(
        rows, "cod_sistema string, cod_luna bigint, monto_cancelado double, fecha_pago timestamp_ntz"
    )


def test_as_of_join(harmonised, payments):
    g = harmonised.select("cod_luna", "fecha_gestion")
    earlier = F.to_date("fecha_gestion") <= F.to_date("fecha_pago")
    matched = payments.join(g, "cod_luna").where(earlier).groupBy("cod_sistema").agg(F.max("fecha_gestion").alias("g"))
    plain = payments.select("cod_sistema").join(matched, "cod_sistema", "left").select("cod_sistema", "g")
    found = attribution.with_last_interaction(payments, harmonised).select("cod_sistema", "fecha_gestion")
    assert found.count() == 400
    assert rows_of(found) == rows_of(plain)


def test_as_of_join_splits_a_hot_client_day(spark, harmonised):
    """All payments of one client and day: the join splits that partition at run time."""
    hot = spark.range(60000).select(
        F.col("id").cast("string").alias("cod_sistema"),
        (F.col("id") % 1 + 7).alias("cod_luna"),
        (F.lit(START + timedelta(days=3)) + F.make_dt_interval(mins=F.col("id") % 1000)).cast("timestamp_ntz")
        .alias("fecha_pago"),
        F.md5(F.col("id").cast("string")).alias("nota"),
    ).repartition(8)
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.0",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
    }
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        joined = attribution.with_last_interaction(hot, harmonised)
        assert joined.where("fecha_gestion IS NOT NULL").count() == 60000
        joined.collect()
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for k in settings:
            spark.conf.unset(k)


def test_latest_assignment_and_chain(spark, universe, payments):
    debt = universe.select(
        F.concat(F.lit("D"), F.col("cod_luna").cast("string")).alias("nro_documento"),
        F.col("cuenta").cast("string").alias("cod_cuenta"),
    )
    debt = debt.union(debt)  # every account has two debt rows
    paid = payments.withColumn("nro_documento", F.concat(F.lit("D"), F.col("cod_luna").cast("string")))
    chain = (
        paid.drop("cod_luna").join(debt, "nro_documento")
        .join(universe, universe.cuenta.cast("string") == debt.cod_cuenta)
    )
    plain = chain.groupBy("CARTERA").agg(F.count("*"), F.sum("monto_cancelado"))
    assert rows_of(attribution.payment_chain(paid, debt, universe, ["CARTERA"])) == rows_of(plain)
    order = W.partitionBy("cod_sistema").orderBy(F.desc("FECHA_ASIGNACION"), F.desc("cuenta"))
    last = chain.withColumn("r", F.row_number().over(order)).where("r = 1").select("cod_sistema", "CARTERA")
    latest = attribution.latest_assignment_by_document(debt, universe)
    found = attribution.with_latest_assignment(paid.drop("cod_luna"), latest)
    assert rows_of(found.select("cod_sistema", "CARTERA")) == rows_of(last)


def test_kpis_of_the_row_product(spark):
    """Facts that miss each other's keys, and rows outside the window, against the join written out."""
    inside, outside = date(2025, 6, 10), date(2025, 5, 1)
    due = [date(2025, 6, 1), date(2025, 7, 1)]
    u = spark.createDataFrame(
        [(("A", "B", "C")[i % 3], "S", due[i % 2], "X", inside if i % 4 else outside, i, float(i), 0.25)
         for i in range(12)],
        "CARTERA string, SERVICIO string, VENCIMIENTO date, CATEGORIA_VENCIMIENTO string, FECHA_ASIGNACION date, "
        "Q_CUENTAS_ASIGNADAS bigint, MONTO_EXIGIBLE_ASIGNADO double, OBJ_RECUPERO double",
    )
    g = spark.createDataFrame(
        [(("B", "C", "D")[i % 3], "S", due[i % 2], "X", inside if i % 3 else outside, ("BOT", "HUMANO")[i % 2], i,
          0.5, float(i), 0.25) for i in range(15)],
        "CARTERA string, SERVICIO string, VENCIMIENTO date, CATEGORIA_VENCIMIENTO string, FECHA_SERVICIO date, "
        "CANAL string, Q_CLIENTES_UNICOS_CONTACTADOS bigint, EFECTIVIDAD_CONTACTO double, MONTO_COMPROMETIDO double, "
        "TASA_COMPROMISO double",
    )
    r = spark.createDataFrame(
        [(("C", "D", "E")[i % 3], "S", due[i % 2], "X", inside if i % 2 else outside, ("BOT", "WEB")[i % 2],
          float(i)) for i in range(9)],
        "CARTERA string, SERVICIO string, VENCIMIENTO date, CATEGORIA_VENCIMIENTO string, FECHA_PAGO date, "
        "CANAL_ATRIBUIDO string, MONTO_PAGADO double",
    )
    for name, df in (("u", u), ("g", g), ("r", r)):
        df.createOrReplaceTempView(f"kpi_{name}")
    plain = spark.sql(
        """
        SELECT coalesce(u.CARTERA, g.CARTERA, r.CARTERA), coalesce(u.VENCIMIENTO, g.VENCIMIENTO, r.VENCIMIENTO),
               coalesce(g.CANAL, r.CANAL_ATRIBUIDO, 'TOTAL'), sum(coalesce(Q_CUENTAS_ASIGNADAS, 0)),
               sum(coalesce(MONTO_EXIGIBLE_ASIGNADO, 0)), sum(coalesce(Q_CLIENTES_UNICOS_CONTACTADOS, 0)),
               round(avg(coalesce(EFECTIVIDAD_CONTACTO, 0)), 6), sum(coalesce(MONTO_COMPROMETIDO, 0)),
               sum(coalesce(MONTO_PAGADO, 0)), round(avg(coalesce(OBJ_RECUPERO, 0.2D)), 6)
        FROM kpi_u u FULL JOIN kpi_g g ON u.CARTERA = g.CARTERA
        FULL JOIN kpi_r r ON coalesce(u.CARTERA, g.CARTERA) = r.CARTERA
        WHERE FECHA_ASIGNACION >= '2025-06-01' OR FECHA_SERVICIO >= '2025-06-01' OR FECHA_PAGO >= '2025-06-01'
        GROUP BY 1, 2, 3
        HAVING sum(coalesce(Q_CUENTAS_ASIGNADAS, 0)) > 0 OR sum(coalesce(Q_CLIENTES_UNICOS_CONTACTADOS, 0)) > 0
            OR sum(coalesce(MONTO_PAGADO, 0)) > 0
        """
    )
    kpis = facts.executive_kpis_row_product(u, g, r, WINDOW).select(
        "CARTERA", "VENCIMIENTO", "CANAL", "UNIVERSO_CUENTAS", "UNIVERSO_MONTO", "CUENTAS_CONTACTADAS",
        "EFECTIVIDAD_PROMEDIO", "MONTO_COMPROMETIDO", "MONTO_RECUPERADO", "OBJ_RECUPERO_PROMEDIO",
    )
    assert rows_of(kpis) == rows_of(plain)


def test_first_contact_flags_keep_ties(spark):
    """The golden frame of the first-time rule: ties all true, null clients never."""
    def at(day, hour):
        return datetime(2025, 6, day, hour)

    shaped = spark.createDataFrame(
        [(1, at(19, 10), "CONTACTO_EFECTIVO", "BOT"), (1, at(19, 14), "NO_CONTESTA", "BOT"),
         (2, at(19, 11), "CONTACTO_EFECTIVO", "HUMANO"), (2, at(20, 9), "CONTACTO_EFECTIVO", "HUMANO"),
         (1, at(20, 15), "CONTACTO_EFECTIVO", "BOT"), (2, at(19, 11), "OTRO", "HUMANO"), (3, at(19, 8), "X", "BOT")],
        "cod_luna bigint, date timestamp_ntz, management string, CANAL string",
    ).select("*", F.lit("OP").alias("OPERADOR"), F.col("management").alias("GRUPO_RESPUESTA"))
    base = spark.createDataFrame(
        [(1, 1, "f.txt", "A"), (2, 2, "f.txt", "B"), (3, None, "f.txt", "B")],
        "cod_luna bigint, cliente bigint, archivo string, CARTERA string",
    ).select("*", F.lit(date(2025, 6, 1)).alias("FECHA_ASIGNACION"), F.lit(None).cast("date").alias("FECHA_CIERRE"))
    flagged = first_contact.flag_first_contacts(shaped, base)
    found = {
        (r.cod_luna, r.date, r.GRUPO_RESPUESTA): (r.es_primera_vez_cliente_cartera_canal, r.es_primer_contacto_efectivo)
        for r in flagged.collect()
    }
    assert found[1, at(19, 10), "CONTACTO_EFECTIVO"] == (True, True)
    assert found[1, at(19, 14), "NO_CONTESTA"] == (False, False)
    assert found[2, at(19, 11), "CONTACTO_EFECTIVO"] == (True, True)
    assert found[2, at(19, 11), "OTRO"] == (True, True)
    assert found[2, at(20, 9), "CONTACTO_EFECTIVO"] == (False, False)
    assert found[1, at(20, 15), "CONTACTO_EFECTIVO"] == (False, False)
    assert found[3, at(19, 8), "X"] == (False, False)
