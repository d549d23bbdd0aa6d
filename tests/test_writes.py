"""Sinks, runs and the incremental fact on the smallest driver tables."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from moraflow.operators import calendar as cal
from moraflow.operators import harmonise
from moraflow.plans import facts, month_run, quality, reports
from moraflow.registry import reports_quality, runs
from moraflow.registry.core import WINDOW, Inputs
from moraflow.schemas import OUTPUTS, conform
from moraflow.sources import sinks
from moraflow.streaming import incremental


@pytest.fixture(scope="module")
def tables(spark, sf_dir):
    return Inputs(spark, sf_dir)


@pytest.fixture(scope="module")
def fact(tables, tmp_path_factory):
    """The daily fact, computed once and read back."""
    path = str(tmp_path_factory.mktemp("fact") / "gestion_agregada")
    sinks.append(conform(tables.daily, OUTPUTS["gestion_agregada"]), "gestion_agregada", path)
    return tables.spark.read.schema(OUTPUTS["gestion_agregada"]).parquet(path)


def stored(spark, path):
    return spark.read.schema(OUTPUTS["gestion_agregada"]).parquet(path)


def per_day(df):
    return {r[0]: r[1] for r in df.groupBy("FECHA_SERVICIO").count().collect()}


def test_replace_range_is_idempotent_and_drops_empty_days(spark, fact, tmp_path):
    path = str(tmp_path / "t")
    all_days = per_day(fact)
    for _ in range(2):
        assert sinks.replace_range(fact, "gestion_agregada", path, WINDOW.first, WINDOW.last) == sum(all_days.values())
        assert per_day(stored(spark, path)) == all_days
    first, last = date(2024, 1, 10), date(2024, 1, 12)
    rerun = fact.where(F.col("FECHA_SERVICIO") == F.lit(first))
    sinks.replace_range(rerun, "gestion_agregada", path, first, last)
    left = per_day(stored(spark, path))
    assert left == {d: n for d, n in all_days.items() if not first < d <= last}


def test_replace_range_refuses_rows_outside(fact, tmp_path):
    with pytest.raises(Exception, match="outside the range"):
        sinks.replace_range(fact, "gestion_agregada", str(tmp_path / "t"), date(2024, 1, 10), date(2024, 1, 12))


def test_replace_month(spark, fact, tmp_path):
    path = str(tmp_path / "t")
    sinks.replace_month(fact, "gestion_agregada", path, date(2024, 1, 15))
    assert per_day(stored(spark, path)) == per_day(fact)


def test_partition_filter_prunes(spark, fact):
    plan = fact.where("FECHA_SERVICIO = '2024-01-10'")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(FECHA_SERVICIO" in plan


def test_contract_refuses_nulls(tables):
    broken = tables.daily.withColumn("CARTERA", F.lit(None).cast("string"))
    with pytest.raises(Exception, match="NOT NULL column CARTERA"):
        conform(broken, OUTPUTS["gestion_agregada"]).write.format("noop").mode("overwrite").save()


def test_backup_and_statistics(spark, fact, tmp_path):
    path = str(tmp_path / "t")
    sinks.append(fact, "gestion_agregada", path)
    copy = sinks.backup(spark, "gestion_agregada", path, "20240131_0600")
    assert copy.endswith("t_backup_20240131_0600")
    rows = {r.tabla: r for r in sinks.statistics(spark, {"original": path, "copia": copy}).collect()}
    assert rows["original"].num_rows == rows["copia"].num_rows == fact.count()
    assert rows["original"].size_mb > 0 and rows["original"].last_modified is not None


def test_create_table(spark, tmp_path):
    name = "gestion_agregada"
    for _ in range(2):
        sinks.create_table(spark, name, OUTPUTS[name], str(tmp_path / name))
    columns = {c.name: c for c in spark.catalog.listColumns(name)}
    assert columns["FECHA_SERVICIO"].isPartition and columns["Q_INTERACCIONES_TOTAL"].dataType == "bigint"
    spark.sql(f"DROP TABLE {name}")


def test_isolated_periods_go_on_after_a_failure(tables):
    seen = []

    def run_period(period):
        name = period.first().ARCHIVO
        if name.endswith("AN_W1"):
            raise ValueError("bad file")
        seen.append(name)

    result = month_run.run_isolated(tables.calendario(), run_period)
    assert sorted(seen) == result.done and len(seen) == 14
    assert result.failed == {"Cartera_Gestion_AN_W1": "bad file"}


def test_period_by_period_equals_all_at_once(spark, tables, tmp_path):
    """Each closed period run alone gives the rows of the single plan over all of them."""
    src = runs.sources(tables)
    args = ("finalizado", datetime(2024, 1, 31), date(2024, 2, 29))
    whole = month_run.build_detailed(spark, src, WINDOW.first, *args)["agregada"]
    path = str(tmp_path / "agregada")

    def run_period(period):
        one = month_run.Sources(period, *[getattr(src, f) for f in list(src.__dataclass_fields__)[1:]])
        sinks.append(month_run.build_detailed(spark, one, WINDOW.first, *args)["agregada"], "agregada", path)

    closed = src.calendario.where("ESTADO = 'finalizado' AND ARCHIVO LIKE '%Temprana%'")
    assert not month_run.run_isolated(closed, run_period).failed
    total = F.sum("total_interacciones")
    apart = spark.read.parquet(path).agg(F.count("*"), total).first()
    assert tuple(apart) == tuple(whole.where("CARTERA = 'TEMPRANA'").agg(F.count("*"), total).first())


def test_incremental_files_equal_one_batch(spark, tables, fact, tmp_path):
    """Human interactions arrive in two files, the second late; a replayed call changes nothing."""
    landing, path, progress = (str(tmp_path / n) for n in ("landing", "fact", "progress"))
    human = tables.gestiones_humano()
    late = F.dayofmonth("date") % 2 == 0
    lookups = {
        "homolog_bot": tables.homolog_bot(), "homolog_humano": tables.homolog_humano(),
        "homolog_usuarios": tables.homolog_usuarios(),
    }

    def arrive(rows):
        rows.coalesce(1).write.mode("append").parquet(landing)
        incremental.process_new_files(
            spark, landing, human.schema, tables.gestiones_bot(), lookups, tables.universe, WINDOW, path, progress,
            first_valid_day=WINDOW.first,
        )

    arrive(human.where(~late))
    arrive(human.where(late & (F.col("document") != "1")))
    arrive(human.where(late & (F.col("document") == "1")))
    arrive(human.limit(0))
    result = stored(spark, path)
    assert result.exceptAll(fact).isEmpty() and fact.exceptAll(result).isEmpty()


def test_stream_loses_no_row_outside_its_window(spark, tables, tmp_path):
    """A file that reaches beyond the window fails its batch and is taken up by a call with a wider window."""
    landing, path, progress = (str(tmp_path / n) for n in ("landing", "fact", "progress"))
    human = tables.gestiones_humano()
    human.coalesce(1).write.parquet(landing)
    lookups = dict(
        homolog_bot=tables.homolog_bot(), homolog_humano=tables.homolog_humano(), homolog_usuarios=tables.homolog_usuarios()
    )
    short = facts.RunWindow(WINDOW.first, date(2024, 1, 10), WINDOW.as_of)

    def call(window):
        incremental.process_new_files(
            spark, landing, human.schema, tables.gestiones_bot(), lookups, tables.universe, window, path, progress,
            first_valid_day=WINDOW.first,
        )

    with pytest.raises(Exception, match="widen the window"):
        call(short)
    call(WINDOW)
    assert stored(spark, path).select("FECHA_SERVICIO").distinct().count() > 10


def test_interactions_are_conserved(tables, fact):
    """The fact counts each interaction once per account its client holds that day."""
    day = F.to_date("fecha_gestion")
    end = F.coalesce("FECHA_CIERRE", F.lit(date(2099, 12, 31)))
    pairs = tables.universe.join(tables.gestiones, "cod_luna").where(day.between(F.col("FECHA_ASIGNACION"), end))
    assert fact.agg(F.sum("Q_INTERACCIONES_TOTAL")).first()[0] == pairs.count()


def test_left_joins_keep_the_row_count(tables):
    assert facts.match_debt(tables.universe, tables.debt).count() == tables.universe.count()
    assert tables.base.count() == tables.accounts().count()


def test_views_push_filters_to_partitions(spark, tables, fact):
    days = cal.stored_calendar(cal.date_range(spark, date(2024, 1, 1), date(2024, 12, 31)))
    reports.register_views(spark, tables.kpis, fact, days)
    view = spark.sql("SELECT * FROM operativo_detalle WHERE FECHA_SERVICIO = '2024-01-10'")
    plan = view._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(FECHA_SERVICIO" in plan
    assert view.count() == fact.where("FECHA_SERVICIO = '2024-01-10'").count()


def test_quality_report_states(spark):
    schema = "FECHA_SERVICIO date, CARTERA string, CANAL string, total_interacciones bigint"
    day = date(2024, 1, 1)
    good = spark.createDataFrame([(day, "A", "BOT", 1), (day, "B", "BOT", 1)], schema)
    nulls = spark.createDataFrame([(day, None, "BOT", 1), (day, None, "WEB", 1), (day, "B", "X", 1)], schema)
    twice = good.union(good.limit(1))
    found = {}
    for name, df in (("good", good), ("nulls", nulls), ("twice", twice), ("empty", good.limit(0))):
        found[name] = quality.quality_report({"agregada": df}).first()
    assert found["good"].status == "PASS" and found["empty"].status == "EMPTY"
    assert found["nulls"].issues == ["Columna CARTERA: 66.7% valores nulos"]
    assert found["twice"].issues == ["1 filas duplicadas en dims clave"] and found["twice"].row_count == 3
    missing = quality.quality_report({"agregada": good.drop("CANAL")}).first()
    assert missing.status == "WARNING" and missing.issues == ["Columnas faltantes: ['CANAL']"]


def test_null_tolerant_lookup_keys(spark):
    normalised = spark.createDataFrame(
        [(1, datetime(2025, 1, 1), "M", "", "", "A", 0.0, None, "BOT")],
        "cod_luna bigint, fecha_gestion timestamp_ntz, management string, sub_management string, compromiso string, "
        "nombre_agente string, monto_compromiso double, fecha_compromiso date, canal_origen string",
    )
    lookup = spark.createDataFrame(
        [("M", None, None, "CONTACTO", "N1", "N2", 1)],
        "bot_management string, bot_sub_management string, bot_compromiso string, contactabilidad_homologada string, "
        "n1_homologado string, n2_homologado string, es_pdp_homologado int",
    )
    assert harmonise.harmonise_bot(normalised, lookup).first().GRUPO_RESPUESTA == "M"
    assert harmonise.harmonise_bot(normalised, lookup, null_tolerant=True).first().GRUPO_RESPUESTA == "CONTACTO"


def test_ratios_read_one_written_daily_fact(spark, tmp_path):
    """Neither the ratios nor the KPIs behind them make the daily fact again."""
    source = str(tmp_path / "made_from")
    rows = [("OP1", 10, 4, 5.0), ("OP1", 10, 4, 5.0), ("OP2", 20, 1, 30.0), (None, 5, 0, None)]
    columns = "OPERADOR_FINAL string, Q_INTERACCIONES_TOTAL bigint, Q_CONTACTOS_EFECTIVOS bigint, MONTO_RECUPERADO double"
    spark.createDataFrame(rows, columns).write.parquet(source)

    class Tables:
        daily = spark.read.parquet(source)

        @property
        def kpis(self):
            return self.daily.withColumn("MONTO_COMPROMETIDO", F.col("MONTO_RECUPERADO") * 2)

    ratios = reports_quality.m8(Tables())
    assert ratios.collect() == [(9 / 45, 0.5, 45 / 2)]
    assert ratios.inputFiles() and not any(source in file for file in ratios.inputFiles())
