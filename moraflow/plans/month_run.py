"""Runs: build all outputs lazily, then write each with one action."""

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moraflow.functions import fixed_values as fv
from moraflow.operators import calendar as cal
from moraflow.operators import first_contact, harmonise
from moraflow.plans import facts, ledger, portfolio, quality
from moraflow.schemas import OUTPUTS, conform
from moraflow.sources import scans, sinks


@dataclass
class Sources:
    """Input tables of a run."""

    calendario: DataFrame
    asignacion: DataFrame
    gestiones_bot: DataFrame
    gestiones_humano: DataFrame
    tran_deuda: DataFrame
    pagos: DataFrame
    homolog_bot: DataFrame | None = None
    homolog_humano: DataFrame | None = None
    homolog_usuarios: DataFrame | None = None


def build_facts(src: Sources, window: facts.RunWindow, first_valid_day: date = fv.BOT_FIRST_VALID_DAY):
    """Universe, daily management and recovery, lazily.

    The assigned universe and the harmonised interactions feed several facts. Both are scans with lookups, without a
    shuffle, so each fact reads them anew instead of keeping a copy of the inputs in memory.
    """
    universe = facts.assigned_universe(src.asignacion, src.calendario, window.as_of)
    debt = scans.dated_debt(src.tran_deuda)
    gestiones = harmonise.harmonise(
        src.gestiones_bot, src.gestiones_humano, src.homolog_bot, src.homolog_humano, src.homolog_usuarios,
        first_valid_day,
    )
    return {
        "asignacion_universo": facts.universe_fact(universe, debt, window),
        "gestion_agregada": facts.daily_management(universe, gestiones, window),
        "recupero_atribuido": facts.attributed_recovery(src.pagos, debt, universe, gestiones, window),
    }


def run_facts(
    spark: SparkSession, src: Sources, window: facts.RunWindow, folder: str,
    first_valid_day: date = fv.BOT_FIRST_VALID_DAY,
) -> dict[str, int]:
    """Write the four facts for the window, replacing its days; the KPIs read the facts just written.

    Returns the rows written per table.
    """
    written = {}
    built = build_facts(src, window, first_valid_day)
    for name, df in built.items():
        rows = conform(df, OUTPUTS[name])
        written[name] = sinks.replace_range(rows, name, f"{folder}/{name}", window.first, window.last)
    # A window without rows leaves no file to read; the empty fact then stands in.
    stored = [
        spark.read.schema(df.schema).parquet(f"{folder}/{name}") if written[name] else df for name, df in built.items()
    ]
    kpis = conform(facts.executive_kpis(*stored, window), OUTPUTS["kpis_ejecutivos"])
    written["kpis_ejecutivos"] = sinks.replace_range(
        kpis, "kpis_ejecutivos", f"{folder}/kpis_ejecutivos", window.first, window.last
    )
    return written


def build_detailed(
    spark: SparkSession, src: Sources, month: date, state: str, run_at: datetime, last_day: date, compat: bool = False,
    by_file: bool = False,
) -> dict[str, DataFrame]:
    """The four detailed outputs for the periods of a month, all periods in one plan.

    `by_file` adds the period's file to every output, which the ledger needs. `last_day` bounds the business-day calendar (periods may run past their month).
    """
    periods = scans.periods_of_month(src.calendario, month, state)
    rows = scans.assignment_of_files(src.asignacion, scans.period_files(periods))
    base = first_contact.base_dimensions(rows, periods, segment_as_portfolio=compat)
    shaped = harmonise.shape_bot(src.gestiones_bot).unionByName(harmonise.shape_human(src.gestiones_humano))
    calendar = cal.business_calendar(cal.date_range(spark, month.replace(day=1), last_day))
    grouped = portfolio.contacts(shaped, base)
    aggregated = portfolio.aggregate_contacts(grouped, calendar, compat, by_file)
    debt = src.tran_deuda if compat else scans.dated_debt(src.tran_deuda)
    return {
        "agregada": aggregated,
        "comparativas": portfolio.comparisons(aggregated, calendar),
        "primera_vez": portfolio.first_contacts(grouped, calendar, run_at, by_file=by_file),
        "base_cartera": portfolio.base_portfolio(base, debt, src.pagos, compat, by_file),
    }


def run_detailed(
    spark: SparkSession, src: Sources, month: date, state: str, run_at: datetime, last_day: date, folder: str, run: str,
    compat: bool = False, refuse_warnings: bool = False,
) -> dict[str, int]:
    """Write the four detailed outputs of a month's periods in a state; the run then owns those periods.

    Returns the rows by table. With `refuse_warnings`, tables that the quality report warns of are not committed.
    """
    outputs = build_detailed(spark, src, month, state, run_at, last_day, compat, by_file=True)
    periods = scans.periods_of_month(src.calendario, month, state)
    return ledger.commit_run(outputs, periods, folder, run, quality_faults if refuse_warnings else None)


def quality_faults(tables: dict[str, DataFrame]) -> list[str]:
    """What the quality report warns of, one text for each table."""
    warned = quality.quality_report(tables).where("status = 'WARNING'").collect()
    return [f"{r.table_name}: {', '.join(r.issues)}" for r in warned]


@dataclass
class PeriodResult:
    done: list[str]
    failed: dict[str, str]


def run_isolated(calendario: DataFrame, run_period: Callable[[DataFrame], None]) -> PeriodResult:
    """Run each period on its own; a failing period is recorded and the others go on.

    Only the file names come to the driver (one per period). Without the need for isolation, run all periods in one
    plan instead.
    """
    result = PeriodResult([], {})
    for row in calendario.select("ARCHIVO").distinct().orderBy("ARCHIVO").toLocalIterator():
        try:
            run_period(calendario.where(F.col("ARCHIVO") == row.ARCHIVO))
            result.done.append(row.ARCHIVO)
        except Exception as error:  # the period is reported as failed, whatever stopped it
            result.failed[row.ARCHIVO] = str(error)
    return result
