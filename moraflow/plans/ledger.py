"""Detailed tables with an owner for every period.

A run writes each table into a partition `corrida` of its own, which no reader sees yet. Its commit then adds one file to
the ledger that names the periods it holds; the newest commit of a period owns it, whatever its state was before. A
period that was open and is closed later, or is run again, so has its rows once, and a run that stops before its commit
leaves the tables as they were.

The ledger has one row for each period and commit. Readers join it on (archivo, corrida), which prunes the partitions of
other runs at run time.

Defined cases: a run name that has been committed is never written again, its stored counts are returned; a period
without rows is owned too, so a rerun can empty it; rows of a period that the run does not hold fail the run; a released
period has no rows; of commits that were made at the same time, the run name that sorts last owns their common periods.
"""

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moraflow.sources import sinks

LEDGER = "_periodos"
LEDGER_SCHEMA = T.StructType([
    T.StructField("archivo", T.StringType()),
    T.StructField("mes", T.DateType()),
    T.StructField("estado", T.StringType()),
    T.StructField("corrida", T.StringType()),
    T.StructField("orden", T.LongType()),
    T.StructField("filas", T.MapType(T.StringType(), T.LongType())),
])


class Refused(Exception):
    """A run that was written and not committed."""


def _no_rows() -> Column:
    return F.create_map().cast("map<string,bigint>")


def _commits(spark: SparkSession, folder: str) -> DataFrame:
    if not sinks.exists(spark, f"{folder}/{LEDGER}"):
        return spark.createDataFrame([], LEDGER_SCHEMA)
    return spark.read.schema(LEDGER_SCHEMA).parquet(f"{folder}/{LEDGER}")


def owners(spark: SparkSession, folder: str) -> DataFrame:
    """The newest commit of each period: archivo, mes, estado, corrida, orden, filas; `corrida` is null once released."""
    newest = F.max_by(F.struct("mes", "estado", "corrida", "orden", "filas"), F.struct("orden", "corrida"))
    return _commits(spark, folder).groupBy("archivo").agg(newest.alias("n")).select("archivo", "n.*")


def _next_order(spark: SparkSession, folder: str) -> int:
    return _commits(spark, folder).agg(F.coalesce(F.max("orden") + 1, F.lit(0))).first()[0]


def _append(rows: DataFrame, folder: str) -> None:
    """One file, which appears as a whole or not at all."""
    rows.select(*(F.col(f.name).cast(f.dataType) for f in LEDGER_SCHEMA)).coalesce(1).write.mode("append").parquet(
        f"{folder}/{LEDGER}"
    )


def _staged(spark: SparkSession, folder: str, name: str, schema: T.StructType, run: str) -> DataFrame:
    return spark.read.schema(schema).parquet(f"{folder}/{name}/corrida={run}")


def commit_run(
    outputs: dict[str, DataFrame], periods: DataFrame, folder: str, run: str,
    check: Callable[[dict[str, DataFrame]], list[str]] | None = None,
) -> dict[str, int]:
    """Write the outputs of a run and make it the owner of its periods. Returns the rows by table.

    `outputs` carry the period's file in `archivo`; `periods` has the calendar's columns ARCHIVO, FECHA_ASIGNACION and
    ESTADO, one row for each. `check` gets the written tables and returns what is wrong with them; then nothing is
    committed and `Refused` is raised. The name of the run starts with a letter, as it is a partition value.
    """
    spark = periods.sparkSession
    if not run[:1].isalpha() or "/" in run or "=" in run:
        raise ValueError(f"not a name for a run: {run!r}")
    done = _commits(spark, folder).where(F.col("corrida") == run)
    if not done.isEmpty():
        return _rows_by_table(done, list(outputs))
    held = periods.select(
        F.concat("ARCHIVO", F.lit(".txt")).alias("archivo"),
        F.trunc("FECHA_ASIGNACION", "MM").alias("mes"),
        F.lower("ESTADO").alias("estado"),
    )
    counts = []
    staged = {}
    for name, df in outputs.items():
        sinks.overwrite(df, name, f"{folder}/{name}/corrida={run}")
        staged[name] = _staged(spark, folder, name, df.schema, run)
        counts.append(staged[name].groupBy("archivo").agg(F.count("*").alias("filas")).withColumn("tabla", F.lit(name)))
    by_file = reduce(DataFrame.unionByName, counts)
    foreign = by_file.join(held, "archivo", "left_anti").select("tabla", "archivo").limit(1).collect()
    if foreign:
        raise Refused(f"{foreign[0].tabla} has rows of {foreign[0].archivo}, a period that {run} does not hold")
    faults = check(staged) if check else []
    if faults:
        raise Refused("; ".join(faults))
    counted = by_file.groupBy("archivo").agg(F.map_from_entries(F.collect_list(F.struct("tabla", "filas"))).alias("filas"))
    rows = held.join(counted, "archivo", "left").select(
        *held.columns,
        F.lit(run).alias("corrida"),
        F.lit(_next_order(spark, folder)).alias("orden"),
        F.coalesce("filas", _no_rows()).alias("filas"),
    )
    _append(rows, folder)
    return _rows_by_table(_commits(spark, folder).where(F.col("corrida") == run), list(outputs))


def _rows_by_table(commits: DataFrame, names: list[str]) -> dict[str, int]:
    sums = [F.sum(F.coalesce(F.element_at("filas", F.lit(n)), F.lit(0))).alias(n) for n in names]
    return {n: c or 0 for n, c in commits.agg(*sums).first().asDict().items()}


def release(spark: SparkSession, folder: str, files: DataFrame) -> None:
    """The periods in `files` (column archivo) have no rows any more, until a run commits them again."""
    gone = owners(spark, folder).join(files.select("archivo").distinct(), "archivo", "left_semi")
    order = _next_order(spark, folder)
    _append(gone.withColumns({"corrida": F.lit(None), "orden": F.lit(order), "filas": _no_rows()}), folder)


def read(spark: SparkSession, folder: str, name: str, schema: T.StructType, month=None, state: str | None = None) -> DataFrame:
    """Rows of the owned periods, all or those of a month or state, with `schema`'s columns (`archivo` among them)."""
    live = owners(spark, folder).where(F.col("corrida").isNotNull())
    if month is not None:
        live = live.where(F.col("mes") == F.lit(month.replace(day=1)))
    if state is not None:
        live = live.where(F.col("estado") == state.lower())
    if not sinks.exists(spark, f"{folder}/{name}"):
        return spark.createDataFrame([], schema)
    with_run = T.StructType([*schema.fields, T.StructField("corrida", T.StringType())])
    rows = spark.read.schema(with_run).parquet(f"{folder}/{name}")
    return rows.join(live.select("archivo", "corrida"), ["archivo", "corrida"], "left_semi").select(*schema.names)


def vacuum(spark: SparkSession, folder: str, names: list[str]) -> list[str]:
    """Delete the partitions of committed runs that own no period any more, and return their names.

    Runs that are not committed may still be writing and are left alone. Call it when no reader has an older plan.
    """
    live = owners(spark, folder).select("corrida").where(F.col("corrida").isNotNull())
    past = _commits(spark, folder).select("corrida").where(F.col("corrida").isNotNull()).distinct()
    gone = sorted(r.corrida for r in past.join(live, "corrida", "left_anti").toLocalIterator())
    for run in gone:
        for name in names:
            sinks.delete(spark, f"{folder}/{name}/corrida={run}")
    return gone
