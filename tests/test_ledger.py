"""Ownership of periods in the detailed tables: every period once, whatever runs and failures came before."""

from datetime import date

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moraflow.plans import ledger, month_run

TEXT = ("CARTERA", "CANAL", "OPERADOR", "archivo")
ROWS = T.StructType([
    T.StructField("FECHA_SERVICIO", T.DateType()),
    *(T.StructField(c, T.StringType()) for c in TEXT),
    T.StructField("total_interacciones", T.LongType()),
])
DAY = date(2024, 1, 10)


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path / "detailed")


def aggregated(spark, **per_file):
    """`n` rows of each file, each with its value."""
    rows = [(DAY, "A", "BOT", str(i), f"{f}.txt", v) for f, (n, v) in per_file.items() for i in range(n)]
    return {"agregada": spark.createDataFrame(rows, ROWS)}


def periods(spark, **states):
    return spark.createDataFrame([(f, DAY, s) for f, s in states.items()], "ARCHIVO string, FECHA_ASIGNACION date, ESTADO string")


def totals(spark, folder, **only):
    found = ledger.read(spark, folder, "agregada", ROWS, **only).groupBy("archivo").agg(
        F.count("*").alias("n"), F.max("total_interacciones").alias("v")
    )
    return {r.archivo[:-4]: (r.n, r.v) for r in found.collect()}


def test_open_then_closed_then_rerun(spark, folder):
    assert ledger.commit_run(aggregated(spark, p=(3, 1)), periods(spark, p="abierto"), folder, "one") == {"agregada": 3}
    ledger.commit_run(aggregated(spark, q=(2, 1)), periods(spark, q="FINALIZADO"), folder, "two")
    ledger.commit_run(aggregated(spark, p=(4, 2)), periods(spark, p="finalizado"), folder, "three")
    assert totals(spark, folder) == {"p": (4, 2), "q": (2, 1)}
    assert totals(spark, folder, state="abierto") == {}
    assert totals(spark, folder, month=DAY) == totals(spark, folder)
    assert totals(spark, folder, month=date(2024, 2, 1)) == {}
    # A run name is committed once; what it stored stays.
    assert ledger.commit_run(aggregated(spark, p=(9, 9)), periods(spark, p="finalizado"), folder, "three") == {"agregada": 4}
    assert totals(spark, folder)["p"] == (4, 2)


def test_a_run_that_fails_changes_nothing(spark, folder):
    held = periods(spark, p="abierto")
    ledger.commit_run(aggregated(spark, p=(3, 1)), held, folder, "one")
    fails = {"agregada": aggregated(spark, p=(5, 5))["agregada"], "comparativas": None}
    with pytest.raises(AttributeError):  # the second table cannot be written
        ledger.commit_run(fails, held, folder, "two")
    assert totals(spark, folder) == {"p": (3, 1)}
    ledger.commit_run(aggregated(spark, p=(2, 2)), held, folder, "two")  # the same run again: its leftovers are replaced
    assert totals(spark, folder) == {"p": (2, 2)}


def test_an_empty_rerun_empties_its_period_only(spark, folder):
    ledger.commit_run(aggregated(spark, p=(3, 1), q=(1, 1)), periods(spark, p="abierto", q="abierto"), folder, "one")
    assert ledger.commit_run(aggregated(spark), periods(spark, p="abierto"), folder, "two") == {"agregada": 0}
    assert totals(spark, folder) == {"q": (1, 1)}
    ledger.release(spark, folder, spark.createDataFrame([("q.txt",)], "archivo string"))
    assert totals(spark, folder) == {}
    ledger.commit_run(aggregated(spark, q=(2, 2)), periods(spark, q="abierto"), folder, "three")
    assert totals(spark, folder) == {"q": (2, 2)}


def test_rows_of_other_periods_and_bad_names_are_refused(spark, folder):
    with pytest.raises(ledger.Refused, match="q.txt"):
        ledger.commit_run(aggregated(spark, p=(1, 1), q=(1, 1)), periods(spark, p="abierto"), folder, "one")
    with pytest.raises(ValueError, match="not a name"):
        ledger.commit_run(aggregated(spark, p=(1, 1)), periods(spark, p="abierto"), folder, "2024")
    assert totals(spark, folder) == {}


def test_a_warned_run_is_not_committed(spark, folder):
    held = periods(spark, p="abierto")
    ledger.commit_run(aggregated(spark, p=(3, 1)), held, folder, "one", month_run.quality_faults)
    nulls = {"agregada": aggregated(spark, p=(3, 2))["agregada"].withColumn("CARTERA", F.lit(None).cast("string"))}
    with pytest.raises(ledger.Refused, match="CARTERA: 100.0% valores nulos"):
        ledger.commit_run(nulls, held, folder, "two", month_run.quality_faults)
    assert totals(spark, folder) == {"p": (3, 1)}


def test_vacuum_deletes_what_no_period_needs(spark, folder):
    ledger.commit_run(aggregated(spark, p=(3, 1), q=(1, 1)), periods(spark, p="abierto", q="abierto"), folder, "one")
    ledger.commit_run(aggregated(spark, p=(2, 2)), periods(spark, p="abierto"), folder, "two")
    assert ledger.vacuum(spark, folder, ["agregada"]) == []  # q is still the first run's
    ledger.commit_run(aggregated(spark, q=(1, 3)), periods(spark, q="abierto"), folder, "three")
    assert ledger.vacuum(spark, folder, ["agregada"]) == ["one"]
    assert totals(spark, folder) == {"p": (2, 2), "q": (1, 3)}
    assert spark.read.parquet(f"{folder}/agregada").count() == 3


def test_readers_prune_the_partitions_of_other_runs(spark, folder):
    ledger.commit_run(aggregated(spark, p=(3, 1)), periods(spark, p="abierto"), folder, "one")
    plan = ledger.read(spark, folder, "agregada", ROWS, month=DAY)._jdf.queryExecution().toString()
    assert "dynamicpruning" in plan
