"""Incremental daily management: new interaction files trigger a rebuild of the days they touch."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moraflow.functions import fixed_values as fv
from moraflow.functions import rules
from moraflow.operators import harmonise
from moraflow.plans import facts
from moraflow.schemas import OUTPUTS, conform


def days_of(interactions: DataFrame) -> DataFrame:
    return interactions.select(F.to_date("date").alias("dia")).distinct()


def rebuild_days(days: DataFrame, bot: DataFrame, human: DataFrame, lookups: dict, universe: DataFrame,
                 window: facts.RunWindow, path: str, first_valid_day=fv.BOT_FIRST_VALID_DAY) -> None:
    """Recompute the given days from all stored interactions and overwrite their partitions.

    A day's rows depend on the interactions of that day only, so a late file is a rebuild of its days, and processing
    a batch twice gives the same table.
    """
    touched = [
        g.withColumn("dia", F.to_date("date")).join(days, "dia", "left_semi").drop("dia") for g in (bot, human)
    ]
    gestiones = harmonise.harmonise(*touched, **lookups, first_valid_day=first_valid_day)
    fact = conform(facts.daily_management(universe, gestiones, window), OUTPUTS["gestion_agregada"])
    writer = fact.hint("rebalance", F.col("FECHA_SERVICIO")).write.mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").partitionBy("FECHA_SERVICIO").parquet(path)


def process_new_files(spark: SparkSession, human_folder: str, human_schema: T.StructType, bot: DataFrame,
                      lookups: dict, universe: DataFrame, window: facts.RunWindow, path: str,
                      checkpoint: str, first_valid_day=fv.BOT_FIRST_VALID_DAY):
    """Process the human interaction files that arrived since the last call, then stop.

    Progress is kept in `checkpoint`, a folder on the cluster's shared storage. A file with rows outside the window fails
    its batch, which then stays unprocessed: a later call with a wider window takes it up.
    """
    stream = spark.readStream.schema(human_schema).parquet(human_folder)

    def rebuild(batch: DataFrame, _batch_id: int) -> None:
        outside = batch.where(~rules.within_days(F.col("date"), window.first, window.last))
        if not outside.isEmpty():
            raise ValueError(f"interactions outside {window.first} to {window.last}: widen the window of the run")
        # The batch only says which days changed; their interactions are read from the whole folder.
        stored = batch.sparkSession.read.schema(human_schema).parquet(human_folder)
        rebuild_days(days_of(batch), bot, stored, lookups, universe, window, path, first_valid_day)

    query = (
        stream.writeStream.foreachBatch(rebuild)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query
