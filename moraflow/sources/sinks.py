"""Writing tables: day partitions, clustered files, idempotent replacement, backups, statistics."""

from datetime import date, timedelta

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from moraflow.functions import fixed_values as fv
from moraflow.session import shared_folder

SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def layout_of(table: str, df: DataFrame) -> tuple[str, list[str]]:
    """Day column of a table, and those of its clustering columns that the data has."""
    day, cluster = fv.TABLE_LAYOUT[table]
    return day, [c for c in cluster if c in df.columns]


def _arranged(df: DataFrame, table: str) -> DataFrame:
    """Rows gathered by day and sorted for row-group skipping.

    REBALANCE lets adaptive execution split a day that holds a large share of the rows over several files.
    """
    day, cluster = layout_of(table, df)
    return df.hint("rebalance", F.col(day)).sortWithinPartitions(day, *cluster)


def append(df: DataFrame, table: str, path: str) -> None:
    day, _ = layout_of(table, df)
    _arranged(df, table).write.mode("append").partitionBy(day).parquet(path)


def overwrite(df: DataFrame, table: str, path: str) -> None:
    """The path holds exactly the given rows, in day partitions."""
    day, _ = layout_of(table, df)
    writer = _arranged(df, table).write.mode("overwrite").option("partitionOverwriteMode", "static")
    writer.partitionBy(day).parquet(path)


def written(df: DataFrame, purpose: str) -> DataFrame:
    """The rows of `df`, written once to the folder that the cluster shares and read from there.

    The shuffle files of the write are deleted at its end instead of when the driver's memory is next collected: nothing
    reads them again, as later steps start from the written rows.
    """
    spark = df.sparkSession
    path = shared_folder(spark, purpose)
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def _place(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    target, storage = _place(spark, path)
    return storage.exists(target)


def delete(spark: SparkSession, path: str) -> None:
    target, storage = _place(spark, path)
    storage.delete(target, True)


def replace_range(df: DataFrame, table: str, path: str, first: date, last: date) -> int:
    """Make the days [first, last] of a table exactly the given rows; other days stay. Returns the rows written.

    Dynamic partition overwrite replaces the days that have rows. Days of the range without rows are dropped after it.
    A rerun after a failure at any point ends in the same state. A row outside the range fails the job.
    """
    spark = df.sparkSession
    day, _ = layout_of(table, df)
    inside = F.col(day).between(F.lit(first), F.lit(last))
    checked = df.withColumn(
        day, F.when(inside, F.col(day)).otherwise(F.raise_error(F.lit(f"{day} outside the range")).cast("date"))
    )
    # Days and rows are observed during the write, so the data is computed once; the set is bounded by the range.
    seen = Observation()
    observed = _arranged(checked, table).observe(
        seen, F.collect_set(day).alias("days"), F.count(F.lit(1)).alias("rows")
    )
    writer = observed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(day).parquet(path)
    written = set(seen.get["days"])
    for offset in range((last - first).days + 1):
        current = first + timedelta(days=offset)
        if current not in written:
            delete(spark, f"{path}/{day}={current.isoformat()}")
    return seen.get["rows"]


def replace_month(df: DataFrame, table: str, path: str, month: date) -> int:
    """Replace the days of one calendar month."""
    first = month.replace(day=1)
    following = (first + timedelta(days=32)).replace(day=1)
    return replace_range(df, table, path, first, following - timedelta(days=1))


def create_table(spark: SparkSession, table: str, schema, location: str | None = None) -> None:
    """Create a catalogue table with a typed schema, partitioned by its day column, unless it exists."""
    day, _ = fv.TABLE_LAYOUT[table]
    columns = ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'}" for f in schema.fields
    )
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet PARTITIONED BY (`{day}`){place}")


def backup(spark: SparkSession, table: str, path: str, stamp: str) -> str:
    """Copy of a table next to it, named by a timestamp."""
    target = f"{path.rstrip('/')}_backup_{stamp}"
    day, _ = fv.TABLE_LAYOUT[table]
    _arranged(spark.read.parquet(path), table).write.mode("errorifexists").partitionBy(day).parquet(target)
    return target


def statistics(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """Rows, size in MB and last modification per table, from one pass over the file metadata."""
    reports = None
    for name, path in paths.items():
        files = spark.read.parquet(path).groupBy(F.col("_metadata.file_path").alias("file")).agg(
            F.count(F.lit(1)).alias("rows"),
            F.max("_metadata.file_size").alias("bytes"),
            F.max("_metadata.file_modification_time").alias("modified"),
        )
        row = files.agg(
            F.coalesce(F.sum("rows"), F.lit(0)).alias("num_rows"),
            F.round(F.coalesce(F.sum("bytes"), F.lit(0)) / (1024 * 1024), 2).alias("size_mb"),
            F.max("modified").alias("last_modified"),
        ).select(F.lit(name).alias("tabla"), "num_rows", "size_mb", "last_modified")
        reports = row if reports is None else reports.unionByName(row)
    return reports


def dry_run(outputs: dict[str, DataFrame]) -> DataFrame:
    """Rows each output would write; nothing is written."""
    counts = None
    for name, df in outputs.items():
        row = df.agg(F.count(F.lit(1)).alias("filas")).select(F.lit(name).alias("tabla"), "filas")
        counts = row if counts is None else counts.unionByName(row)
    return counts
