"""Session settings: tasks stay small, whatever number of shuffle partitions the session was given."""

from pyspark.sql import functions as F

from moraflow.session import configure


def test_tasks_follow_the_input_and_not_the_partition_setting(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        rows = configure(spark).range(1_500_000).select(F.sha2(F.col("id").cast("string"), 256).alias("k"))
        sizes = rows.repartition("k").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len(sizes) > 4
    assert sum(r["count"] for r in sizes) == 1_500_000
