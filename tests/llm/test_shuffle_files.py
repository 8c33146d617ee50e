"""Shuffle files go with the query that made them."""

import time
from pathlib import Path

from pyspark.sql import functions as F

from duebook.llm.rows import pinned, prepare


def shuffle_files(spark):
    found = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {x.name for d in found for x in Path(d.toString()).glob("*/shuffle_*.data")}


def test_written_tables_leave_no_shuffle_files(spark, tmp_path):
    before = shuffle_files(spark)
    prepare(spark)
    counted = spark.range(5_000).groupBy((F.col("id") % 97).alias("k")).agg(F.count("*").alias("n"))
    counted.write.parquet(str(tmp_path / "counted"))
    kept = pinned(counted.repartition(3, "k"))
    for _ in range(50):
        if not shuffle_files(spark) - before:
            break
        time.sleep(0.2)
    assert not shuffle_files(spark) - before
    # A later query of the same rows makes them again.
    assert counted.count() == kept.count() == spark.read.parquet(str(tmp_path / "counted")).count() == 97
    assert sorted(counted.collect()) == sorted(counted.collect()) == sorted(kept.collect())
