"""Checkpoints of the operators and the files they leave."""

import time

from pyspark.sql import functions as F

from snapcredit.llm.common import FILE_CLEANUP, checkpointed


def shuffle_files(spark):
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = manager.getAllFiles()
    return {name for i in range(files.size()) if (name := files.apply(i).getName()).startswith("shuffle_")}


def test_a_checkpoint_leaves_no_shuffle_files(spark):
    before, held = shuffle_files(spark), spark.conf.get(FILE_CLEANUP, None)
    kept = checkpointed(spark.range(0, 1000, 1, 8).groupBy((F.col("id") % 10).alias("k")).count())
    for _ in range(50):
        if not (left := shuffle_files(spark) - before):
            break
        time.sleep(0.2)
    assert not left
    assert kept.count() == 10 and kept.agg(F.sum("count")).first()[0] == 1000
    assert spark.conf.get(FILE_CLEANUP, None) == held
