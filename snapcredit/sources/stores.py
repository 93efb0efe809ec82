"""Co-located stores: tables bucketed and sorted by customer, which join and deduplicate without a shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

#: Rows of a bucket, about.
ROWS_PER_BUCKET = 2_000_000
MOST_BUCKETS = 65_536


def bucket_count(n_rows: int, rows_per_bucket: int = ROWS_PER_BUCKET) -> int:
    """A power of two, so that stores of different sizes still share bucket borders."""
    wanted = max(1, -(-n_rows // rows_per_bucket))
    return min(1 << (wanted - 1).bit_length(), MOST_BUCKETS)


def colocate(spark: SparkSession) -> None:
    """Let buckets by customer serve joins on the customer and more columns; sessions of `build_session` do."""
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")


def write_bucketed(
    df: DataFrame, name: str, path: str, buckets: int, key: str = "Customer_ID", order: Sequence[str] = ()
) -> DataFrame:
    """The frame as table ``name`` below ``path``, in ``buckets`` by ``key``, sorted by it and then by ``order``.

    One shuffle deals the rows to as many tasks as there are buckets, so a bucket is one sorted file.
    Stores with the same number of buckets join on ``key``, alone or with more columns, where they lie.
    """
    writer = df.repartition(buckets, key).write.mode("overwrite").option("path", path).format("parquet")
    writer.bucketBy(buckets, key).sortBy(key, *order).saveAsTable(name)
    return df.sparkSession.table(name)


def drop_store(spark: SparkSession, name: str) -> None:
    """Forget the table; its files stay where they are."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
