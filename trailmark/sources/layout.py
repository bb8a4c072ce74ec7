"""Table layouts that save work at every later read."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def save_colocated(
    tables: Mapping[str, DataFrame], keys: Mapping[str, str], buckets: int, database: str = "default", prefix: str = "", path: str | None = None,
) -> None:
    """Save tables bucketed and sorted on their event key.

    Events (``id``) and the per-event tables (``event_id``) written with the same bucket count
    join without a shuffle or a sort: the largest joins here are all on that key.  Table names begin with ``prefix``;
    ``path`` is a folder for the files, by default the database's own.
    """
    for name, df in tables.items():
        key = keys[name]
        writer = df.repartition(buckets, key).write.mode("overwrite").bucketBy(buckets, key).sortBy(key)
        if path:
            writer = writer.option("path", f"{path}/{name}")
        writer.saveAsTable(f"{database}.{prefix}{name}")


def write_by_day(df: DataFrame, path: str, time: str = "event_time") -> None:
    """Write an event table in folders per UTC day, rows in time order, for day filters and for
    picking up only new days."""
    (
        df.withColumn("event_date", F.to_date(time))
        .repartitionByRange("event_date", time).sortWithinPartitions(time)
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("event_date").parquet(path)
    )
