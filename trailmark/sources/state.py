"""Watermark state: an append-only table of (sync_name, cursor), newest version wins.

An append becomes visible only when its job commits, so a crash leaves the previous cursor.
One writer per sync.
"""

from __future__ import annotations

from datetime import datetime
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EPOCH = "1970-01-01 00:00:00"
_SCHEMA = "sync_name string, last_synced_at timestamp, last_uid string, version long"


class Cursor(NamedTuple):
    """Last exported position as timestamp text (UTC, microseconds) and uid."""

    at: str
    uid: str | None


class SyncState:
    def __init__(self, spark: SparkSession, path: str):
        self._spark, self._path = spark, path
        # Creates the folder so that the first read finds an empty table.
        spark.createDataFrame([], _SCHEMA).write.mode("append").parquet(path)

    def _log(self) -> DataFrame:
        return self._spark.read.schema(_SCHEMA).parquet(self._path)

    def table(self) -> DataFrame:
        """One current row per sync."""
        newest = F.max_by(F.struct("last_synced_at", "last_uid", "version"), "version").alias("s")
        return self._log().groupBy("sync_name").agg(newest).select("sync_name", "s.*")

    def seed(self, sync_name: str, at: str = EPOCH) -> None:
        """Insert a starting row for a sync that has none; existing rows stay."""
        wanted = self._row(sync_name, Cursor(at, None), F.lit(0))
        wanted.join(self._log(), "sync_name", "left_anti").write.mode("append").parquet(self._path)

    def seed_all(self, names: DataFrame, at: str = EPOCH) -> None:
        """Insert a starting row for every ``sync_name`` of a DataFrame that has none, in one job."""
        new = names.select("sync_name").filter("sync_name is not null").distinct().join(self._log(), "sync_name", "left_anti")
        new.select(
            "sync_name", F.lit(at).cast("timestamp").alias("last_synced_at"), F.lit(None).cast("string").alias("last_uid"),
            F.lit(0).cast("long").alias("version"),
        ).write.mode("append").parquet(self._path)

    def _row(self, sync_name: str, cursor: Cursor, version) -> DataFrame:
        return self._spark.range(1).select(
            F.lit(sync_name).alias("sync_name"), F.lit(cursor.at).cast("timestamp").alias("last_synced_at"),
            F.lit(cursor.uid).cast("string").alias("last_uid"), version.cast("long").alias("version"),
        )

    def read(self, sync_name: str) -> Cursor:
        text = F.date_format("last_synced_at", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("at")
        row = self.table().filter(F.col("sync_name") == sync_name).select(text, "last_uid").first()
        return Cursor(EPOCH, None) if row is None else Cursor(row["at"], row["last_uid"])

    def advance(self, sync_name: str, cursor: Cursor) -> None:
        last = self.table().filter(F.col("sync_name") == sync_name).select("version").first()
        version = F.lit(0 if last is None else last["version"] + 1)
        self._row(sync_name, cursor, version).write.mode("append").parquet(self._path)


def cursor_text(moment: datetime) -> str:
    return moment.strftime("%Y-%m-%d %H:%M:%S.%f")
