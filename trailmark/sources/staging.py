"""Source access and the staging renames."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trailmark.config import AttributionConfig


class Tables(Mapping[str, DataFrame]):
    """Tables by logical name, found through one template such as ``"prod.behaviour.{}"`` (catalog)
    or ``"s3://bucket/behaviour/{}"`` (Parquet folders).  ``names`` maps logical to physical names.
    """

    def __init__(
        self, spark: SparkSession, template: str, names: Mapping[str, str] | None = None
    ):
        self._spark, self._template, self._names = spark, template, dict(names or {})

    def __getitem__(self, name: str) -> DataFrame:
        target = self._template.format(self._names.get(name, name))
        return self._spark.read.parquet(target) if "/" in target else self._spark.table(target)

    def __iter__(self):
        return iter(self._names)

    def __len__(self) -> int:
        return len(self._names)

    def register(self, prefix: str = "raw_") -> None:
        """Pass-through temp views over the configured sources."""
        for name in self._names:
            self[name].createOrReplaceTempView(prefix + name)


def stage_events(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("id").alias("event_id"), F.col("user_id").alias("device_id"),
        "session_id", "event_time", "event_type", "processed_time",
    )


def stage_source_properties(source_properties: DataFrame) -> DataFrame:
    kept = ["event_id", F.col("url_full_url").alias("full_url"), "url_query", "url_path",
            F.col("initial_referrer_host").alias("referrer_host"), "initial_referrer_full_url"]
    if "event_time" in source_properties.columns:
        kept.append("event_time")
    return source_properties.select(*kept)


def stage_users(users: DataFrame) -> DataFrame:
    """Device to permanent user, identified devices only."""
    return users.filter(F.col("uid").isNotNull()).select(
        F.col("id").alias("device_id"), F.col("uid").alias("user_id")
    )


def price_of(properties: Column, scale: int) -> Column:
    """The ``price`` entry of a JSON payload; NULL unless numeric.  Scale 0 rounds to whole units."""
    return F.get_json_object(properties, "$.price").try_cast(f"decimal(38,{scale})")


def stage_custom_events(custom_events: DataFrame, cfg: AttributionConfig | None = None) -> DataFrame:
    cfg = cfg or AttributionConfig()
    return custom_events.select(
        "event_id", F.col("user_id").alias("device_id"), "session_id", "event_time", "event_name",
        "event_properties", price_of(F.col("event_properties"), cfg.price_scale).alias("price"),
    )


def same_event_time(
    context: DataFrame, holds: Callable[[Column], Column]
) -> DataFrame:
    """Apply an event-time filter to a per-event context table before it is joined.

    A context row carries its event's own time, so rows outside the range cannot match and the
    larger side of the join is pruned at the scan.  Tables without the column pass unchanged.
    """
    if "event_time" not in context.columns:
        return context
    return context.filter(holds(F.col("event_time")))
