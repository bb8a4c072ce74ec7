"""Settings, session preparation and the shared work area."""

from __future__ import annotations

import re
import tempfile
import uuid
from dataclasses import dataclass, replace
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The attribution model names and their output order.
FIRST_TOUCH = "First Touch"
LAST_TOUCH = "Last Touch"
LINEAR = "Linear"
U_SHAPED = "40-20-40 U-Shaped"
FULL_CREDIT = "Full Credit"
DISTRIBUTING_MODELS = (FIRST_TOUCH, LAST_TOUCH, LINEAR, U_SHAPED)
ALL_MODELS = (*DISTRIBUTING_MODELS, FULL_CREDIT)


@dataclass(frozen=True)
class AttributionConfig:
    """One row of attribution parameters, injected as literals instead of a config-table join.

    ``as_of`` stands in for the current timestamp (``None`` means now).
    ``price_scale=0`` drops cents the way an integer price cast does.
    ``strict_reference`` keeps an empty referrer as source ``''`` instead of ``'direct'``.
    """

    lookback_days: int = 90
    attribution_window_days: int = 14
    conversion_event_name: str = "Checkout Success"
    as_of: str | None = None
    price_scale: int = 2
    strict_reference: bool = False

    def now(self) -> Column:
        return F.current_timestamp() if self.as_of is None else F.lit(self.as_of).cast("timestamp")

    def but(self, **changes: Any) -> AttributionConfig:
        return replace(self, **changes)


def prepare_session(spark: SparkSession) -> SparkSession:
    """Pin the settings the results depend on and the ones skewed joins need.

    Timestamps are UTC throughout.  Adaptive execution splits hot join partitions; ``force``
    lets it do so where the split costs an extra exchange further up.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    return spark


_LOCAL_WORK: dict[str, str] = {}


def work_dir(spark: SparkSession) -> str:
    """The shared folder for written intermediates: the cluster's ``spark.checkpoint.dir``.

    Only a local master (``local`` or ``local[...]``, one machine) may fall back to a temporary folder; on a
    cluster a machine-local path would vanish with its executor.  A ``file:`` path is taken as given, since
    clusters mount shared folders that way.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_WORK:
        _LOCAL_WORK[app] = tempfile.mkdtemp(prefix="trailmark-")
    return _LOCAL_WORK[app]


def run_dir(spark: SparkSession) -> str:
    """This application's own folder in the work area."""
    return f"{work_dir(spark)}/trailmark-{spark.sparkContext.applicationId}"


def work_path(spark: SparkSession, name: str) -> str:
    return f"{run_dir(spark)}/{name}-{uuid.uuid4().hex}"


def clean_work(spark: SparkSession) -> bool:
    """Remove all intermediates of this application; call it when no result that reads them is needed any more."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(run_dir(spark))
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def work_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the work area and read it back.

    Used where a result is scanned more than once.  Unlike a cache it survives executor loss,
    cuts lineage, and later scans still prune columns and push filters.
    """
    spark = df.sparkSession
    path = work_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
