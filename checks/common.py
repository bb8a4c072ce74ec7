"""What the registered queries share: parameters and result shaping."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trailmark.config import AttributionConfig, prepare_session
from trailmark.sources.landing import AS_OF, Star, star

Query = Callable[[SparkSession, str], DataFrame]
Build = Callable[[Star], DataFrame]

TZ = "America/Denver"
DAY = "2024-01-10"
CFG = AttributionConfig(as_of=AS_OF)
# A lookback short enough to cut rows off.
SHORT = CFG.but(lookback_days=10, attribution_window_days=7)

_PLAIN = {"int": "bigint", "smallint": "bigint", "tinyint": "bigint", "float": "double",
          "timestamp": "timestamp_ntz", "date": "string"}


def plain(df: DataFrame) -> DataFrame:
    """Wide integers, doubles and naive UTC timestamps, so that types compare across engines."""
    out = []
    for f in df.schema:
        kind = f.dataType.simpleString()
        kind = "double" if kind.startswith("decimal") else _PLAIN.get(kind)
        out.append(F.col(f.name).cast(kind).alias(f.name) if kind else F.col(f.name))
    return df.select(*out)


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Fix floating sums, whose last bits depend on the order of addition."""
    doubles = {f.name: F.round(F.col(f.name), digits) for f in df.schema if f.dataType.typeName() == "double"}
    return df.withColumns(doubles) if doubles else df


def query(fn: Callable[[Star], DataFrame]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        prepare_session(spark)
        return rounded(plain(fn(star(spark, sf_dir))))

    run.__name__ = getattr(fn, "__name__", "query")
    run.__doc__ = fn.__doc__
    return run
