"""trailmark: digital-behaviour analytics as PySpark dataflows.

Everything here is a function from DataFrames to DataFrames.  See README.md for the map.
"""

from trailmark.config import AttributionConfig, prepare_session, work_table

__all__ = ["AttributionConfig", "prepare_session", "work_table"]
