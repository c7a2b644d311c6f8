"""Nested JSON documents to flat tables, on Spark DataFrames."""

from flatspark.session import LAUNCH_SETTINGS, configure, work_dir

__all__ = ["LAUNCH_SETTINGS", "configure", "work_dir"]
