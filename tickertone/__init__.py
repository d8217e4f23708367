"""Market features and news tone as lazy Spark DataFrame jobs."""

from .config import Settings
from .session import get_spark, shared_folder, stage

__all__ = ["Settings", "get_spark", "shared_folder", "stage"]
