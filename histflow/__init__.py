"""histflow: load semi-structured master data and keep its history, on Spark."""

from histflow.session import configure, work_folder

__all__ = ["configure", "work_folder"]
