"""The registered queries over the given tables, each with its check SQL."""

from workload import columns, documents, history, loads  # noqa: F401  (registers)
from workload.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
