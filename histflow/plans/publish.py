"""Finish a load: audit rows, target, processed keys, in this order.

Only what the batch changes is written: its audit rows, the touched buckets of the target
and the keys of the rows it processed. Each step can be repeated after a failure: audit rows
and keys replace those of the same batch, and a finished batch is not merged again.
"""

from __future__ import annotations

from histflow.functions.scalar import AsOf, as_instant
from histflow.plans.loads import Load
from histflow.sources.ledger import Ledger
from histflow.sources.store import HistoryTable


def publish(
    load: Load,
    table: HistoryTable,
    as_of: AsOf,
    origin: str,
    batch: int,
    audit_path: str | None = None,
    ledger: Ledger | None = None,
) -> bool:
    """Write a load's results; whether its rows were merged now."""
    if load.rows is None:
        raise ValueError("the load has no rows to merge")
    if audit_path is not None and load.rejected is not None:
        load.rejected.write.mode("overwrite").parquet(f"{audit_path}/origin={origin}/batch={batch}")
    merged = table.apply(load.rows, as_instant(as_of), origin=origin, batch=batch)
    if ledger is not None and load.processed is not None:
        ledger.record(load.processed, origin, batch)
    return merged
