"""The operators run on the given tables, each beside plain SQL for the same result."""

from shiplog.workloads import changes, ledgers, usage
from shiplog.workloads.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "changes", "ledgers", "usage"]
