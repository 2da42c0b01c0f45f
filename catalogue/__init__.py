"""Every query of the inventory, each beside the SQL that checks it."""

from catalogue import report, basics, inputs, trends  # noqa: F401  (register queries)
from catalogue.core import ORACLES, QUERIES, runnable

__all__ = ["ORACLES", "QUERIES", "runnable"]
