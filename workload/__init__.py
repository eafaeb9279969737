"""The registered queries: registry operators over the provided tables, and their SQL equivalents."""

from workload.catalog import ORACLE, QUERIES
from workload import serving, served, merging, cleaning, drops, ledger, loads, streams  # noqa: F401  (importing registers the queries)

__all__ = ["ORACLE", "QUERIES"]
