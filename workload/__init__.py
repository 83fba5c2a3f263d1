"""Registered queries: the operators on study tables derived from the TPC-H-like tables."""

from workload import batch, delivery, identity, publication, records, redelivery, runs, variables  # noqa: F401
from workload.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
