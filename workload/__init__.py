"""Registered queries: each operator on the given tables, with the SQL that must agree with it."""
from workload import cells, cleaning, dedup, fidelity, profiles, reports, runs, transforms  # noqa: F401
from workload.registry import QUERIES, SQL  # noqa: F401
