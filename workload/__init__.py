"""The registered queries: the library run over the given tables, each beside its SQL check."""

from workload import game, lake, marts, runs  # noqa: F401
from workload.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
