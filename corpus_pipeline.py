"""Cleaning and packing a corpus; the stages are :mod:`tablelift.llm.pipeline`."""

from tablelift.llm.pipeline import ORACLE_SQL, STAGES, run

__all__ = ["ORACLE_SQL", "STAGES", "run"]
