"""All registered queries."""

from topicloom.checks import report_checks, sources_checks, vector_checks  # noqa: F401
from topicloom.checks.tables import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
