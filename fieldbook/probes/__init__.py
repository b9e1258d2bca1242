from fieldbook.probes import reports, rows, streams, tables  # noqa: F401
from fieldbook.probes.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
