"""Named queries over the driver tables, each with a DuckDB oracle where SQL can say it."""

from tsline.suite import delivered, destinations, formats, lines, packing, readback, streams  # noqa: F401  (registration)
from tsline.suite.registry import ORACLES, QUERIES

__all__ = ["QUERIES", "ORACLES"]
