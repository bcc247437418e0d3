"""All registered queries."""

from assaylake.queries import channels, health, maps, medallion, outputs, privacy, validation  # noqa: F401
from assaylake.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
