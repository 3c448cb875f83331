"""Import every module that registers queries."""

from mercato.catalog import (  # noqa: F401
    behaviour_queries,
    control_queries,
    gold_queries,
    merge_queries,
    message_queries,
)
from mercato.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
