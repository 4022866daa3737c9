"""All queries of the subpackage, by name."""

from corundum.llm.oracle import SQL
from corundum.llm.queries import QUERIES

__all__ = ["QUERIES", "SQL"]
