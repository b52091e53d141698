"""All registered queries, filled by importing the modules that define them."""

from harness import (  # noqa: F401
    q_directory, q_linkage, q_more, q_operators, q_panels, q_registry, q_stored)
from harness.registry import SPARK, SQL

__all__ = ["SPARK", "SQL"]
