"""Registered queries over the given tables, each with the SQL that states its expected result."""

from feedback_lens.catalog import corpus, models, pages, similarity, text  # noqa: F401  (register on import)
from feedback_lens.catalog.registry import all_oracles, all_queries, coverage

__all__ = ["all_oracles", "all_queries", "coverage"]
