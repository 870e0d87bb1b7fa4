"""Readers, writers and reusable stages."""

from feedback_lens.sources.readers import read_lexicon, read_pages, read_reviews, read_vectors
from feedback_lens.sources.stages import stage
from feedback_lens.sources.writers import write_table

__all__ = ["read_lexicon", "read_pages", "read_reviews", "read_vectors", "stage", "write_table"]
