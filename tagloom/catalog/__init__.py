"""Every registered query; importing the package fills the registry."""

from tagloom.catalog import evaluating, ingesting, labelling, modelling, relating, reporting, texts, vectors, word_vectors
from tagloom.catalog.registry import QUERIES, SQL

__all__ = [
    "QUERIES", "SQL", "evaluating", "ingesting", "labelling", "modelling",
    "relating", "reporting", "texts", "vectors", "word_vectors",
]
