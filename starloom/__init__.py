"""Star-schema loads and rankings as plain Spark jobs."""

from starloom.specs import Column, Dimension, Source, Star

__all__ = ["Column", "Dimension", "Source", "Star"]
