"""Product-event analytics on Spark: validate, land, refine, measure, serve."""

from tidemark.session import configure

__all__ = ["configure"]
