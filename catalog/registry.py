"""Every registered query by name, with its SQL or None."""

from . import ranking_queries, text_queries

QUERIES = {**text_queries.QUERIES, **ranking_queries.QUERIES}
