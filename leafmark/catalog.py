"""Modules that register queries; each has queries() and oracle_sql()."""

from .plans import citation_queries, number_queries, page_queries, source_queries, text_queries

MODULES = [citation_queries, text_queries, number_queries, page_queries, source_queries]
