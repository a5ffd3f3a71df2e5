"""Composed pipelines, dashboard queries, fixtures and the query registry."""
