"""Registered queries: each module listed here has QUERIES and SQL."""

CATALOGUE = ["reference_queries", "text_queries", "record_queries", "web_queries", "flow_queries"]
