"""Spark data source for cursor-paged endpoints and its transports."""
