"""Distributed operators: filters, joins, ranking, clustering, statistics, validation."""
