"""Whole flows: the queries over the project's tables, preparation and evaluation."""
