"""Queries over the model: hourly report, checks, dictionaries, analyses, registry."""
