"""Incremental upkeep of the wide table as new billing data lands."""
