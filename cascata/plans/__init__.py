"""Named batch queries and their SQL oracles."""

from cascata.plans.catalog import oracles, queries

__all__ = ["oracles", "queries"]
