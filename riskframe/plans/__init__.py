"""Composed jobs: the registered queries (Spark) and their SQL oracles."""
