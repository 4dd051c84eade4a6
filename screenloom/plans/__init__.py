"""The registered queries, each with its DuckDB SQL."""

from screenloom.plans import files_and_signals, genotyping, mapping, phenotyping, quality, selection  # noqa: F401  registers its queries
from screenloom.plans.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
