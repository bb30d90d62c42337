"""Column functions (built-in Spark expressions only, no UDFs)."""

from sluice.functions.connection import (
    first_present,
    jdbc_database,
    jdbc_host,
    redact_json_map,
    redact_map,
    round2,
)

__all__ = ["first_present", "jdbc_database", "jdbc_host", "redact_json_map", "redact_map", "round2"]
