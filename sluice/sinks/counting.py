"""Counts taken by a write itself."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import Observation


def observed(seen: Observation, *names: str) -> dict[str, int]:
    """The named metrics of a finished write. Spark drops an observation
    together with a plan that it proves empty; the metrics are then 0, and the
    caller's comparison with the written rows still holds."""
    try:
        found = seen.get
    except Py4JJavaError as error:
        if "AssertionError" not in str(error.java_exception):
            raise
        found = {}
    return {n: found.get(n, 0) for n in names}
