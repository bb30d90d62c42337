"""Connection-record functions over columns: URL parts, secret redaction,
first present key, two-decimal rendering.

They are compositions of built-in expressions: JVM-side, no Python per
row. The URL functions compile into whole-stage codegen; the map redaction
uses a higher-order function (``transform_values``), which Spark evaluates
outside codegen but still in the JVM.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Option keys whose values are secrets (compared lower-cased),
# and the mask that replaces them.
SECRET_KEYS = ("password", "pwd")
MASK = "******"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _plain_url(url: str | Column) -> Column:
    """The URL without its ``jdbc:`` prefix and ``;`` options, as ``parse_url`` reads it."""
    return F.split_part(F.regexp_replace(_col(url), "^jdbc:", ""), F.lit(";"), F.lit(1))


def jdbc_host(url: str | Column) -> Column:
    """Host of a JDBC / HTTP URL by the URL grammar: user info, port, path and
    query are no part of it. NULL without a host or for no URL at all."""
    return F.try_parse_url(_plain_url(url), F.lit("HOST"))


def jdbc_database(url: str | Column) -> Column:
    """Database of a JDBC URL: the last segment of its path, without query and
    ``;`` options. NULL when there is none."""
    path = F.try_parse_url(_plain_url(url), F.lit("PATH"))
    return F.nullif(F.split_part(path, F.lit("/"), F.lit(-1)), F.lit(""))


def redact_map(m: str | Column, keys: Sequence[str] = SECRET_KEYS) -> Column:
    """Mask the values of secret keys (case-insensitive) in a map column."""
    lowered = [k.lower() for k in keys]
    return F.transform_values(
        _col(m), lambda k, v: F.when(F.lower(k).isin(lowered), F.lit(MASK)).otherwise(v)
    )


def redact_json_map(js: str | Column, keys: Sequence[str] = SECRET_KEYS) -> Column:
    """A JSON object string -> the same object with secret values masked,
    rendered back to compact JSON (values as strings)."""
    parsed = F.from_json(_col(js), "map<string,string>")
    return F.to_json(redact_map(parsed, keys))


def first_present(m: str | Column, *keys: str) -> Column:
    """Value of the first key present in a map (``get(a, get(b))``)."""
    col = _col(m)
    return F.coalesce(*[F.try_element_at(col, F.lit(k)) for k in keys])


def round2(x: str | Column) -> Column:
    """Two-decimal rendering of a number, as a string ("{:.2f}").

    Java formatting rounds half up on the shortest decimal form (1.005 ->
    "1.01"); Python rounds the binary value (1.005 -> "1.00"). They agree
    whenever the value has at most two decimals, as money columns do."""
    return F.format_string("%.2f", _col(x))
