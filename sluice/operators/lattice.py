"""Records whose fields have different types from row to row.

JSON texts are parsed to VARIANT values, which keep each value's own type. Every
path gets the types found there with their rows; types meet in a lattice (BIGINT
below DECIMAL below DOUBLE, VOID below all), and where they have no common type
but text the path is a conflict. ``resolve`` then settles paths by choice: cast
to a type, split into one column per type, or keep the value as JSON.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Numeric types, each holding those before it.
NUMBERS = ("BIGINT", "DECIMAL", "DOUBLE")
_NODE = "array<struct<path: string, v: variant, open: boolean>>"


def parsed(column: str | Column) -> Column:
    """A JSON text as VARIANT; NULL where it is no JSON."""
    return F.try_parse_json(F.col(column) if isinstance(column, str) else column)


def kind(value: Column) -> Column:
    """The type of a VARIANT without its parts: OBJECT, ARRAY, STRING, BOOLEAN,
    BIGINT, DECIMAL, DOUBLE, VOID (a JSON null), ..."""
    return F.regexp_extract(F.schema_of_variant(value), "^[A-Z_]+", 0)


def field_types(df: DataFrame, json_column: str, *, depth: int = 4) -> DataFrame:
    """(path, type, n_rows): the types found at every path down to ``depth``
    levels, and how often. Paths read ``$``, ``$.a``, ``$.a[]`` (elements of an
    array, each counted). A text that is no JSON counts as INVALID at ``$``, NULL
    as VOID. One pass: a container is replaced by itself and its children, level
    by level, and counted with map-side aggregation."""
    text = F.col("`" + json_column.replace("`", "``") + "`")
    rows = df.select(F.lit("$").alias("path"), parsed(text).alias("v"), F.lit(True).alias("open"), text.isNull().alias("none"))
    nodes = rows
    for _ in range(depth):
        member = F.expr(
            "transform(map_entries(try_variant_get(v, '$', 'map<string, variant>')), "
            "e -> named_struct('path', concat(path, '.', e.key), 'v', e.value, 'open', true))"
        )
        element = F.expr(
            "transform(try_variant_get(v, '$', 'array<variant>'), "
            "e -> named_struct('path', concat(path, '[]'), 'v', e, 'open', true))"
        )
        inside = F.when(F.col("open") & (kind(F.col("v")) == "OBJECT"), member).when(F.col("open") & (kind(F.col("v")) == "ARRAY"), element)
        itself = F.expr("array(named_struct('path', path, 'v', v, 'open', false))")
        every = F.concat(itself, F.coalesce(inside, F.expr(f"cast(array() as {_NODE})")))
        nodes = nodes.select("none", F.explode(every).alias("node")).select("none", "node.*")
    kinds = F.when(F.col("v").isNotNull(), kind(F.col("v"))).when(F.col("none"), "VOID").otherwise("INVALID")
    return nodes.groupBy("path", kinds.alias("type")).agg(F.count(F.lit(1)).alias("n_rows"))


def merged_types(types: DataFrame) -> DataFrame:
    """(path, merged, conflict, types, n_rows, n_other) per path of
    ``field_types``: the least type that holds all values there. ``conflict``
    where that is text only for want of a common type; ``types`` names what was
    found, in alphabetic order; ``n_other`` counts the rows (VOID aside) that
    aren't of the most frequent type (ties: the first in alphabetic order)."""
    found = types.groupBy("path").agg(
        F.sort_array(F.collect_list("type")).alias("all"),  # one entry per type
        F.sum("n_rows").alias("n_rows"),
        F.sum(F.when(F.col("type") != "VOID", F.col("n_rows")).otherwise(0)).alias("typed"),
        F.max(F.when(F.col("type") != "VOID", F.col("n_rows")).otherwise(0)).alias("most"),
    )
    real = F.array_remove("all", "VOID")
    numeric = F.size(F.array_except(real, F.array(*map(F.lit, NUMBERS)))) == 0
    merged = F.when(F.size(real) == 0, F.lit("VOID")).when(F.size(real) == 1, real[0])
    widest = F.when(F.array_contains(real, "DOUBLE"), "DOUBLE").otherwise("DECIMAL")
    merged = merged.when(numeric, widest).otherwise("STRING")
    conflict = (F.size(real) > 1) & ~numeric
    return found.select(
        "path", merged.alias("merged"), conflict.alias("conflict"), F.array_join("all", ",").alias("types"), "n_rows",
        (F.col("typed") - F.col("most")).cast("long").alias("n_other"),
    )


def resolve(df: DataFrame, json_column: str, choices: Mapping[str, str]) -> DataFrame:
    """``df`` with columns for the chosen paths (``$.a.b``), named after their
    last part.

    ``cast:<type>``: the value as that type, and ``<name>_failed``, true where a
    value is there that doesn't convert. ``split:<type>,<type>``: one column
    ``<name>_<type>`` per type, each holding the values found with that type
    (DECIMAL and DOUBLE as DOUBLE). ``keep``: the value as JSON text. A path that
    a row lacks, JSON null and texts that are no JSON give NULL.
    """
    spelled = {"BIGINT": "bigint", "DECIMAL": "double", "DOUBLE": "double", "STRING": "string", "BOOLEAN": "boolean"}
    text = F.col("`" + json_column.replace("`", "``") + "`")
    out: dict[str, Column] = {}
    for path, choice in choices.items():
        name = path.rsplit(".", 1)[-1]
        found = F.try_variant_get(parsed(text), path, "variant")
        real = found.isNotNull() & ~F.is_variant_null(found)
        how, _, what = choice.partition(":")
        if how == "cast":
            value = F.try_variant_get(parsed(text), path, what)
            out[name] = value
            out[f"{name}_failed"] = real & value.isNull()
        elif how == "split":
            for t in (x.strip().upper() for x in what.split(",")):
                value = F.to_json(found) if t in ("OBJECT", "ARRAY") else F.try_variant_get(parsed(text), path, spelled[t])
                out[f"{name}_{t.lower()}"] = F.when(real & (kind(found) == t), value)
        elif how == "keep":
            out[name] = F.when(real, F.to_json(found))
        else:
            raise ValueError(f"{path}: {choice!r} is none of cast:<type>, split:<types>, keep")
    return df.withColumns(out)
