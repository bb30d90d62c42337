"""Column types from the data: a one-pass profile and a least-type rule.

A schema alone says "string" or "bigint"; a target table wants VARCHAR(32) or
SMALLINT. The profile takes, in one scan with map-side aggregation, what the rule
needs of every column, so a type is chosen that holds every value that is there.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Lengths a text column may get; longer ones take the database's text type.
LENGTHS = (16, 32, 64, 128, 255, 1000, 4000)
#: Doubles with at most this many decimals everywhere become exact decimals.
MOST_DECIMALS = 6
_INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _q(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def _decimals(value: Column) -> Column:
    """Decimals of a double's shortest form, or MOST_DECIMALS + 1 if there are
    more, it is not finite or too large for 15 exact digits."""
    out = F.when(~(F.abs(value) < 1e15), F.lit(MOST_DECIMALS + 1))
    for n in range(MOST_DECIMALS + 1):
        out = out.when(value == F.round(value, n), F.lit(n))
    return out.otherwise(F.lit(MOST_DECIMALS + 1))


def profile_columns(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column_name, position, spark_type, n_rows, n_nulls, least, largest,
    max_chars, max_bytes, int_digits, decimals) per column, in one pass. Numbers
    fill ``least`` and ``largest`` (as text) and the digits before and after the
    point; texts and binaries their lengths; other fields are NULL."""
    names = list(columns or df.columns)
    aggs: list[Column] = [F.count(F.lit(1)).alias("n")]
    for i, c in enumerate(names):
        kind, value = df.schema[c].dataType, _q(c)
        none = F.lit(None)
        least = largest = chars = size = digits = decimals = none
        if isinstance(kind, (*_INTEGERS, T.DecimalType, T.FloatType, T.DoubleType)):
            least, largest = F.min(value).cast("string"), F.max(value).cast("string")
            if isinstance(kind, T.DecimalType):
                whole = F.floor(F.abs(value)).cast("string")
                digits, decimals = F.max(F.when(value.isNotNull(), F.length(whole))), F.lit(kind.scale)
            elif isinstance(kind, (T.FloatType, T.DoubleType)):
                whole = F.when(F.abs(value) < 1e15, F.length(F.floor(F.abs(value)).cast("long").cast("string")))
                digits, decimals = F.max(whole), F.max(F.when(value.isNotNull(), _decimals(value)))
        elif isinstance(kind, T.StringType):
            chars, size = F.max(F.char_length(value)), F.max(F.octet_length(value))
        elif isinstance(kind, T.BinaryType):
            size = F.max(F.octet_length(value))
        aggs.append(
            F.struct(
                F.lit(c).alias("column_name"), F.lit(i).alias("position"), F.lit(kind.simpleString()).alias("spark_type"),
                (F.count(F.lit(1)) - F.count(value)).alias("n_nulls"), least.cast("string").alias("least"),
                largest.cast("string").alias("largest"), chars.cast("long").alias("max_chars"), size.cast("long").alias("max_bytes"),
                digits.cast("int").alias("int_digits"), decimals.cast("int").alias("decimals"),
            ).alias(f"c{i}")
        )
    one = df.agg(*aggs)
    return one.select("n", F.explode(F.array(*[f"c{i}" for i in range(len(names))])).alias("c")).select(
        "c.column_name", "c.position", "c.spark_type", F.col("n").alias("n_rows"), "c.n_nulls", "c.least", "c.largest",
        "c.max_chars", "c.max_bytes", "c.int_digits", "c.decimals",
    )


def least_types(profile: DataFrame) -> DataFrame:
    """(column_name, position, sql_type, nullable) for a profile: integers the
    narrowest of SMALLINT, INT, BIGINT; doubles DECIMAL(p, s) if every value has
    at most MOST_DECIMALS decimals and 15 digits, else DOUBLE; texts the first of
    LENGTHS that holds them, else the text type of the target (NULL: leave it
    out); a column without values keeps its declared type. ``nullable`` says
    whether a NULL was seen."""
    kind = F.col("spark_type")
    small = lambda bits: (F.col("least").cast("long") >= -(1 << bits)) & (F.col("largest").cast("long") < (1 << bits))
    whole = F.when(F.col("least").isNull(), F.element_at(F.create_map(*[F.lit(x) for p in _DECLARED.items() for x in p]), kind))
    whole = whole.when(small(15), "SMALLINT").when(small(31), "INT").otherwise("BIGINT")
    digits = F.coalesce("int_digits", F.lit(0)) + F.col("decimals")
    exact = (F.col("decimals") <= MOST_DECIMALS) & (digits <= 15)
    double = F.when(exact, F.format_string("DECIMAL(%d,%d)", F.greatest(digits, F.lit(1)), F.col("decimals"))).otherwise("DOUBLE")
    text = F.when(F.coalesce("max_chars", F.lit(0)) <= LENGTHS[0], f"VARCHAR({LENGTHS[0]})")
    for n in LENGTHS[1:]:
        text = text.when(F.col("max_chars") <= n, f"VARCHAR({n})")
    decimal = F.when(F.col("int_digits").isNull(), F.upper(kind)).otherwise(
        F.format_string("DECIMAL(%d,%d)", F.greatest(F.col("int_digits") + F.col("decimals"), F.lit(1)), F.col("decimals"))
    )
    chosen = (
        F.when(kind.isin("tinyint", "smallint", "int", "bigint"), whole)
        .when(kind.isin("float", "double"), double)
        .when(kind.startswith("decimal"), decimal)
        .when(kind == "string", text)
        .when(kind.startswith("timestamp"), "TIMESTAMP")
        .otherwise(F.upper(kind))
    )
    return profile.select("column_name", "position", chosen.alias("sql_type"), (F.col("n_nulls") > 0).alias("nullable"))


#: SQL names of the integer types.
_DECLARED = {"tinyint": "SMALLINT", "smallint": "SMALLINT", "int": "INT", "bigint": "BIGINT"}


def column_ddl(df: DataFrame, columns: Sequence[str] | None = None) -> str:
    """The chosen types as a list for ``write_jdbc(create_column_types=...)``;
    columns that take the target's text type are left out of it."""
    rows = least_types(profile_columns(df, columns)).orderBy("position").collect()  # one per column
    return ", ".join("`" + r["column_name"].replace("`", "``") + "` " + r["sql_type"] for r in rows if r["sql_type"])
