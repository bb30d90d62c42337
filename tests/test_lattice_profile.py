"""Mixed record types, profiled column types."""

import json
import random
from collections import Counter

import pytest

from sluice.operators import lattice as L
from sluice.operators import profile as P
from sluice.sinks import jdbc as JW
from sluice.sources import jdbc as JR
from tests.conftest import SF_SMALL


def brute_types(texts, depth=4):
    found = Counter()

    def walk(path, v, left):
        kind = (
            "VOID" if v is None else "BOOLEAN" if isinstance(v, bool) else "BIGINT" if isinstance(v, int)
            else "DECIMAL" if isinstance(v, float) else "STRING" if isinstance(v, str) else "ARRAY" if isinstance(v, list) else "OBJECT"
        )
        found[path, kind] += 1
        if left and isinstance(v, dict):
            for k, x in v.items():
                walk(f"{path}.{k}", x, left - 1)
        if left and isinstance(v, list):
            for x in v:
                walk(f"{path}[]", x, left - 1)

    for t in texts:
        if t is None:
            found["$", "VOID"] += 1
            continue
        try:
            value = json.loads(t)
        except ValueError:
            found["$", "INVALID"] += 1
            continue
        walk("$", value, depth)
    return found


@pytest.mark.parametrize("depth", [0, 1, 4])
def test_types_equal_brute_force(spark, depth):
    rng = random.Random(depth)

    def value(left):
        kinds = [None, True, 3, -7, 2.5, "x", "5", ""]
        if left and rng.random() < 0.5:
            return rng.choice([
                {k: value(left - 1) for k in rng.sample("abc", rng.randrange(4))}, [value(left - 1) for _ in range(rng.randrange(4))],
            ])
        return rng.choice(kinds)

    texts = [json.dumps(value(4)) for _ in range(150)] + [None, "", "{", "[]", "{}", '"text"', "7"]
    df = spark.createDataFrame([(t, "mine") for t in texts], "`j.s` STRING, path STRING").repartition(3)
    got = {(r.path, r.type): r.n_rows for r in L.field_types(df, "j.s", depth=depth).collect()}
    assert got == dict(brute_types(texts, depth))


def test_merging_in_the_lattice(spark):
    rows = [
        ("a", "BIGINT", 5), ("a", "VOID", 9), ("b", "BIGINT", 5), ("b", "DECIMAL", 1), ("c", "DOUBLE", 1), ("c", "BIGINT", 3), ("c", "DECIMAL", 2),
        ("d", "STRING", 2), ("d", "BIGINT", 4), ("d", "OBJECT", 1), ("e", "VOID", 2), ("f", "ARRAY", 1), ("f", "OBJECT", 1),
    ]
    got = {r.path: (r.merged, r.conflict, r.types, r.n_rows, r.n_other) for r in L.merged_types(spark.createDataFrame(rows, "path STRING, type STRING, n_rows LONG")).collect()}
    assert got == {
        "a": ("BIGINT", False, "BIGINT,VOID", 14, 0), "b": ("DECIMAL", False, "BIGINT,DECIMAL", 6, 1),
        "c": ("DOUBLE", False, "BIGINT,DECIMAL,DOUBLE", 6, 3), "d": ("STRING", True, "BIGINT,OBJECT,STRING", 7, 3),
        "e": ("VOID", False, "VOID", 2, 0), "f": ("STRING", True, "ARRAY,OBJECT", 2, 1),
    }


def test_resolution(spark):
    texts = ['{"a": {"x": 1}}', '{"a": {"x": "12"}}', '{"a": {"x": "no"}}', '{"a": {"x": null}}', '{"a": 3}', None, "nope", '{"a": {"x": [1]}}']
    df = spark.createDataFrame([(t,) for t in texts], "j STRING")
    rows = L.resolve(df, "j", {"$.a.x": "cast:int"}).collect()
    assert [(r.x, r.x_failed) for r in rows] == [(1, False), (12, False), (None, True), (None, False), (None, False), (None, False), (None, False), (None, True)]
    rows = L.resolve(df, "j", {"$.a.x": "split:bigint,string,array"}).collect()
    assert [(r.x_bigint, r.x_string, r.x_array) for r in rows][:3] == [(1, None, None), (None, "12", None), (None, "no", None)]
    assert rows[-1].x_array == "[1]"
    assert [r.a for r in L.resolve(df, "j", {"$.a": "keep"}).collect()][3:6] == ['{"x":null}', "3", None]
    with pytest.raises(ValueError):
        L.resolve(df, "j", {"$.a": "guess"})


def test_no_records(spark):
    none = spark.createDataFrame([], "j STRING")
    assert L.merged_types(L.field_types(none, "j")).collect() == []


def test_least_types(spark):
    rows = [
        (1, 40_000, 3_000_000_000, 1.25, 1.0, 0.1 + 0.2, "ab", "é" * 20, None, None, True),
        (-5, -3, None, -100.5, None, 1e300, "", None, None, None, None),
    ]
    df = spark.createDataFrame(
        rows, "a LONG, b LONG, c LONG, d DOUBLE, e DOUBLE, f DOUBLE, g STRING, h STRING, i STRING, j INT, k BOOLEAN"
    )
    got = {r.column_name: (r.sql_type, r.nullable) for r in P.least_types(P.profile_columns(df)).collect()}
    assert got == {
        "a": ("SMALLINT", False), "b": ("INT", False), "c": ("BIGINT", True), "d": ("DECIMAL(5,2)", False), "e": ("DECIMAL(1,0)", True),
        "f": ("DOUBLE", False), "g": ("VARCHAR(16)", False), "h": ("VARCHAR(32)", True), "i": ("VARCHAR(16)", True), "j": ("INT", True),
        "k": ("BOOLEAN", True),
    }
    profile = {r.column_name: r for r in P.profile_columns(df).collect()}
    assert (profile["h"].max_chars, profile["h"].max_bytes) == (20, 40) and profile["a"].n_rows == 2


def test_other_columns(spark):
    df = spark.sql("SELECT cast(12.30 AS DECIMAL(20,4)) AS d, cast(NULL AS DECIMAL(7,1)) AS n, date'2024-01-01' AS t, repeat('x', 5000) AS long, double('NaN') AS nan, float(0.5) AS f")
    got = {r.column_name: r.sql_type for r in P.least_types(P.profile_columns(df)).collect()}
    assert got == {"d": "DECIMAL(6,4)", "n": "DECIMAL(7,1)", "t": "DATE", "long": None, "nan": "DOUBLE", "f": "DECIMAL(2,1)"}


@pytest.mark.parametrize("name", ["customer", "part", "orders"])
def test_nothing_is_truncated_in_a_database(spark, derby, name):
    df = spark.read.parquet(f"{SF_SMALL}/{name}.parquet")
    JW.write_jdbc(df, derby, f"PROF_{name}", mode="overwrite", create_column_types=P.column_ddl(df))
    back = JR.read_table(spark, derby, f"PROF_{name}")
    cast = back.select(*[back[f.name].cast(f.dataType).alias(f.name) for f in df.schema])
    assert cast.count() == df.count() and cast.exceptAll(df).isEmpty()
    assert "VARCHAR(16)" in P.column_ddl(df) and "DECIMAL" in P.column_ddl(df)
