"""Functions and checks against plain-Python statements of their rules, on
thousands of generated inputs evaluated in one Spark job each."""

import random

from pyspark.sql import functions as F

from sluice.functions import jdbc_database, jdbc_host, redact_map


def _urls(n, seed=7):
    """(URL, host, database) built part by part from the URL grammar."""
    rnd = random.Random(seed)
    out = []
    for _ in range(n):
        host = rnd.choice(["db.example.com", "h", "10.0.0.7", "a-b.example"])
        path = "/".join(rnd.choice(["db", "en", "v1", "x:y", "a@b"]) for _ in range(rnd.randint(0, 3)))
        tail = rnd.choice(["", "?", "?opt=a/b", "?u=x:y&z=//w", "#top", "?a=1#f/g"])
        user = rnd.choice(["", "", "u@", "u:pw@"])
        port = rnd.choice(["", ":3306"])
        slash = "/" if path or rnd.random() < 0.5 else ""
        end = "/" if path and rnd.random() < 0.2 else ""
        scheme = rnd.choice(["jdbc:mysql", "jdbc:postgresql", "https", "http"])
        database = None if end or not path else path.split("/")[-1]
        out.append((f"{scheme}://{user}{host}{port}{slash}{path}{end}{tail}", host, database))
    return out


def test_url_functions_match_rules(spark):
    urls = _urls(3000) + [
        ("http://h.example/a:b", "h.example", "a:b"), ("https://h.example?x=1", "h.example", None),
        ("jdbc:mysql://u:pw@h.example:3306/db", "h.example", "db"), ("jdbc:mysql://h.example/db?opt=a/b", "h.example", "db"),
        ("jdbc:sqlserver://h.example:1433;databaseName=x", "h.example", None), ("no-scheme-here", None, "no-scheme-here"),
        ("", None, None), (None, None, None),
    ]
    df = spark.createDataFrame(urls, "url STRING, host STRING, db STRING")
    got = df.select("*", jdbc_host("url").alias("h"), jdbc_database("url").alias("d")).collect()
    for r in got:
        assert (r.h, r.d) == (r.host, r.db), r.url


def test_redaction_matches_rules(spark):
    rnd = random.Random(3)
    keys = ["password", "PASSWORD", "Pwd", "pwd", "user", "host", "passwd", "pw", "dbname", "Password1"]
    maps = [{k: f"v{i}{k}" for k in rnd.sample(keys, rnd.randint(0, 6))} for i in range(1000)]
    df = spark.createDataFrame([(m,) for m in maps], "m MAP<STRING,STRING>")
    got = [r.r for r in df.select(redact_map("m").alias("r")).collect()]
    expected = [{k: ("******" if k.lower() in ("password", "pwd") else v) for k, v in m.items()} for m in maps]
    assert got == expected


def test_checks_match_brute_force(spark):
    from collections import Counter

    from sluice.operators import quality as Q

    rnd = random.Random(11)
    left = [(rnd.choice([None, *range(40)]), rnd.choice([None, "a", "b"])) for _ in range(400)]
    right = [(rnd.choice([None, *range(20, 60)]), rnd.choice([None, "a", "b"])) for _ in range(300)]
    L = spark.createDataFrame(left, "k INT, v STRING")
    R = spark.createDataFrame(right, "k INT, v STRING")

    dup = {(r.k, r.n_rows) for r in Q.check_unique(L, ["k"]).collect()}
    assert dup == {(k, n) for k, n in Counter(k for k, _ in left if k is not None).items() if n > 1}

    parents = {k for k, _ in right}
    fk = {(r.k, r.n_rows) for r in Q.check_foreign_key(L, R, ["k"]).collect()}
    assert fk == {(k, n) for k, n in Counter(k for k, _ in left if k is not None and k not in parents).items()}

    rec = Counter((r.key, r.v_status) for r in Q.reconcile(L, R, "k", "k", [("v", "v", "v")]).collect())
    lc, rc = Counter(k for k, _ in left), Counter(k for k, _ in right)
    lv = {k: v for k, v in left}
    rv = {k: v for k, v in right}
    expected = Counter()
    for k in set(lc) | set(rc):
        if k is None:  # NULL keys never match: one unmatched row per side that has them
            if k in lc:
                expected[(None, "missing_right")] += 1
            if k in rc:
                expected[(None, "missing_left")] += 1
        elif k not in lc:
            expected[(k, "missing_left")] += 1
        elif k not in rc:
            expected[(k, "missing_right")] += 1
        elif lc[k] > 1 or rc[k] > 1:
            expected[(k, "duplicate")] += 1
        else:
            expected[(k, "match" if lv[k] == rv[k] else "mismatch")] += 1
    assert rec == expected


def test_assign_keys_matches_python_sort(spark):
    from sluice.operators.keys import assign_keys

    rnd = random.Random(5)
    rows = [(rnd.choice([None, *range(30)]), rnd.choice(["x", "y", None]), i) for i in range(700)]
    df = spark.createDataFrame(rows, "a INT, b STRING, id0 INT")
    got = assign_keys(df, ["a", "b", "id0"], key_name="id", start=10, num_partitions=7).collect()

    def sort_key(r):  # Spark ascending: NULLs first
        return tuple((v is not None, v) for v in r)

    expected = {row[2]: i + 10 for i, row in enumerate(sorted(rows, key=sort_key))}
    assert {r.id0: r.id for r in got} == expected
