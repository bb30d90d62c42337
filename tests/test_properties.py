"""Property tests for the read planners (pure functions, no Spark)."""

import duckdb
from hypothesis import given, settings
from hypothesis import strategies as st

from sluice.config import derby_memory
from sluice.sources.jdbc import range_predicates

CFG = derby_memory("props")


@settings(max_examples=60, deadline=None)
@given(
    cuts=st.lists(st.integers(-1000, 1000), max_size=8, unique=True).map(sorted),
    values=st.lists(st.one_of(st.none(), st.integers(-2000, 2000)), min_size=1, max_size=60),
)
def test_range_predicates_are_disjoint_and_covering(cuts, values):
    preds = range_predicates(CFG, "k", cuts)
    con = duckdb.connect()
    con.execute('CREATE TABLE t ("k" INTEGER)')
    con.executemany("INSERT INTO t VALUES (?)", [(v,) for v in values])
    hits = " + ".join(f"CASE WHEN {p} THEN 1 ELSE 0 END" for p in preds)
    counts = [r[0] for r in con.execute(f"SELECT {hits} FROM t").fetchall()]
    assert counts == [1] * len(values)


@settings(max_examples=300, deadline=None)
@given(
    counts=st.lists(st.integers(0, 500), min_size=1, max_size=40),
    k=st.integers(1, 12),
)
def test_equal_depth_cuts_balance(counts, k):
    from sluice.sources.jdbc import equal_depth_cuts

    hist = list(enumerate(counts))  # values 0..n-1 ascending
    cuts = equal_depth_cuts(hist, k)
    assert cuts == sorted(set(cuts)) and len(cuts) <= k - 1
    assert all(c in dict(hist) and c != 0 for c in cuts)  # a cut never drops the first range
    edges = [0, *cuts, len(counts)]
    loads = [sum(counts[a:b]) for a, b in zip(edges, edges[1:])]
    assert sum(loads) == sum(counts)
    bound = sum(counts) / max(1, min(k, len(counts))) + max(counts)
    assert max(loads) <= bound


def test_equal_depth_cuts_edges():
    from sluice.sources.jdbc import equal_depth_cuts

    assert equal_depth_cuts([(0, 0), (1, 0)], 2) == []
    assert equal_depth_cuts([], 4) == []
    assert equal_depth_cuts([("a", 1), ("b", 100), ("c", 1), ("d", 1)], 3) == ["c", "d"]  # hot b closes its range
