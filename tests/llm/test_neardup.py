"""Near-duplicate classes against a brute-force comparison of all sets."""

import itertools
import random

import pytest

from sluice.llm import neardup
from sluice.llm.stars import components
from sluice.llm.wordhash import SPACES, Words, text_shingles


def shingle_set(text, k):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    return frozenset([tuple(words)]) if len(words) < k else frozenset(zip(*[words[i:] for i in range(k)]))


def brute(rows, k, percent):
    sets = {i: shingle_set(t, k) for i, t in rows}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(sets, 2):
        common = len(sets[a] & sets[b])
        if common and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i), root(i) == i) for i in sets}


def corpus(seed, n=160):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    texts = []
    for _ in range(n):
        kind = rng.random()
        if texts and kind < 0.25:
            texts.append(rng.choice(texts))
        elif texts and kind < 0.7:  # a near copy, of a copy perhaps
            words = rng.choice(texts).split()
            for _ in range(rng.randrange(1, 5)):
                if words:
                    words[rng.randrange(len(words))] = rng.choice(vocabulary)
            texts.append(" ".join(words))
        else:
            texts.append(" ".join(rng.choices(vocabulary, k=rng.choice([1, 2, 3, 20, 60, 120]))))
    return list(enumerate(texts))


@pytest.mark.parametrize("k,percent", [(3, 85), (5, 80)])
def test_matches_brute_force(spark, docs, k, percent):
    rows = corpus(k)
    got = neardup.near_duplicates(docs(rows), shingle=k, percent=percent).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in got} == brute(rows, k, percent)


def test_one_large_group_of_near_copies(spark, docs):
    rng = random.Random(3)
    base = [f"b{i}" for i in range(80)]
    rows = []
    for i in range(150):
        words = list(base)
        for _ in range(rng.randrange(0, 8)):
            words[rng.randrange(80)] = f"x{rng.randrange(500)}"
        rows.append((i, " ".join(words)))
    got = neardup.near_duplicates(docs(rows), shingle=3, percent=85).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in got} == brute(rows, 3, 85)


def test_edge_cases(spark, docs):
    long = " ".join(f"t{i}" for i in range(30_000))
    rows = [
        (1, None), (2, ""), (3, " \t\n "), (4, "one"), (5, "ONE"), (6, "one two"), (7, long), (8, long + " tail"),
        (9, "same row"), (9, "same row"), (None, "one"),
    ]
    df = docs(rows, extra=["n_shingles", "kept", "id", "component_id"])
    got = neardup.near_duplicates(df, shingle=3, percent=85).collect()
    assert len(got) == len(rows)
    by = {r["doc_id"]: r for r in got}
    assert [by[i]["n_shingles"] for i in (1, 2, 3, 4, 6)] == [0, 0, 0, 1, 1]
    assert all(by[i]["component_id"] == i and by[i]["kept"] for i in (1, 2, 3, 4, 6, 7, 9))
    assert by[5]["component_id"] == 4 and by[8]["component_id"] == 7 and not by[8]["kept"]
    assert by[None]["component_id"] is None and by[None]["kept"]


def test_texts_that_share_an_id(spark, docs):
    a, b, c = (" ".join(f"{x}{i}" for i in range(40)) for x in "abc")
    rows = [(5, a), (5, b), (2, a), (3, b), (9, c), (9, c + " tail"), (10, c), (7, "one"), (7, "two"), (7, None), (6, "two")]
    got = neardup.near_duplicates(docs(rows), shingle=3, percent=85).collect()
    assert len(got) == len(rows)
    component = {}
    for r in got:
        if r["n_shingles"]:
            component.setdefault(r["doc_id"], set()).add(r["component_id"])
    assert component == {5: {2}, 2: {2}, 3: {2}, 9: {9}, 10: {9}, 7: {6}, 6: {6}}


def test_empty_table(spark, docs):
    assert neardup.near_duplicates(docs([])).collect() == []


def test_bands_keep_the_miss_probability():
    for percent in (60, 80, 85, 95):
        rows, bands = neardup.bands_for(percent)
        assert (1 - (percent / 100) ** rows) ** bands <= neardup.MISS
        assert rows * bands <= neardup.MAX_HASHES


def test_shingle_hashes_are_distinct_and_stable():
    texts = [b"a b c d", b"A B C", None, b"", b"x", b"a  b\tc\x0bd"]
    sets = text_shingles(Words(texts, SPACES), 3)
    assert [len(s) for s in sets] == [2, 1, 0, 0, 1, 2]
    assert set(sets[1].tolist()) < set(sets[0].tolist())
    assert sets[0].tolist() == sets[5].tolist()


def test_components_of_long_chains_and_stars(spark, tmp_path):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 40)] + [(7, 7 + 200)]

    def save(df, name):
        df.write.mode("overwrite").parquet(f"{tmp_path}/{name}")
        return spark.read.parquet(f"{tmp_path}/{name}")

    got = dict(components(spark.createDataFrame(edges, "u long, v long"), save).collect())
    want = {i: 0 for i in range(1, 61)} | {100 + i: 100 for i in range(1, 40)} | {207: 0}
    assert got == want
    assert components(spark.createDataFrame([], "u long, v long"), save, "none").collect() == []
