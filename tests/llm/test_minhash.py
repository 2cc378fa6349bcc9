import re
from collections import defaultdict

import pytest

from courtstats.llm.minhash import near_duplicates
from courtstats.llm.queries import QUERIES
from tests.llm.oracle import mirrored

SF = "/root/testdata/sf0.001"


def shingles(text, size):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))
    if not words:
        return set()
    if len(words) < size:
        return {tuple(words)}
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def brute(rows, size, percent=80):
    """(n_shingles, component_id) of each row, by looking at all pairs that share."""
    sets = [shingles(t, size) for _, t in rows]
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    where = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            where[x].append(i)
    pairs = {(a, b) for v in where.values() for a in v for b in v if a < b}
    for a, b in pairs:
        both = len(sets[a] & sets[b])
        if 100 * both >= percent * len(sets[a] | sets[b]):
            up[root(a)] = root(b)
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[root(i)] = min(d, low.get(root(i), d))
    return [(len(sets[i]), low.get(root(i)) if sets[i] else d) for i, (d, _) in enumerate(rows)]


def test_query_matches_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = {r.doc_id: r for r in QUERIES["op4_minhash_near_dedup"](spark, SF).collect()}
    for (doc, _), (n, component) in zip(rows, brute(rows, 4)):
        assert (got[doc].n_shingles, got[doc].component_id) == (n, component)
        assert got[doc].kept == (component == doc)


def test_edges(spark):
    base = " ".join(f"w{i}" for i in range(60))
    near = base.replace("w59", "x59")
    chain = near.replace("w0 ", "x0 ")
    rows = [
        (5, base), (7, near), (3, chain), (9, None), (10, ""), (11, " \n\t"),
        (12, "One two"), (13, "one  TWO"), (14, "One"), (5, base), (None, near),
        (None, None), (20, "É é"), (21, "é é"), (22, "w " * 30_000),
    ]
    # Words and shingles that a hash modulo a power of two takes for equal.
    rows += [(30 + i, w) for i, w in enumerate(mirrored())]
    rows += [(40 + i, f"{w} x {w} y {w} z") for i, w in enumerate(mirrored())]
    docs = spark.createDataFrame(
        [(d, t, 1, "z") for d, t in rows],
        "doc_id long, text string, n_shingles long, label string",
    )
    got = near_duplicates(docs, 5)
    want = [(d, n, c) for (d, _), (n, c) in zip(rows, brute(rows, 5))]
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted([(r.doc_id, r.n_shingles, r.component_id) for r in got.collect()], key=key) == sorted(want, key=key)
    kept = {r.doc_id for r in got.where("kept").collect()}
    assert kept == {3, 9, 10, 11, 12, 14, 20, 21, 22, 30, 31, 40, 41, None}
    assert near_duplicates(docs.limit(0)).count() == 0


@pytest.mark.parametrize("extra", [0, 30])
def test_members_linked_only_through_others(spark, extra):
    """Copies that are too unlike each other still meet over their source."""
    words = [f"v{i}" for i in range(200)]
    rows = [(100, " ".join(words))]
    for k in range(8 + extra):
        own = list(words)
        own[10 + 4 * k] = f"u{k}"
        own[11 + 4 * k : 14 + 4 * k] = [f"u{k}"] * 3
        rows.append((k, " ".join(own)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in near_duplicates(docs).collect()}
    assert got == {d: c for (d, _), (_, c) in zip(rows, brute(rows, 5))}
