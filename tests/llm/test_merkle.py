import random
import zlib
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from courtstats.llm import merkle
from courtstats.llm.merkle import verified_manifest
from courtstats.llm.queries import ORACLES, QUERIES
from courtstats.sources.shared import stage
from tests.llm.oracle import same_as_sql

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, grp int, path string"


def h(text):
    return sha256(text.encode()).hexdigest()


def leaf(values):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def climb(nodes, arity):
    """The root of some nodes, and for each the siblings of every step up."""
    paths = [[] for _ in nodes]
    under = [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        runs = [range(i, min(i + arity, len(nodes))) for i in range(0, len(nodes), arity)]
        for run in runs:
            for i in run:
                before, after = ("".join(nodes[j] for j in run if c(j)) for c in (i.__gt__, i.__lt__))
                for below in under[i]:
                    paths[below].append((before, after))
        under = [[b for i in run for b in under[i]] for run in runs]
        nodes = [h("".join(nodes[i] for i in run)) for run in runs]
    return nodes[0], paths


def brute(rows, arity=16):
    first = lambda v, empty: (v is not None, empty if v is None else v)
    leaves = [(r, leaf(r[:5])) for r in rows]
    names = sorted({r[1] for r in rows}, key=lambda v: first(v, b"") if v is None else (True, v.encode()))
    trees, paths = [], []
    for name in names:
        own = sorted((x for x in leaves if x[0][1] == name), key=lambda x: (first(x[0][0], 0), x[1]))
        root, path = climb([d for _, d in own], arity)
        trees.append(root)
        paths.append([(r, d, p) for (r, d), p in zip(own, path)])
    root, above = climb(trees, arity)
    out = []
    for subroot, own, more in zip(trees, paths, above):
        for r, d, path in own:
            folded = d
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and r[4] is not None:
                text = "".join(c.lower() if "A" <= c <= "Z" else c for c in r[4])
                folded = leaf([*r[:4], text])
            for before, after in path + more:
                folded = h(before + folded + after)
            proof = h("".join(b + a for b, a in path + more))
            out.append((r[0], d, subroot, root, proof, folded, folded == root))
    return out


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("sf", [SF, "/root/testdata/sf0.01"])
def test_query_matches_sql(spark, sf):
    name = "op11_merkle_manifest"
    same_as_sql(QUERIES[name](spark, sf), ORACLES[name], sf)


def odd_rows():
    rnd = random.Random(3)
    rows = []
    for i in range(330):
        source = rnd.choice([None, "", "hot", "hot", "hot", "é", "z", "Z"])
        rows.append((i * 3, source, rnd.choice(["en", None]), rnd.choice([i, None]), f"Text ABC {i}", 1, "p"))
    rows += [(5, f"s{i}", None, None, None, None, None) for i in range(40)]
    rows += [(None, "hot", "en", 1, "No ID", 1, None), (None, "hot", "en", 2, "No ID", 1, None)]
    rows += [rows[0], rows[0], (0, rows[0][1], "x", 1, "other text", 1, None)]
    rows += [(7, "hot", "en", 1, "", 1, ""), (8, "hot", "en", 1, "LONG ü " * 30_000, 1, "")]
    return rows + [(100, "hot", "en", 1, "AGAIN", 1, "")] * 40


@pytest.mark.parametrize("arity", [16, 2])
def test_odd_rows(spark, arity):
    rows = odd_rows()
    docs = spark.createDataFrame(rows, SCHEMA)
    got = rows_of(verified_manifest(docs, arity))
    assert got == sorted(brute(rows, arity), key=str)
    assert {r[6] for r in got} == {True, False}


def test_one_row_and_no_rows(spark):
    rows = [(5, None, "en", None, "One Row", 1, "")]
    docs = spark.createDataFrame(rows, SCHEMA)
    assert rows_of(verified_manifest(docs)) == brute(rows)
    assert verified_manifest(docs.limit(0)).count() == 0


def test_hot_group_is_spread(spark, monkeypatch):
    """Ranges share the rows of one group, most with one doc_id, evenly."""
    stored = {}
    monkeypatch.setattr(merkle, "stage", lambda df, name: stored.setdefault(name, stage(df, name)))
    rows = spark.range(40_000).selectExpr(
        "if(id % 3 = 0, id, 7) as doc_id", "if(id % 10 < 9, 'hot', 'cold') as grp", "id as row"
    )
    ranked = merkle._ranked(stage(rows, "rows"), ["doc_id", "row"], "ordered")
    ranges = stored["ordered"].groupBy(F.shiftright("at", 33)).count().collect()
    assert len(ranges) >= 8 and max(r["count"] for r in ranges) < 2 * 40_000 / 8
    got = ranked.groupBy("grp").agg(F.count_distinct("lo"), F.min("lo"), F.max("hi"), F.max("n"))
    assert sorted(map(tuple, got.collect())) == [("cold", 4000, 0, 4000, 4000), ("hot", 36000, 0, 36000, 36000)]
