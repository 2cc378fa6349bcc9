import random
from collections import defaultdict
from hashlib import sha256
from math import floor, isfinite

import numpy as np
import pytest
from pyspark.errors import PySparkException

from courtstats.llm import vector_codes as codes
from courtstats.llm.queries import ORACLES, QUERIES
from courtstats.llm.vector_codes import nearest, vector_codes
from tests.llm.oracle import same_as_sql

SCHEMA = "vec_id long, embedding array<float>, label int, code string, vector int, part int"


def brute(rows):
    kept = [r for r in rows if r[1] is not None and all(x is not None and isfinite(x) for x in r[1])]
    if not kept:
        return []
    vectors = [[floor(1024 * x) for x in r[1]] for r in kept]
    width = len(vectors[0]) // 4
    part = lambda v, k: v[k * width : (k + 1) * width]
    order = sorted(range(len(kept)), key=lambda i: (kept[i][0] is None, kept[i][0] or 0, vectors[i]))[:256]
    books = [[part(vectors[i], k) for i in order] for k in range(4)]

    def assign(v, book):
        return min((sum((a - b) ** 2 for a, b in zip(v, e)), i) for i, e in enumerate(book))

    for _ in range(4):
        for k, book in enumerate(books):
            own = defaultdict(list)
            for v in vectors:
                own[assign(part(v, k), book)[1]].append(part(v, k))
            for i, held in own.items():
                book[i] = [sum(c) // len(held) for c in zip(*held)]
    digest = sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    found = [[assign(part(v, k), books[k]) for k in range(4)] for v in vectors]
    totals = defaultdict(int)
    for r, f in zip(kept, found):
        totals[r[2]] += sum(d for d, _ in f)
    return sorted(
        (
            (r[0], "".join(f"{i:02x}" for _, i in f), sum(d for d, _ in f), totals[r[2]], digest)
            for r, f in zip(kept, found)
        ),
        key=str,
    )


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_matches_sql(spark, sf):
    name, folder = "op13_vector_codes", f"/root/testdata/{sf}"
    same_as_sql(QUERIES[name](spark, folder), ORACLES[name], folder)


def result(spark, rows):
    df = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA)
    return sorted(map(tuple, vector_codes(df).collect()), key=str)


@pytest.mark.parametrize("block", [2048, 3])
def test_odd_rows(spark, monkeypatch, block):
    monkeypatch.setattr(codes, "BLOCK", block)
    rnd = random.Random(2)
    short = lambda: float(np.float32(rnd.choice([rnd.gauss(0, 0.3), 0.0, -0.001, 0.5])))
    rows = [(i * 2, [short() for _ in range(8)], rnd.choice([None, 1, 1, 2])) for i in range(330)]
    bad = [None, [None] * 8, [float("nan")] + [0.0] * 7, [float("inf")] * 8, [-float("inf")] + [1.0] * 7]
    rows += [(i, v, 1) for i, v in enumerate(bad)]
    rows += [rows[0], rows[0], (None, rows[4][1], 5), (3, rows[9][1], None), (0, rows[8][1], 2)]
    rows += [(1000 + i, rows[1][1], 7) for i in range(200)]
    rnd.shuffle(rows)
    assert result(spark, rows) == brute(rows)


def test_few_and_none(spark):
    rows = [(5, [0.25, -0.25, 1.0, 2.0], None), (6, [-0.0001, 0.0, 0.0, 9.0], None), (7, None, 1)]
    assert result(spark, rows) == brute(rows)
    assert result(spark, rows[2:]) == [] and result(spark, []) == []
    assert result(spark, [(1, [], 1), (2, [], 1)]) == brute([(1, [], 1), (2, [], 1)])


def test_large_and_uneven_vectors_raise(spark):
    for odd in ([20_000.0, 0, 0, 0], [0.0] * 8):
        with pytest.raises((ValueError, PySparkException)):
            result(spark, [(1, [0.0] * 4, 1), (2, [float(x) for x in odd], 1)])
    with pytest.raises(ValueError):
        result(spark, [(1, [0.0] * 6, 1)])


@pytest.mark.parametrize("scale", [3, 1 << 23])
def test_trie_gives_exact_distances(monkeypatch, scale):
    monkeypatch.setattr(codes, "BLOCK", 7)
    rng = np.random.default_rng(1)
    parts = np.unique(rng.integers(-scale, scale, (500, 4)) // max(scale // 3, 1), axis=0) * max(scale // 3, 1)
    book = rng.integers(-scale, scale, (40, 4))
    book[11] = book[3]
    want = ((parts[:, None, :].astype(object) - book[None]) ** 2).sum(axis=2)
    index, distance = nearest(parts, book)
    assert list(distance) == list(want.min(axis=1))
    assert list(index) == [list(row).index(min(row)) for row in want]
