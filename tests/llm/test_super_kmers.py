import random
import re
from hashlib import sha256

import numpy as np
import pytest

from courtstats.llm import arrays, super_kmers
from courtstats.llm.queries import QUERIES
from courtstats.llm.super_kmers import earlier_windows, smallest_documents

SCHEMA = "doc_id long, text string, bucket string, n_words int"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, window=13):
    texts = [(d, WORD.findall(t or "")) for d, t in rows]
    first = {}
    for doc, words in texts:
        for i in range(len(words) - window + 1) if doc is not None else ():
            key = tuple(words[i : i + window])
            first[key] = min(first.get(key, doc), doc)
    out = []
    for doc, words in texts:
        gone = [False] * len(words)
        for i in range(len(words) - window + 1) if doc is not None else ():
            if first[tuple(words[i : i + window])] < doc:
                gone[i : i + window] = [True] * window
        kept = " ".join(w for w, g in zip(words, gone) if not g)
        out.append((doc, len(words), sum(gone), sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def result(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_matches_brute_force(spark, sf):
    folder = f"/root/testdata/{sf}"
    rows = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    got = result(QUERIES["op12_super_kmer_dedup"](spark, folder))
    assert got == brute(rows)
    assert 0 < sum(r[2] for r in got) < sum(r[1] for r in got)


def odd_rows():
    rnd = random.Random(4)
    fresh = lambda n: " ".join(f"w{rnd.randrange(10**6)}" for _ in range(n))
    base, few = fresh(60), fresh(12)
    rows = [(None, base), (None, base + " more"), (3, None), (4, ""), (5, " \t\n"), (6, few), (7, few)]
    rows += [(10, base), (9, "x " + base.replace(" ", "\n\t")), (9, base), (12, base.upper()), (13, base), (13, base)]
    rows += [(20, "a " * 500), (21, "a " * 13), (22, "a " * 12), (23, "b a " * 40), (24, "a b " * 40)]
    rows += [(30, fresh(200_000)), (31, fresh(30) + " é ü\x00 " + base)]
    rows.append((32, " ".join(rows[-2][1].split()[150_000:150_090])))
    # One common run in many contexts: one bucket with many different super-k-mers.
    run = fresh(11)
    rows += [(100 + i, f"{fresh(20)} {run} {rnd.choice('pqrs')} {rnd.choice('tuvw')} {fresh(20)}") for i in range(200)]
    rows += [(400 + i, base) for i in range(50)]
    return rows


@pytest.mark.parametrize("hot", [None, 300])
def test_odd_rows(spark, monkeypatch, hot):
    if hot:
        monkeypatch.setattr(super_kmers, "HOT_BYTES", hot)
        monkeypatch.setattr(super_kmers, "PART_BYTES", 200)
        monkeypatch.setattr(arrays, "BATCH_BYTES", 500)
    rows = odd_rows()
    docs = spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA)
    assert result(earlier_windows(docs)) == brute(rows)
    assert earlier_windows(docs.limit(0)).count() == 0


def test_smallest_documents_are_exact():
    rnd = random.Random(1)
    packed = [" ".join(rnd.choice("ab") for _ in range(rnd.randrange(5, 12))).encode() for _ in range(300)]
    docs = np.array([rnd.randrange(1000) for _ in packed])
    first = {}
    for p, d in zip(packed, docs):
        words = p.split()
        for i in range(len(words) - 4):
            first[tuple(words[i : i + 5])] = min(first.get(tuple(words[i : i + 5]), d), d)
    found, many = smallest_documents(packed, docs, 5)
    for p, got in zip(packed, np.split(found, np.cumsum(many)[:-1])):
        words = p.split()
        assert list(got) == [first[tuple(words[i : i + 5])] for i in range(len(words) - 4)]
