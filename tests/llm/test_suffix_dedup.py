import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from courtstats.llm import suffix_dedup
from courtstats.llm.queries import QUERIES
from courtstats.llm.suffix_dedup import repeat_report, without_repeats

SF = "/root/testdata/sf0.001"


def brute(texts, length):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(b[i : i + length] for b in raw for i in range(len(b) - length + 1))
    out = []
    for b in raw:
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                gone[i : i + length] = True
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        out.append((len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def repeating(rows, length=400, words=51):
    """Whether bytes go or a run of words stands in another document, by counting all."""
    runs, found = defaultdict(set), []
    for doc, text in rows:
        own = words_of(text)
        for i in range(len(own) - words + 1) if doc is not None else ():
            runs[tuple(own[i : i + words])].add(doc)
    for (doc, text), (_, removed, _, _) in zip(rows, brute([t for _, t in rows], length)):
        own = words_of(text)
        shared = any(len(runs[tuple(own[i : i + words])]) > 1 for i in range(len(own) - words + 1))
        found.append(removed > 0 or (doc is not None and shared))
    return found


def values(rows):
    return [(r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows]


def test_query_matches_brute_force(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()
    got = QUERIES["op1_suffix_array_dedup"](spark, SF).orderBy("doc_id").collect()
    assert values(got) == brute([r.text for r in rows], 400)
    want = repeating([(r.doc_id, r.text) for r in rows])
    assert [r.repeats for r in got] == want and 0 < sum(want) < len(want)


def test_short_passages_are_told(spark):
    rnd = random.Random(8)
    fresh = lambda n: " ".join(f"w{rnd.randrange(10**6)}" for _ in range(n))
    some = " ".join(rnd.choice(["of", "the", "a", "it"]) + str(i) for i in range(51))
    assert len(some) < 400
    rows = [
        (1, f"{fresh(20)} {some} {fresh(20)}"), (2, f"{some.replace(' ', chr(10))} {fresh(90)}"),
        (3, f"{fresh(20)} {some[:-4]} {fresh(20)}"), (4, fresh(80)), (5, f"{some} x {some}"), (None, some),
        (6, None), (7, ""), (8, " ".join(["ha"] * 60)), (9, " ".join(f"q{i}" for i in range(55))),
        (10, " ".join(f"q{i}" for i in range(55))), (11, " ".join(f"r{i}" for i in range(55))),
        (11, " ".join(f"r{i}" for i in range(55))), (12, " ".join(f"s{i}" for i in range(40))), (13, " ".join(f"s{i}" for i in range(40))),
    ]
    docs = spark.createDataFrame([(*r, "x", True) for r in rows], "doc_id long, text string, short_key string, repeats boolean")
    got = repeat_report(docs).collect()
    key = lambda r: tuple(map(str, r))
    want = zip(rows, brute([t for _, t in rows], 400), repeating(rows))
    assert sorted(map(tuple, got), key=key) == sorted(((r[0], *b, x) for r, b, x in want), key=key)
    assert {r.doc_id for r in got if r.repeats} == {1, 2, 5, 9, 10}


def edge_rows():
    rng = np.random.default_rng(1)
    base = "".join(rng.choice(list("abcdé "), 900))
    return [
        None, "", "x", base, base, base[:500] + "Q" + base[500:], "zz" + base[100:520],
        "a" * 2000, "ab" * 700, "ü" * 800, base[300:700], "\x00" * 450, "t" + "a" * 400,
        base[:399], "\U0001f600" * 101, "k" * 401, base[200:601] + base[200:601],
    ]


def test_edges(spark, monkeypatch):
    texts = edge_rows()
    docs = spark.createDataFrame(
        [(i // 2, t, "s") for i, t in enumerate(texts)], "doc_id long, text string, share string"
    )
    key = lambda r: tuple(map(str, r))
    want = sorted(((i // 2, *v) for i, v in enumerate(brute(texts, 400))), key=key)
    got = [tuple(r)[:5] for r in repeat_report(docs).collect()]
    assert sorted(got, key=key) == want
    monkeypatch.setattr(suffix_dedup, "HOT_BYTES", 600)
    monkeypatch.setattr(suffix_dedup, "PART_BYTES", 500)
    got = [tuple(r)[:5] for r in repeat_report(docs).collect()]
    assert sorted(got, key=key) == want
    assert repeat_report(docs.limit(0)).count() == 0


def test_text_keeps_whole_characters(spark):
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(edge_rows())], "doc_id long, text string, id int")
    out = without_repeats(docs)
    assert out.columns == docs.columns and out.count() == docs.count()
    got = {r.doc_id: r.text for r in out.collect()}
    assert got[0] is None and got[2] == "x" and got[3] == "" and got[9] == ""
    assert out.where(F.col("text").contains("�")).count() == 0
