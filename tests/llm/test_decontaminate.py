import random
import re

import numpy as np

from courtstats.llm.decontaminate import contamination, without_contamination
from courtstats.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))


def overlap(text, item):
    """Item words inside windows of twelve with ten equal, by trying all places."""
    a, b = words(text), words(item)
    n = min(12, len(b))
    if not b or len(a) < n:
        return 0
    need = 10 if n == 12 else n - 1 if n >= 8 else n
    number = {w: i for i, w in enumerate({*a, *b})}
    a, b = (np.array([number[w] for w in x]) for x in (a, b))
    covered = set()
    for i in range(len(b) - n + 1):
        same = sum((a[k : len(a) - n + 1 + k] == b[i + k]).astype(int) for k in range(n))
        if same.max() >= need:
            covered |= set(range(i, i + n))
    return len(covered)


def test_query_matches_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    items = spark.read.parquet(f"{SF}/benchmark.parquet").collect()
    got = {r.doc_id: r for r in QUERIES["op8_benchmark_decontamination"](spark, SF).collect()}
    assert len(got) == len(docs)
    for d in docs:
        found = [(overlap(d.text, i.text), -i.item_id) for i in items]
        n = sum(f[0] > 0 for f in found)
        assert (got[d.doc_id].contaminated, got[d.doc_id].n_items) == (n > 0, n)
        if n:
            assert (got[d.doc_id].covered_words, -got[d.doc_id].item_id) == max(found)


def changed(item, at):
    own = words(item)
    for i in at:
        own[i] = f"other{i}"
    return " ".join(own)


def test_substitutions_and_edges(spark):
    rnd = random.Random(3)
    some = lambda n: " ".join(f"q{rnd.randrange(900)}" for _ in range(n))
    items = [some(30), some(12), some(9), some(5), None, "", some(8), some(11), some(1)]
    texts = [None, "", " ", items[0], items[3], items[2].upper(), changed(items[2], [4])]
    texts += [f"{some(3)} {changed(items[k], [at])} {some(2)}" for k in (2, 6, 7) for at in (0, 3, 7)]
    texts += [changed(items[k], at) for k in (2, 6, 7) for at in ([0, 1], [2, 5])]
    texts += [changed(items[3], [2]), f"x {items[8]} y", some(4) + " " + items[3]]
    for a in range(12):
        for b in range(a, 12, 3):
            texts.append(f"{some(5)} {changed(items[1], [a, b])} {some(3)}")
    texts += [changed(items[1], [1, 5, 9]), changed(items[0], range(0, 30, 4)), some(3000) + items[1], items[0], items[0]]
    texts += [" ".join(words(items[0])[3:14]), " ".join(words(items[0])[3:15])]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, item_id string")
    bench = spark.createDataFrame([(i, t, 0) for i, t in [*enumerate(items), (77, items[0]), (None, items[1])]],
                                  "item_id long, text string, covered int")
    got = {r.doc_id: r for r in contamination(docs, bench).collect()}
    for i, t in enumerate(texts):
        found = [overlap(t, item) for item in items]
        assert got[i].n_items == sum(f > 0 for f in found), (i, t)
        assert got[i].covered_words == max(found)
    clean = without_contamination(docs, bench)
    assert clean.columns == docs.columns
    assert {r.doc_id for r in clean.collect()} == {i for i in got if not got[i].contaminated}
    assert contamination(docs.limit(0), bench).count() == 0
    assert contamination(docs, bench.limit(0)).where("contaminated").count() == 0
