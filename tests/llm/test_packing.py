from collections import defaultdict
from zlib import crc32

import numpy as np
from hypothesis import given
from hypothesis import strategies as st

from courtstats.llm import byte_bpe
from courtstats.llm.packing import pack, shortest_pack_first
from courtstats.llm.queries import QUERIES
from tests.llm.oracle import mirrored

SF = "/root/testdata/sf0.001"
PATH = byte_bpe.vocabulary("byte_bpe_50k.json")


def check(docs, rows, size):
    """Every id in one piece, sequences without gaps; returns the share of padding."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    for doc, text in docs.items():
        ids = byte_bpe.library(PATH).encode(text or "", add_special_tokens=False).ids + [0]
        at = 0
        for r in sorted(by_doc[doc], key=lambda r: r.start):
            own = np.array(ids[r.start : r.start + r.length], "<u4")
            assert (r.start, r.ids_crc32, r.doc_tokens) == (at, crc32(own.tobytes()), len(ids))
            at += r.length
        assert at == len(ids)
    used = padded = 0
    for own in by_sequence.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert 0 < at <= size
        used += at
        padded += at if at & (at - 1) == 0 else size
    return 1 - used / padded if padded else 0


def test_query(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").collect()
    got = QUERIES["op5_packing"](spark, SF).collect()
    assert check({r.doc_id: r.text for r in rows}, got, 1024) < 0.02


def test_edges(spark):
    texts = [None, "", "a b", " x" * 40, "same", "same", "word " * 5000, "y" * 90]
    docs = spark.createDataFrame([(i, t, 9) for i, t in enumerate(texts)], "doc_id long, text string, start int")
    check(dict(enumerate(texts)), pack(docs, 32).collect(), 32)
    check(dict(enumerate(mirrored())), pack(spark.createDataFrame(list(enumerate(mirrored())), "doc_id long, text string"), 32).collect(), 32)
    again = docs.selectExpr("cast(null as long) as doc_id", "text").union(docs.select("doc_id", "text"))
    assert pack(again, 32).count() == 2 * pack(docs, 32).count()
    assert pack(docs.limit(0)).count() == 0


@given(st.dictionaries(st.integers(1, 64), st.integers(1, 50)))
def test_patterns_hold_the_histogram(histogram):
    left = dict(histogram)
    for pattern, count in shortest_pack_first(histogram, 64):
        assert sum(pattern) <= 64
        for length in pattern:
            left[length] -= count
    assert not any(left.values())
