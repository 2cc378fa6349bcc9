import random

import numpy as np

from courtstats.llm import byte_bpe
from courtstats.llm.queries import QUERIES
from courtstats.llm.token_counts import (
    INSIDE,
    longest_beginnings,
    prefix_counts,
    prefix_table,
    token_counts,
)
from tests.llm.oracle import mirrored

SF = "/root/testdata/sf0.001"
PATH = byte_bpe.vocabulary("byte_bpe_50k.json")
PARTS = list("aZ19 \n\t  '’!sretvmld.é漢字🙂٣²_  \x1c\x85​") + [
    "'s", "'re", "'ll", "  ", "<|endoftext|>", "<|endof", "'S", "'ve", " the", "tion", "ing", "\r\n",
]


def some_texts(n, seed=1):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(PARTS) for _ in range(rnd.randint(0, 25))) for _ in range(n)]


def library(texts):
    encoded = byte_bpe.library(PATH).encode_batch(texts, add_special_tokens=False)
    return [e.ids for e in encoded]


def packed(texts):
    raw = [t.encode() for t in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)])


def test_ids_are_those_of_the_library():
    for seed in range(20):
        texts = some_texts(40, seed)
        ids, counts = byte_bpe.ids_of(PATH, *packed(texts))
        assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == library(texts)


def test_every_prefix_has_the_count_of_the_library():
    for seed in range(12):
        texts = some_texts(25, seed)
        data, offsets = packed(texts)
        counts = prefix_counts(PATH, data, offsets)
        for text, begin in zip(texts, offsets):
            want = [len(x) for x in library([text[: i + 1] for i in range(len(text))])]
            ends = begin + np.cumsum([len(c.encode()) for c in text]).astype(int) - 1
            assert counts[ends].tolist() == want, text


def test_query_counts_as_the_library(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()
    got = QUERIES["op9_token_counts"](spark, SF).orderBy("doc_id").collect()
    want = [len(x) for x in library([r.text for r in rows])]
    assert [r.n_tokens for r in got] == want
    for r, row in zip(got, rows):
        assert (r.n_bytes, r.over_limit) == (len(row.text.encode()), r.n_tokens > 512)
        text = row.text.encode()[: r.fit_bytes].decode()
        assert len(library([text])[0]) <= 512
        assert r.over_limit == (r.fit_bytes < r.n_bytes)


def test_edges(spark):
    texts = [None, "", " ", "a" * 3000, "é" * 2000, "  \n " * 500, "x<|endoftext|>y", "same", "same", "'re"]
    texts += mirrored()
    docs = spark.createDataFrame([(None if i == 4 else i // 2, t, 5) for i, t in enumerate(texts)],
                                 "doc_id long, text string, n_tokens int")
    got = sorted((r.n_bytes, r.n_tokens) for r in token_counts(docs).collect())
    want = sorted((len((t or "").encode()), len(x)) for t, x in zip(texts, library([t or "" for t in texts])))
    assert got == want
    assert token_counts(docs.limit(0)).count() == 0


def test_longest_beginning_within_a_budget(spark):
    """One stored table answers every budget and the count of every beginning."""
    texts = ["it's  raining 漢字 tion 12345 " * 3, None, "", "é🙂" * 9, "x<|endoftext|>y the end", "  \n  "]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    table = prefix_table(docs)
    for r in table.collect():
        text, steps = texts[r.doc_id] or "", np.frombuffer(r.steps, "<i2")
        ends = np.flatnonzero(steps != INSIDE)
        counts = np.cumsum(steps[ends], dtype=np.int64)
        assert counts.tolist() == [len(x) for x in library([text[: i + 1] for i in range(len(text))])]
        assert (ends + 1).tolist() == [len(text[: i + 1].encode()) for i in range(len(text))]
    stored = table.cache()
    for limit in range(0, 40, 7):
        for r in longest_beginnings(stored, limit).collect():
            text = texts[r.doc_id] or ""
            best = max(len(text[:i].encode()) for i in range(len(text) + 1) if len(library([text[:i]])[0]) <= limit)
            assert r.fit_bytes == best
    stored.unpersist()
