import os
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from corpus_pipeline import STAGES
from courtstats.sources.shared import shared_folder
from tests.llm.test_decontaminate import overlap
from tests.llm.test_minhash import brute
from tests.llm.test_packing import check

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """What every stage returns on the smallest tables, written and read again."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, function in STAGES:
        path = str(tmp_path_factory.mktemp("stage") / "out")
        function(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append(docs)
    return out


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_each_stage_on_its_own_input(steps, spark):
    for df in steps[:-1]:
        assert df.columns == COLUMNS
    start = texts(spark.read.parquet(f"{SF}/documents.parquet"))
    calm, single, cut, clean = map(texts, steps[:4])
    assert 0.85 * len(start) < len(calm) < len(start)
    rows = sorted(calm.items())
    assert set(single) == {d for (d, _), (n, c) in zip(rows, brute(rows, 5)) if c == d}
    assert set(cut) == set(single)
    assert cut == dict(zip(single, without_repeated(list(single.values()))))
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    gone = set(cut) - set(clean)
    assert all(any(overlap(cut[d], i) for i in items) for d in gone)
    check(clean, steps[4].collect(), 1024)


def test_odd_rows(spark):
    rnd = random.Random(5)
    rows = [(i, " ".join(f"w{rnd.randrange(500)}" for _ in range(60)), "en", "s", 1) for i in range(30)]
    rows += [(None, None, None, None, None), (7, "", None, "s", 0), rows[3], (99, rows[4][1], "en", "t", 2), (None, rows[5][1], "x", "y", 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs = docs.withColumn("label", F.lit("extra")).withColumn("text_key", F.lit(1))
    out = docs.select("*")
    for name, function in STAGES[:-1]:
        out = function(spark, out, SF)
        assert out.columns == docs.columns
    ids = sorted((r.doc_id, r.text) for r in out.where("doc_id is not null").collect())
    assert ids == sorted([(r[0], r[1]) for r in rows[:30]] + [(7, "")])
    assert out.where("doc_id is null").count() == 1
    empty = docs.limit(0)
    for name, function in STAGES:
        empty = function(spark, empty, SF)
        assert empty.count() == 0


def test_short_passages_of_over_50_words_go(spark):
    rnd = random.Random(9)
    fresh = lambda n: [f"w{rnd.randrange(10**6)}" for _ in range(n)]
    rows, want = [], {}
    for k, n in enumerate([50, 51, 53, 57, 60, 51]):
        passage = ["a", *[rnd.choice(["of", "the", "house", "it"]) + str(k) for _ in range(n - 1)]]
        for copy in range(3):
            head, tail = fresh(30), fresh(30)
            # White space between the words does not matter; a longer place holds it too.
            held = ("\n" if copy == 1 else " ").join(passage)
            assert len(held) < 400
            more = ["", " ".join(fresh(60)), ""][copy]
            rows.append((len(rows), " ".join([*head, held, *tail, more]), "en", "s", 1))
            want[rows[-1][0]] = " ".join([*head, held if n == 50 else "", *tail, more])
    repeated = " ".join(["ha"] * 52)
    rows += [(100, "x " + repeated + " y", "en", "s", 1), (101, " ".join(fresh(51)), "en", "s", 1)]
    want |= {100: "x  y", 101: rows[-1][1]}
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert texts(corpus_pipeline.suffix_dedup(spark, docs, SF)) == want


def without_repeated(texts):
    """Texts without repeated strings of 400 bytes and runs of 51 words, by counting all."""
    raw = [t.encode() for t in texts]
    spans = [[m.span() for m in re.finditer(rb"[^ \t\n\v\f\r]+", b)] for b in raw]
    windows = [
        (i, s[k][0], s[k + 50][1], tuple(b[x:y] for x, y in s[k : k + 51]))
        for i, (b, s) in enumerate(zip(raw, spans))
        for k in range(len(s) - 50)
    ]
    windows += [(i, k, k + 400, b[k : k + 400]) for i, b in enumerate(raw) for k in range(len(b) - 399)]
    seen = Counter(w[3] for w in windows)
    gone = [bytearray(len(b)) for b in raw]
    for i, begin, end, held in windows:
        if seen[held] > 1:
            gone[i][begin:end] = b"\1" * (end - begin)
    out = []
    for text, g in zip(texts, gone):
        kept, at = "", 0
        for c in text:
            size = len(c.encode())
            kept += "" if all(g[at : at + size]) else c
            at += size
        out.append(kept)
    return out


def test_stage_matches_brute_force_of_bytes_and_words(spark):
    given = spark.read.parquet(f"{SF}/documents.parquet")
    rows = given.dropDuplicates(["text"]).where("text is not null").collect()
    got = texts(corpus_pipeline.suffix_dedup(spark, spark.createDataFrame(rows, given.schema), SF))
    assert got == dict(zip([r.doc_id for r in rows], without_repeated([r.text for r in rows])))


CLASHES = [
    "text_key", "_key", "_changed", "kept_text", "changed", "a.b", "c1", "score", "_id", "kept", "found",
    "component_id", "n_removed", "seeds", "row", "kept_id",
]


@pytest.mark.parametrize("stage", range(4))
def test_own_columns_keep_their_values(spark, stage):
    rnd = random.Random(6)
    text = lambda: " ".join(f"w{rnd.randrange(500)}" for _ in range(70))
    rows = [(i, text(), "en", "s", 1, *[f"{c} {i}" for c in CLASHES]) for i in range(12)]
    rows.append((50, rows[3][1], *rows[3][2:]))
    names = [*COLUMNS, *CLASHES]
    docs = spark.createDataFrame(rows, ["doc_id", "text", *[f"x{i}" for i in range(len(names) - 2)]]).toDF(*names)
    out = STAGES[stage][1](spark, docs, SF)
    assert out.columns == names
    given = {r[0]: r for r in rows}
    got = [tuple(r) for r in out.collect()]
    assert len(got) >= 12 and all(r[2:] == given[r[0]][2:] for r in got)


def test_run(spark):
    folder = shared_folder(spark).removeprefix("file:")
    before = set(os.listdir(folder))
    assert corpus_pipeline.run(spark, SF).count() > 0
    # Only the rows of the last stage stay.
    assert [n.rsplit("-", 1)[0] for n in set(os.listdir(folder)) - before] == ["packing"]
