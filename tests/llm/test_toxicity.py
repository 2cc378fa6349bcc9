import random
import tracemalloc
import zlib

import numpy as np
import pytest

from courtstats.llm.queries import QUERIES
from courtstats.llm.toxicity import LETTERS, _codes, _disguised, _readings, decode, letter_model, score_texts, without_toxic

SF = "/root/testdata/sf0.01"
BAD = ["idiot", "pathetic", "moron", "worthless"]


def words(n, seed):
    rnd = random.Random(seed)
    return [rnd.choice(["the", "and", "ering", "tion", "house", "there", "seven", "often", "idea", "late"]) for _ in range(n)]


@pytest.fixture(scope="module")
def corpus(spark):
    rows = []
    for i in range(400):
        own = words(40, i)
        if i % 4 == 0:
            own[i % 40] = BAD[i // 4 % 4]
        rows.append((i, " ".join(own), int(i % 4 == 0)))
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2], 0) for r in rows], "doc_id long, toxic int, score int")
    return docs, labels


def brute_best(word, model):
    """The best path by trying all choices of signs, for short words."""
    from courtstats.llm.toxicity import DROPPED, SUBSTITUTED, _lattice

    best = (-np.inf, ())
    paths = [(0.0, ())]
    for letters, drop, double in _lattice(word):
        step = [(DROPPED, ())] if drop else []
        for x in letters:
            cost = SUBSTITUTED if drop else 0.0
            step.append((cost, (x,)))
            if double:
                step.append((cost, (x, x)))
        paths = [(a + c, p + q) for a, p in paths for c, q in step]
    for cost, path in paths:
        around = (0, *path, 0)
        total = cost + sum(model[a, b] for a, b in zip(around, around[1:]))
        best = max(best, (total, path))
    return list(best[1])


def test_viterbi_finds_the_best_path(corpus):
    model = letter_model(corpus[0])
    shown = ["1d10t", "m0r0n", "p.a.t.h.e.t.i.c", "idiooooot", "w0rthl3$$", "i d i o t", "a", "777", "@@@b", "é1é", "x+y"]
    codes = [np.array([ord(c) for c in w], np.uint32) for w in shown]
    found = decode(codes, model)
    for word, got in zip(codes, found):
        assert got == brute_best(word, model)
    text = ["".join(LETTERS[x - 1] for x in f) for f in found]
    assert text[0] == "idiot" and text[1] == "moron" and text[2] == "pathetic" and text[5] == "idiot"


def test_disguised_words_count(corpus, spark):
    docs, labels = corpus
    shown = ["m0r0n", "1d1ot", "i d i o t", "p.a.t.h.e.t.i.c", "W0RTHLE$$", "moooooron", "Idiot!!", "*moron*"]
    rows = [(1000 + i, " ".join([*words(20, i), w, *words(20, i + 50)])) for i, w in enumerate(shown)]
    rows += [(2000 + i, " ".join(words(40, 900 + i)) + tail) for i, tail in enumerate(["", " 2024 $5 a.b!", " 3rd +1 x-y"])]
    rows += [(3000, None), (3001, ""), (None, "idiot"), (1000, rows[0][1]), (3002, "z" * 40_000 + " 1a" * 9000)]
    more = spark.createDataFrame(rows, "doc_id long, text string")
    got = score_texts(docs.unionByName(more), labels).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == 400 + len(rows)
    assert all(by[1000 + i].predicted == 1 for i in range(len(shown)))
    assert all(by[d].predicted == 0 for d in (2000, 2001, 2002, 3000, 3001, 3002)) and by[None].predicted == 1
    assert all(0 <= r.score <= 1 for r in got)
    for i in range(400):
        assert by[i].predicted == (i % 4 == 0)
        assert by[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0)


def test_filter_and_empty_tables(corpus, spark):
    docs, labels = corpus
    wide = docs.selectExpr("*", "doc_id as score", "'x' as `row`")
    kept = without_toxic(wide, labels)
    assert kept.columns == wide.columns
    assert sorted(r.doc_id for r in kept.collect()) == [i for i in range(400) if i % 4]
    assert score_texts(docs.limit(0), labels).count() == 0
    assert score_texts(docs, labels.limit(0)).where("predicted = 1").count() == 0


def test_held_out_accuracy(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    got = QUERIES["op3_toxicity"](spark, SF).join(labels, "doc_id").where("held_out").collect()
    hit = [r.predicted == r.toxic for r in got]
    assert sum(hit) >= 0.93 * len(hit)
    toxic = [r.predicted for r in got if r.toxic]
    assert sum(toxic) >= 0.7 * len(toxic)


def test_long_tokens_need_little_memory(corpus):
    rnd = random.Random(3)
    model = letter_model(corpus[0])
    shown = ["m0r0n", "1d10t", "w0rthl3$$"] * 100
    for signs in ("abcdefghijklmnopqrstuvwxyz0123456789+", "0123456789"):
        long = "".join(rnd.choice(signs) for _ in range(30_000))
        codes = [np.array([ord(c) for c in w], np.uint32) for w in [*shown, long]]
        tracemalloc.start()
        found = decode(codes, model)
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < 50e6
        assert found[:3] == decode(codes[:3], model) and len(found[-1]) > 0


def restored(text, model):
    """The words that stand in the features of a text besides its plain ones."""
    data = np.frombuffer(text.encode(), np.uint8)
    codes, edges = _codes(data, np.array([0, len(data)]))
    found = _readings(codes, *_disguised(codes, edges), model)[0]
    return ["".join(map(chr, x)) for x in found]


def test_tokens_keep_their_plain_words_and_other_letters(corpus, spark):
    docs, labels = corpus
    model = letter_model(docs)
    assert "idiot" in restored("the idea.1d10t", model) and "idiot" in restored("seven,1d10t,there", model)
    assert restored("приветтт", model)[0] in ("привет", "приветт")
    assert any(x.startswith("今天天气") and x.endswith("很好") for x in restored("今天天气2024很好。你好", model))
    shown = ["idiot,you,are,sooo,dumb", "idiot...l00k", "the...1d10t...house", "house/1d10t/late", "今天。idiot。2024年很好", "worthless;th3re"]
    rows = [(1000 + i, " ".join([*words(20, i), w, *words(20, i + 50)])) for i, w in enumerate(shown)]
    more = spark.createDataFrame(rows, "doc_id long, text string")
    by = {r.doc_id: r.predicted for r in score_texts(docs.unionByName(more), labels).collect()}
    assert [by[r[0]] for r in rows] == [1] * len(rows)


def test_other_scripts_are_learnt(spark):
    rows = []
    for i in range(400):
        own = [["погода", "сегодня", "хорошая", "город"][(i * 7 + k * k) % 4] for k in range(20)]
        if i % 4 == 0:
            own[i % 20] = "дурак1" + "у" * 3 + "дурак"
        rows.append((i, " ".join(own), int(i % 4 == 0)))
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    got = score_texts(docs, labels).collect()
    assert all(r.predicted == (r.doc_id % 4 == 0) for r in got)


def test_signs_at_the_end_and_words_of_signs_count(corpus, spark):
    docs, labels = corpus
    more = ["dunno", "disgusting", "ass"]
    rows = [(500 + i, " ".join([*words(20, i), more[i % 3], *words(20, i + 70)])) for i in range(120)]
    seen = spark.createDataFrame([(d, 1, 0) for d, _ in rows], "doc_id long, toxic int, score int")
    shown = ["worthles5", "p4th3tic", "disgustin9", "disgustin6", "455", "@$5", "4.5.5", "a5$", "as5", "moron!!"]
    rows += [(1000 + i, " ".join([*words(20, i), w, *words(20, i + 50)])) for i, w in enumerate(shown)]
    # The last character of all texts, and of a text before one that begins with a letter.
    rows += [(1100, "seven often a5$"), (1101, "the house as5")]
    rows += [(2000 + i, " ".join(words(40, 900 + i)) + t) for i, t in enumerate([" the!!", " 3rd", " 7 8", " house! late!"])]
    all_docs = docs.unionByName(spark.createDataFrame(rows, "doc_id long, text string")).coalesce(1)
    by = {r.doc_id: r.predicted for r in score_texts(all_docs, labels.unionByName(seen)).collect()}
    assert [i for i, w in enumerate(shown) if not by[1000 + i]] == []
    assert by[1100] == by[1101] == 1
    assert [by[2000 + i] for i in range(4)] == [0] * 4


def test_last_sign_of_a_word(corpus):
    model = letter_model(corpus[0])
    pairs = {"idio7": "idiot", "idio+": "idiot", "worthles5": "worthless", "455": "ass", "disgustin9": "disgusting"}
    for word, meant in pairs.items():
        assert meant in restored(word, model) and meant in restored("the " + word + ", house", model)
    assert restored("the house - 7 ...", model) == [] and "house" in restored("house!", model)
