import re

from courtstats.llm.queries import ORACLES, QUERIES
from courtstats.llm.quality import STOP_WORDS, quality
from tests.llm.oracle import same_as_sql

SF = "/root/testdata/sf0.001"


def test_query_matches_sql(spark):
    name = "op6_quality_rules"
    same_as_sql(QUERIES[name](spark, SF), ORACLES[name], SF)


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    triples = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {i + k for i, t in enumerate(triples) if triples.count(t) > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n, symbols, again = len(words), len(re.findall(r"[#*$%&|<>]", text)), len(covered)
    failed = n < 50 or 100 * again > 50 * n
    chars, dup = sum(map(len, words)), len(lines) - len(set(lines))
    kept = not failed and 2 * n <= chars <= 15 * n and 10 * symbols <= n
    kept = kept and 50 * sum(w.lower() in STOP_WORDS for w in words) >= n and 2 * dup <= len(lines)
    return n, chars, symbols, dup, again, failed, kept


def test_edges(spark):
    good = " ".join(f"word{i} the" for i in range(40))
    texts = [
        None, "", " \n\t\x0b\f\r", "a", "a b", "a b c", "a b c a b c", "x x x x x", "é  ü\n\né  ü\n \né  ü",
        good, good + "\n" + good, good.replace("the", "zzz"), good + " # * $ % & | < >" * 3, good.upper(),
        "y" * 5000, "\u00a0 \u2003", "line one\n" * 40 + good, "🙂 " * 70, good + "\n" + "\n".join(["same line"] * 300),
    ]
    docs = spark.createDataFrame([(i, t, "w", 1) for i, t in enumerate(texts)],
                                 "doc_id long, text string, words string, n_words int")
    got = {r[0]: tuple(r)[1:] for r in quality(docs).collect()}
    assert got == {i: brute(t) for i, t in enumerate(texts)}
    assert quality(docs.union(docs)).count() == 2 * len(texts)
    assert quality(docs.limit(0)).count() == 0


def test_clean_and_junk(spark):
    """Labelled junk goes, labelled clean text that passes the base stays."""
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "quality")
    got = quality(spark.read.parquet(f"{sf}/documents.parquet")).join(labels, "doc_id")
    rows = got.select("quality", "base_failed", "kept").collect()
    assert not [r for r in rows if r.quality == 0 and r.kept]
    clean = [r.kept for r in rows if r.quality == 1 and not r.base_failed]
    assert sum(clean) >= 0.99 * len(clean)


def test_no_user_function(spark):
    plan = QUERIES["op6_quality_rules"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan
