"""Quality rules: a threshold table compiled into one projection.

Each rule compares a part with a whole, in percent. All parts and wholes are column
expressions over the words and lines of a text; nothing leaves the engine and rows
do not move.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: White space between words: blank, tab, line feed, vertical tab, form feed, return.
SPACES = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
#: Frequent function words of the four languages (fixed values).
STOP_WORDS = (
    "the of and to in is that it for was with as on be by this are at from or "
    "le la les de des du et en un une que qui dans pour sur est pas par au avec "
    "der die das und den von zu mit sich auf für ist im dem nicht ein eine als "
    "el y los las del se por con no para es al lo como"
).split()


@dataclass(frozen=True)
class Rule:
    """``least <= 100 * part / whole <= most``; a bound of None is not checked.

    A whole of zero passes.
    """

    name: str
    part: str
    whole: str
    least: int | None = None
    most: int | None = None

    def passes(self) -> Column:
        part, whole = 100 * F.col(self.part), F.col(self.whole)
        checks = F.lit(True)
        if self.least is not None:
            checks &= part >= self.least * whole
        if self.most is not None:
            checks &= part <= self.most * whole
        return checks


RULES = (
    Rule("mean word length", "word_chars", "n_words", 200, 1500),
    Rule("symbols for words", "n_symbols", "n_words", None, 10),
    Rule("stop words", "n_stop_words", "n_words", 2, None),
    Rule("repeated lines", "n_dup_lines", "n_lines", None, 50),
)
LEAST_WORDS = 50
MOST_REPEATED = 50


def _without(text: Column, characters: str) -> Column:
    for c in characters:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def _facts(docs: DataFrame) -> DataFrame:
    """The numbers that rules use, for every row."""
    text = F.coalesce("text", F.lit(""))
    bare = F.btrim(text, F.lit(SPACES))
    cut = docs.select(
        "doc_id",
        text.alias("text"),
        F.when(bare == "", F.array().cast("array<string>"))
        .otherwise(F.split(bare, r"[\x20\x09-\x0D]+"))
        .alias("words"),
        F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "").alias("lines"),
    )
    # Three words in a row by hash; two of a text are taken as equal if the 64 bits are.
    triples = F.transform(
        F.arrays_zip(
            F.col("words").alias("a"),
            F.expr("slice(words, 2, greatest(size(words), 1))").alias("b"),
            F.expr("slice(words, 3, greatest(size(words), 1))").alias("c"),
        ),
        lambda t: F.xxhash64(t["a"], t["b"], t["c"]),
    )
    cut = cut.withColumn("n_words", F.size("words")).withColumn(
        "triples", F.slice(triples, F.lit(1), F.greatest(F.col("n_words") - 2, F.lit(0)))
    )
    pairs = F.transform("triples", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    cut = cut.withColumn(
        "ordered",
        F.when(
            F.size(F.array_distinct("triples")) < F.size("triples"), F.sort_array(pairs)
        ).otherwise(F.array().cast("array<struct<h: bigint, i: int>>")),
    )
    again = F.filter(
        "ordered",
        lambda t, k: F.coalesce(F.get("ordered", k - 1)["h"] == t["h"], F.lit(False))
        | F.coalesce(F.get("ordered", k + 1)["h"] == t["h"], F.lit(False)),
    )
    starts = F.sort_array(F.transform(again, lambda t: t["i"]))
    repeated = F.aggregate(
        starts,
        F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last")),
        lambda a, i: F.struct(
            (a["n"] + F.least(F.lit(3), i - a["last"])).alias("n"), i.alias("last")
        ),
        lambda a: a["n"],
    )
    stop = F.filter("words", lambda w: F.lower(w).isin(STOP_WORDS))
    return cut.select(
        "doc_id",
        F.col("n_words").cast("bigint").alias("n_words"),
        F.char_length(_without(F.col("text"), SPACES)).cast("bigint").alias("word_chars"),
        (F.octet_length("text") - F.octet_length(_without(F.col("text"), SYMBOLS)))
        .cast("bigint")
        .alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        repeated.cast("bigint").alias("n_repeat_words"),
        F.size("lines").cast("bigint").alias("n_lines"),
        F.size(stop).cast("bigint").alias("n_stop_words"),
    )


def quality(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept``.

    A row fails the base with fewer than 50 words or more than half of them in
    windows of three words that come again in the text; it is kept if it passes the
    base and every rule. A null text has no words. Rows that repeat are judged each;
    an empty table gives no rows, texts are taken whole, however long, and other
    columns are not read.
    """
    failed = (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")
    )
    verdict = ~failed
    for rule in rules:
        verdict &= rule.passes()
    return _facts(docs).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        failed.alias("base_failed"),
        verdict.alias("kept"),
    )
