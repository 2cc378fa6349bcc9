"""The corpus pipeline: documents to packed training sequences in five stages.

Every stage takes the rows its predecessor kept and, but for the last, returns the
columns of the documents. ``doc_id`` need not be unique or present: rows are judged
by their texts.
"""

from pyspark.sql import functions as F

from courtstats.llm.decontaminate import without_contamination
from courtstats.llm.minhash import near_duplicates
from courtstats.llm.packing import pack
from courtstats.llm.suffix_dedup import without_repeats
from courtstats.llm.tables import table, with_key
from courtstats.llm.toxicity import without_toxic
from courtstats.sources.shared import forget, stage_result

#: The stages learn a model, search for copies and cut tokens, which SQL cannot express.
ORACLE_SQL = None

#: Passages of over 50 words that repeat are cut.
WORDS = 51


def toxicity(spark, docs, sf_dir):
    """Documents with a toxicity score of 0.5 or more go."""
    return without_toxic(docs, table(spark, sf_dir, "labels", "doc_id", "toxic"))


def near_dedup(spark, docs, sf_dir):
    """One document of each group of near duplicates stays, that of the smallest doc_id.

    Rows that repeat both doc_id and text count as one document.
    """
    kept = near_duplicates(docs).where("kept").select(F.col("doc_id").alias("kept_id"), "text_key")
    number = f"c{docs.columns.index('doc_id')}"
    rows = with_key(docs)
    same = (rows["text_key"] == kept["text_key"]) & rows[number].eqNullSafe(kept["kept_id"])
    return (
        rows.join(kept, same, "left_semi")
        .dropDuplicates([number, "text_key"])
        .drop("text_key")
        .toDF(*docs.columns)
    )


def suffix_dedup(spark, docs, sf_dir):
    """Strings of 400 bytes, and runs of 51 words of any length in bytes, that stand in
    several places are cut out; all rows stay."""
    return without_repeats(docs, words=WORDS)


def decontamination(spark, docs, sf_dir):
    """Documents that overlap a benchmark item go."""
    return without_contamination(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))


def packing(spark, docs, sf_dir):
    """Sequences of 1024 tokens: one row for each piece of a document."""
    return pack(docs)


STAGES = [
    ("toxicity", toxicity),
    ("minhash near-dedup", near_dedup),
    ("suffix-array dedup", suffix_dedup),
    ("benchmark decontamination", decontamination),
    ("packing", packing),
]


def run(spark, sf_dir):
    """All stages over the documents, each written and read again.

    What a stage wrote on its way, and the rows of the stage before, are deleted when
    its own rows are written.
    """
    docs, path = table(spark, sf_dir, "documents"), None
    for name, function in STAGES:
        made, own = stage_result(
            spark, lambda: function(spark, docs, sf_dir), name.replace(" ", "-")
        )
        if path:
            forget(spark, path)
        docs, path = made, own
    return docs
