"""Near duplicates by circulant MinHash.

One permutation scatters the shingles over a universe, a second gives values to
its places. Coordinate k of a signature reads the second permutation k places
further on, so all coordinates of a shingle are one slice of one table. Bands of
coordinates collect candidates; every link is confirmed on the full shingle sets.

Documents with equal shingle sets form one class and take part once. Shingles that
only one candidate class has, and counts of shingles in bins, bound what a pair can
share and rule out many classes and pairs for certain. In each bucket the class with the fewest shingles of its own
is compared with all others. Where classes of a bucket are still apart after that,
all their pairs that are not ruled out are compared, each in the first band they
share. What pairs are compared is never capped.

Bands decide by chance: a pair at the threshold shares no band with probability
(1 - 0.8^6)^40, about 5 in a million; more alike pairs less.
"""

from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh3_128_digest

from courtstats.llm.arrays import mix, pieces, shingle_hashes, word_hashes
from courtstats.llm.components import components
from courtstats.llm.tables import distinct_texts, text_key
from courtstats.sources.shared import stage

ROWS, BANDS = 6, 40
UNIVERSE = 1 << 22
#: Bins over which the shingles of a set are counted.
BINS = 128


@cache
def _table():
    """The second permutation, continued so that slices run round its end."""
    places = np.random.default_rng(4).permutation(UNIVERSE).astype(np.uint32)
    return np.lib.stride_tricks.sliding_window_view(
        np.concatenate([places, places[: ROWS * BANDS - 1]]), ROWS * BANDS
    )


def signature(shingles):
    """All coordinates of a set of shingle hashes."""
    at = (shingles >> np.uint64(64 - 22)).astype(np.int64)
    out = None
    for i in range(0, len(at), 1024):
        low = _table()[at[i : i + 1024]].min(axis=0)
        out = low if out is None else np.minimum(out, low)
    return out


def bands(values):
    """One number for each band of a signature."""
    parts = values.reshape(BANDS, ROWS).astype(np.uint64)
    out = np.arange(1, BANDS + 1, dtype=np.uint64)
    for j in range(ROWS):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + parts[:, j])
    return out.view(np.int64)


def _sets(column, size):
    """The sorted distinct shingles of each row."""
    for begin, end, data, offsets in pieces(column):
        hashes, have = shingle_hashes(*word_hashes(data, offsets), size)
        for own in np.split(hashes, np.cumsum(have)[:-1]) if end > begin else []:
            yield np.unique(own)


def _signed(size):
    def run(batches):
        for batch in batches:
            keys, counts, banded, spread = [], [], [], []
            for own in _sets(batch.column(1), size):
                counts.append(len(own))
                keys.append(xxh3_128_digest(own.tobytes()) if len(own) else None)
                banded.append(bands(signature(own)) if len(own) else None)
                bins = (own & np.uint64(BINS - 1)).astype(np.int64)
                spread.append(np.bincount(bins, minlength=BINS) if len(own) else None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(2),
                    pa.array(keys, pa.binary()),
                    pa.array(counts, pa.int64()),
                    pa.array(banded, pa.list_(pa.int64())),
                    pa.array(spread, pa.list_(pa.int32())),
                ],
                ["doc_id", "text_key", "class_key", "n_shingles", "bands", "spread"],
            )

    return run


def _confirmed(size, percent):
    def run(batches):
        last, kept = None, None
        for batch in batches:
            others = _sets(batch.column(3), size)
            found = []
            for i, own in enumerate(others):
                if batch.column(0)[i].as_py() != last:
                    last = batch.column(0)[i].as_py()
                    kept = next(_sets(batch.column(2).slice(i, 1), size))
                both = len(np.intersect1d(own, kept, assume_unique=True))
                found.append(100 * both >= percent * (len(own) + len(kept) - both))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(found, pa.bool_())],
                ["a", "b", "linked"],
            )

    return run


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id, text_key, n_shingles, component_id, kept`` for every row of ``docs``.

    A document's set holds its distinct shingles of ``size`` words (A-Z in lower
    case); one of all its words if it has fewer. Two sets are linked if 100 times
    their common part is at least ``percent`` times their union. ``component_id``
    is the smallest doc_id reachable over links, ``kept`` marks rows with that
    doc_id. Null and empty texts have no set, are linked with nothing and kept.
    Every row counts as a document, rows that repeat a doc_id too; a null doc_id
    is kept only if no other doc_id is in its component.
    An empty table gives no rows, texts are taken whole, however long, and other
    columns are not read.
    """
    signed = stage(
        docs.select("doc_id", "text", text_key().alias("k")).mapInArrow(
            _signed(size),
            "doc_id bigint, text_key binary, class_key binary, n_shingles bigint,"
            " bands array<bigint>, spread array<int>",
        ),
        "signed",
    )
    classes = stage(
        signed.where("class_key is not null")
        .groupBy("class_key")
        .agg(
            F.min("doc_id").alias("least"),
            F.min("text_key").alias("text_key"),
            F.first("n_shingles").alias("n"),
            F.first("bands").alias("bands"),
            F.first("spread").alias("spread"),
        )
        .select(F.monotonically_increasing_id().alias("node"), "*"),
        "classes",
    )
    members = classes.select("node", "n", "bands", F.posexplode("bands").alias("slot", "band"))
    shared = (
        members.groupBy("band")
        .agg(F.min("node").alias("low"), F.max("node").alias("high"))
        .where("low < high")
        .select("band")
    )
    candidates = stage(
        members.select("band", "node").join(shared, "band").select("node").distinct(), "candidates"
    )
    texts = stage(
        distinct_texts(docs)
        .join(classes.join(candidates, "node", "left_semi").select("node", "text_key"), "text_key")
        .select("node", "text"),
        "texts",
    )
    able = _with_common(classes.join(candidates, "node", "left_semi"), texts, size, percent)
    able = stage(
        able.select("node", "n", "common", F.posexplode("bands").alias("slot", "band")),
        "members",
    )
    again = (
        able.groupBy("band")
        .agg(F.min("node").alias("low"), F.max("node").alias("high"))
        .where("low < high")
        .select("band")
    )
    buckets = stage(able.join(again, "band", "left_semi"), "buckets")
    labels = _linked(buckets, classes, texts, size, percent)
    found = classes.select("node", "class_key", "least").join(labels, "node", "left")
    found = found.withColumn("label", F.coalesce("label", "node"))
    lowest = found.groupBy("label").agg(F.min("least").alias("lowest"))
    placed = found.join(lowest, "label").select("class_key", "lowest")
    component = F.when(F.col("class_key").isNull(), F.col("doc_id")).otherwise(
        F.col("lowest")
    )
    return signed.drop("bands", "spread").join(placed, "class_key", "left").select(
        "doc_id",
        "text_key",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, component.isNull()).alias("kept"),
    )


def _linked(buckets, classes, texts, size, percent):
    """Labels of the nodes that have links."""
    possible = (
        f"{percent} * greatest(n, m) <= 100 * least(n, m)"
        f" and (100 + {percent}) * least(common, c) >= {percent} * (n + m)"
    )
    other = buckets.select(
        "band",
        F.col("node").alias("centre"),
        F.col("n").alias("m"),
        F.col("common").alias("c"),
    )
    cleanest = Window.partitionBy("band").orderBy((F.col("c") / F.col("m")).desc(), "centre")
    centres = other.withColumn("rank", F.row_number().over(cleanest)).where("rank = 1")
    pair = [F.least("centre", "node").alias("a"), F.greatest("centre", "node").alias("b")]
    pairs = (
        buckets.join(centres, "band")
        .where(f"centre <> node and {possible}")
        .select(*pair)
        .distinct()
    )
    judged = stage(_judge(pairs, texts, size, percent), "judged")
    labels = components(judged.where("linked"))
    placed = buckets.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    apart = (
        placed.groupBy("band")
        .agg(F.min("label").alias("low"), F.max("label").alias("high"))
        .where("low < high")
    )
    open_ = placed.join(apart.select("band"), "band", "left_semi")
    open_ = stage(open_.join(classes.select("node", "bands", "spread"), "node"), "open")
    other = open_.select(
        F.col("band").alias("same_band"),
        F.col("node").alias("centre"),
        F.col("label").alias("own"),
        F.col("n").alias("m"),
        F.col("common").alias("c"),
        F.col("bands").alias("others"),
        F.col("spread").alias("spreads"),
    )
    # A pair that shares several bands is taken in the first of them. What two sets
    # share in a bin is at most the smaller count there.
    first = "array_position(zip_with(bands, others, (x, y) -> x = y), true) = slot + 1"
    common = "aggregate(zip_with(spread, spreads, (x, y) -> least(x, y)), 0, (s, x) -> s + x)"
    enough = f"(100 + {percent}) * {common} >= {percent} * (n + m)"
    same_band = F.col("band") == F.col("same_band")
    apart = F.expr(f"centre < node and own <> label and {possible} and {first} and {enough}")
    rest = (
        open_.join(other, same_band & apart)
        .select(*pair)
        .join(judged.select("a", "b"), ["a", "b"], "left_anti")
    )
    more = stage(_judge(rest, texts, size, percent), "judged").where("linked")
    if more.isEmpty():
        return labels
    return components(judged.where("linked").unionByName(more))


def _with_common(members, texts, size, percent):
    """Add ``common``, the shingles of a class that any other candidate has.

    A class of which too many are its own cannot be linked with anything; it leaves
    the buckets. For the others ``common`` bounds what a pair can share.
    """

    def listed(batches):
        for batch in batches:
            sets = [own.view(np.int64) for own in _sets(batch.column(1), size)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sets, pa.list_(pa.int64()))], ["node", "shingles"]
            )

    own = (
        texts.mapInArrow(listed, "node bigint, shingles array<bigint>")
        .select("node", F.explode("shingles").alias("shingle"))
        .groupBy("shingle")
        .agg(F.min("node").alias("node"), F.max("node").alias("other"))
        .where("node = other")
        .groupBy("node")
        .agg(F.count("*").alias("alone"))
    )
    return (
        members.join(own, "node", "left")
        .withColumn("common", F.col("n") - F.coalesce("alone", F.lit(0)))
        .where(f"100 * common >= {percent} * n")
        .drop("alone")
    )


def _judge(pairs, texts, size, percent):
    others = pairs.join(texts.select(F.col("node").alias("b"), F.col("text").alias("tb")), "b")
    return (
        others.join(
            texts.select(F.col("node").alias("a"), F.col("text").alias("ta")), "a"
        )
        .select("a", "b", "ta", "tb")
        .mapInArrow(_confirmed(size, percent), "a bigint, b bigint, linked boolean")
    )
