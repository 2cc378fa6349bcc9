"""Benchmark decontamination by spaced-seed hashing.

A seed hashes six of twelve words in a row and ignores the others. The masks come
from four groups of every fourth place: two substitutions leave two groups whole,
and every pair of groups is one of three masks, shifted. So any twelve words of an
item that stand in a text with at most two replaced share a seed with it.

Texts are scanned once against a bit table of the item seeds, whose size has a
fixed bound however many items there are. The few hits that pass are joined with
the item seeds by hash, and each alignment found is verified word by word.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtstats.llm.arrays import mix, pieces, word_hashes
from courtstats.llm.tables import rows_without, text_key
from courtstats.sources.shared import stage

WINDOW, EQUAL = 12, 10
MASKS = ((0, 1, 4, 5, 8, 9), (0, 3, 4, 7, 8, 11), (0, 2, 4, 6, 8, 10))
#: Items of fewer words than a window may have one word replaced; with fewer words
#: than this they must stand in a text unchanged.
LEAST_FREE = 8
MOST_BITS = 28
PROBES = 3


def _seeds(words, counts, masks):
    """For each mask its lengths, and hash, row and place of every seed."""
    ends = np.cumsum(counts)
    row = np.repeat(np.arange(len(counts)), counts)
    place = np.arange(len(words)) - (ends - counts)[row]
    for mask, lengths in masks.items():
        last = max(mask)
        n = len(words) - last
        if n <= 0:
            continue
        total = np.full(n, hash(mask) & 0x7FFFFFFF, np.uint64)
        for j, at in enumerate(mask):
            total = (total ^ words[at : at + n]) * np.uint64(0x9E3779B97F4A7C15 + 2 * j)
        fits = np.flatnonzero(place[:n] + last < counts[row[:n]])
        yield lengths, (mix(total)[fits], row[fits], place[fits])


def _masks(lengths):
    """Masks and the lengths of the items that each is for; ``WINDOW`` is any from there on.

    Of a short item the words at even and at odd places are two masks, of which one
    replaced word leaves one whole; the shortest are taken whole.
    """
    masks = {mask: [WINDOW] for mask in MASKS}
    for n in sorted({int(n) for n in lengths}):
        for mask in [range(0, n, 2), range(1, n, 2)] if n >= LEAST_FREE else [range(n)]:
            masks.setdefault(tuple(mask), []).append(n)
    return masks


def _needed(n):
    """Words of a window of ``n`` that must be equal."""
    return EQUAL if n == WINDOW else n - 1 if n >= LEAST_FREE else n


def _item_seeds(masks):
    def run(batches):
        for batch in batches:
            out = [[], [], []]
            for begin, _, data, offsets in pieces(batch.column(1)):
                words, counts = word_hashes(data, offsets)
                for lengths, (seed, row, place) in _seeds(words, counts, masks):
                    n = np.minimum(counts[row], WINDOW)
                    # A short item has one seed a mask, from its first word on.
                    own = np.isin(n, lengths) & ((n == WINDOW) | (place == 0))
                    out[0].append(row[own] + begin)
                    out[1].append(seed[own].view(np.int64))
                    out[2].append(place[own])
            row, seed, place = [np.concatenate(o) if o else np.zeros(0, np.int64) for o in out]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row)), pa.array(seed), pa.array(place)],
                ["item_key", "seed", "item_place"],
            )

    return run


def _bit(seed, probe, bits):
    """One of the places of a seed in the bit table, as a column."""
    return F.shiftrightunsigned(seed, probe * 12).bitwiseAND((1 << bits) - 1)


def _bit_table(seeds, bits):
    """Bits of all item seeds; at most 2^(MOST_BITS - 6) numbers reach the driver."""
    places = seeds.select(
        F.explode(F.array(*[_bit(F.col("seed"), p, bits) for p in range(PROBES)])).alias("bit")
    )
    words = places.groupBy(F.shiftright("bit", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("set")
    )
    table = np.zeros(1 << (bits - 6), np.int64)
    for batch in words.toArrow().to_batches():
        table[batch.column(0).to_numpy()] = batch.column(1).to_numpy()
    return table.view(np.uint8)


def _hits(table, masks, bits):
    low = np.uint64((1 << bits) - 1)

    def run(batches):
        bytes_ = table.value
        for batch in batches:
            rows, found, at = [], [], []
            for begin, end, data, offsets in pieces(batch.column(1)):
                words, counts = word_hashes(data, offsets)
                seeds, owners, places = [], [], []
                for _, (seed, row, place) in _seeds(words, counts, masks):
                    keep = np.arange(len(seed))
                    for probe in range(PROBES):
                        bit = (seed[keep] >> np.uint64(12 * probe)) & low
                        set_ = bytes_[(bit >> np.uint64(3)).astype(np.int64)] >> (bit & np.uint64(7)).astype(np.uint8)
                        keep = keep[set_ & 1 == 1]
                    seeds.append(seed[keep])
                    owners.append(row[keep])
                    places.append(place[keep])
                if not seeds:
                    continue
                seed, owner, place = map(np.concatenate, (seeds, owners, places))
                order = np.argsort(owner, kind="stable")
                each, first = np.unique(owner[order], return_index=True)
                rows += (each + begin).tolist()
                found += np.split(seed[order].view(np.int64), first[1:]) if len(each) else []
                at += np.split(place[order], first[1:]) if len(each) else []
            many = pa.list_(pa.int64())
            taken = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(taken), batch.column(1).take(taken), pa.array(found, many), pa.array(at, many)],
                ["text_key", "text", "seeds", "places"],
            )

    return run


def covered_words(text, item, shifts):
    """Item words inside verified windows, over some alignments of the two."""
    n = min(WINDOW, len(item))
    need = _needed(n)
    best = np.zeros(len(item) + 1, np.int64)
    for shift in shifts:
        begin, end = max(0, -shift), min(len(item), len(text) - shift)
        if end - begin < n:
            continue
        same = np.append(0, np.cumsum(item[begin:end] == text[begin + shift : end + shift]))
        good = np.flatnonzero(same[n:] - same[:-n] >= need) + begin
        np.add.at(best, good, 1)
        np.add.at(best, good + n, -1)
    return int((np.cumsum(best[:-1]) > 0).sum())


def _words_of(column):
    for begin, end, data, offsets in pieces(column):
        words, counts = word_hashes(data, offsets)
        yield from np.split(words, np.cumsum(counts)[:-1])


def _verified():
    def run(batches):
        for batch in batches:
            covered, size = [], []
            shifts = batch.column(4).to_pylist()
            for text, item, own in zip(_words_of(batch.column(2)), _words_of(batch.column(3)), shifts):
                covered.append(covered_words(text, item, own))
                size.append(len(item))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(covered, pa.int64()), pa.array(size, pa.int64())],
                ["text_key", "item_key", "covered", "item_words"],
            )

    return run


def _lengths(batches):
    for batch in batches:
        counts = [len(w) for w in _words_of(batch.column(0))]
        yield pa.RecordBatch.from_arrays([pa.array(counts, pa.int64())], ["n"])


def contaminated_texts(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``text_key, item_id, covered, item_words`` of verified overlaps.

    A text overlaps an item if twelve consecutive words of the item stand in it in
    a row with at most two replaced (A-Z in lower case), or a whole item of 8 to 11
    words with at most one replaced, or a whole shorter item unchanged; null and
    empty items never match. ``covered`` counts item words in such windows. Items of equal text count once,
    under the smallest item_id.
    """
    spark = docs.sparkSession
    items = stage(
        benchmark.select(text_key().alias("item_key"), "text", "item_id")
        .groupBy("item_key")
        .agg(F.first("text").alias("item"), F.min("item_id").alias("item_id")),
        "items",
    )
    lengths = items.select("item").mapInArrow(_lengths, "n bigint")
    short = lengths.where(f"n between 1 and {WINDOW - 1}").distinct().collect()
    masks = _masks(r.n for r in short)
    seeds = stage(
        items.select("item_key", "item").mapInArrow(
            _item_seeds(masks), "item_key binary, seed bigint, item_place bigint"
        ),
        "seeds",
    )
    bits = min(MOST_BITS, max(20, (64 * seeds.count()).bit_length()))
    table = spark.sparkContext.broadcast(_bit_table(seeds, bits))
    hits = stage(
        docs.select(text_key().alias("text_key"), "text")
        .mapInArrow(
            _hits(table, masks, bits),
            "text_key binary, text string, seeds array<bigint>, places array<bigint>",
        )
        .groupBy("text_key")
        .agg(*[F.first(c).alias(c) for c in ("text", "seeds", "places")]),
        "hits",
    )
    shifts = (
        hits.select("text_key", F.explode(F.arrays_zip("seeds", "places")).alias("hit"))
        .select("text_key", F.col("hit.seeds").alias("seed"), F.col("hit.places").alias("place"))
        .join(seeds, "seed")
        .groupBy("text_key", "item_key")
        .agg(F.collect_set(F.col("place") - F.col("item_place")).alias("shifts"))
    )
    return (
        shifts.join(items.select("item_key", "item"), "item_key")
        .join(hits.select("text_key", "text"), "text_key")
        .select("text_key", "item_key", "text", "item", "shifts")
        .mapInArrow(_verified(), "text_key binary, item_key binary, covered bigint, item_words bigint")
        .where("covered > 0")
        .join(items.select("item_key", "item_id"), "item_key")
        .select("text_key", "item_id", "covered", "item_words")
    )


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, contaminated, n_items, item_id, covered_words`` for every row.

    ``item_id`` is the item with the most words covered (the smallest of several),
    null without overlap. Null and empty texts are clean. Rows that repeat are
    judged alike;
    an empty table gives no rows, texts are taken whole, however long, and other
    columns are not read.
    """
    found = stage(
        contaminated_texts(docs, benchmark)
        .groupBy("text_key")
        .agg(
            F.count("*").alias("n_items"),
            F.max(F.struct("covered", (-F.col("item_id")).alias("negative"))).alias("best"),
        ),
        "contaminated",
    )
    return docs.select("doc_id", text_key().alias("text_key")).join(found, "text_key", "left").select(
        "doc_id",
        F.col("n_items").isNotNull().alias("contaminated"),
        F.coalesce("n_items", F.lit(0).cast("bigint")).alias("n_items"),
        (-F.col("best.negative")).alias("item_id"),
        F.coalesce("best.covered", F.lit(0).cast("bigint")).alias("covered_words"),
    )


def without_contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose text overlaps no item, all columns kept.

    Null and empty texts stay, and so do all rows if there is no item; rows that
    repeat are judged alike, an empty table stays empty.
    """
    found = stage(contaminated_texts(docs, benchmark).select("text_key").distinct(), "contaminated")
    return rows_without(docs, found)
